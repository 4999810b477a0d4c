"""Numbered versions of a folder's content, each there as a whole or not at all.

A version is written beside the others and becomes one by an empty file that bears its
number, created last and in one step. Readers take the newest number; what a failed write
left behind has none, and the next write replaces it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from souk.plans.tables import file_system

_COMMITS = "_commits"


def committed(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of complete versions, ascending."""
    files, place = file_system(spark, f"{folder}/{_COMMITS}")
    if not files.exists(place):
        return []
    return sorted(int(found.getPath().getName()) for found in files.listStatus(place))


def commit(spark: SparkSession, folder: str, number: int) -> None:
    """Make version ``number`` one; fails if there is one of that number already."""
    files, place = file_system(spark, f"{folder}/{_COMMITS}/{number}")
    if not files.createNewFile(place):
        raise FileExistsError(f"version {number} of {folder} exists")


def retire(spark: SparkSession, folder: str, number: int, path: str) -> None:
    """Remove version ``number``, which lies in ``path``: the number first."""
    for gone in (f"{folder}/{_COMMITS}/{number}", path):
        files, place = file_system(spark, gone)
        files.delete(place, True)
