"""Intermediate results written once and read many times.

A parquet table in a folder that all executors share cuts lineage, outlives lost
executors and, unlike a checkpointed RDD, is read column by column. The folder is
``spark.checkpoint.dir`` or, where a session names none, its warehouse.

Each table has an owner that removes it. ``owned()`` is one: what is written inside it goes
when it ends. What is written outside belongs to the driver and goes when that exits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

SETTINGS = ("spark.checkpoint.dir", "spark.sql.warehouse.dir")



@dataclass
class Owner:
    """What goes together: paths of written tables, and results by what they are of."""

    paths: list[str] = field(default_factory=list)
    results: dict[Any, list] = field(default_factory=dict)


_owned: ContextVar[Owner | None] = ContextVar("owned", default=None)
_drivers: dict[str, Owner] = {}


def owner_of(spark: SparkSession) -> Owner:
    """The owner of what is written now: the innermost ``owned()``, or the application."""
    return _owned.get() or _drivers.setdefault(spark.sparkContext.applicationId, Owner())


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder of the session."""
    for setting in SETTINGS:
        if folder := spark.conf.get(setting, None):
            return folder.rstrip("/")
    raise ValueError(f"set {SETTINGS[0]} to a folder that all executors share")


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, removed by its owner."""
    path = f"{scratch_folder(spark)}/souk-{uuid.uuid4().hex}"
    owner = _owned.get()
    if owner is None:
        files, place = file_system(spark, path)
        files.deleteOnExit(place)
    else:
        owner.paths.append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Run ``df`` now and return the written rows."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Owns what is written inside: results that read it must be used up before the end."""
    owner = Owner()
    token = _owned.set(owner)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in owner.paths:
            files, place = file_system(spark, path)
            files.delete(place, True)


def file_system(spark: SparkSession, path: str):
    """Hadoop's view of where ``path`` is, whatever store that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place
