"""Bounded summaries that tasks read: a bitmap of keys, counters of hashes, sums of pages."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITMAP_BITS = 27
COUNTER_BITS = 19
DEALS = 1 << 10
_PAGE = 1 << 12


def grouped(function: Callable[..., pa.Table], **fixed) -> Callable[[pa.Table], pa.Table]:
    """``function`` with some arguments fixed, typed as ``applyInArrow`` wants it."""

    def call(group: pa.Table) -> pa.Table:
        return function(group, **fixed)

    return call


@dataclass(frozen=True)
class Bitmap:
    """A fixed number of bits; a key that was added is always held, others rarely."""

    bits: np.ndarray
    mask: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = keys.astype(np.int64) & self.mask
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bitmap(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> Bitmap:
    """A bitmap of hashed ``column``: 2**bits bits whatever the number of keys.

    It saves shuffling rows that cannot match. As it fills up it saves less, so callers
    still join by the key itself.
    """
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    pages = keys.select(slot.alias("slot")).groupBy(
        F.shiftright("slot", 15).alias("page")
    ).agg(F.expr("bitmap_construct_agg(slot & 32767)").alias("bits")).toArrow()
    out = np.zeros((1 << (bits - 15), 1 << 12), np.uint8)
    for page, held in zip(pages.column("page").to_pylist(), pages.column("bits").to_pylist()):
        out[page] = np.frombuffer(held, np.uint8)
    return Bitmap(out.reshape(-1), (1 << bits) - 1)


def holds(spark: SparkSession, keys: Bitmap) -> Callable[[Column], Column]:
    """Whether a key may be one of ``keys``: a filter that only the key passes through."""
    sent = spark.sparkContext.broadcast(keys)

    @F.pandas_udf("boolean")
    def held(column: pd.Series) -> pd.Series:
        return pd.Series(sent.value.holds(column.to_numpy()))

    return held


@dataclass(frozen=True)
class Counters:
    """How often a hash occurs, at least as often as it does: hashes share counters."""

    counts: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.counts[(hashes >> np.uint64(11)) & np.uint64(len(self.counts) - 1)]


def column_counts(rows: DataFrame, column: str, bits: int = COUNTER_BITS) -> Counters:
    """Counters of the packed 64-bit hashes in ``column``, 2**bits of them in all."""
    pages = added(
        rows.select(column).mapInArrow(
            partial(_count_pages, column=column, bits=bits), "deal int, page int, cells binary"),
        ["page"], "int64",
    )
    out = np.zeros(1 << bits, np.int64)
    for page, cells in zip(pages.column("page").to_pylist(), pages.column("cells").to_pylist()):
        out[page * _PAGE:(page + 1) * _PAGE] = np.frombuffer(cells, np.int64)
    return Counters(np.minimum(out, 2**31 - 1).astype(np.int32))


def _count_pages(
    batches: Iterator[pa.RecordBatch], column: str, bits: int
) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << bits, np.int64)
    for batch in batches:
        for packed in batch.column(column).to_pylist():
            hashes = np.frombuffer(packed, np.uint64)
            np.add.at(counts, (hashes >> np.uint64(11)) & np.uint64(len(counts) - 1), 1)
    pages = counts.reshape(-1, _PAGE)
    full = np.flatnonzero(pages.any(axis=1))
    deal = TaskContext.get().partitionId() % DEALS
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(full), deal), pa.int32()), pa.array(full, pa.int32()),
         pa.array([pages[p].tobytes() for p in full], pa.binary())],
        ["deal", "page", "cells"],
    )


def added(pages: DataFrame, keys: Sequence[str], dtype: str) -> pa.Table:
    """The sum of the numbers in ``cells`` (packed, of ``dtype``) per value of ``keys``.

    ``pages`` has columns deal, *keys and cells, a row per task and key. ``deal`` spreads the
    tasks, as ``TaskContext.partitionId() % DEALS`` does: pages are added within each deal and
    the deals after that, so that no group holds a page of every task. The result goes to
    the driver; the number of keys and the size of their cells bound it. The sums travel
    compressed: those of mostly zeros are shuffled as so few bytes that one task sends them all.
    """
    types = {f.name: f.dataType.simpleString() for f in pages.schema}
    for dealt in (["deal"], []):
        kept = [*dealt, *keys]
        schema = ", ".join(f"{name} {types[name]}" for name in [*kept, "cells"])
        pages = pages.groupBy(*kept).applyInArrow(
            grouped(_add, keys=tuple(kept), dtype=dtype, packed=not dealt), schema)
    sums = pages.toArrow()
    cells = [zlib.decompress(c) for c in sums.column("cells").to_pylist()]
    return sums.drop_columns("cells").append_column("cells", pa.array(cells, pa.binary()))


def _add(group: pa.Table, keys: tuple[str, ...], dtype: str, packed: bool) -> pa.Table:
    total = None
    for cells in group.column("cells").to_pylist():
        numbers = np.frombuffer(cells, dtype)
        total = numbers.copy() if total is None else total + numbers
    first = {key: group.column(key).slice(0, 1).combine_chunks() for key in keys}
    cells = zlib.compress(total.tobytes(), 1) if packed else total.tobytes()
    return pa.table(first | {"cells": pa.array([cells], pa.binary())})
