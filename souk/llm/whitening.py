"""Whitening of embeddings: leading components of their covariance, scaled to unit variance.

Vectors become whole numbers, so sums, and products of what is left after subtracting a
whole number near the mean, are exact whatever the order in which tasks add them. The
covariance is divided out once, its leading eigenvectors come from ``spectrum``, and the
covariance of what was whitened is measured on all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm import spectrum
from souk.llm.frames import DEALS, added

COMPONENTS = 32
STEPS, SHIFT = 64, 1_000_000
#: Whole numbers beyond this take no part: sums of pairs of them still fit a long.
LARGEST = 1 << 60
#: Numbers of a batch handled at once, and of a page of products.
_BLOCK, _PAGE = 1 << 20, 1 << 13
_LIMB = 21


@dataclass(frozen=True)
class Fit:
    """What whitens vectors of one length.

    ``centre`` is a whole vector near the mean, ``left`` the sums of what remains after
    subtracting it from all ``n`` vectors. ``vectors`` are components as columns.
    """

    n: int
    centre: np.ndarray
    left: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.centre) - self.left / self.n

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)**2 of whole rows; None beyond a long."""
        apart = rows - self.centre
        most = self.n * int(np.abs(apart).max(initial=0)) + int(np.abs(self.left).max(initial=0))
        if most * most * max(1, rows.shape[1]) < 1 << 63:
            return ((self.n * apart - self.left) ** 2).sum(axis=1).tolist()
        exact = ((self.n * apart.astype(object) - self.left.astype(object)) ** 2).sum(axis=1)
        return [total if total < 1 << 63 else None for total in exact]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: it is not NULL, all entries are finite and none too large."""
    bound = (LARGEST - SHIFT) / STEPS
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < bound))
    return F.coalesce(fine, F.lit(False))


def fit(vectors: DataFrame, vector_col: str = "embedding", most: int = COMPONENTS) -> dict[int, Fit]:
    """A fit per length of the usable vectors: ``most`` components of falling variance.

    Vectors of different length have no common covariance, so each length is a fit of its
    own. A length whose vectors are all equal, or empty, has no components. What reaches
    the driver is bounded by the length of vectors, squared, not by their number.
    """
    rows = _rows(vectors, None, vector_col)
    fits = {}
    for size, sums in _sums(rows).items():
        n = int(sums[0])
        means = sums[1:]
        centre = np.array([(2 * int(s) + n) // (2 * n) for s in means], np.int64)
        left = np.array([int(s) - n * int(c) for s, c in zip(means, centre)], np.int64)
        fits[size] = Fit(n, centre, left, np.zeros(0), np.zeros((size, 0)), np.zeros(0))
    for size, products in _products(rows, fits, _apart).items():
        fits[size] = _solved(fits[size], products, most)
    for size, products in _products(rows, fits, Fit.whiten).items():
        error = np.abs(products / fits[size].n - np.eye(len(products)))
        fits[size] = replace(fits[size], identity_error=float(error.max(initial=0.0)))
    return fits


def components(
    vectors: DataFrame, fits: dict[int, Fit], id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error).

    One per usable vector, repeated rows included, and component of its length's fit, from
    1. Vectors that are NULL or hold NULL, NaN, infinite or too large entries have none.
    ``deviation`` is n squared times the squared distance to the mean, exact, or NULL where
    that is beyond a long. An id may be NULL; other columns are ignored.
    """
    kind = vectors.select(id_col).schema[0].dataType.simpleString()
    sent = vectors.sparkSession.sparkContext.broadcast(fits)
    return _rows(vectors, id_col, vector_col).mapInArrow(
        partial(_components, fits=sent),
        f"id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double",
    ).withColumnRenamed("id", id_col)


def whiten(
    vectors: DataFrame, fits: dict[int, Fit], id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows (id, whitened) of usable vectors, all components of a vector in an array."""
    kind = vectors.select(id_col).schema[0].dataType.simpleString()
    sent = vectors.sparkSession.sparkContext.broadcast(fits)
    return _rows(vectors, id_col, vector_col).mapInArrow(
        partial(_whitened, fits=sent), f"id {kind}, whitened array<double>"
    ).withColumnRenamed("id", id_col)


# --- statistics ---------------------------------------------------------------------------------


def _rows(vectors: DataFrame, id_col: str | None, vector_col: str) -> DataFrame:
    own = [] if id_col is None else [F.col(id_col).alias("id")]
    rows = vectors.select(*own, F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.filter(usable(F.col("vector")))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of one length, some at a time, with their whole numbers as a matrix."""
    for batch in batches:
        sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            own = batch if len(np.unique(sizes)) == 1 else batch.filter(pa.array(sizes == size))
            step = max(1, _BLOCK // max(1, int(size)))
            for start in range(0, own.num_rows, step):
                rows = own.slice(start, step)
                numbers = rows.column("vector").flatten().to_numpy(zero_copy_only=False)
                whole = np.floor(STEPS * numbers).astype(np.int64) + SHIFT
                yield rows, whole.reshape(rows.num_rows, int(size))


def _deal() -> int:
    return TaskContext.get().partitionId() % DEALS


_PAGES = "deal int, size int, page int, cells binary"


def _paged(totals: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (size, page), cells in totals.items():
        yield pa.RecordBatch.from_pylist(
            [{"deal": _deal(), "size": size, "page": page, "cells": cells.tobytes()}],
            pa.schema([("deal", pa.int32()), ("size", pa.int32()), ("page", pa.int32()),
                       ("cells", pa.binary())]),
        )


def _sums(rows: DataFrame) -> dict[int, list[int]]:
    """Per length: the number of vectors, then the exact sum of each dimension."""
    pages = added(rows.mapInArrow(_sum_limbs, _PAGES), ["size", "page"], "int64")
    sums: dict[int, list[int]] = {}
    for row in sorted(pages.to_pylist(), key=lambda r: r["page"]):
        limbs = np.frombuffer(row["cells"], np.int64).tolist()
        held = sums.setdefault(row["size"], [0] * len(limbs))
        sums[row["size"]] = [a + (b << _LIMB * row["page"]) for a, b in zip(held, limbs)]
    return sums


def _sum_limbs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums in three parts of 21 bits, which thousands of billions of rows don't overflow."""
    totals: dict[tuple[int, int], np.ndarray] = {}
    for _, whole in _blocks(batches):
        counted = np.column_stack([np.ones(len(whole), np.int64), whole])
        for page in range(3):
            limbs = counted >> _LIMB * page
            if page < 2:
                limbs &= (1 << _LIMB) - 1
            key = whole.shape[1], page
            totals[key] = totals.get(key, 0) + limbs.sum(axis=0)
    return _paged(totals)


def _apart(fit: Fit, rows: np.ndarray) -> np.ndarray:
    return (rows - fit.centre).astype(np.float64)


def _products(
    rows: DataFrame, fits: dict[int, Fit], function: Callable[[Fit, np.ndarray], np.ndarray]
) -> dict[int, np.ndarray]:
    """Per length: sums over all rows of the products of each two entries of ``function``."""
    sent = rows.sparkSession.sparkContext.broadcast(fits)
    pages = added(
        rows.mapInArrow(partial(_multiply, fits=sent, function=function), _PAGES),
        ["size", "page"], "float64",
    )
    parts: dict[int, list[np.ndarray]] = {}
    for row in sorted(pages.to_pylist(), key=lambda r: r["page"]):
        parts.setdefault(row["size"], []).append(np.frombuffer(row["cells"], np.float64))
    out = {}
    for size, cells in parts.items():
        flat = np.concatenate(cells)
        out[size] = flat.reshape(round(len(flat) ** 0.5), -1) if len(flat) else np.zeros((0, 0))
    return out


def _multiply(
    batches: Iterator[pa.RecordBatch], fits, function: Callable[[Fit, np.ndarray], np.ndarray]
) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for _, whole in _blocks(batches):
        size = whole.shape[1]
        entries = function(fits.value[size], whole)
        totals[size] = totals.get(size, 0) + entries.T @ entries
    pages = {}
    for size, total in totals.items():
        step = max(1, _PAGE // max(1, len(total)))
        for page, start in enumerate(range(0, len(total), step)):
            pages[size, page] = total[start:start + step]
    return _paged(pages)


def _solved(fit: Fit, products: np.ndarray, most: int) -> Fit:
    """``fit`` with its components; the covariance is rounded once, from whole numbers."""
    n, size = fit.n, len(products)
    left = fit.left.tolist()
    covariance = np.array([
        [(n * int(products[i, j]) - left[i] * left[j]) / n ** 2 for j in range(size)]
        for i in range(size)
    ]).reshape(size, size)
    values, vectors = spectrum.leading(covariance, most)
    trace = float(np.trace(covariance))
    return replace(fit, values=values, vectors=vectors, explained=values / (trace or 1.0))


# --- rows ---------------------------------------------------------------------------------------


def _components(batches: Iterator[pa.RecordBatch], fits) -> Iterator[pa.RecordBatch]:
    for batch, whole in _blocks(batches):
        fit = fits.value[whole.shape[1]]
        rows, count = len(whole), len(fit.values)
        if not count:
            continue
        which = pa.array(np.repeat(np.arange(rows), count))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(which),
             pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()),
             pa.array(np.full(rows * count, fit.n)),
             pa.array(fit.deviations(whole), pa.int64()).take(which),
             pa.array(fit.whiten(whole).reshape(-1)),
             pa.array(np.tile(fit.explained, rows)),
             pa.array(np.full(rows * count, fit.identity_error))],
            ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        )


def _whitened(batches: Iterator[pa.RecordBatch], fits) -> Iterator[pa.RecordBatch]:
    for batch, whole in _blocks(batches):
        out = fits.value[whole.shape[1]].whiten(whole)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(list(out), pa.list_(pa.float64()))], ["id", "whitened"])
