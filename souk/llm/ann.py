"""Approximate nearest neighbours by multi-index hashing.

Unit vectors are projected on rotations learned by iterative quantisation and become
binary codes. Codes are split into substrings, each indexed by value. If two codes differ
in at most ``r`` bits, some of ``s`` substrings differs in at most ``r // s``, so probing
every substring's values within that distance finds every code within the radius; found
codes are compared whole, and those within it are ranked by their vectors.

Index and queries form a grid of blocks: a task holds one block of each, whatever the
number of vectors, and copies of one vector are spread like any others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 20_000
BITS = 128
INDEX_BLOCK = 50_000
QUERY_BLOCK = 20_000
_SUBSTRING = 16
_POPCOUNT = np.bitwise_count(np.arange(1 << _SUBSTRING, dtype=np.uint32)).astype(np.uint8)


@dataclass(frozen=True)
class Codes:
    """Projections of unit vectors whose signs are the bits, and the radius to search."""

    projections: np.ndarray
    radius: int

    def of(self, unit: np.ndarray) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        bits = unit @ self.projections > 0
        weights = 1 << np.arange(_SUBSTRING)
        return (bits.reshape(len(unit), -1, _SUBSTRING) * weights).sum(axis=2).astype(np.uint16)


def usable(vector: str, size: int | None = None) -> Column:
    """Whether a vector takes part: no NULL, no component NULL or not finite, not zero."""
    column = F.col(vector).cast("array<double>")
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = ~bad & F.exists(column, lambda x: x != 0)
    return F.coalesce(fine if size is None else fine & (F.size(column) == size), F.lit(False))


def fit(vectors: DataFrame, k: int, bits: int = BITS, sample: int = SAMPLE) -> Codes:
    """Codes learned from the ``sample`` vectors with the smallest hashed ids.

    The radius covers 99 in 100 of the sample's own nearest ``k``, and so more of a whole
    table's, which are nearer. ``vectors`` has columns id and vector, all usable.
    """
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    unit = _unit(_matrix(rows.column("vector")))
    draw = np.random.default_rng(20)
    if not len(unit):
        return Codes(np.zeros((1, bits)), bits)
    size = unit.shape[1]
    width = min(size, bits)
    _, axes = np.linalg.eigh(unit.T @ unit)
    axes = axes[:, ::-1][:, :width]
    projected = unit @ axes
    parts = []
    for _ in range(-(-bits // width)):
        rotation = np.linalg.qr(draw.normal(size=(width, width)))[0]
        for _ in range(30):  # the rotation that brings signs nearest to the projections
            u, _, v = np.linalg.svd(projected.T @ np.sign(projected @ rotation))
            rotation = u @ v
        parts.append(axes @ rotation)
    codes = Codes(np.concatenate(parts, axis=1)[:, :bits], bits)
    if len(unit) <= 2 * k:
        return codes
    asked = draw.choice(len(unit), min(300, len(unit)), replace=False)
    cosines = unit[asked] @ unit.T
    cosines[np.arange(len(asked)), asked] = -2
    near = np.argpartition(-cosines, k, axis=1)[:, :k]
    code = codes.of(unit)
    apart = _POPCOUNT[code[asked][:, None] ^ code[near]].sum(axis=2)
    return Codes(codes.projections, int(np.quantile(apart, 0.99)))


def nearest(
    vectors: DataFrame, queries: Column | None = None, id_col: str = "vec_id",
    vector_col: str = "embedding", k: int = 5, bits: int = BITS,
    index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Rows (query_id, rank, id, score): the ``k`` nearest of each row that ``queries`` picks.

    Nearest is of the largest cosine in double precision on the vectors as given; ties go
    to the smaller id. A query is not its own neighbour: no row of its id is. A query
    with fewer than ``k`` codes in its radius takes the next ones by distance, so that it
    lacks neighbours only where there are none. NULL ids, unusable vectors and those not of
    the commonest length take no part. Rows that repeat an id are one: it has its best
    score. Other columns are ignored.
    """
    chosen = F.lit(True) if queries is None else queries
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(chosen, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & usable("vector"))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(
        F.count("*").alias("held"), F.count_if("asks").alias("asking")
    ).orderBy(F.desc("held"), "size").first()
    size, held, asking = sizes or (0, 0, 0)
    rows = rows.filter(F.size("vector") == size)
    codes = rows.sparkSession.sparkContext.broadcast(fit(rows.select("id", "vector"), k, bits))
    across = max(-(-held // index_block), min(12, -(-held // 2000)), 1)
    down = max(-(-asking // query_block), 1)

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")

    def all_of(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    index = rows.select("id", "vector", dealt(across).alias("i")).select(
        "*", all_of(down).alias("j"))
    asked = rows.filter("asks").select("id", "vector", dealt(down).alias("j")).select(
        "*", all_of(across).alias("i"))

    def search(queries: pa.Table, index: pa.Table) -> pa.Table:
        return _search(queries, index, codes.value, k)

    found = asked.groupBy("i", "j").cogroup(index.groupBy("i", "j")).applyInArrow(
        search, "query_id long, id long, score double"
    )
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score"
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True, initial=0)
    scaled = vectors / np.where(largest > 0, largest, 1)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class Index:
    """Codes by the values of each of their substrings."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parts = []
        for values in codes.T:
            order = np.argsort(values, kind="stable")
            found, counts = np.unique(values, return_counts=True)
            self.parts.append((found, counts, order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes that differ from ``code`` in at most ``radius`` bits."""
        pieces = len(self.parts)
        each, over = divmod(radius, pieces)
        hit = np.zeros(len(self.codes), bool)
        for number, (values, counts, order) in enumerate(self.parts):
            # radius + 1 > pieces * (each) + over: the last substrings may have a bit less.
            reach = each if number <= over else each - 1
            if reach >= 0:
                near = _POPCOUNT[values ^ code[number]] <= reach
                hit[order[np.repeat(near, counts)]] = True
        places = np.flatnonzero(hit)
        apart = _POPCOUNT[self.codes[places] ^ code].sum(axis=1)
        return places[apart <= radius]


def _search(queries: pa.Table, index: pa.Table, codes: Codes, k: int) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.float64())
    out: list[list] = [[], [], []]
    if queries.num_rows and index.num_rows:
        vectors, ids = _matrix(index.column("vector")), index.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        vectors, ids = vectors[order], ids[order]
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        unit = _unit(vectors)
        held = Index(codes.of(unit))
        # Rows that repeat an id must not crowd others out; one more, as a query finds itself.
        enough = (k + 1) * int(np.unique(ids, return_counts=True)[1].max())
        asked, names = _matrix(queries.column("vector")), queries.column("id").to_numpy()
        same, which = np.unique(asked, axis=0, return_inverse=True)
        turned = _unit(same)
        sketch = codes.of(turned)
        for number in range(len(same)):  # copies of a vector ask once
            radius = codes.radius
            places = held.within(sketch[number], radius)
            while len(places) < enough and radius < sketch.shape[1] * _SUBSTRING:
                radius = min(2 * radius + 1, sketch.shape[1] * _SUBSTRING)
                places = held.within(sketch[number], radius)
            for query in names[which == number].tolist():
                others = places[ids[places] != query]
                if not len(others):
                    continue
                rough = unit[others] @ turned[number]
                if len(others) > enough:
                    least = np.partition(rough, len(rough) - enough)[len(rough) - enough]
                    others = others[rough >= least - 1e-9]
                score = (vectors[others] * same[number]).sum(axis=1) / (
                    lengths[others] * np.sqrt((same[number] * same[number]).sum()))
                first = np.lexsort((ids[others], -score))
                first = first[np.sort(np.unique(ids[others[first]], return_index=True)[1])][:k]
                out[0] += [query] * len(first)
                out[1] += ids[others[first]].tolist()
                out[2] += score[first].tolist()
    return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], ["query_id", "id", "score"])
