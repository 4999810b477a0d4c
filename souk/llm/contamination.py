"""Benchmark decontamination: short test items found inside long documents.

Containment, unlike resemblance, does not shrink with the document: an item of ``n``
shingles is contained when at least ``percent`` of them occur in it. Items are
partitioned by size, and each size has its own signature length: of the item's
``n - ceil(n * percent / 100) + 1`` smallest hashes, its min-hashes, at least one must
occur in every document that contains it. So a document is probed with all its shingles
against the signatures of all sizes, and the items it meets are verified by exact
counts of distinct shingles. No containment is missed, and none is reported wrongly.

The items' hashes are broadcast in blocks of bounded size; a larger benchmark takes one
pass a block. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.text import SHINGLE_WORDS, Words, slices
from souk.plans.tables import materialize

#: Hashes of a broadcast block: 16 bytes each, and an item goes to one block whole.
BLOCK_HASHES = 4_000_000


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", percent: int = 75,
    block_hashes: int = BLOCK_HASHES,
) -> DataFrame:
    """Rows (id, item_ids, shares), one per row of ``docs``, in no order.

    ``item_ids`` are the distinct ids of the items it contains, ascending, and ``shares``
    how much of each item's distinct shingles it holds; of items that repeat an id the most.
    Words and shingles are those of the n-gram join; an item of fewer than five words is
    contained where its words stand in a row. Items or documents that are NULL, empty or
    without words contain nothing and are contained nowhere; items with a NULL id are
    ignored. Repeated rows count each for itself. Other columns are ignored.
    """
    found = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumns(_nothing())
    for block in _blocks(items, item_col, item_text_col, block_hashes, percent):
        found = flagged(found, block)
        if block.more:
            found = materialize(found)
    return found.select(F.col("id").alias(id_col), "item_ids", "shares")


def pairs(found: DataFrame, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """Rows (id, item, containment) of ``contaminated``'s; clean documents have none."""
    hit = F.explode(F.arrays_zip("item_ids", "shares")).alias("hit")
    return found.select(F.col(id_col), hit).select(
        id_col, F.col("hit.item_ids").alias(item_col), F.col("hit.shares").alias("containment"))


def clean_rows(
    docs: DataFrame, items: DataFrame, text_col: str = "text", percent: int = 75
) -> DataFrame:
    """The rows of ``docs`` whose text contains no item of ``items``, all columns kept."""
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("row"))
    found = rows.select("row", F.col("row")[text_col].alias("text")).withColumns(_nothing())
    for block in _blocks(items, "item_id", "text", BLOCK_HASHES, percent):
        found = flagged(found, block)
        if block.more:
            found = materialize(found)
    return found.filter("size(item_ids) = 0").select(
        *(F.col("row")[n].alias(n) for n in names)
    )


def _nothing() -> dict[str, Column]:
    return {
        "item_ids": F.array().cast("array<bigint>"), "shares": F.array().cast("array<double>"),
    }


class Block:
    """Some items' hashes, ready to be met: (hash, item) pairs by hash."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray], words: np.ndarray,
                 percent: int, more: bool):
        self.ids, self.more = ids, more
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.needed = -(-self.sizes * percent // 100)
        self.short = sorted(set(words[(words < SHINGLE_WORDS) & (words > 0)].tolist()))
        kept = self.sizes - self.needed + 1
        self.hashes, self.owner = _by_hash(sets, self.sizes)
        self.signature = np.unique(np.concatenate(
            [s[:k] for s, k in zip(sets, kept)] or [np.zeros(0, np.uint64)]
        ))
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.signature >> np.uint64(42)] = True

    def meets(self, hashes: np.ndarray) -> np.ndarray:
        """Which of ``hashes`` are in a signature."""
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(42)])
        at = np.searchsorted(self.signature, hashes[maybe])
        at = np.minimum(at, len(self.signature) - 1)
        return maybe[self.signature[at] == hashes[maybe]]


def _by_hash(sets: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.concatenate(sets or [np.zeros(0, np.uint64)])
    order = np.argsort(hashes, kind="stable")
    return hashes[order], np.repeat(np.arange(len(sets)), sizes)[order]


def _blocks(
    items: DataFrame, item_col: str, text_col: str, limit: int, percent: int
) -> Iterator[Block]:
    """The items in blocks of about ``limit`` hashes, dealt by hash of their ids."""
    sets = items.select(
        F.col(item_col).cast("bigint").alias("id"), F.col(text_col).alias("text")
    ).dropna(subset=["id"]).mapInArrow(_item_sets, "id long, words long, hashes binary")
    total = sets.agg(F.sum(F.octet_length("hashes") / 8)).first()[0] or 0
    blocks = int(-(-total // limit))
    for number in range(blocks):
        rows = sets.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toArrow()
        held = [np.frombuffer(b, np.uint64) for b in rows.column("hashes").to_pylist()]
        yield Block(
            rows.column("id").to_numpy(), held, rows.column("words").to_numpy(),
            percent, more=number + 1 < blocks,
        )


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, "text"):
        words = Words(texts)
        sets, counts = words.sets(), np.diff(words.bounds)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(some)), pa.array(counts[some]),
             pa.array([sets[i].tobytes() for i in some], pa.binary())],
            ["id", "words", "hashes"],
        )


def flagged(found: DataFrame, block: Block) -> DataFrame:
    """``found`` with the items of ``block`` added to its ``item_ids``."""
    sent = found.sparkSession.sparkContext.broadcast(block)
    return found.mapInArrow(partial(_flag, sent=sent), found.schema)


def _flag(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    block = sent.value
    for batch, texts in slices(batches, "text"):
        met = _met(Words(texts), block)
        if met:
            ids = batch.column("item_ids").to_pylist()
            shares = batch.column("shares").to_pylist()
            for text, items, found in met:
                best = dict(zip(ids[text], shares[text]))
                for item, share in zip(block.ids[items].tolist(), found.tolist()):
                    best[item] = max(share, best.get(item, 0.0))
                ids[text], shares[text] = map(list, zip(*sorted(best.items())))
            for name, values in (("item_ids", ids), ("shares", shares)):
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(
                    at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type)
                )
        yield batch


def _met(words: Words, block: Block) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Texts that contain items: (text, items, their shares)."""
    if not len(block.signature):
        return []
    runs = [words.runs(SHINGLE_WORDS), *(words.runs(n) for n in block.short)]
    texts = np.unique(np.concatenate([owner[block.meets(hashes)] for hashes, owner in runs]))
    out = []
    for text in texts.tolist():
        own = np.concatenate([
            hashes[slice(*np.searchsorted(owner, [text, text + 1]))] for hashes, owner in runs
        ])
        own = np.unique(own)
        low = np.searchsorted(block.hashes, own, "left")
        high = np.searchsorted(block.hashes, own, "right")
        hit = high > low
        places = _ranges(low[hit], high[hit])
        counts = np.bincount(block.owner[places], minlength=len(block.ids))
        items = np.flatnonzero((counts >= block.needed) & (counts > 0))
        if len(items):
            out.append((text, items, counts[items] / block.sizes[items]))
    return out


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``low[0] .. high[0] - 1, low[1] .. high[1] - 1, ...``"""
    sizes = high - low
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - sizes), sizes)


#: The rows of ``pairs`` in DuckDB's SQL.
ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
items AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
item_shingles AS (
  SELECT DISTINCT i, item_id, size, array_to_string(w[p:p + size - 1], ' ') AS shingle FROM (
    SELECT i, item_id, w, least(5, len(w)) AS size, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p
    FROM items WHERE len(w) > 0)),
sizes AS (SELECT i, count(*) AS n FROM item_shingles GROUP BY i),
text_shingles AS (
  SELECT DISTINCT r, doc_id, size, array_to_string(w[p:p + size - 1], ' ') AS shingle FROM (
    SELECT r, doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
    FROM texts, (SELECT DISTINCT size FROM item_shingles) WHERE len(w) >= size)),
met AS (
  SELECT r, doc_id, i, item_id, count(*) AS c FROM text_shingles JOIN item_shingles USING (size, shingle)
  GROUP BY ALL)
SELECT doc_id, item_id, max(c / n) AS containment FROM met JOIN sizes USING (i)
WHERE 100 * c >= 75 * n GROUP BY r, doc_id, item_id
"""
