"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in a fixed number of hash buckets; tasks count
what they read, and only the counts meet. Smoothed log probabilities, languages times
buckets, are broadcast; a batch is scored by looking up its n-grams and adding up runs.
The text is all that a prediction sees.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm.frames import DEALS, added
from souk.llm.text import Texts, slices

UNKNOWN = "und"
BUCKET_BITS = 16
ORDERS = (1, 2, 3)
#: Values in the broadcast matrix: 64 MB in single precision.
MATRIX_LIMIT = 1 << 24
_SLICE = 1 << 20
_PAGE = 1 << 12


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training: by the checksum of its id's decimal digits.

    A NULL id is kept out too, so that it can't leak.
    """
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(True))


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = BUCKET_BITS
) -> Model:
    """A model of the languages in ``lang_col``, from every row that has one.

    NULL languages and texts teach nothing. Languages number at most
    ``MATRIX_LIMIT / 2**bits``; more raise an error, as their matrix would be too large to
    broadcast. No labelled rows give a model that knows no language.
    """
    labelled = docs.select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).filter("lang IS NOT NULL")
    languages = labelled.select("lang").distinct().limit((MATRIX_LIMIT >> bits) + 1).count()
    if languages > MATRIX_LIMIT >> bits:
        raise ValueError(f"more than {MATRIX_LIMIT >> bits} languages")
    pages = labelled.dropna().mapInArrow(
        partial(_count, bits=bits), "deal int, lang string, page int, cells binary")
    rows = added(pages, ["lang", "page"], "int64").to_pylist()  # bounded by the languages
    names = sorted({r["lang"] for r in rows})
    matrix = np.zeros((1 << bits, len(names)), np.int64)
    texts = np.zeros(len(names), np.int64)
    for row in rows:
        at = names.index(row["lang"])
        texts[at], *held = np.frombuffer(row["cells"], np.int64)
        matrix[row["page"] * _PAGE:(row["page"] + 1) * _PAGE, at] = held
    return Model(names, matrix, texts)


class Model:
    """Log probabilities of buckets (rows) in languages (columns), and their priors."""

    def __init__(self, names: list[str], counts: np.ndarray, texts: np.ndarray):
        self.names = names
        smooth = counts + 0.5
        self.logs = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
        self.priors = np.log((texts + 1) / (texts + 1).sum()) if names else np.zeros(0)

    @property
    def bits(self) -> int:
        return int(len(self.logs)).bit_length() - 1


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` and (lang_pred, score).

    ``score`` is the posterior probability of ``lang_pred``, 0 where that is ``und``: the
    text is NULL, empty or without a letter, or the model knows no language. Equal
    posteriors go to the first name. A column already called lang_pred or score is
    replaced.
    """
    kept = [f"`{n}`" for n in docs.columns if n.lower() not in ("lang_pred", "score")]
    rows = docs.select(*kept)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*rows.schema]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(partial(_predict, sent=sent, text_col=text_col), schema)


def predict_beside(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``predict`` with each row of ``docs`` as the struct ``row``, whatever its columns."""
    rows = docs.select(F.struct(*(F.col(f"`{n}`") for n in docs.columns)).alias("row"))
    return predict(rows.withColumn("text", F.col("row")[text_col]), model).drop("text")


def _predict(batches: Iterator[pa.RecordBatch], sent, text_col: str) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for batch, texts in slices(batches, text_col, _SLICE):
        letters = [
            t is not None and any(map(str.isalpha, t)) for t in batch.column(text_col).to_pylist()
        ]
        best, score = scores(texts, model)
        known = np.array(letters, bool) & bool(model.names)
        names = [model.names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))],
            [*batch.schema.names, "lang_pred", "score"],
        )


def scores(texts: Texts, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Each text's best language and its posterior."""
    width = max(1, len(model.names))
    total = np.zeros((len(texts), width))
    if not model.names:
        return np.zeros(len(texts), np.int64), total[:, 0]
    total += model.priors
    for buckets, owner in grams(texts, model.bits):
        if len(buckets):
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            total[owner[first]] += np.add.reduceat(model.logs[buckets], first, dtype=np.float64)
    total -= total.max(axis=1, keepdims=True)
    odds = np.exp(total)
    best = odds.argmax(axis=1)
    return best, odds[np.arange(len(texts)), best] / odds.sum(axis=1)


def grams(texts: Texts, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of code points, per order, and the text of each.

    A-Z count as a-z, and anything in ASCII that is no letter as a space.
    """
    points, bounds = code_points(texts)
    points = _folding()[np.minimum(points, 0x110000)].astype(np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bounds))
    for order in ORDERS:
        count = max(0, len(points) - order + 1)
        mix = np.full(count, order, np.uint32)
        for k in range(order):
            mix = (mix ^ points[k:k + count]) * np.uint32(0x9E3779B1)
            mix ^= mix >> np.uint32(15)
        inside = owner[:count] == owner[order - 1:]
        yield (mix[inside] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits), owner[:count][inside]


def code_points(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts end to end, and each text's bounds among them."""
    data = texts.data
    lead = (data & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(lead)))
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    return points, before[texts.bounds]


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    fold = np.arange(0x110001, dtype=np.uint32)
    for point in range(128):
        fold[point] = ord(chr(point).lower()) if chr(point).isalpha() else 32
    return fold


def _count(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A task's counts per language, in pages of buckets, its number of texts before each."""
    counts: dict[str, np.ndarray] = {}
    texts_of: dict[str, int] = {}
    for batch, texts in slices(batches, "text", _SLICE):
        langs = np.array(batch.column("lang").to_pylist())
        names, which = np.unique(langs, return_inverse=True)
        if len({*counts, *names.tolist()}) > MATRIX_LIMIT >> bits:
            raise ValueError(f"more than {MATRIX_LIMIT >> bits} languages")
        for name, held in zip(names.tolist(), np.bincount(which).tolist()):
            counts.setdefault(name, np.zeros(1 << bits, np.int64))
            texts_of[name] = texts_of.get(name, 0) + held
        for buckets, owner in grams(texts, bits):
            joint = np.bincount(
                (which[owner].astype(np.int64) << bits) | buckets, minlength=len(names) << bits
            ).reshape(len(names), -1)
            for name, more in zip(names.tolist(), joint):
                counts[name] += more
    deal = TaskContext.get().partitionId() % DEALS
    rows = [
        (deal, name, page, np.append(texts_of[name], held).tobytes())
        for name, all_pages in counts.items()
        for page, held in enumerate(all_pages.reshape(-1, _PAGE))
    ]
    if rows:
        kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["deal", "lang", "page", "cells"])

