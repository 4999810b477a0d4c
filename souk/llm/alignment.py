"""Alignment of two tokenizations of the same texts, and counts of linked token pairs.

A task aligns the tokens of some documents at a time: an as-of merge, keyed by document,
finds for each token's first byte the other side's covering token; the union of both
directions is every overlap, and overlaps whose tokens end together cut groups.

Tokens that end together agree on the bytes they share, so one is a suffix of the other.
The vocabularies alone list all such pairs. Every pair has a number in that list, counts of
the corpus are one array of that size, and neither grows with the documents.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.frames import DEALS, added
from souk.llm.text import slices
from souk.plans.tables import materialize

SLICE_BYTES = 1 << 19
_PAGE = 1 << 13
_DIGITS = 7  # of a token's id

# The letters that stand for bytes in a byte-level vocabulary: bytes that print stand for
# themselves, the others, in order, for the code points from 256. Fixed values.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

# --- tokenizers ---------------------------------------------------------------------------------


class ByteLevel:
    """Byte-level BPE read from a JSON file; special tokens in texts are plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        others = [b for b in range(256) if b not in set(_PRINTED)]
        byte_of = {chr(b): b for b in _PRINTED}
        byte_of |= {chr(256 + i): b for i, b in enumerate(others)}
        special = {token["content"] for token in whole["added_tokens"] if token["special"]}
        ranks = {
            bytes(byte_of[letter] for letter in token): number
            for token, number in whole["model"]["vocab"].items() if token not in special
        }
        self.tokens = _listed(ranks)
        # A token's id is its rank, so merging by rank gives the ids of the file's merges.
        self._encoding = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encoding.encode_ordinary(" " + text) for text in texts]


class Pieces:
    """Pieces with byte fallback; the model itself puts a space before the text."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [self._bytes(i) for i in range(self._model.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self._model.id_to_piece(number)
        if self._model.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def _listed(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, number in ranks.items():
        tokens[number] = token
    return tokens


@lru_cache(maxsize=2)
def _sides(paths: tuple[str, str]) -> tuple[ByteLevel, Pieces]:
    """The two tokenizers, read once a worker."""
    return ByteLevel(paths[0]), Pieces(paths[1])


@dataclass(frozen=True)
class Pairs:
    """All pairs of an A and a B token of which one ends with the other, numbered.

    ``keys`` is ascending, ``a << 32 | b``; a token has at most its length of suffixes, so
    the vocabularies bound their number.
    """

    keys: np.ndarray

    @staticmethod
    def of(a_tokens: list[bytes], b_tokens: list[bytes]) -> Pairs:
        def suffixes(ours: list[bytes], theirs: list[bytes]) -> Iterator[tuple[int, int]]:
            ids: dict[bytes, list[int]] = {}
            for number, token in enumerate(theirs):
                if token:
                    ids.setdefault(token, []).append(number)
            for number, token in enumerate(ours):
                for cut in range(len(token)):
                    for other in ids.get(token[cut:], ()):
                        yield number, other

        keys = {a << 32 | b for a, b in suffixes(a_tokens, b_tokens)}
        keys |= {a << 32 | b for b, a in suffixes(b_tokens, a_tokens)}
        return Pairs(np.array(sorted(keys), np.int64))

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, a.astype(np.int64) << 32 | b)

    def best(self, counts: np.ndarray) -> np.ndarray:
        """Whether a pair's count is the highest that its B token has."""
        b = self.keys & 0xFFFFFFFF
        highest = np.zeros(int(b.max(initial=0)) + 1, np.int64)
        np.maximum.at(highest, b, counts)
        return counts == highest[b]


# --- one batch ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Side:
    """The tokens of some documents, in order: their ids, documents and bytes [start, end).

    Bytes are counted over all documents, of which both sides have the same bytes; ``bounds``
    cuts the tokens by document.
    """

    ids: np.ndarray
    docs: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of(ids: list[list[int]], lengths: np.ndarray) -> Side:
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        bounds = np.append(0, np.cumsum(counts))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(bounds[-1]))
        ends = np.cumsum(lengths[flat])
        docs = np.repeat(np.arange(len(ids)), counts)
        return Side(flat, docs, ends - lengths[flat], ends, bounds)


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of A and of B, as places in the two lists, that share a byte.

    Of two that overlap one starts within the other, so a backward as-of merge of either
    side's starts with the other's finds them all; those that start together come twice.
    """
    left = pd.DataFrame({"start": a.starts, "doc": a.docs, "a": np.arange(len(a.ids))})
    right = pd.DataFrame({"start": b.starts, "doc": b.docs, "b": np.arange(len(b.ids))})
    in_b = pd.merge_asof(left, right, on="start", by="doc")
    in_a = pd.merge_asof(right, left, on="start", by="doc")
    twice = a.starts[in_a["a"].to_numpy()] == b.starts[in_a["b"].to_numpy()]
    pairs = pd.concat([in_b[["a", "b"]], in_a.loc[~twice, ["a", "b"]]])
    return pairs["a"].to_numpy(), pairs["b"].to_numpy()


def ending_together(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The overlapping tokens with the same last byte, in order of the text."""
    of_a, of_b = overlaps(a, b)
    same = a.ends[of_a] == b.ends[of_b]
    order = np.argsort(of_a[same])
    return of_a[same][order], of_b[same][order]


def _written(a: Side, b: Side, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
    """The groups of all documents as ``a1,a2|b1;a3|b2,b3``, a row of bytes a token.

    A row is a decimal id and the sign after it, zeros before; rows follow the text, the A
    tokens of a group before its B tokens.
    """
    rows = []
    for side, ids, last, sign in ((0, a.ids, last_a, b"|"), (1, b.ids, last_b, b";")):
        signs = np.full(len(ids), b","[0], np.uint8)
        signs[last] = sign[0]
        group = np.searchsorted(last, np.arange(len(ids)))
        digits = np.zeros((len(ids), _DIGITS + 1), np.uint8)
        digits[:, _DIGITS], digits[:, _DIGITS - 1] = signs, ids % 10 + 48
        for place in range(1, _DIGITS):
            rest = ids // 10 ** place
            digits[:, _DIGITS - 1 - place] = np.where(rest > 0, rest % 10 + 48, 0)
        rows.append((group * 2 + side, digits))
    order = np.argsort(np.concatenate([rows[0][0], rows[1][0]]), kind="stable")
    return np.concatenate([rows[0][1], rows[1][1]])[order]


def _hashes(a: Side, b: Side, last_a: np.ndarray, last_b: np.ndarray) -> list[str]:
    """Per document the SHA-256 of its groups; '' without tokens."""
    written = _written(a, b, last_a, last_b)
    bounds = a.bounds + b.bounds
    used = written != 0
    cuts = np.append(0, np.cumsum(used.sum(axis=1)))[bounds]
    flat = written[used].tobytes()
    return [
        hashlib.sha256(flat[low:high - 1]).hexdigest() if high > low else ""
        for low, high in zip(cuts.tolist(), cuts[1:].tolist())
    ]


class Tokenized:
    """Texts encoded by both sides; those whose tokens don't give the text back have none."""

    def __init__(self, texts: list[str | None], a: ByteLevel, b: Pieces):
        texts = [text or "" for text in texts]
        wanted = [b" " + text.encode() if text else b"" for text in texts]
        encoded = []
        for side in (a, b):
            ids = side.encode(texts)
            token = side.tokens.__getitem__
            encoded.append((ids, [b"".join(map(token, one)) for one in ids]))
        (ids_a, bytes_a), (ids_b, bytes_b) = encoded
        whole = [bool(w) and w == x == y for w, x, y in zip(wanted, bytes_a, bytes_b)]
        self.a = Side.of([i if w else [] for i, w in zip(ids_a, whole)], _lengths(a))
        self.b = Side.of([i if w else [] for i, w in zip(ids_b, whole)], _lengths(b))


def _lengths(side: ByteLevel | Pieces) -> np.ndarray:
    return np.fromiter(map(len, side.tokens), np.int64, len(side.tokens))


# --- operators ----------------------------------------------------------------------------------


def aligned(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    One per row of ``docs``, repeated rows included. A, byte-level, encodes a space and the
    text, B the text. Texts that are NULL or empty, or that either side's tokens don't spell
    out, have no tokens: counts of zero and ''. A link is two tokens that end at the same
    byte; a pair of ids counts as often as the corpus links it. ``n_best`` counts links whose
    pair is among their B id's most frequent, ``count_sum`` adds up the counts of all links.
    Texts are encoded once: what the counts are looked up for is written between the passes.
    An id may be NULL; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    a, b = _sides((a_path, b_path))
    pairs = spark.sparkContext.broadcast(Pairs.of(a.tokens, b.tokens))
    links = materialize(_texts(docs, id_col, text_col).mapInArrow(
        partial(_linked, paths=(a_path, b_path), pairs=pairs),
        f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs binary, times binary",
    ))
    counts = _counted(links, len(pairs.value.keys))
    known = spark.sparkContext.broadcast((counts, pairs.value.best(counts)))
    return links.mapInArrow(
        partial(_summed, known=known),
        f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups_sha256 string",
    ).withColumnRenamed("id", id_col)


def overlapping(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, a_id, b_id, start, end, together): every overlap of two tokens.

    ``start`` and ``end`` are bytes of the space and the text, ``together`` tells whether the
    two tokens end there both.
    """
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(
        partial(_overlapping, paths=(a_path, b_path)),
        f"id {kind}, a_id int, b_id int, start long, end long, together boolean",
    ).withColumnRenamed("id", id_col)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def _overlapping(
    batches: Iterator[pa.RecordBatch], paths: tuple[str, str]
) -> Iterator[pa.RecordBatch]:
    for batch, _ in slices(batches, "text", SLICE_BYTES):
        both = Tokenized(batch.column("text").to_pylist(), *_sides(paths))
        a, b = both.a, both.b
        of_a, of_b = overlaps(a, b)
        first = np.append(a.starts, 0)[a.bounds[a.docs[of_a]]]  # byte of the document's start
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(a.docs[of_a])),
             pa.array(a.ids[of_a], pa.int32()), pa.array(b.ids[of_b], pa.int32()),
             pa.array(np.maximum(a.starts[of_a], b.starts[of_b]) - first),
             pa.array(np.minimum(a.ends[of_a], b.ends[of_b]) - first),
             pa.array(a.ends[of_a] == b.ends[of_b])],
            ["id", "a_id", "b_id", "start", "end", "together"],
        )


def _linked(
    batches: Iterator[pa.RecordBatch], paths: tuple[str, str], pairs
) -> Iterator[pa.RecordBatch]:
    for batch, _ in slices(batches, "text", SLICE_BYTES):
        both = Tokenized(batch.column("text").to_pylist(), *_sides(paths))
        a, b = both.a, both.b
        last_a, last_b = ending_together(a, b)
        numbers = pairs.value.numbers(a.ids[last_a], b.ids[last_b])
        bounds = np.searchsorted(a.docs[last_a], np.arange(batch.num_rows + 1))
        held = [
            np.unique(numbers[low:high], return_counts=True)
            for low, high in zip(bounds.tolist(), bounds[1:].tolist())
        ]
        # Each group ends in one link.
        ended = pa.array(np.diff(bounds))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(np.diff(a.bounds)), pa.array(np.diff(b.bounds)),
             ended, ended, pa.array(_hashes(a, b, last_a, last_b), pa.string()),
             pa.array([which.astype("<u4").tobytes() for which, _ in held], pa.binary()),
             pa.array([times.astype("<u4").tobytes() for _, times in held], pa.binary())],
            ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
        )


def _counted(links: DataFrame, size: int) -> np.ndarray:
    """How often the corpus links each of the ``size`` pairs."""
    pages = added(
        links.select("pairs", "times").mapInArrow(
            partial(_count, size=size), "deal int, page int, cells binary"),
        ["page"], "int64",
    )
    counts = np.zeros(-(-size // _PAGE) * _PAGE, np.int64)
    for row in pages.to_pylist():
        low = row["page"] * _PAGE
        counts[low:low + _PAGE] = np.frombuffer(row["cells"], np.int64)
    return counts[:size]


def _count(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((-(-size // _PAGE), _PAGE), np.int64)
    flat = counts.reshape(-1)
    for batch in batches:
        for which, times in zip(batch.column("pairs"), batch.column("times")):
            flat[np.frombuffer(which.as_buffer(), "<u4")] += np.frombuffer(times.as_buffer(), "<u4")
    used = np.flatnonzero(counts.any(axis=1))
    deal = TaskContext.get().partitionId() % DEALS
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(used), deal), pa.int32()), pa.array(used, pa.int32()),
         pa.array([counts[page].tobytes() for page in used], pa.binary())],
        ["deal", "page", "cells"],
    )


def _summed(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:
    counts, best = known.value
    for batch in batches:
        n_best, count_sum = [], []
        for which, times in zip(batch.column("pairs"), batch.column("times")):
            own = np.frombuffer(which.as_buffer(), "<u4")
            held = np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
            n_best.append(int(held[best[own]].sum()))
            count_sum.append(int(held @ counts[own]))
        kept = ["id", "n_a", "n_b", "n_groups", "n_links"]
        yield pa.RecordBatch.from_arrays(
            [*map(batch.column, kept), pa.array(n_best, pa.int64()),
             pa.array(count_sum, pa.int64()), batch.column("groups_sha256")],
            [*kept, "n_best", "count_sum", "groups_sha256"],
        )
