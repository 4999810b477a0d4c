"""License scans: exact phrases, and short notices with a bounded number of edits.

A notice that may differ by ``k`` edits is cut into ``k + 1`` seeds, one of which any
such copy must hold unchanged. Seeds are found by plain search in the text's words, and
only the neighbourhoods of finds go to the bounded-error matcher, which verifies the
edits and says where the notice stands. Tasks read whole texts; nothing is shuffled.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.text import Texts, slices

# Phrases that must be found exactly, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Notices, the edits they may have, and their labels.
NOTICES = (
    ("under the mit license", 2, "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", 6, "mit"),
    ("apache license version 2", 2, "apache-2"),
    ("creative commons attribution noncommercial", 3, "cc-by-nc"),
    ("gnu general public license", 2, "gpl"),
    ("gnu lesser general public license", 3, "lgpl"),
    ("mozilla public license", 2, "mpl"),
    ("redistribution and use in source and binary forms with or without modification", 6, "bsd"),
)
_SCHEMA = "n_words long, places array<long>, labels array<string>, " \
    "notices array<struct<label:string,first:long,last:long,edits:int,unchanged:double>>"

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARK = 1  # stands between texts


@dataclass(frozen=True)
class Notice:
    words: bytes
    edits: int
    label: str

    @property
    def seeds(self) -> list[tuple[int, bytes]]:
        """``edits + 1`` pieces with their offsets."""
        cuts = np.linspace(0, len(self.words), self.edits + 2).astype(int).tolist()
        return [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:])]

    @property
    def pattern(self) -> regex.Pattern:
        # A notice starts and ends with whole words.
        body = regex.escape(self.words)
        return regex.compile(rb"(?b)(?<= )(?:" + body + rb"){e<=%d}(?= )" % self.edits)


_NOTICES = [(n, n.seeds, n.pattern) for n in (Notice(t.encode(), k, v) for t, k, v in NOTICES)]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_words, places, labels, notices), one per row of ``docs``.

    Words are runs of a-z, 0-9 and anything beyond ASCII, after A-Z are lower-cased.
    ``places`` are the first words of exact phrases, ascending, from 0, a word once for
    every phrase that starts there; ``labels`` the distinct labels of phrases, sorted;
    ``notices`` what the matcher verified: the notice's label, its first and last word,
    its edits, the share of its letters without one. A NULL or empty text has no words. Other columns are ignored.
    """
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _scan, f"id {kind}, {_SCHEMA}"
    ).withColumnRenamed("id", id_col)


def digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The scan in flat columns. ``score`` is 1 with an exact phrase, else the best
    notice's share of unchanged letters, else 0."""
    labels = F.array_sort(F.array_distinct(F.concat("labels", F.col("notices.label"))))
    best = F.array_max("notices.unchanged")
    return scanned.select(
        id_col, "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                        ("edits", pa.int32()), ("unchanged", pa.float64())])
    for batch, texts in slices(batches, "text"):
        counts, places, labels, notices = found(texts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(counts), pa.array(places, pa.list_(pa.int64())),
             pa.array(labels, pa.list_(pa.string())), pa.array(notices, pa.list_(schema))],
            ["id", "n_words", "places", "labels", "notices"],
        )


def found(texts: Texts):
    """Per text: number of words, places of phrases, their labels, notices."""
    words, starts, firsts, counts = _normalised(texts)
    places: list[list[int]] = [[] for _ in counts]
    labels: list[set[str]] = [set() for _ in counts]
    notices: list[list[tuple]] = [[] for _ in counts]

    def word_at(at: int) -> tuple[int, int]:
        """The text and the number, within it, of the word that holds byte ``at``."""
        word = int(np.searchsorted(starts, at, "right")) - 1
        text = int(np.searchsorted(firsts, word, "right")) - 1
        return text, word - int(firsts[text])

    for phrase, label in PHRASES:
        for match in re.finditer(rb"(?<= )(?=" + phrase.encode() + rb" )", words):
            text, word = word_at(match.start())
            places[text].append(word)
            labels[text].add(label)
    for notice, seeds, pattern in _NOTICES:
        for edits, start, end in _verified(words, notice, pattern, _neighbourhoods(words, notice, seeds)):
            text, first = word_at(start)
            last = word_at(end - 1)[1]
            notices[text].append((notice.label, first, last, edits, 1 - edits / len(notice.words)))
    names = ("label", "first", "last", "edits", "unchanged")
    return (
        counts, [sorted(p) for p in places], [sorted(x) for x in labels],
        [[dict(zip(names, n)) for n in sorted(set(x))] for x in notices],
    )


def _verified(words: bytes, notice: Notice, pattern: regex.Pattern, stretches) -> list[tuple]:
    """Copies (edits, start, end) in the stretches, none of which overlap, the least edited first.

    The matcher gives a stretch's best copy only. What copies leave of a stretch is searched
    again, so that a better copy hides no other.
    """
    taken: list[tuple[int, int, int]] = []
    spans: list[tuple[int, int]] = []  # of those taken, by place
    least = len(notice.words) - notice.edits
    while stretches:
        matches = [(part, pattern.search(words, *part)) for part in stretches]
        found = [(part, (sum(m.fuzzy_counts), *m.span())) for part, m in matches if m]
        for copy in sorted({c for _, c in found}):
            _, start, end = copy
            at = bisect.bisect_left(spans, (start, end))
            if (at == 0 or spans[at - 1][1] <= start) and (at == len(spans) or end <= spans[at][0]):
                spans.insert(at, (start, end))
                taken.append(copy)
        left = set()
        for (low, high), _ in found:
            at = max(0, bisect.bisect_left(spans, (low, low)) - 1)
            while at < len(spans) and spans[at][0] < high:
                left.add((low, spans[at][0]))
                low = max(low, spans[at][1])
                at += 1
            left.add((low, high))
        stretches = sorted((a, b) for a, b in left if b - a > least)
    return taken


def _neighbourhoods(words: bytes, notice: Notice, seeds) -> list[tuple[int, int]]:
    """Stretches that may hold the notice: around finds of its seeds, within one text.

    Only finds that may be of one copy share a stretch, so its length is bounded.
    """
    size, slack = len(notice.words), notice.edits + 1
    near = sorted(
        (max(0, m.start() - offset - slack), min(len(words), m.start() - offset + size + slack))
        for offset, seed in seeds for m in re.finditer(re.escape(seed), words)
    )
    if len(seeds) > 1:  # most finds of one seed have nothing else of the notice around them
        near = [(a, b) for a, b in near if _likely(words[a:b], notice)]
    merged: list[tuple[int, int]] = []
    mark = bytes([_MARK])
    for low, high in near:
        # The matcher must not see across a mark between texts.
        middle = (low + high) // 2
        low = max(low, words.rfind(mark, low, middle) + 1)
        cut = words.find(mark, middle, high)
        high = high if cut < 0 else cut
        if merged and low < merged[-1][1] and low - merged[-1][0] <= 2 * notice.edits:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _likely(near: bytes, notice: Notice) -> bool:
    """Whether enough of the notice's letters are there at all: an edit changes two counts."""
    have = np.bincount(np.frombuffer(near, np.uint8), minlength=256)
    want = np.bincount(np.frombuffer(notice.words, np.uint8), minlength=256)
    return int(np.maximum(want - have, 0).sum()) <= notice.edits


def _normalised(texts: Texts):
    """All words with a space before and after each, a mark as a word after each text.

    Returns the bytes, the byte each word or mark starts at, each text's first word among
    those, and each text's number of words.
    """
    ends = texts.bounds[1:]
    between = np.tile(np.array([32, _MARK, 32], np.uint8), len(ends))
    data = np.insert(_LOWER[texts.data], np.repeat(ends, 3), between)
    inside = _WORD[data]
    inside[ends + 3 * np.arange(len(ends)) + 1] = True  # the marks
    before = np.concatenate(([False], inside[:-1]))
    kept = inside | before
    out = np.where(inside, data, 32)[kept].astype(np.uint8)
    starts = np.flatnonzero((inside & ~before)[kept]) + 1
    marks = out == _MARK
    at_mark = np.flatnonzero(marks[starts - 1])
    firsts = np.concatenate(([0], at_mark[:-1] + 1)).astype(np.int64)
    return b" " + out.tobytes(), starts, firsts, (at_mark - firsts).astype(np.int64)
