"""Near copies, contained items and repeated bytes against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from souk.llm import contamination, ngram_join, repeats
from souk.llm.components import components
from souk.llm.frames import added, bitmap
from souk.llm.text import Fingerprints, Words, as_texts
from tests.llm import brute

DOCS = "doc_id long, text string, key string, n long, component_id string, item_ids string"


def words(draw, count, vocabulary=4000):
    return [f"w{draw.randrange(vocabulary)}" for _ in range(count)]


def edited(draw, text, edits):
    text = list(text)
    for _ in range(edits):
        text[draw.randrange(len(text))] = f"e{draw.randrange(10**6)}"
    return text


def frame(spark, rows, schema=DOCS):
    """Rows (id, text), with columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, t, "k", 1, "c", "x") for i, t in rows], schema)


@pytest.fixture(scope="module")
def crowd():
    """Near copies by the dozen, exact copies, odd texts, repeated and nameless rows."""
    draw = random.Random(11)
    base, line = words(draw, 120), words(draw, 30)
    texts = [edited(draw, base, draw.randrange(6)) for _ in range(60)]
    texts += [words(draw, draw.randrange(3, 60)) + line for _ in range(40)]
    texts += [words(draw, 80) for _ in range(20)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(200, None), (201, ""), (202, " \t\n "), (203, "one two"), (204, "ONE  Two"),
             (205, "one two three"), (None, rows[70][1]), (None, "nobody else writes like this here"),
             (300, rows[75][1]), (300, rows[75][1]), (5, rows[5][1]), (301, "a " * 3000)]
    draw.shuffle(rows)
    return rows


def by_row(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("block", [512, 7])
def test_groups_equal_brute_force(spark, crowd, block):
    found = ngram_join.ngram_join(frame(spark, crowd), block=block).collect()
    assert by_row(found) == by_row(brute.groups(crowd))


def test_threshold_is_met_exactly(spark):
    # 16 shingles, of which 12 in common with a set of 12: exactly three quarters.
    text = [f"t{i}" for i in range(20)]
    rows = [(1, " ".join(text)), (2, " ".join(text[:16])), (3, " ".join(text[:15]))]
    assert by_row(ngram_join.ngram_join(frame(spark, rows)).collect()) == by_row(brute.groups(rows))


def test_no_documents(spark):
    empty = frame(spark, [])
    assert ngram_join.ngram_join(empty).collect() == []
    assert ngram_join.one_of_each(empty).collect() == []
    assert repeats.repeated(empty).collect() == []
    assert contamination.contaminated(empty, empty, item_col="doc_id").collect() == []


def test_one_of_each_group_stays(spark, crowd):
    kept = ngram_join.one_of_each(frame(spark, crowd))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    named = [(i, t) for i, t in crowd if i is not None]
    wanted = {(i, t) for (i, t), (_, n, first) in zip(crowd, brute.groups(crowd))
              if i is not None and (not n or i == first)}
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert {r for r in rows if r[0] is not None} == wanted
    assert len([r for r in rows if r[0] is not None]) == len(wanted) and len(named) > len(wanted)
    assert [r for r in rows if r[0] is None] == [(None, "nobody else writes like this here")]


def test_facts_of_a_large_group_meet_its_rows_in_many_tasks(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 3900, 7).otherwise(F.col("id")).alias("leader"), F.col("id").alias("set"))
    facts = spark.createDataFrame([(7, "large"), (8, "nobody's")], "leader long, fact string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", False)
        met = ngram_join._beside(rows, facts, "left").withColumn("task", F.spark_partition_id()).toPandas()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted(met["set"]) == list(range(4000)) and list(met.columns) == ["leader", "set", "fact", "task"]
    assert ((met.fact == "large") == (met["set"] < 3900)).all()
    assert met[met.leader == 7].groupby("task").size().max() < 2000
    assert ngram_join._beside(rows, facts).count() == 3900


def test_components(spark):
    draw = random.Random(2)
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 101 + i) for i in range(30)]
    edges = chain + star + [(7, 7), (500, 500), (101, 600), (3, 2), (3, 2), (None, 4)]
    draw.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 131)},
                   500: 500, 600: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_bitmap_holds_every_key(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("key"))
    held = bitmap(keys, "key", bits=20)
    values = keys.toPandas()["key"].to_numpy()
    assert held.holds(values).all() and held.holds(values + 1).mean() < 0.05


def test_sums_of_mostly_zeros_reach_the_driver_small(spark, monkeypatch):
    numbers = np.zeros(1 << 12, np.int64)
    numbers[[3, 70]] = 2**40, -5
    rows = [(deal, page, numbers.tobytes()) for deal in (0, 1) for page in range(100)]
    pages = spark.createDataFrame(rows, "deal int, page int, cells binary")
    received = []
    fetch = type(pages).toArrow
    monkeypatch.setattr(
        type(pages), "toArrow", lambda df: received.append(fetch(df)) or received[-1])
    sums = added(pages, ["page"], "int64")
    assert sorted(sums.column("page").to_pylist()) == list(range(100))
    assert set(sums.column("cells").to_pylist()) == {(2 * numbers).tobytes()}
    assert received[0].nbytes < sums.nbytes / 20
    assert sums.schema.names == ["page", "cells"]
    assert added(pages.limit(0), ["page"], "int64").num_rows == 0


def test_words_and_fingerprints():
    texts = as_texts(pa.array(["The cat\tSAT", None, "", "x", "the  CAT sat on the mat"]))
    found = Words(texts)
    assert np.diff(found.bounds).tolist() == [3, 0, 0, 1, 6]
    assert (found.hashes[:3] == found.hashes[4:7]).all()
    assert [len(s) for s in found.sets()] == [1, 0, 0, 1, 2]
    data = np.frombuffer(b"abcabcabd", np.uint8)
    prints = Fingerprints(data)
    a, b, c = prints.of(np.array([0, 3, 6]), np.array([3, 6, 9]))
    assert a == b != c and (prints.windows(3)[[0, 3, 6]] == [a, b, c]).all()


# --- contained items ------------------------------------------------------------------------


@pytest.mark.parametrize("block_hashes", [4_000_000, 40])
def test_contained_items_equal_brute_force(spark, block_hashes):
    draw = random.Random(4)
    items = [(i, " ".join(words(draw, draw.randrange(1, 40)))) for i in range(25)]
    items += [(3, items[4][1]), (30, None), (31, ""), (None, items[0][1]), (32, "x1 x2 x3")]
    rows = []
    for i in range(60):
        text = words(draw, draw.randrange(200))
        for _ in range(draw.randrange(3)):
            part = edited(draw, items[draw.randrange(25)][1].split(), draw.randrange(3))
            at = draw.randrange(len(text) + 1)
            text[at:at] = part[:draw.randrange(len(part) // 2, len(part) + 1)]
        rows.append((i, " ".join(text)))
    rows += [(70, None), (71, ""), (72, "a X1 x2\nX3 b"), (None, items[8][1]), (5, rows[5][1])]
    benchmark = spark.createDataFrame(
        [(i, t, 0) for i, t in items], "item_id long, text string, containment int")
    docs = frame(spark, rows)
    found = contamination.contaminated(docs, benchmark, block_hashes=block_hashes).collect()
    assert by_row((r.doc_id, r.item_ids) for r in found) == by_row(
        (i, brute.contained(t, items)) for i, t in rows)
    assert all(len(r.shares) == len(r.item_ids) and all(s >= 0.75 for s in r.shares) for r in found)
    listed = contamination.pairs(contamination.contaminated(docs, benchmark)).collect()
    assert by_row((r.doc_id, r.item_id) for r in listed) == by_row(
        (i, item) for i, t in rows for item in brute.contained(t, items))
    clean = contamination.clean_rows(docs, benchmark)
    assert clean.columns == docs.columns
    assert by_row((r.text,) for r in clean.collect()) == by_row(
        (t,) for _, t in rows if not brute.contained(t, items))
    nothing = contamination.contaminated(docs, benchmark.limit(0)).collect()
    assert all(r.item_ids == r.shares == [] for r in nothing)


# --- repeated bytes ---------------------------------------------------------------------------


@pytest.mark.parametrize("size", [400, 180])
def test_removed_bytes_equal_brute_force(spark, size):
    draw = random.Random(6)

    def letters(count):
        return "".join(draw.choice("abcdefghijé ") for _ in range(count))

    shared = [letters(n) for n in (size - 1, size, size + 1, size + 60, 3 * size)]
    rows = [(i, letters(draw.randrange(300)) + draw.choice(shared)[draw.randrange(20):]
             + letters(draw.randrange(200)) + draw.choice(shared)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "a" * 1000), (103, "ab" * 700), (104, "z" * size),
             (None, rows[0][1]), (7, rows[7][1]), (105, letters(4000)), (106, "é" * size)]
    got = repeats.repeated(frame(spark, rows), size=size)
    flags = brute.repeated_bytes([t for _, t in rows], size)
    wanted = []
    for (i, text), flag in zip(rows, flags):
        data = (text or "").encode()
        kept = bytes(b for b, gone in zip(data, flag) if not gone)
        wanted.append((i, len(data), brute.runs(flag), kept))
    assert by_row((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept))
                  for r in got.collect()) == by_row(wanted)
    digests = repeats.digests(got).collect()
    assert by_row(digests) == by_row(
        (i, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for i, n, spans, kept in wanted)


def test_words_that_swap_halves_are_told_apart():
    """Each next half swaps two letters: equal modulo any power of two, whatever the base."""
    import pyarrow as pa

    from souk.llm.text import Fingerprints, Words, as_texts

    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
        swapped = word.translate(str.maketrans("ab", "ba"))
        texts = as_texts(pa.array([word, swapped]))
        for seed in range(3):
            one, other = Fingerprints(texts.data, seed).of(texts.bounds[:-1], texts.bounds[1:])
            assert one != other
        assert len(np.unique(Words(texts).hashes)) == 2


def test_fingerprints_are_those_of_the_bytes():
    import pyarrow as pa

    from souk.llm.text import Fingerprints, as_texts

    draw = random.Random(5)
    data = as_texts(pa.array(["".join(draw.choice("ab") for _ in range(3000))])).data
    prints = Fingerprints(data, 1)
    assert np.array_equal(prints.windows(9), prints.of(
        np.arange(len(data) - 8), np.arange(9, len(data) + 1)))
    names = {}
    for start in range(0, len(data) - 20):
        for size in (1, 7, 20):
            piece = data[start:start + size].tobytes()
            name = int(prints.of(np.array([start]), np.array([start + size]))[0])
            assert names.setdefault(piece, name) == name
    assert len(set(names.values())) == len(names)
