"""Exact copies."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from souk.llm import exact
from tests.llm.brute import LOWER

SCHEMA = "doc_id long, text string, keep_id string, digest string, salt long, content string"


def brute(rows):
    groups = defaultdict(list)
    for name, text in rows:
        groups[(text or "").translate(LOWER)].append(name)
    out = []
    for name, text in rows:
        low = (text or "").translate(LOWER)
        keep = max((n for n in groups[low] if n is not None), default=None)
        out.append((name, keep, len(groups[low]), name == keep,
                    hashlib.sha256(low.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA)
    return sorted(map(tuple, exact.copies(docs.repartition(5), **how).collect()), key=repr)


ROWS = [(1, "One"), (2, "oNE"), (3, "two"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, " one"),
        (9, "one "), (3, "TWO"), (3, "two"), (11, "a\x00b"), (12, "A\x00B"), (None, "only"),
        (None, "One"), (13, "İ"), (14, "long " * 200_000), (15, "LONG " * 200_000),
        (16, "long " * 200_000 + ".")]


def test_equals_brute_force(spark):
    assert found(spark, ROWS) == brute(ROWS)


@pytest.mark.parametrize("width", [0, 1])
def test_colliding_digests_are_told_apart_by_text(spark, width):
    def weak(text):
        return F.substring(exact.sha256(text), 1, width)

    assert found(spark, ROWS, digest=weak) == brute(ROWS)


def test_a_large_group_over_many_partitions(spark):
    rows = [(i, "Hot" if i % 3 else f"cold {i // 6}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    assert sorted(map(tuple, exact.copies(docs).collect()), key=repr) == brute(rows)


def test_no_rows(spark):
    assert found(spark, []) == []


def test_what_stays_keeps_its_columns(spark):
    docs = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in ROWS], SCHEMA)
    kept = exact.without_copies(docs)
    assert kept.columns == docs.columns
    expected = sorted((n for n, keep, _, stays, _ in brute(ROWS) if stays), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == expected


def test_plan_is_native_and_bounded(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = exact.copies(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert "collect_" not in plan
