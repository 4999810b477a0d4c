"""The registered queries against their SQL, and the pipeline against a plain version."""

import glob
import os
import random
import struct
import zlib

import duckdb
import pytest

import corpus_pipeline
from souk.llm import queries
from tests.conftest import TESTDATA
from tests.llm import brute
from tests.llm.test_models import library  # noqa: F401  (a fixture)


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, key):
    folder = f"{TESTDATA}/sf0.001"
    duck = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    mine = queries.QUERIES[key](spark, folder)
    theirs = duck.execute(queries.ORACLES[key])
    assert mine.columns == [c[0] for c in theirs.description]
    rows = sorted(map(str, map(tuple, mine.collect())))
    assert rows == sorted(map(str, theirs.fetchall())) and rows


def test_every_operator_is_registered():
    assert [int(k[2:].split("_")[0]) for k in queries.QUERIES] == list(range(1, 14))


def test_native_operators_run_no_python(spark):
    for key in ("op1_tool_calls", "op7_secret_scan", "op11_exact_dedup"):
        plan = queries.QUERIES[key](spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution()
        assert "Python" not in plan.toString() and "InArrow" not in plan.toString()


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    """Two languages, near copies, benchmark passages, secrets, noise."""
    draw = random.Random(5)
    english = ["the", "and", "with", "thing", "that", "other", "which", "where", "than", "whole"]
    french = ["été", "où", "près", "eau", "quelle", "leçon", "forêt", "élève", "même", "voilà"]

    def text(words, count):
        return [draw.choice(words) + draw.choice(["", "s", "e"]) + str(draw.randrange(9) or "") for _ in range(count)]

    items = [(i, " ".join(text(english, 15))) for i in range(4)]
    rows = []
    for i in range(80):
        words, lang = (english, "en") if i % 2 else (french, "fr")
        body = text(words, draw.randrange(30, 90))
        if i % 9 == 0:
            body[10:10] = items[i % 4][1].split()
        if i % 10 == 3:
            body.append(f"password=own{i}own{i} token=everyones")
        rows.append((i, " ".join(body), lang, f"s{i % 7}", 0))
    rows += [(100 + i, r[1] + " more", r[2], r[3], 0) for i, r in enumerate(rows[20:30])]
    rows += [(200, "1 2 3 !", "en", "s", 0), (201, None, "en", "s", 0), (202, "", None, None, 0),
             (203, rows[50][1], "fr", "s", 0), (50, rows[50][1], "fr", "s1", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_pipeline_equals_a_plain_one(spark, corpus, library):  # noqa: F811
    folder, rows, items = corpus
    named = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    first = [m for _, _, m in brute.groups([(r[0], r[1]) for r in named])]
    single = {r[0]: r for r, m in zip(named, first) if r[0] == m}
    clean = [r for r in single.values() if not brute.contained(r[1], items)]
    hidden = {}
    for i, text, *_ in clean:
        hidden[i] = text.replace(f"password=own{i}own{i}", "password=[secret]")
    assert len(named) < len(rows) and len(single) < len(named) and len(clean) < len(single)
    assert any("[secret]" in t for t in hidden.values())
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: list(struct.unpack(f"<{r.n_tokens}I", r.ids)) for r in got} == {
        i: library.encode_ordinary(t) for i, t in hidden.items()}
    assert len(got) == len(hidden)


def test_stages_keep_the_columns_of_documents(spark, corpus):
    folder, rows, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near copies", "benchmarks", "secrets", "tokens"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, folder)
            assert out.dtypes == docs.dtypes
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).collect() == []


def test_training_rows_are_those_not_held_out(spark):
    from souk.llm.language import held_out
    rows = spark.range(50).select("id", held_out("id").alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
