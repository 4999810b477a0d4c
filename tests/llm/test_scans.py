"""Secrets, licenses and tool calls."""

import hashlib
import json
import random
import re

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from souk.llm import licenses, queries, secrets, tools
from souk.llm.text import as_texts

DOCS = "doc_id long, text string, source string, base string, row long, live string"
ASSIGN = re.compile(secrets.ASSIGN.replace("(?i:", "(?ai:"))


def frame(spark, rows, owner=lambda i: f"o{i}"):
    return spark.createDataFrame(
        [(i, t, owner(n), "b", 1, "l") for n, (i, t) in enumerate(rows)], DOCS)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def shown(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


# --- secrets ----------------------------------------------------------------------------------


def test_base_spans_equal_plain_search(spark):
    draw = random.Random(1)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", " ", "  ", ":", "=", '"', "'",
             "abc", "abcdef", "0" * 23, "ab" * 12, "AKIA", "B7" * 8, "é", "😀", "\n", ".", "-", "x"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(600)]
    texts += [None, "", "secret: token = abcdefgh", "token=" * 50, "AKIAAKIA" + "Z" * 12, "f" * 9000,
              " ".join(f"token={i:08d}" for i in range(300))]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4])]
    got = secrets.digests(secrets.scan(frame(spark, rows))).collect()
    wanted = []
    for i, text in rows:
        spans = base_spans(text or "")
        wanted.append((i, *([k for _, k, _ in spans].count(n) for n in range(3)),
                       hashlib.sha256(shown(spans).encode()).hexdigest()))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(wanted, key=str)
    empty = frame(spark, [])
    assert secrets.scan(empty).collect() == [] and secrets.masked(empty).collect() == []


def test_ownership_tells_examples_from_live_keys(spark):
    copied, own, key = "password=hunter2hunter2", "password=onlymine77", "kX9" * 8
    rows = [(1, f"a {copied}"), (2, f"b {copied}"), (3, f"c {own}"), (4, f"d {own} e"),
            (5, f"{key} f"), (6, "plain words"), (7, None), (8, f"é {own}, {copied} {key}")]
    docs = frame(spark, rows, lambda n: f"o{n}" if n < 2 else "mine")
    found = {r.doc_id: r for r in secrets.digests(secrets.scan(docs)).collect()}
    assert (found[1].n_live, found[1].n_example) == (0, 1)
    assert (found[3].n_live, found[4].n_live) == (1, 1)
    assert found[5].spans == "own:0:24" and found[5].n_live == 1
    assert found[8].spans == f"assign:2:{2 + len(own)},assign:{4 + len(own)}:{4 + len(own + copied)}," \
        f"own:{5 + len(own + copied)}:{5 + len(own + copied + key)}"
    masked = secrets.masked(docs)
    assert masked.schema == docs.schema
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts == {
        1: rows[0][1], 2: rows[1][1], 3: "c password=[secret]", 4: "d password=[secret] e",
        5: "[secret] f", 6: "plain words", 7: None, 8: f"é password=[secret], {copied} [secret]"}


def test_several_owners_make_a_mixed_token_no_secret(spark):
    rows = [(i, f"{'aB3' * 9} {i}") for i in range(3)]
    shared = secrets.digests(secrets.scan(frame(spark, rows))).collect()
    assert {r.spans for r in shared} == {""}
    alone = secrets.digests(secrets.scan(frame(spark, rows, lambda n: "one"))).collect()
    assert {r.spans for r in alone} == {"own:0:27"}
    nobody = secrets.digests(secrets.scan(frame(spark, rows, lambda n: None))).collect()
    assert {r.spans for r in nobody} == {"own:0:27"}
    copies = secrets.digests(secrets.scan(frame(spark, [(i, "aB3" * 9) for i in range(9)]))).collect()
    assert {r.spans for r in copies} == {"own:0:27"}


def test_scan_and_masking_agree_with_counting(spark):
    draw = random.Random(7)
    values = [f"value{i:04d}" for i in range(12)]
    rows = [(i, " ".join(f"token={v}" for v in draw.sample(values, draw.randrange(3))))
            for i in range(60)]
    rows += [(60, None), (61, ""), (62, rows[1][1]), (None, rows[2][1])]
    owners = [draw.choice(["a", "b", "c", None]) for _ in rows]
    docs = frame(spark, rows, lambda n: owners[n])

    def smallest(holder):
        return [(x is not None, str(x)) for x in holder]

    held = {}  # of each text, its smallest holder
    for (i, text), owner in zip(rows, owners):
        held[text or ""] = min(held.get(text or "", (owner, i)), (owner, i), key=smallest)
    holders = {v: [h for t, h in held.items() if v in t] for v in values}
    copied = {v for v, h in holders.items() if len({o for o, _ in h}) > 2 and len(set(h)) > 2}
    assert 0 < len(copied) < len(values)
    wanted = sorted((str(i), sum(v not in copied for v in re.findall(r"value\d+", t or "")))
                    for i, t in rows)
    scanned = secrets.digests(secrets.scan(docs)).collect()
    assert sorted((str(r.doc_id), r.n_live) for r in scanned) == wanted
    masked = secrets.masked(docs).collect()
    assert sorted((str(r.doc_id), (r.text or "").count("[secret]")) for r in masked) == wanted


def test_masking_asks_for_more_than_copies(spark):
    passage, copied, shared, key = "password=inTwoTexts1", "token=oneText99", "secret=example1", "kX9" * 8
    rows = [(1, f"a {passage} {key}"), (2, f"b {passage} {key}"), *((i, f"c {copied}") for i in range(3, 7)),
            *((i, f"d{i} {shared}") for i in range(7, 10))]
    texts = {r.doc_id: r.text for r in secrets.masked(frame(spark, rows)).collect()}
    assert texts == {
        1: "a password=[secret] [secret]", 2: "b password=[secret] [secret]",
        **{i: "c token=[secret]" for i in range(3, 7)}, **{i: f"d{i} {shared}" for i in range(7, 10)}}
    # Several texts, but two owners.
    for owner in (lambda n: f"o{n % 2}", lambda n: f"o{min(n, 1)}"):
        few = secrets.masked(frame(spark, [(i, f"d{i} {shared}") for i in range(6)], owner)).collect()
        assert {r.text for r in few} == {f"d{i} secret=[secret]" for i in range(6)}


def test_a_repository_of_several_owners_counts_once(spark):
    rows = [(i, f"token=shared{'aB3' * 3} {'aB3' * 9} {i}") for i in range(4)]
    docs = frame(spark, rows)  # four owners, and "b" for all in base
    team = secrets.digests(secrets.scan(docs, repo_col="base")).collect()
    assert {(r.spans, r.n_live, r.n_example) for r in team} == {("assign:0:21,own:22:49", 2, 0)}
    assert {r.text for r in secrets.masked(docs, repo_col="base").collect()} == {
        f"token=[secret] [secret] {i}" for i in range(4)}
    spread = secrets.digests(secrets.scan(docs)).collect()
    assert {(r.spans, r.n_live, r.n_example) for r in spread} == {("assign:0:21", 0, 1)}
    assert {r.text for r in secrets.masked(docs).collect()} == {t for _, t in rows}
    # Of each number of repositories, two are too few; a NULL one is one.
    for names, live in ((["x", "y"] * 2, True), (["x", "y", "z", "z"], False), ([None, "x", None, "y"], False)):
        named = spark.createDataFrame(
            [(i, t, f"o{i}", n) for (i, t), n in zip(rows, names)], "doc_id long, text string, source string, name string")
        got = secrets.scan(named, repo_col="name").collect()
        assert {(r.n_live, r.n_example) for r in got} == {(2, 0) if live else (0, 1)}
        assert {"[secret]" in r.text for r in secrets.masked(named, repo_col="name").collect()} == {live}


def test_the_query_names_a_document_as_its_sql_does(spark, tmp_path):
    texts = [f"{i} token=value{n} {'aB3' * 9}{n}" for n in range(3) for i in range(4)]
    ids = [1, 1, 1, 1, None, None, None, 2, 5, 6, 5, 6]
    owners = ["a", "b", "c", "d", "a", "null", None, "a", "a", "b", "a", "b"]
    docs = spark.createDataFrame(list(zip(ids, texts, owners)), "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    wanted = sorted(map(str, duck.execute(secrets.ORACLE).fetchall()))
    assert sorted(str(tuple(r)) for r in queries.op7_secret_scan(spark, str(tmp_path)).collect()) == wanted
    masked = corpus_pipeline.without_secrets(spark, docs, str(tmp_path)).collect()
    assert {r.text for r in masked if "[secret]" not in r.text} == set(texts[:8])


# --- licenses ---------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_phrases_equal_plain_search(spark):
    draw = random.Random(3)
    parts = ["under the", "MIT", "License", "apache license", "version", "2", "cc by nc", "by", "é",
             "under the mit license", "x1", "cc", "ü"]
    texts = ["".join(draw.choice(parts) + draw.choice([" ", "-", "\x01", "\n", ", "])
                     for _ in range(draw.randrange(30))) for _ in range(300)]
    texts += [None, "", "cc by nc", "CC-BY-NC cc by nc by nc", "under the mit licenses", "a " * 40_000]
    rows = list(enumerate(texts)) + [(None, texts[0]), (1, texts[1])]
    got = licenses.digests(licenses.scan(frame(spark, rows))).collect()
    for (i, text), r in zip(rows, got):
        words = WORD.findall((text or "").translate(LOWER))
        places, labels = [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            for at in range(len(words)):
                if words[at:at + len(p)] == p:
                    places.append(at)
                    labels.add(label)
        assert (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            i, len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))
        assert labels <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert licenses.scan(frame(spark, [])).collect() == []


def test_notices_with_edits(spark):
    rows = [
        (1, "Released undr the MIT licence."), (2, "see the GNU Generel Public License, version 3"),
        (3, "Permission is hereby granted, free of charge, to any persons obtaining a copy"),
        (4, "nothing to see"), (5, "under mitigated licensing"), (6, "Apache License, Versoin 2.0"),
        (7, "gnu general"), (8, "public license"),
    ]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows)).collect()}
    labels = {i: sorted({n.label for n in r.notices}) for i, r in got.items()}
    assert labels == {1: ["mit"], 2: ["gpl"], 3: ["mit"], 4: [], 5: [], 6: ["apache-2"], 7: [], 8: []}
    (notice,) = got[2].notices
    assert (notice.first, notice.last, notice.edits) == (2, 5, 1)
    score = {r.doc_id: r.score for r in licenses.digests(licenses.scan(frame(spark, rows))).collect()}
    assert score[4] == 0 and 0.9 < score[2] < 1


def test_neighbours_hide_no_notice(spark):
    edited, whole = "foo gnu genral public license", "gnu general public license bar"
    rows = [(1, edited), (2, whole), (3, f"{edited} {whole}"), (4, whole)]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows).coalesce(1)).collect()}
    assert {i: [(n.first, n.last, n.edits) for n in r.notices] for i, r in got.items()} == {
        1: [(1, 4, 1)], 2: [(0, 3, 0)], 3: [(1, 4, 1), (5, 8, 0)], 4: [(0, 3, 0)]}


def test_notices_do_not_depend_on_neighbours():
    draw = random.Random(8)

    def edited(words):
        letters = list(words)
        for _ in range(draw.randrange(3)):
            letters[draw.randrange(len(letters))] = draw.choice(["", "x", " ", "ab"])
        return "".join(letters)

    texts = [" ".join(draw.choice([edited(draw.choice(licenses.NOTICES)[0]), "x", "the", ""])
                      for _ in range(draw.randrange(6))) for _ in range(400)]
    _, _, _, together = licenses.found(as_texts(pa.array(texts)))
    alone = [licenses.found(as_texts(pa.array([t])))[3][0] for t in texts]
    assert together == alone and sum(map(len, alone)) > 100


# --- tool calls ---------------------------------------------------------------------------------

CALLS = "call_id string, parent_id string, position long, name string, arguments string, level long"
RESULTS = "call_id string, position long, content string, status string"
PARAMETERS = "name string, parameter string, type string, required boolean"
SEARCH = [("search", "q", "string", True), ("search", "n", "integer", False),
          ("search", "o", "object", False), ("search", "q", "string", True)]


def linked(spark, calls, results=()):
    rows = tools.link(
        spark.createDataFrame([(*c, 9) for c in calls], CALLS),
        spark.createDataFrame([(*r, "s") for r in results], RESULTS),
        spark.createDataFrame(SEARCH, PARAMETERS),
    ).collect()
    assert len({r.call_id for r in rows}) == len(rows)
    return {r.call_id: r for r in rows}


def test_calls_meet_their_results(spark):
    good = '{"q": "x", "n": 2}'
    got = linked(spark, [
        ("a", None, 1, "search", good), ("b", "a", 3, "search", good), ("c", "b", 9, "search", good),
        ("a", None, 5, "search", "{}"), (None, None, 1, "search", good), ("d", "gone", 2, "search", good),
    ], [("a", 2, "r1"), ("a", 2, "r0"), ("c", 4, None), ("z", 7, "lost"), (None, 1, "n")])
    assert {k: (r.level, r.status, r.n_calls, r.n_results) for k, r in got.items()} == {
        "a": (0, "answered", 2, 2), "b": (1, "unanswered", 1, 0), "c": (2, "early", 1, 1),
        "d": (0, "unanswered", 1, 0), "z": (None, "orphan", 0, 1)}
    assert got["a"].message == (
        '{"arguments":{"n":2,"q":"x"},"content":"r0","id":"a","name":"search"}')
    assert got["z"].valid is None and json.loads(got["z"].message)["content"] == "lost"


def test_levels_of_long_chains_and_circles(spark):
    calls = [(f"c{i}", f"c{i - 1}" if i else None, i, "search", "{}") for i in range(200)]
    calls += [("x", "y", 1, "search", "{}"), ("y", "x", 2, "search", "{}"),
              ("me", "me", 3, "search", "{}"), ("behind", "x", 4, "search", "{}")]
    got = linked(spark, calls)
    assert all(got[f"c{i}"].level == i for i in range(200))
    assert [got[k].level for k in ("x", "y", "me", "behind")] == [None] * 4


@pytest.mark.parametrize("arguments, problems", [
    ('{"q":"x"}', []), ('{"q":"x","n":1,"o":{}}', []), ('{"n":1}', ["missing q"]),
    ('{"q":null,"n":1.5}', ["missing q", "type n"]), ('{"q":1,"zz":2}', ["type q", "unknown zz"]),
    ("[1]", ["syntax"]), ("{", ["syntax"]), (None, ["syntax"]), ("", ["syntax"]),
    ('{"q":"x","o":[1]}', ["type o"]),
])
def test_arguments_against_parameters(spark, arguments, problems):
    (row,) = linked(spark, [("a", None, 1, "search", arguments)]).values()
    assert (row.problems, row.valid) == (problems, not problems)


def test_unknown_tools_and_no_calls(spark):
    got = linked(spark, [("a", None, 1, "other", '{"b":1}'), ("b", None, 1, None, "{}")])
    assert got["a"].problems == got["b"].problems == ["tool"]
    assert linked(spark, []) == {}


def test_very_long_texts(spark):
    size = tools.LONG + 1_000_000
    turns = spark.createDataFrame([(1, 1, "user", "x"), (1, 2, "assistant", "y")],
                                  "conv_id long, turn long, role string, text string")
    for role in ("user", "assistant"):
        long = turns.withColumn("text", F.when(F.col("role") == role, F.repeat("text", F.lit(size)))
                                .otherwise(F.col("text")))
        (row,) = tools.linked_turns(long).select(
            "valid", "problems", F.length("message").alias("size"),
            F.substring("message", 1, 21).alias("start")).collect()
        short = '{"arguments":{"text":"x","turn":1},"content":"y","id":"1:1","name":"open"}'
        assert (row.valid, row.problems, row.size) == (True, [], len(short) + size - 1)
        assert row.start == short[:21] or role == "user"
    calls = spark.createDataFrame([("a", None, 1, "search", "{", 9)], CALLS).withColumn(
        "arguments", F.repeat("arguments", F.lit(size)))
    (row,) = tools.link(calls, spark.createDataFrame([], RESULTS), spark.createDataFrame(
        SEARCH, PARAMETERS)).select("problems", F.length("message").alias("size")).collect()
    assert row.problems == ["too long"] and row.size > size


def test_turns_of_conversations(spark):
    turns = [(1, 0, "system", "be"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo"),
             (1, 3, "user", 'q "é"\n'), (2, 0, "user", None), (2, 1, "assistant", "a"),
             (2, 1, "assistant", "b"), (3, 1, "assistant", "lost"), (None, 1, "user", "x"), (4, None, "user", "y"),
             (1, 4, "assistant", "a"), (1, 5, "assistant", "b"), (1, 9, "user", "late"), (1, 9, "user", "more"),
             (5, 0, None, None), (5, 0, None, "b"), (5, 0, "system", "")]
    table = spark.createDataFrame(
        [(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, call_id string, level int")
    got = {r.call_id: r for r in tools.linked_turns(table).collect()}
    assert {k: (r.level, r.status, r.n_results, r.problems) for k, r in got.items()} == {
        "1:1": (0, "answered", 1, []), "1:3": (1, "answered", 1, []), "1:4": (None, "orphan", 1, None),
        "1:9": (2, "unanswered", 0, []), "1:0:system": (None, "context", 1, None),
        "5:0:": (None, "context", 2, None), "5:0:system": (None, "context", 1, None), "2:0": (0, "answered", 2, ["missing text"]), "3:0": (None, "orphan", 1, None)}
    assert got["1:3"].message == (
        '{"arguments":{"after":1,"text":"q \\"é\\"\\n","turn":3},"content":"a","id":"1:3","name":"reply"}')
    assert got["1:9"].message == (
        '{"arguments":{"after":3,"text":"late","turn":9},"id":"1:9","name":"reply"}')
    assert (got["1:9"].n_calls, got["2:0"].name, got["1:9"].name) == (2, "open", "reply")
    assert got["1:0:system"].message == '{"content":"be","id":"1:0:system","role":"system"}'
    assert got["5:0:"].message == '{"content":"b","id":"5:0:"}'
    assert tools.linked_turns(table.limit(0)).collect() == []


def test_turns_of_a_large_conversation(spark):
    draw = random.Random(5)
    turns = [(1, t, draw.choice(["user", "user", "assistant", "tool"])) for t in range(0, 9000, 3)]
    turns += [(c, t, draw.choice(["user", "system"])) for c in range(2, 40) for t in draw.sample(range(9), 3)]
    table = spark.createDataFrame([(*t, "x") for t in turns * 2], "conv_id long, turn long, role string, text string")
    before, wanted = {}, {}
    for conv, turn, role in sorted(turns):
        if role == "user":
            wanted[conv, turn] = before.get(conv)
            before[conv] = turn
    rows = tools._before(table.filter("role = 'user'").select("conv_id", "turn")).collect()
    assert {(r.conv_id, r.turn): r.before for r in rows} == wanted and len(rows) == len(wanted)


def test_filter_takes_linear_time(spark):
    import time
    texts = spark.range(1).select(F.repeat(F.lit("z"), 1_000_000).alias("text"))
    texts.filter(F.col("text").rlike(secrets.CANDIDATE)).count()
    start = time.perf_counter()
    assert texts.filter(F.col("text").rlike(secrets.CANDIDATE)).count() == 0
    assert time.perf_counter() - start < 5
