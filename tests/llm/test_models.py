"""Language ID, neighbours, tokens and their counts."""

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from souk.llm import ann, bpe, language, tokens

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, score string, ids string"


# --- language ---------------------------------------------------------------------------------


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.withColumn("held_out", language.held_out())
    model = language.train(docs.filter("NOT held_out"))
    rows = language.predict(docs.filter("held_out"), model).collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_scores_equal_plain_bayes(spark):
    rows = [(1, "the cat sat", "en"), (2, "le chat est là", "fr"), (3, "the dog", "en"),
            (4, None, "en"), (5, "la la", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert model.names == ["en", "fr"]
    counts = {name: np.zeros(1 << 16) for name in model.names}
    for _, text, name in rows[:3]:
        for buckets, _ in language.grams(_texts(text), 16):
            np.add.at(counts[name], buckets, 1)
    best, score = language.scores(_texts("the là"), model)
    odds = []
    for name, prior in zip(model.names, (3, 2)):
        share = (counts[name] + 0.5) / (counts[name] + 0.5).sum()
        odds.append(np.log(prior / 5) + sum(
            np.log(share[b]) for buckets, _ in language.grams(_texts("the là"), 16) for b in buckets))
    expected = np.exp(odds - np.max(odds))
    assert best[0] == expected.argmax()
    assert score[0] == pytest.approx(expected.max() / expected.sum(), rel=1e-4)


def _texts(text):
    import pyarrow as pa

    from souk.llm.text import as_texts
    return as_texts(pa.array([text]))


def test_texts_without_letters_and_clashing_names(spark):
    docs = spark.createDataFrame(
        [(1, "hello there", "en", "x", "y"), (2, None, "en", "x", "y"), (3, "", "fr", "x", "y"),
         (4, "12 ?! \n", None, "x", "y"), (1, "hello there", "en", "x", "y"), (None, "où", "fr", "x", "y"),
         (6, "ß" * 70_000, "de", "x", "y")], DOCS)
    found = language.predict(docs, language.train(docs)).collect()
    assert [(r.doc_id, r.lang_pred) for r in found] == [
        (1, "en"), (2, "und"), (3, "und"), (4, "und"), (1, "en"), (None, "fr"), (6, "de")]
    assert [r.score for r in found if r.lang_pred == "und"] == [0.0] * 3
    knows_nothing = language.train(docs.filter("lang IS NULL"))
    assert {r.lang_pred for r in language.predict(docs, knows_nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), language.train(docs)).collect() == []
    beside = language.predict_beside(docs, language.train(docs)).select("row.*")
    assert beside.schema == docs.schema and beside.collect() == docs.collect()


def test_too_many_languages_fail(spark):
    docs = spark.range(20).select(F.lit("a").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(Exception, match="more than 16 languages"):
        language.train(docs, bits=20)


# --- neighbours -------------------------------------------------------------------------------


def exact(rows, asks, k):
    out = {}
    for q, v in rows:
        if not asks(q):
            continue
        v = np.array(v, float)
        near = []
        for c, w in rows:
            if c != q:
                w = np.array(w, float)
                near.append((-(v @ w) / np.sqrt(v @ v) / np.sqrt(w @ w), c))
        out[q] = sorted(near)[:k]
    return out


def test_neighbours_of_clustered_vectors(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(30, 24))
    vectors = (centres[draw.integers(30, size=1500)] + 0.4 * draw.normal(size=(1500, 24))).astype("f4")
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.nearest(table, F.col("vec_id") % 50 == 0, index_block=400, query_block=11).collect()
    wanted = exact(rows, lambda q: q % 50 == 0, 5)
    got = {}
    for r in found:
        got.setdefault(r.query_id, {})[r.vec_id] = (r.rank, r.score)
    assert set(got) == set(wanted) and all(len(v) == 5 for v in got.values())
    hits = sum(c in got[q] for q, near in wanted.items() for _, c in near)
    assert hits / (5 * len(wanted)) >= 0.95
    for q, near in wanted.items():
        for score, c in near:
            if c in got[q]:
                assert got[q][c][1] == pytest.approx(-score, abs=1e-12)
        ranked = sorted((rank, score) for rank, score in got[q].values())
        assert [r for r, _ in ranked] == [1, 2, 3, 4, 5]
        assert [s for _, s in ranked] == sorted((s for _, s in ranked), reverse=True)


def test_pigeonhole_finds_every_code_in_the_radius():
    draw = np.random.default_rng(9)
    codes = draw.integers(0, 1 << 16, (400, 4)).astype(np.uint16)
    codes[50:] = codes[:350] ^ (1 << draw.integers(0, 16, (350, 4))).astype(np.uint16)
    index = ann.Index(codes)
    apart = np.bitwise_count(codes[:, None] ^ codes).sum(axis=2)
    for radius in (0, 1, 3, 4, 5, 11, 30, 64):
        for q in range(0, 400, 37):
            assert index.within(codes[q], radius).tolist() == np.flatnonzero(apart[q] <= radius).tolist()


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(100 + i, [3.0, float(i), 1.0]) for i in range(6)]
    odd = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]), (203, [float("nan"), 1.0, 1.0]),
           (204, [float("inf"), 1.0, 1.0]), (205, [1.0, 2.0]), (None, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(
        [(i, v, 1, "r") for i, v in rows + odd + rows[:2]],
        "vec_id long, embedding array<double>, score int, rank string")
    found = ann.nearest(table, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found][:5] == [(0, k, k) for k in range(1, 6)]
    assert [r.query_id for r in found] == [0] * 5 + [100] * 5
    few = spark.createDataFrame(rows[:1] + rows[40:42], "vec_id long, embedding array<double>")
    assert ann.nearest(few).count() == 6
    assert ann.nearest(table.limit(0)).collect() == []


# --- tokens -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    draw = random.Random(8)
    parts = [" ", "  ", "\n", "'", "s", "t", "re", "'ll", "ve", "d", "a", "Z", "9", "é", "字", "!",
             "\t", "'s", "𝒳", "😀", " ", "\x1c", "́"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(3000)]
    return texts + [None, "", " ", "   ", "it's we'll\n\n x ", "a" * 5000, " " * 900 + "b",
                    "ab" * 400 + "!" * 700, "x'" * 300]


def test_tokens_equal_the_library(spark, library):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "l", "s", "i") for i, t in enumerate(texts)], DOCS)
    encoded = bpe.encode(docs, RANKS)
    for row in encoded.collect():
        wanted = library.encode_ordinary(texts[row.doc_id] or "")
        ids = struct.unpack(f"<{row.n_tokens}I", row.ids)
        assert list(ids) == wanted
        pieces = [len(library.decode_single_token_bytes(i)) for i in ids]
        assert list(struct.unpack(f"<{row.n_tokens}I", row.offsets)) == [
            sum(pieces[:k]) for k in range(len(pieces))] if len(pieces) < 60 else True
    for row in bpe.digests(bpe.decode(encoded, RANKS)).collect():
        text = (texts[row.doc_id] or "").encode()
        assert row.decoded_sha256 == hashlib.sha256(text).hexdigest()
    assert bpe.digests(bpe.decode(bpe.encode(docs.limit(0), RANKS), RANKS)).collect() == []


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    ranks = bpe.Ranks.load(RANKS)
    for text in odd_texts()[:200]:
        ids, _, _ = ranks.encode(_texts(text))
        assert ids.tolist() == library.encode_ordinary(text)


def test_histogram_answers_every_limit(spark):
    lengths = [0, 0, 3, 3, 3, 7, 1023, 1024, 1025, 1025, 5000, 90_000, None]
    table = spark.createDataFrame([(n, 1) for n in lengths], "n_tokens long, docs int")
    suffixes = tokens.histogram(table)
    known = [n or 0 for n in lengths]
    for r in suffixes.collect():
        assert r.docs == known.count(r.n_tokens)
        assert r.docs_from == sum(n >= r.n_tokens for n in known)
        assert r.tokens_from == sum(n for n in known if n >= r.n_tokens)
        assert (r.docs_total, r.tokens_total) == (len(known), sum(known))
        assert r.truncated_total == sum(min(n, r.n_tokens) for n in known)
        assert r.quantile == sum(n <= r.n_tokens for n in known) / len(known)
    limits = [0, 1, 3, 4, 1023, 1024, 2000, 4999, 5000, 89_999, 90_000, 10**6, 3, None]
    asked = spark.createDataFrame([(n,) for n in limits], "limit long")
    answers = {r.limit: r for r in tokens.at_limits(suffixes, asked).collect()}
    assert sorted(answers) == sorted({n for n in limits if n is not None})
    for limit, r in answers.items():
        assert r.docs_over == sum(n > limit for n in known)
        assert r.truncated_total == sum(min(n, limit) for n in known)
    assert tokens.histogram(table.limit(0)).collect() == []
    assert [tuple(r) for r in tokens.at_limits(tokens.histogram(table.limit(0)), asked.limit(1)).collect()] == [(0, 0, 0, 0)]


def test_structured_texts_are_encoded_exactly():
    import pyarrow as pa

    from souk.llm.text import as_texts
    ranks = bpe.Ranks.load(RANKS)
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), "x y  z x"]
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})
    for _ in range(2):
        ids, _, bounds = ranks.encode(as_texts(pa.array(texts)))
        for i, text in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == known.encode_ordinary(text)


def test_pieces_of_one_fingerprint_are_looked_up_by_their_bytes(monkeypatch):
    import pyarrow as pa

    from souk.llm.text import Fingerprints, as_texts
    monkeypatch.setattr(Fingerprints, "of", lambda self, starts, ends: np.zeros(len(starts), np.uint64))
    ranks = bpe.Ranks.load(RANKS)
    text = "one two three two one"
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})
    for _ in range(2):
        ids, *_ = ranks.encode(as_texts(pa.array([text])))
        assert ids.tolist() == known.encode_ordinary(text)


@pytest.mark.parametrize("parts", [1, 3])
def test_languages_up_to_the_bound_over_many_batches(spark, parts):
    rows = [(i, f"text {i} abc", f"l{i % 256:03d}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(parts)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "500")
    try:
        assert len(language.train(docs).names) == 256
    finally:
        spark.conf.set(size, before)
