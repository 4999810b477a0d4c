"""Alignment of two tokenizers."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from souk.llm import alignment, queries

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a string, pairs long, groups_sha256 string"
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]


@pytest.fixture(scope="module")
def library():
    """The two libraries' own tokens of a text: lists of (id, bytes)."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    others = [b for b in range(256) if b not in PRINTED]
    byte = {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(i):
        text = b.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if b.is_byte(i) else text.replace("▁", " ").encode()

    def both(text):
        if not text:
            return [], []
        ours = [(i, bytes(byte[c] for c in a.id_to_token(i)))
                for i in a.encode(" " + text, add_special_tokens=False).ids]
        theirs = [(i, piece(i)) for i in b.encode(text)]
        want = b" " + text.encode()
        if any(b"".join(t for _, t in side) != want for side in (ours, theirs)):
            return [], []
        return ours, theirs

    return both


def spans(tokens):
    out, at = [], 0
    for number, token in tokens:
        out.append((number, at, at + len(token)))
        at += len(token)
    return out


def brute(rows, library):
    links, docs = Counter(), []
    for name, text in rows:
        a, b = map(spans, library(text))
        groups, mine = [], []
        a_end = {end: number for number, _, end in a}
        cut = 0
        for number, _, end in b:
            if end in a_end:
                mine.append((a_end[end], number))
                groups.append(",".join(str(n) for n, _, e in a if cut < e <= end) + "|" + ",".join(
                    str(n) for n, _, e in b if cut < e <= end))
                cut = end
        links.update(mine)
        text = ";".join(groups)
        docs.append((name, len(a), len(b), groups, mine,
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    highest = defaultdict(int)
    for (_, number), count in links.items():
        highest[number] = max(highest[number], count)
    return sorted((
        (name, n_a, n_b, len(groups), len(mine), sum(links[p] == highest[p[1]] for p in mine),
         sum(links[p] for p in mine), digest)
        for name, n_a, n_b, groups, mine, digest in docs
    ), key=repr)


def found(rows):
    return sorted(map(tuple, rows.collect()), key=repr)


ROWS = [
    (1, "The quick brown fox."), (2, "The quick  brown\tfox\r\n\r\n "), (3, None), (4, ""),
    (5, " "), (6, "   leading"), (7, "héllo wörld — 你好，世界 🎉👩‍👩‍👧"), (8, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (9, "a" * 3000), (10, "▁ ▁▁x"), (11, "\x00\x01\x7f"), (1, "The quick brown fox."),
    (None, "The end."), (12, "ﬁ ① Ǻ é   　 ﻿"), (13, "1234567890 3.14"),
    (14, "don't we'll I'VE"), (15, "\n"), (16, "كيف حالك שלום"), (17, "word " * 30_000),
]


def test_equals_brute_force(spark, library):
    docs = spark.createDataFrame([(*r, "x", 1, "z") for r in ROWS], SCHEMA).repartition(4)
    rows = alignment.aligned(docs, A, B)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                            "groups_sha256"]
    short = [r for r in ROWS if r[0] != 17]
    expected = brute(short, library)
    one = alignment.aligned(docs.filter("doc_id != 17 OR doc_id IS NULL"), A, B)
    assert found(one) == expected
    assert rows.count() == len(ROWS)


def test_query_on_its_table(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert found(queries.op13_cross_tokenizer(spark, folder)) == brute(
        [tuple(r) for r in rows], library)


def test_overlaps_are_all_that_share_a_byte(spark, library):
    rows = [r for r in ROWS if r[0] not in (1, 9, 17, None)]
    docs = spark.createDataFrame([(*r, "x", 1, "z") for r in rows], SCHEMA).repartition(3)
    expected = set()
    for name, text in rows:
        a, b = map(spans, library(text))
        for x, a_low, a_high in a:
            for y, b_low, b_high in b:
                if a_low < b_high and b_low < a_high:
                    expected.add((name, x, y, max(a_low, b_low), min(a_high, b_high),
                                  a_high == b_high))
    got = list(map(tuple, alignment.overlapping(docs, A, B).collect()))
    assert len(got) == len(set(got)) and set(got) == expected


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert found(alignment.aligned(docs, A, B)) == []
    assert found(alignment.aligned(
        spark.createDataFrame([(1, None, "", 1, "")], SCHEMA), A, B
    )) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_every_possible_pair_is_listed():
    a = [b"x", b"abc", b"bc", b""]
    b = [b"c", b"abc", b"zabc", b"", b"bc", b"bc"]
    pairs = alignment.Pairs.of(a, b)
    expected = {i << 32 | j for i, s in enumerate(a) for j, t in enumerate(b)
                if s and t and (s.endswith(t) or t.endswith(s))}
    assert set(pairs.keys.tolist()) == expected
    counts = alignment.Pairs.of(alignment.ByteLevel(A).tokens, alignment.Pieces(B).tokens).keys
    assert len(counts) < 1 << 20  # of two vocabularies, whatever the corpus


def test_byte_level_ids_are_the_librarys():
    """Every code point, between letters, digits, signs and white space."""
    ours = alignment.ByteLevel(A)
    theirs = Tokenizer.from_file(A)
    theirs.encode_special_tokens = True
    points = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}!{chr(c)}  {chr(c)}  z" for c in points]
    plain = theirs.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert ours.encode(texts) == [e.ids for e in plain]
