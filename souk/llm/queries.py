"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import (
    alignment, ann, bpe, contamination, exact, language, licenses, ngram_join, repeats, secrets,
    tokens, tools, whitening,
)

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    linked = tools.linked_turns(_table(spark, folder, "conversations"))
    return linked.withColumn("problems", F.array_join("problems", ","))


def op2_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, folder, "documents"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", language.held_out())
    model = language.train(docs.filter("NOT held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path(TOKENIZER)
    return bpe.digests(bpe.decode(bpe.encode(_table(spark, folder, "documents"), ranks), ranks))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(repeats.repeated(_table(spark, folder, "documents")))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return secrets.digests(secrets.scan(docs, repo_col=secrets.DOCUMENT))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digests(licenses.scan(_table(spark, folder, "documents")))


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.pairs(contamination.contaminated(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    ))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return tokens.histogram(bpe.encode(docs, public_tokenizers.path(TOKENIZER)))


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.copies(_table(spark, folder, "documents"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return whitening.components(vectors, whitening.fit(vectors))


def op13_cross_tokenizer(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(
        _table(spark, folder, "documents"),
        public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tool_calls": op1_tool_calls,
    "op2_multi_index_hashing": op2_multi_index_hashing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_language_id": op4_language_id,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_license_scan": op8_license_scan,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_cross_tokenizer": op13_cross_tokenizer,
}

ORACLES: dict[str, str] = {
    "op1_tool_calls": tools.ORACLE,
    "op3_ngram_jaccard_join": ngram_join.ORACLE,
    "op7_secret_scan": secrets.ORACLE,
    "op9_benchmark_decontamination": contamination.ORACLE,
    "op11_exact_dedup": exact.ORACLE,
}
