"""A corpus from raw documents: stages that each work on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import bpe, contamination, language, secrets
from souk.llm.ngram_join import one_of_each
from souk.plans.tables import materialize

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
#: Posterior below which a prediction of the language is no decision.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without a letter, or undecided, go.

    The model learns from the labelled documents that are not held out.
    """
    model = language.train(docs.filter(~language.held_out()))
    predicted = language.predict_beside(docs, model)
    decided = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return predicted.filter(decided).select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return contamination.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, credentials that look live masked, lengths counted anew."""
    masked = secrets.masked(docs, repo_col=secrets.DOCUMENT)
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens: doc_id, n_tokens, ids."""
    ranks = public_tokenizers.path(TOKENIZER)
    return bpe.encode(docs, ranks).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("language", known_language),
    ("near copies", without_near_copies),
    ("benchmarks", without_benchmarks),
    ("secrets", without_secrets),
    ("tokens", encoded),
]

ORACLE_SQL = None  # most stages can't be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` after all stages, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
