"""Exact copies: texts that are equal once A-Z are in lower case.

Rows are combined in three steps, and each compares whole texts, not digests alone. Within
a task equal texts become one row (the map side of an aggregate keyed by digest and text).
Those rows are merged per digest, the digests of large groups dealt over salts. The salts'
winners of one digest, a bounded number of rows, are combined last. The winners then meet
the documents by digest; a digest that stands for several texts is joined by text as well.

Only built-in functions run, and no group is gathered in one row.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.plans.tables import materialize

#: A group that holds this share of all rows, or more, is salted; there are at most so many.
LARGE = 1024
SALTS = 32


def normalised(text: Column) -> Column:
    """``text`` with A-Z in lower case; NULL is empty."""
    return F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256
) -> DataFrame:
    """Rows (id, keep_id, group_size, kept, text_sha256), one per row of ``docs``.

    ``keep_id`` is the largest id of the rows with an equal text, ``group_size`` their
    number, ``kept`` whether the row is the one that stays. NULL texts are empty ones, and
    empty ones are equal. Rows that repeat an id with an equal text are one document: each
    counts, and they share their verdict. An id may be NULL; it stays only where no row of
    the group has one. Other columns are ignored, whatever their names; no rows give none.
    ``digest`` maps a text to its group; it may collide, as texts are compared.
    """
    texts = docs.select(
        F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("content")
    ).withColumn("digest", digest(F.col("content")))
    rows = materialize(texts.select("id", "digest", sha256(F.col("content")).alias("sha256")))
    winners = materialize(_winners(rows, texts))
    held = winners.groupBy("digest").agg(
        F.count("*").alias("texts"), F.max("keep").alias("keep"), F.sum("held").alias("held"))
    groups = materialize(held.filter("texts > 1 OR held > 1"))
    clashing = groups.filter("texts > 1").select("digest")
    marked = _marked(rows, groups.filter("texts = 1"))
    if not clashing.isEmpty():
        marked = marked.join(clashing, "digest", "left_anti").unionByName(
            _by_text(texts.join(clashing, "digest", "left_semi")))
    keep, own = F.col("keep"), F.col("id")
    return marked.select(
        own.alias(id_col),
        keep.alias("keep_id"),
        F.col("held").alias("group_size"),
        own.eqNullSafe(keep).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    gone = copies(docs, id_col, text_col).filter("NOT kept").select(
        F.col(id_col).alias("gone_id"), F.col("text_sha256").alias("gone_sha256")).distinct()
    own = sha256(normalised(docs[text_col]))
    same = docs[id_col].eqNullSafe(gone["gone_id"]) & (own == gone["gone_sha256"])
    return docs.join(gone, same, "left_anti")


def _winners(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows (digest, keep, held) per text: its largest id and its number of rows."""
    counts = rows.groupBy("digest").agg(F.count("*").alias("held"))
    least = F.greatest(F.floor(rows.select(F.count("*")).scalar() / LARGE), F.lit(2))
    # At most LARGE digests, as each holds its share of the rows.
    large = counts.filter(F.col("held") >= least).select("digest", F.lit(True).alias("large"))
    salt = F.when(F.col("large"), F.spark_partition_id() % SALTS + 1).otherwise(F.lit(0))
    salted = (
        texts.join(F.broadcast(large), "digest", "left").withColumn("salt", salt)
        .groupBy("digest", "salt", "content")
        .agg(F.max("id").alias("keep"), F.count("*").alias("held"))
    )
    # Texts go on only with the few large groups.
    salted = materialize(salted.withColumn("content", F.when(F.col("salt") > 0, F.col("content"))))
    combined = salted.filter("salt > 0").groupBy("digest", "content").agg(
        F.max("keep").alias("keep"), F.sum("held").alias("held"))
    return salted.filter("salt = 0").select("digest", "keep", "held").unionByName(
        combined.drop("content"))


def _marked(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with their group's ``keep`` and ``held``; a row of no group is its own.

    Large groups, few by their size, are broadcast; the rows of others are joined by digest.
    """
    least = F.greatest(F.floor(rows.select(F.count("*")).scalar() / LARGE), F.lit(2))
    large = groups.filter(F.col("held") >= least).select(
        "digest", F.struct("keep", "held").alias("group"))
    small = groups.filter(F.col("held") < least).select(
        "digest", F.struct("keep", "held").alias("group"))
    beside = rows.join(F.broadcast(large), "digest", "left")
    found = beside.filter(F.col("group").isNotNull()).unionByName(
        beside.filter(F.col("group").isNull()).drop("group").join(small, "digest", "left"))
    return found.select(
        "digest", "id", "sha256",
        F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("group.keep")).alias("keep"),
        F.coalesce("group.held", F.lit(1)).cast("long").alias("held"),
    )


def _by_text(texts: DataFrame) -> DataFrame:
    """As ``_marked``, for digests that stand for several texts."""
    groups = texts.groupBy("digest", "content").agg(
        F.max("id").alias("keep"), F.count("*").alias("held"))
    return texts.join(groups, ["digest", "content"]).select(
        "digest", "id", sha256(F.col("content")).alias("sha256"), "keep", "held")


ORACLE = """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS content
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(content) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY content)
"""
