"""Token counts: an exact histogram of encoded lengths that answers every context limit.

Documents are aggregated by length first, so what follows works on distinct lengths.
Sums over all longer ones are made of sums within a span of lengths, and over the spans,
of which there are few: neither is a sort of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.plans.tables import materialize

SPAN = 1024


def histogram(lengths: DataFrame, length_col: str = "n_tokens", span: int = SPAN) -> DataFrame:
    """A row per distinct length of the documents in ``lengths``.

    ``n_tokens, docs``: a length and how many have it. ``docs_from, tokens_from``: documents
    of that length or more, and their tokens. ``docs_total, tokens_total``: of all.
    ``truncated_total``: tokens left when every document is cut to that length.
    ``quantile``: the share of documents no longer than it. Lengths between two rows follow
    from the next longer row. A NULL length counts as 0; no documents give no rows.
    """
    counts = lengths.select(F.coalesce(F.col(length_col), F.lit(0)).cast("long").alias("n_tokens"))
    # A row per length: written, as lengths may be costly to make and are read twice.
    counts = materialize(counts.groupBy("n_tokens").agg(F.count("*").alias("docs")))
    counts = counts.withColumn("span", F.floor(F.col("n_tokens") / span)).withColumn(
        "tokens", F.col("docs") * F.col("n_tokens")
    )
    spans = counts.groupBy("span").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    # A row per span of lengths: the longest document bounds their number.
    longer = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    all_spans = Window.orderBy(F.desc("span")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    spans = spans.select(
        "span",
        F.coalesce(F.sum("docs").over(longer), F.lit(0)).alias("docs_beyond"),
        F.coalesce(F.sum("tokens").over(longer), F.lit(0)).alias("tokens_beyond"),
        F.sum("docs").over(all_spans).alias("docs_total"),
        F.sum("tokens").over(all_spans).alias("tokens_total"),
    )
    within = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    suffixes = counts.join(spans, "span").select(
        "n_tokens", "docs",
        (F.sum("docs").over(within) + F.col("docs_beyond")).alias("docs_from"),
        (F.sum("tokens").over(within) + F.col("tokens_beyond")).alias("tokens_from"),
        "docs_total", "tokens_total",
    )
    return suffixes.withColumns({
        "truncated_total": F.col("tokens_total") - F.col("tokens_from")
        + F.col("docs_from") * F.col("n_tokens"),
        "quantile": (F.col("docs_total") - F.col("docs_from") + F.col("docs"))
        / F.col("docs_total"),
    })


def at_limits(suffixes: DataFrame, limits: DataFrame, limit_col: str = "limit") -> DataFrame:
    """For each limit: ``limit, docs_over, tokens_total, truncated_total``.

    ``docs_over`` are longer than the limit. A limit is answered by the next length above
    it, found by a join on spans of lengths, never by comparing it with all lengths.
    NULL limits are dropped; repeated limits give one row.
    """
    limits = limits.select(F.col(limit_col).cast("long").alias("limit")).dropna().distinct()
    # Lengths and limits in one order, backwards: each limit takes the last length above it.
    marks = suffixes.select(
        F.col("n_tokens").alias("at"), F.lit(None).cast("long").alias("limit"),
        F.struct("docs_from", "tokens_from").alias("above"),
    ).unionByName(limits.select(
        F.col("limit").alias("at"), "limit",
        F.lit(None).cast("struct<docs_from:bigint,tokens_from:bigint>").alias("above"),
    ))
    marks = marks.withColumn("span", F.floor(F.col("at") / SPAN))
    where = F.when(F.col("above").isNotNull(), F.col("at"))
    firsts = marks.groupBy("span").agg(F.min_by("above", where).alias("first"))
    beyond = Window.orderBy("span").rowsBetween(1, Window.unboundedFollowing)
    firsts = firsts.select("span", F.first("first", ignorenulls=True).over(beyond).alias("beyond"))
    later = Window.partitionBy("span").orderBy(F.desc("at"), F.col("limit").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = suffixes.agg(F.max("tokens_total").alias("tokens_total"))
    answered = marks.withColumn("next", F.last("above", ignorenulls=True).over(later)).filter(
        F.col("limit").isNotNull()
    ).join(firsts, "span").withColumn("next", F.coalesce("next", "beyond"))
    total = F.coalesce(totals.scalar(), F.lit(0))
    over = F.coalesce(F.col("next.docs_from"), F.lit(0))
    return answered.select(
        "limit", over.alias("docs_over"), total.alias("tokens_total"),
        (total - F.coalesce(F.col("next.tokens_from"), F.lit(0)) + over * F.col("limit"))
        .alias("truncated_total"),
    )
