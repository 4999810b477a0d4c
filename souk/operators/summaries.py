"""Small tables and headline figures over the customer and delivery results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import exact
from souk.operators.delivery import EARLY, VERY_LATE
from souk.operators.rfm import AT_RISK_GROUP
from souk.plans.select import at_positions
from souk.plans.slices import PERSON
from souk.plans.tables import materialize


def _mean_spend() -> Column:
    return exact.mean(F.sum(exact.cents("monetary")), F.count("monetary"), 0, units=100)


# --- segments -------------------------------------------------------------------------


def rfm_segment_counts(rfm: DataFrame) -> DataFrame:
    return (
        rfm.groupBy("segment")
        .agg(
            F.count("*").alias("count"),
            _mean_spend().alias("avg_monetary"),
        )
        .orderBy("count", "segment")
    )


def rfm_totals(people: DataFrame) -> DataFrame:
    """Number of people and mean spend; takes segments or plain customer totals."""
    return people.agg(
        F.count("*").alias("total"),
        _mean_spend().alias("avg_monetary"),
    )


def rfm_headline(rfm: DataFrame) -> DataFrame:
    return rfm.agg(
        F.count("*").alias("total_customers"),
        F.count_if(F.col("segment") == "Champions").alias("champions"),
        F.count_if(F.col("segment").isin(AT_RISK_GROUP)).alias("at_risk"),
        _mean_spend().alias("avg_monetary"),
    )


def rfm_sample(rfm: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """``n`` people at random: those whose seeded hash sorts first, the same every time.

    People are counted by the first digits of their hash, and only those up to the smallest
    digits that hold ``n`` are sorted, so that the tasks of a large table do not each offer
    ``n`` rows to the final sort.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(PERSON).cast("string")))
    drawn = rfm.withColumns({"draw": draw, "digits": F.substring(draw, 1, 4)})
    # 16**4 rows at most, whatever the number of people.
    sizes = drawn.groupBy("digits").agg(F.count("*").alias("held")).withColumn(
        "before", F.sum("held").over(
            Window.orderBy("digits").rowsBetween(Window.unboundedPreceding, -1))
    )
    last = sizes.filter(F.coalesce("before", F.lit(0)) < n).select(F.max("digits")).scalar()
    return drawn.filter(F.col("digits") <= last).orderBy("draw", PERSON).limit(n).select(
        "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "segment"
    )


# --- lifetime value: over customer totals, whose ``monetary`` is the final value ---------


def _bucket(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Number of the equal-width bin of ``value`` in [low, high), all whole numbers."""
    return F.floor(
        F.try_divide(
            ((value - low) * bins).cast("decimal(20,0)"), (high - low).cast("decimal(18,0)")
        )
    ).cast("int") + 1


def ltv_histogram(totals: DataFrame, bins: int = 50) -> DataFrame:
    """People per equal-width bin of lifetime value; empty bins are absent."""
    cents = totals.select(exact.cents("monetary").alias("cents"))
    bounds = cents.select(F.struct(F.min("cents").alias("low"), F.max("cents").alias("high")))
    low, high = F.col("bounds.low"), F.col("bounds.high")

    def edge(number: Column) -> Column:
        return exact.mean(low * bins + number * (high - low), F.lit(100 * bins), 0)

    return (
        cents.withColumn("bounds", bounds.scalar())
        .groupBy(_bucket(F.col("cents"), low, high + 1, bins).alias("bucket"), "bounds")
        .agg(F.count("*").alias("customers"))
        .select(
            "bucket",
            edge(F.col("bucket") - 1).alias("bin_lo"),
            edge(F.col("bucket")).alias("bin_hi"),
            "customers",
        )
        .orderBy("bucket")
    )


def ltv_stats(totals: DataFrame) -> DataFrame:
    """Exact median, mean and largest lifetime value, and people with several orders."""
    people = materialize(totals.select("monetary", "frequency"))
    middle = at_positions(
        people, [exact.cents("monetary")], lambda rows: ((rows - 1) // 2, rows // 2))
    # One row in the middle stands for two.
    total, rows = sum(f.value for f in middle), len(middle)
    median = exact.mean(F.lit(total), F.lit(rows), 0, units=100)
    return people.agg(
        median.alias("median"),
        _mean_spend().alias("mean"),
        F.round(F.max("monetary"), 0).cast("decimal(18,0)").alias("max"),
        F.count_if(F.col("frequency") > 1).alias("multi_order"),
    )


def ltv_top_customers(totals: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` people of highest lifetime value."""
    return (
        totals.select(
            PERSON,
            F.col("frequency").alias("order_sequence"),
            F.col("monetary").alias("cumulative_revenue"),
        )
        .orderBy(F.desc_nulls_first("cumulative_revenue"), F.asc_nulls_last(PERSON))
        .limit(k)
    )


# --- cohorts ----------------------------------------------------------------------------


def cohort_matrix(cohorts: DataFrame, min_size: int = 50) -> DataFrame:
    """A row per cohort and a column ``M<n>`` per month since; missing months are zero."""
    kept = materialize(cohorts.filter(F.col("cohort_size") >= min_size))
    # One row per calendar month at most.
    months = [row[0] for row in kept.select("months_since").distinct().collect()]
    names = [f"M{month}" for month in sorted(months)]
    return (
        kept.groupBy(F.date_format("cohort_month", "yyyy-MM").alias("cohort"))
        .pivot("months_since", sorted(months)).agg(F.first("retention_rate"))
        .toDF("cohort", *names)
        .withColumns({name: F.coalesce(name, F.lit(0)).cast("decimal(18,2)") for name in names})
        .orderBy("cohort")
    )


def cohort_headline(cohorts: DataFrame, min_size: int = 50) -> DataFrame:
    """Cohorts of ``min_size`` or more: count, mean size, mean return after a month."""
    start, next_month = F.col("months_since") == 0, F.col("months_since") == 1
    kept = cohorts.filter(F.col("cohort_size") >= min_size)
    rate = exact.mean(
        F.sum(F.when(next_month, F.col("retention_rate") * 100)), F.count_if(next_month), 1,
        units=100,
    )
    return kept.agg(
        F.count_if(start).alias("total_cohorts"),
        exact.mean(F.sum(F.when(start, F.col("cohort_size"))), F.count_if(start), 0)
        .alias("avg_cohort_size"),
        F.coalesce(rate, F.lit(0)).cast("decimal(18,1)").alias("avg_m1_retention"),
        F.max("months_since").alias("max_months"),
    )


# --- churn ------------------------------------------------------------------------------


def churn_headline(churn: DataFrame) -> DataFrame:
    """Repeat customers, active and churned with shares, and their mean gap in days."""
    everybody, churned = F.count("*"), F.count_if("is_churned")
    return churn.agg(
        everybody.alias("repeat_customers"),
        (everybody - churned).alias("active"),
        exact.percent(everybody - churned, everybody, 0).alias("active_pct"),
        churned.alias("churned"),
        exact.percent(churned, everybody, 0).alias("churned_pct"),
        exact.mean(
            F.sum(F.col("avg_days_between") * 10), F.count("avg_days_between"), 0, units=10
        ).alias("avg_cadence_days"),
    )


def churn_histogram(churn: DataFrame, bins: int = 50) -> DataFrame:
    """People per bin of days since the last order, by status; bins span least to most."""
    # At most two rows per day of the calendar; bounds and rows share the shuffle.
    days = churn.groupBy("days_since_last", "is_churned").agg(F.count("*").alias("people"))
    bounds = days.select(
        F.struct(F.min("days_since_last").alias("low"), F.max("days_since_last").alias("high"))
    )
    bucket = _bucket(
        F.col("days_since_last"), F.col("bounds.low"), F.col("bounds.high") + 1, bins
    )
    return (
        days.withColumn("bounds", bounds.scalar())
        .groupBy(bucket.alias("bucket"), "is_churned")
        .agg(F.sum("people").alias("customers"))
        .orderBy("bucket", "is_churned")
    )


def churn_customers(churn: DataFrame, status: str = "all", k: int = 200) -> DataFrame:
    """The ``k`` longest silent people; ``status`` is ``all``, ``active`` or ``churned``."""
    kept = {
        "all": F.lit(True), "active": ~F.col("is_churned"), "churned": F.col("is_churned"),
    }[status]
    return (
        churn.filter(kept)
        .orderBy(F.desc_nulls_first("days_since_last"), F.asc_nulls_last(PERSON))
        .limit(k)
    )


# --- delivery ---------------------------------------------------------------------------


def delivery_headline(delivery: DataFrame) -> DataFrame:
    """Delivered rows, share early, score of the latest, and days of the early."""

    def of(bucket: str, column: str) -> Column:
        return F.max(F.when(F.col("delivery_bucket") == bucket, F.col(column)))

    return delivery.agg(
        F.sum("order_count").alias("delivered_orders"),
        F.coalesce(of(EARLY, "pct_of_total"), F.lit(0)).cast("decimal(18,1)").alias("early_pct"),
        F.coalesce(of(VERY_LATE, "avg_review_score"), F.lit(0)).cast("decimal(18,2)")
        .alias("very_late_avg_review"),
        of(EARLY, "avg_delta_days").alias("early_avg_delta_days"),
    )
