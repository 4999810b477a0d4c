"""Positions in global orderings of a large frame, without a global sort in one task.

Every row is listed once per ordering, and the list is range-partitioned by ordering,
value and key. A partition, written with its number, is a slice; rows are numbered within
their slice, and the sizes of earlier slices are added. The key in the ordering splits
any crowd of equal values. Nothing is fetched to the driver, and the plan is the same for
any number of rows: one range shuffle, one shuffle by slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.plans.tables import materialize


def ranked(df: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Rows (measure, position, size, key, *measures): each row of ``df`` once per measure.

    ``measure`` is an index into ``measures``; ``position`` counts from 0 by that measure
    and the key, ascending; ``size`` is the number of rows. Only the row's own measure is
    not NULL. ``key`` differs from row to row; measures are not NULL. Pass a written frame:
    choosing the ranges reads it a second time.
    """
    own = [
        F.struct(F.lit(number).alias("measure"), *(
            (F.col(name) if name == measure else F.lit(None).cast(df.schema[name].dataType))
            .alias(name) for name in measures
        ))
        for number, measure in enumerate(measures)
    ]
    listed = df.select(key, F.explode(F.array(*own)).alias("row")).select(key, "row.*")
    order = [*measures, key]
    sliced = materialize(
        listed.repartitionByRange("measure", *order).withColumn("slice", F.spark_partition_id())
    )
    # At most a row per slice and measure.
    sizes = sliced.groupBy("measure", "slice").agg(F.count("*").alias("held"))
    slices = Window.partitionBy("measure").orderBy("slice")
    starts = sizes.select(
        "measure", "slice",
        F.coalesce(F.sum("held").over(slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("start"),
        F.sum("held").over(Window.partitionBy("measure")).alias("size"),
    )
    within = Window.partitionBy("measure", "slice").orderBy(*order)
    numbered = sliced.withColumn("number", F.row_number().over(within) - 1)
    return numbered.join(starts, ["measure", "slice"]).select(
        "measure", (F.col("number") + F.col("start")).alias("position"), "size", key, *measures
    )


def tile(buckets: int) -> Column:
    """Bucket, from 1, of a row of ``ranked`` among ``buckets`` equal parts.

    The first parts take the remainder, one row each.
    """
    each, left = F.floor(F.col("size") / buckets), F.col("size") % buckets
    long = left * (each + 1)  # rows in the parts that hold one more
    position = F.col("position")
    return F.when(position < long, F.floor(position / (each + 1))).otherwise(
        left + F.floor((position - long) / F.greatest(each, F.lit(1)))
    ).cast("int") + 1
