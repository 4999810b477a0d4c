"""Running computations per person that stay spread when one person is huge.

A window partitioned by person puts all of a person's rows in one task. Few people can hold
a large share of all rows, though; their number is bounded by the share. Rows are written
once, people are counted, and a bounded sample of the large ones' times cuts those people's
time lines into slices. Windows run per (person, slice), and the state at the end of each
slice is carried to the person's later slices. Everybody else is one slice. The plan is the
same whatever the data, and where slices are cut changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from souk.plans.tables import materialize

PERSON = "customer_unique_id"
#: A person with this share of all rows, or more, is cut into slices of about that share.
SHARE = 256
#: Sampled rows between two cuts.
_APART = 32


class Timeline:
    """A person's rows in time order, ready for windows.

    ``rows`` holds the data, ``window`` the order within a person's slice. ``carry``
    brings in what earlier slices of the person left behind. No two rows of a person have
    the same ``order``.
    """

    def __init__(self, rows: DataFrame, order: Sequence[str]):
        written = materialize(rows)
        total = written.select(F.count("*")).scalar()
        # At most SHARE people, as each has its share of the rows.
        large = (
            written.groupBy(PERSON).agg(F.count("*").alias("held"))
            .filter((F.col("held") > 1) & (F.col("held") * SHARE >= total)).select(PERSON)
        )
        place = F.struct(*order)
        step = F.greatest(F.floor(total / (SHARE * _APART)), F.lit(1))
        # SHARE * _APART rows in all, as far as hashes are even; where it is cut is free.
        self.cuts = materialize(
            written.join(F.broadcast(large), PERSON, "left_semi")
            .filter(F.pmod(F.xxhash64(*order), step) == 0)
            .groupBy(PERSON).agg(F.array_sort(F.collect_list(place)).alias("places"))
            .select(PERSON, F.filter("places", lambda _, i: i % _APART == _APART - 1).alias("cuts"))
        )
        reached = F.size(F.filter("cuts", lambda cut: cut <= place))
        self.rows = (
            written.join(F.broadcast(self.cuts), PERSON, "left")
            .withColumn("slice", F.when(F.col("cuts").isNull(), 0).otherwise(reached))
            .drop("cuts")
        )
        self.window: WindowSpec = Window.partitionBy(PERSON, "slice").orderBy(*order)

    def carry(self, totals: dict[str, Column], state: dict[str, Column]) -> DataFrame:
        """``rows`` with a column per entry of ``state``: NULL unless a person continues.

        ``totals`` aggregate a (person, slice); ``state`` derives from them over the
        person's slices, ordered, through ``earlier()`` or ``previous()``. Only people who are
        cut have several slices, so the carried rows number about two per share and are
        broadcast.
        """
        ends = (
            self.rows.join(F.broadcast(self.cuts), PERSON, "left_semi")
            .groupBy(PERSON, "slice").agg(*(c.alias(name) for name, c in totals.items()))
        )
        carried = ends.select(
            PERSON, "slice", *(c.alias(name) for name, c in state.items()))
        return self.rows.join(F.broadcast(carried), [PERSON, "slice"], "left")


def earlier(total: str) -> Column:
    """Sum of ``total`` over the person's earlier slices."""
    slices = Window.partitionBy(PERSON).orderBy("slice")
    return F.sum(total).over(slices.rowsBetween(Window.unboundedPreceding, -1))


def previous(total: str) -> Column:
    """``total`` of the person's slice before this one."""
    return F.lag(total).over(Window.partitionBy(PERSON).orderBy("slice"))
