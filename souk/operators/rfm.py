"""Recency, frequency and money scored by quantile, and the segments they form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.calendar import whole_days
from souk.functions.exact import cents
from souk.operators.orders import customer_totals, last_purchase
from souk.plans.select import cuts, part
from souk.plans.slices import PERSON
from souk.plans.tables import materialize
from souk.schema import Tables

# Segment, then the (lowest, highest) score it takes of recency, frequency and money;
# None leaves that end open. The first that fits wins. Fixed values, as is the group below.
SEGMENTS = [
    ("Champions", (4, None), (4, None), (4, None)),
    ("Can't Lose Them", (None, 2), (4, None), (4, None)),
    ("Need Attention", (3, 3), (3, 3), (3, 3)),
    ("At Risk", (None, 2), (3, None), (3, None)),
    ("Loyal Customers", (None, None), (3, None), (3, None)),
    ("Potential Loyalists", (3, None), (2, None), (2, None)),
    ("New Customers", (4, None), (None, 2), (None, None)),
    ("Promising", (3, None), (None, 2), (None, 2)),
    ("Lost", (1, 1), (1, 1), (1, 1)),
    ("About to Sleep", (2, 2), (2, None), (None, None)),
    ("Hibernating", (None, 2), (None, 2), (None, None)),
]
OTHERS = "Others"
AT_RISK_GROUP = ["At Risk", "Hibernating", "About to Sleep"]


def segment(r: Column, f: Column, m: Column) -> Column:
    """Name of the segment that three scores form."""
    name = F
    for label, *ranges in SEGMENTS:
        fits = F.lit(True)
        for score, (lowest, highest) in zip((r, f, m), ranges):
            if lowest is not None:
                fits = fits & (score >= lowest)
            if highest is not None:
                fits = fits & (score <= highest)
        name = name.when(fits, label)
    return name.otherwise(OTHERS)


def rfm_segments(t: Tables, buckets: int = 5, ordered: bool = False) -> DataFrame:
    """People with a paid order, scored one to ``buckets`` on each measure.

    Equal values are split between buckets by person id.
    """
    return scored(customer_totals(t), last_purchase(t), buckets, ordered)


def scored(
    totals: DataFrame, last: Column, buckets: int = 5, ordered: bool = False
) -> DataFrame:
    """Segments of people's ``totals``, recency measured at ``last``.

    The cuts between buckets are found by counting; a person's scores then follow from the
    person's own row.
    """
    people = materialize(totals.select(
        PERSON, whole_days(last, F.col("last_order_date")).alias("recency_days"), "frequency",
        "monetary",
    ))
    values = [F.col("recency_days"), F.col("frequency"), cents("monetary")]
    found = cuts(people, PERSON, values, buckets)
    recency, frequency, money = (part(found, n, v, PERSON) for n, v in enumerate(values))
    segments = people.withColumns({
        "r_score": F.lit(buckets + 1) - recency, "f_score": frequency, "m_score": money,
    }).withColumn("segment", segment(F.col("r_score"), F.col("f_score"), F.col("m_score")))
    return segments.orderBy(F.desc_nulls_first("monetary"), PERSON) if ordered else segments
