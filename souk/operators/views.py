"""The five customer and delivery results by name.

Delivery is live: registering it runs nothing, and each read computes it from the tables. As
Spark lists a table's files when it is opened, new files show after opening the tables anew and
registering again.
The others look at the data when they are built, for the calendar's months or for ranges of
people; they are snapshots, made and renewed by ``refresh_views``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from souk.operators.churn import churn_risk
from souk.operators.cohort import cohort_retention
from souk.operators.delivery import delivery_performance
from souk.operators.rfm import rfm_segments
from souk.operators.value import customer_ltv
from souk.schema import Tables

# Names of the views, fixed values.
LIVE_VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "v_delivery_performance": lambda t: delivery_performance(t, extremes=False),
}
SNAPSHOT_VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "v_cohort_retention": cohort_retention,
    "v_clv": customer_ltv,
    "v_rfm_segments": rfm_segments,
    "v_churn_risk": churn_risk,
}


def register_views(t: Tables) -> None:
    """Make the tables and the live results readable from SQL. Runs no job."""
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    for name, view in LIVE_VIEWS.items():
        view(t).createOrReplaceTempView(name)


def refresh_views(t: Tables, *names: str) -> None:
    """Make or renew snapshots, all unless named, from the tables as they are now."""
    for name in names or SNAPSHOT_VIEWS:
        SNAPSHOT_VIEWS[name](t).createOrReplaceTempView(name)
