"""The five views kept up to date from the files that were added since the last refresh.

A refresh reads the new files of orders, customers, payments and reviews, and adds a batch to
a folder of states. States merge: what a person or a day is in all batches follows from its
parts, never from the tables' older files.

- ``facts``: one row per order that a batch changed, as it then is: person, time, days
  late, cents, reviews. Parts may come in any order, a payment before its order too.
- ``months``: bits of a person's active months; they merge by OR.
- ``placed``: a person's orders of a batch in a row: how many, first, last, days between.
  Two such stretches merge if one ends before the other begins.
- ``paid``, ``running``: what a person's paid orders add, and their running totals, to
  which the totals of earlier stretches are added.
- ``delivery``: rows and review sums by days late, of what an order counts now less what
  it counted before.

Somebody whose stretches cross, because an order came late or was paid again, is computed from
their own facts. A batch counts once its number is committed, as a whole; a failed refresh
leaves none. Cost: new files, the facts of orders they touch, and views over states.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.functions import exact
from souk.functions.calendar import month_number, whole_days
from souk.operators.churn import churned, order_gaps
from souk.operators.cohort import WORD, retention
from souk.operators.delivery import days_late, summarised
from souk.operators.orders import order_reviews, order_values
from souk.operators.rfm import scored
from souk.operators.value import TIME, money_of, running_totals
from souk.plans import versions
from souk.plans.slices import PERSON
from souk.plans.tables import materialize
from souk.schema import SCHEMAS, Tables
from souk.sources import files

_READ = ("orders", "customers", "order_payments", "order_reviews")
_BOUGHT, _ORDER = TIME
_SUMS = ("cents", "reviews", "scores", "score_sum")


class Maintained:
    """States of the tables in ``folder``, as ``files.write_parquet`` keeps them, in ``state``.

    Rows are added to tables, never changed or removed; replacing the tables starts anew.
    Keys are those of ``schema``. Results equal those of the operators on all rows.
    ``schemas`` tells the tables' types where ids are not text.
    """

    def __init__(self, spark: SparkSession, folder: str, state: str,
                 schemas: Mapping[str, StructType] = SCHEMAS):
        self.spark, self.tables, self.schemas = spark, files.current(spark, folder), schemas
        self.state = f"{state}/{self.tables.rsplit('/', 1)[1]}"

    # --- states -----------------------------------------------------------------------------

    def batches(self) -> list[int]:
        return versions.committed(self.spark, self.state)

    def _states(self, name: str) -> DataFrame:
        """All batches' rows of a state, with their ``batch``."""
        paths = [f"{self.state}/{name}/batch={n}" for n in self.batches()]
        return self.spark.read.option("basePath", f"{self.state}/{name}").parquet(*paths)

    def _facts(self, of: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """The latest fact of each order; ``of`` narrows them by what never changes."""
        rows = of(self._states("facts"))
        kept = [name for name in rows.columns if name not in ("batch", _ORDER)]
        latest = rows.groupBy(_ORDER).agg(F.max_by(F.struct(*kept), "batch").alias("fact"))
        return latest.select(_ORDER, "fact.*")

    # --- refresh ----------------------------------------------------------------------------

    def refresh(self) -> bool:
        """Take in files added since the last refresh; False if there are none."""
        done = self.batches()
        listed = {
            n: self.spark.read.schema(self.schemas[n]).parquet(f"{self.tables}/{n}") for n in _READ
        }
        files_of = self.spark.createDataFrame(
            [(n, path) for n, df in listed.items() for path in df.inputFiles()],
            "table string, file string")
        if done:
            files_of = files_of.join(self._states("files"), ["table", "file"], "left_anti")
        new: dict[str, list[str]] = {n: [] for n in _READ}
        for table, path in files_of.agg(F.collect_list(F.struct("table", "file"))).first()[0]:
            new[table].append(path)
        if not any(new.values()):
            return False
        number = max(done, default=0) + 1

        def write(name: str, rows: DataFrame) -> DataFrame:
            path = f"{self.state}/{name}/batch={number}"
            rows.write.mode("overwrite").parquet(path)
            return self.spark.read.schema(rows.schema).parquet(path)

        added = {
            n: self.spark.read.schema(df.schema).parquet(*new[n]) if new[n] else df.limit(0)
            for n, df in listed.items()
        }
        facts = write("facts", self._changed(added, bool(done)))
        write("customers", added["customers"].select("customer_id", PERSON))
        for name, rows in _states_of(facts).items():
            write(name, rows)
        write("files", self.spark.createDataFrame(
            [(n, path) for n, paths in new.items() for path in paths], "table string, file string"))
        versions.commit(self.spark, self.state, number)
        return True

    def _changed(self, added: dict[str, DataFrame], more: bool) -> DataFrame:
        """The facts of all orders that new rows touch, beside what they were before.

        ``more``: there are earlier batches.
        """
        t = Tables(**added | {
            n: lambda: None for n in ("products", "sellers", "order_items",
                                      "product_category_translation")})
        customers = t.customers.select("customer_id", PERSON)
        parts = [
            t.orders.select(_ORDER, "customer_id", _BOUGHT, days_late().alias("delta"),
                            F.lit(True).alias("known")),
            order_values(t).withColumnRenamed("order_cents", "cents"),
            order_reviews(t),
        ]
        if more:
            customers = customers.unionByName(self._states("customers").select(*customers.columns))
            without = self._states("facts").filter(F.col(PERSON).isNull())
            parts.append(without.join(t.customers.select("customer_id"), "customer_id", "left_semi")
                         .select(_ORDER))
            touched = reduce(DataFrame.unionByName, [p.select(_ORDER) for p in parts]).distinct()
            before = self._facts(lambda rows: rows.join(touched, _ORDER, "left_semi"))
            parts.append(before.drop("placed_before", *(f"{n}_before" for n in (*_SUMS, "delta")))
                         .withColumn("old", F.lit(True)))
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if not more:
            rows = rows.withColumns({PERSON: F.lit(None).cast(t.customers.schema[PERSON].dataType),
                                     "old": F.lit(None).cast("boolean")})
        old = F.col("old")

        def held(column: Column) -> Column:
            return F.coalesce(F.bool_or(column), F.lit(False))

        merged = rows.groupBy(_ORDER).agg(
            held(F.col("known")).alias("known"),
            *(F.max(n).alias(n) for n in ("customer_id", _BOUGHT, "delta")),
            F.max(PERSON).alias("person_before"),
            *(F.sum(n).alias(n) for n in _SUMS),
            F.min("score_min").alias("score_min"), F.max("score_max").alias("score_max"),
            F.max(F.when(old, F.col("delta"))).alias("delta_before"),
            *(F.sum(F.when(old, F.col(n))).alias(f"{n}_before") for n in _SUMS),
        )
        return merged.join(customers, "customer_id", "left").withColumns({
            "placed_before": F.col("person_before").isNotNull(),
            PERSON: F.coalesce("person_before", PERSON),
        }).drop("person_before")

    # --- views ------------------------------------------------------------------------------

    def views(self) -> dict[str, Callable[[], DataFrame]]:
        """The five results by name, each from the states as they are when it is called."""
        return {
            "v_cohort_retention": self.cohort_retention,
            "v_clv": self.customer_ltv,
            "v_rfm_segments": self.rfm_segments,
            "v_churn_risk": self.churn_risk,
            "v_delivery_performance": self.delivery_performance,
        }

    def register(self) -> None:
        """Make the results readable from SQL, as of the last refresh."""
        for name, view in self.views().items():
            view().createOrReplaceTempView(name)

    def _last_purchase(self) -> Column:
        return self._states("clock").select(F.max("last")).scalar()

    def cohort_retention(self) -> DataFrame:
        start, end = self._states("clock").agg(
            F.min(month_number(F.col("first"))), F.max(month_number(F.col("last")))).first()
        start = (start or 0) // WORD * WORD
        bits, word = F.col("bits"), F.col("word")
        # The lowest bit alone, less one, has as many bits as there are months before it.
        lowest = F.bit_count(bits.bitwiseAND(-bits) - 1)
        people = self._states("months").groupBy(PERSON).agg(
            F.min(word * WORD + lowest - start).alias("first"),
            *(F.bit_or(F.when(word == start // WORD + n, bits).otherwise(F.lit(0).cast("bigint")))
              .alias(f"months_{n}") for n in range(((end or 0) - start) // WORD + 1)),
        )
        return retention(people, start, end or 0)

    def customer_ltv(self) -> DataFrame:
        stretches, late = _stretches(self._states("paid"))
        before = Window.partitionBy(PERSON).orderBy("first").rowsBetween(
            Window.unboundedPreceding, -1)
        carried = stretches.select(
            PERSON, "batch", F.sum("stretch_cents").over(before).alias("cents_before"),
            F.sum("stretch_orders").over(before).alias("orders_before"))
        on_time = self._states("running").join(carried, [PERSON, "batch"]).withColumns({
            "running_cents": F.col("running_cents") + F.coalesce("cents_before", F.lit(0)),
            "order_sequence": F.col("order_sequence") + F.coalesce("orders_before", F.lit(0)),
        })
        paid = self._facts(lambda rows: rows.join(late, PERSON, "left_semi")).filter(
            "known AND cents IS NOT NULL")
        crossed = running_totals(paid.select(
            PERSON, *reversed(TIME), F.col("cents").alias("order_cents")))
        return money_of(on_time.select(*crossed.columns).unionByName(crossed))

    def rfm_segments(self, buckets: int = 5) -> DataFrame:
        totals = self._states("paid").groupBy(PERSON).agg(
            F.sum("more_orders").alias("frequency"),
            exact.money(F.sum("more_cents")).alias("monetary"),
            F.max(f"last.{_BOUGHT}").alias("last_order_date"),
        )
        return scored(totals, self._last_purchase(), buckets)

    def churn_risk(self) -> DataFrame:
        stretches, late = _stretches(self._states("placed"))
        ended = F.lag("last").over(Window.partitionBy(PERSON).orderBy("first"))
        between = whole_days(F.col(f"first.{_BOUGHT}"), ended[_BOUGHT])
        on_time = stretches.select(
            PERSON, "order_count", "gaps", "gap_days", "last_order_date", between.alias("between")
        ).groupBy(PERSON).agg(
            F.sum("order_count").alias("order_count"),
            (F.sum("gap_days") + F.coalesce(F.sum("between"), F.lit(0))).alias("gap_days"),
            (F.sum("gaps") + F.count("between")).alias("gaps"),
            F.max("last_order_date").alias("last_order_date"),
        )
        placed = self._facts(lambda rows: rows.join(late, PERSON, "left_semi")).filter("known")
        crossed = order_gaps(placed.select(PERSON, *TIME))
        return churned(on_time.unionByName(crossed.select(*on_time.columns)), self._last_purchase())

    def delivery_performance(self) -> DataFrame:
        return summarised(self._states("delivery"), extremes=False)


def _states_of(facts: DataFrame) -> dict[str, DataFrame]:
    """A batch's states, of the orders it changed."""
    known = facts.filter("known AND customer_unique_id IS NOT NULL")
    place = F.struct(*TIME)
    new = known.filter("NOT placed_before").select(PERSON, *TIME)
    month = month_number(F.col(_BOUGHT))
    months = new.select(
        PERSON, F.floor(month / WORD).cast("int").alias("word"),
        (month % WORD).cast("int").alias("bit"),
    ).groupBy(PERSON, "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    placed = order_gaps(new, first=F.min(place), last=F.max(place))
    cents, before = F.col("cents"), F.when(F.col("placed_before"), F.col("cents_before"))
    paid = materialize(known.filter(cents.isNotNull() & ~cents.eqNullSafe(before)).select(
        PERSON, *TIME, cents.alias("order_cents"), before.alias("cents_before")))
    stretches = paid.groupBy(PERSON).agg(
        F.count("*").alias("stretch_orders"), F.sum("order_cents").alias("stretch_cents"),
        F.count_if(F.col("cents_before").isNull()).alias("more_orders"),
        F.sum(F.col("order_cents") - F.coalesce("cents_before", F.lit(0))).alias("more_cents"),
        F.min(place).alias("first"), F.max(place).alias("last"),
    )
    return {
        "months": months,
        "placed": placed,
        "paid": stretches,
        "running": running_totals(paid.drop("cents_before")),
        "delivery": _delivery(facts),
        "clock": facts.agg(F.min(_BOUGHT).alias("first"), F.max(_BOUGHT).alias("last")),
    }


def _delivery(facts: DataFrame) -> DataFrame:
    """What delivered orders now add to their day of delay, a row per day."""

    def rows(reviews: str) -> Column:
        return F.coalesce(reviews, F.lit(1))

    def change(name: str) -> Column:
        return F.coalesce(name, F.lit(0)) - F.when(
            F.col("delta_before").isNotNull(), F.coalesce(f"{name}_before", F.lit(0))).otherwise(0)

    counted = F.when(F.col("delta_before").isNotNull(), rows("reviews_before")).otherwise(0)
    return facts.filter("delta IS NOT NULL").groupBy("delta").agg(
        F.sum(rows("reviews") - counted).alias("rows"),
        F.sum(change("scores")).alias("scores"), F.sum(change("score_sum")).alias("score_sum"),
        F.min("score_min").alias("score_min"), F.max("score_max").alias("score_max"),
    )


def _stretches(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stretches of people whose stretches follow each other, and the people whose don't.

    A person has at most one a batch.
    """
    order = Window.partitionBy(PERSON).orderBy("first", "last")
    ended = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    checked = rows.withColumn("crosses", F.coalesce(ended >= F.col("first"), F.lit(False)))
    late = checked.filter("crosses").select(PERSON).distinct()
    return rows.join(late, PERSON, "left_anti"), late
