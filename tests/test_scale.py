"""What must hold however large the data: spread work, pruned scans, exact selection."""

import glob
import os
import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
from souk.operators import basic, joined, quality, rfm, summaries
from souk.operators.churn import churn_risk
from souk.operators.cohort import cohort_retention
from souk.operators.orders import customer_totals
from souk.operators.value import customer_ltv
from souk.plans import deal, results, slices, tables
from souk.plans.rank import ranked, tile
from souk.plans.select import at_positions, cuts, part
from souk.plans.tables import materialize
from souk.sources.star import read_star
from tests.tiny import rows, shop


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    return read_star(spark, sf_dir)


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def unmerged(spark):
    """Keeps small ranges apart, which would be merged at run time."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, before)


# --- positions ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def numbers(spark):
    return materialize(
        spark.range(30_000).select(
            F.col("id").cast("string").alias("key"),
            (F.pmod(F.xxhash64("id"), F.lit(7)) * F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)))
            .cast("int").alias("tied"),
            (F.pmod(F.xxhash64("id"), F.lit(99991)) / 100).cast("decimal(20,2)").alias("spread"),
        )
    )


def test_positions_equal_a_global_sort(numbers, unmerged):
    found = ranked(numbers, "key", ["tied", "spread"])
    for number, measure in enumerate(["tied", "spread"]):
        ordered = sorted(tuple(r) for r in numbers.select(measure, "key").collect())
        mine = found.filter(F.col("measure") == number).select("position", measure, "key", "size")
        assert [tuple(r) for r in mine.orderBy("position").collect()] == [
            (place, value, key, 30_000) for place, (value, key) in enumerate(ordered)]


def test_crowded_values_spread_over_slices(numbers, unmerged):
    text = plan(ranked(numbers, "key", ["tied"]))
    sizes = re.findall(r"slice", text)
    slices_of = ranked(numbers, "key", ["tied"]).groupBy(F.floor(F.col("position") / 3750)).count()
    assert sizes and {r["count"] for r in slices_of.collect()} == {3750}
    # Every window but those over the slices' sizes is within a slice.
    assert not re.search(r"Window \[row_number\(\)[^\n]*\], \[measure\], ", text)


def spread(spark, values, parts=4):
    kinds = "value long, key string"
    return materialize(spark.createDataFrame(
        [(v, f"k{i * 7919 % 1000:03d}") for i, v in enumerate(values)], kinds).repartition(parts))


@pytest.mark.parametrize("values", [
    [], [5], [None, None], [3, 1, 2], [7] * 50, [0, -1, 1, None, -(2**63), 2**63 - 1, 0],
    [(-1) ** i * i**7 for i in range(300)], [i % 4 for i in range(500)],
    [2**40 + i // 3 for i in range(400)],
])
def test_values_at_positions_equal_a_sort(spark, values):
    known = sorted(v for v in values if v is not None)
    found = at_positions(spread(spark, values), [F.col("value"), F.lit(3)],
                         lambda rows: {0, rows // 3, (rows - 1) // 2, rows // 2, rows - 1, rows, -1})
    for f in found:
        order = known if f.measure == 0 else [3] * len(values)
        assert order[f.position] == f.value
        assert f.left == f.position - order.index(f.value)
    assert {f.position for f in found if f.measure == 0} == {
        p for p in (0, len(known) // 3, (len(known) - 1) // 2, len(known) // 2, len(known) - 1)
        if 0 <= p < len(known)}


@pytest.mark.parametrize("size", [0, 4, 7, 501])
@pytest.mark.parametrize("distinct", [1, 3, 10**6])
def test_cuts_equal_ntile(spark, size, distinct):
    df = spread(spark, [i * 31 % 1009 % distinct - 5 for i in range(size)])
    by = Window.orderBy("value", "key")
    found = cuts(df, "key", [F.col("value"), -F.col("value")], 5)
    wrong = df.select(
        part(found, 0, F.col("value"), "key").alias("a"), F.ntile(5).over(by).alias("b"),
        part(found, 1, -F.col("value"), "key").alias("c"),
        F.ntile(5).over(Window.orderBy(-F.col("value"), "key")).alias("d"),
    ).filter("a != b OR c != d")
    assert wrong.count() == 0 and len(found) == 2 * min(4, max(0, size - 1))


def test_only_ties_of_a_cut_are_dealt_by_key(star, monkeypatch):
    from souk.plans import select
    written = []
    monkeypatch.setattr(
        select, "materialize", lambda df: written.append(materialize(df)) or written[-1])
    people = rfm.rfm_segments(star)
    tied = written[0].groupBy("measure").agg(F.count_distinct("value").alias("n")).collect()
    assert len(written) == 1 and all(r["n"] <= 4 for r in tied)
    assert "Window" not in plan(people) and "Exchange" not in plan(people)


def test_median_deals_no_rows_by_range(star):
    assert "rangepartitioning" not in plan(summaries.ltv_stats(customer_totals(star)))


def test_scores_equal_global_ntile(star):
    scored = rfm.rfm_segments(star)
    person = slices.PERSON
    wanted = scored.select(
        person,
        (6 - F.ntile(5).over(Window.orderBy("recency_days", person))).alias("r_score"),
        F.ntile(5).over(Window.orderBy("frequency", person)).alias("f_score"),
        F.ntile(5).over(Window.orderBy("monetary", person)).alias("m_score"),
    )
    assert scored.select(*wanted.columns).exceptAll(wanted).count() == 0


@pytest.mark.parametrize("size", [0, 1, 3, 5, 7, 12, 101])
def test_tiles_equal_ntile(spark, size):
    rows_of = spark.range(size).select("id", F.col("id").alias("position"), F.lit(size).alias("size"))
    got = [r[0] for r in rows_of.orderBy("id").select(tile(5)).collect()]
    each, left = divmod(size, 5)
    assert got == [b + 1 for b in range(5) for _ in range(each + (b < left))]


def test_nothing_is_fetched_to_the_driver():
    """Small fetches only: the calendar's months, and what the months of a matrix are."""
    fetches = []
    for path in glob.glob("souk/plans/*.py") + glob.glob("souk/operators/*.py"):
        with open(path) as code:
            fetches += [path for _ in re.findall(r"toArrow|toPandas|toLocalIterator|\.collect\(", code.read())]
    assert fetches == ["souk/operators/summaries.py"]


# --- one person with a third of all orders ------------------------------------------------


@pytest.fixture(scope="module")
def crowded(spark):
    draw = random.Random(7)
    start = datetime(2018, 1, 1)
    return shop(spark, [
        (f"o{i:05d}", "hot" if i % 3 == 0 else f"p{draw.randrange(400)}",
         # Many of the hot person's orders share one moment.
         start if i % 6 == 0 else start + timedelta(hours=draw.randrange(9000)),
         [f"{draw.randrange(1, 9999) / 100:.2f}"], [])
        for i in range(3000)
    ])


def test_hot_person_spreads_over_slices(crowded, unmerged):
    from souk.operators.orders import placed_orders
    line = slices.Timeline(placed_orders(crowded), ["order_purchase_timestamp", "order_id"])
    sizes = line.rows.filter(F.col(slices.PERSON) == "hot").groupBy("slice").count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 1000


def test_slices_change_no_running_total(crowded, unmerged):
    from souk.functions import exact
    from souk.operators.orders import paid_orders
    person = Window.partitionBy(slices.PERSON).orderBy("order_purchase_timestamp", "order_id")
    wanted = paid_orders(crowded).select(
        slices.PERSON, "order_id",
        exact.money(F.sum("order_cents").over(person.rowsBetween(Window.unboundedPreceding, 0)))
        .alias("cumulative_revenue"),
        F.row_number().over(person).cast("bigint").alias("order_sequence"),
    )
    assert rows(customer_ltv(crowded).select(*wanted.columns)) == rows(wanted)


def test_slices_change_no_gap(crowded, unmerged):
    from souk.functions.calendar import whole_days
    from souk.operators.orders import placed_orders
    person = Window.partitionBy(slices.PERSON).orderBy("order_purchase_timestamp", "order_id")
    bought = F.col("order_purchase_timestamp")
    gaps = placed_orders(crowded).withColumn("gap", whole_days(bought, F.lag(bought).over(person)))
    wanted = gaps.groupBy(slices.PERSON).agg(
        F.count("*").alias("order_count"),
        F.round(F.avg("gap"), 1).cast("decimal(18,1)").alias("avg_days_between"),
    ).filter("order_count > 1")
    assert rows(churn_risk(crowded).select(*wanted.columns)) == rows(wanted)


@pytest.mark.parametrize("operator", [customer_ltv, churn_risk])
def test_no_window_spans_a_person(star, operator):
    """Windows over orders are within a slice; those by person see a row per slice."""
    for window in re.findall(r"Window \[.*?\], \[(\w+(?:, \w+)*)\]", plan(operator(star))):
        assert "slice" in window or window == slices.PERSON
    text = plan(operator(star))
    assert not re.search(r"row_number\(\)[^\n]*\], \[customer_unique_id\], ", text)


# --- invariants -----------------------------------------------------------------------------


def test_invariants(star):
    totals = customer_totals(star).cache()
    people = totals.count()
    ltv = customer_ltv(star)
    last = ltv.groupBy(slices.PERSON).agg(
        F.max_by("cumulative_revenue", "order_sequence").alias("monetary"),
        F.max("order_sequence").alias("frequency"),
    )
    assert last.exceptAll(totals.select(*last.columns)).count() == 0
    assert summaries.ltv_histogram(totals).agg(F.sum("customers")).first()[0] == people
    scored = rfm.rfm_segments(star)
    for score in ("r_score", "f_score", "m_score"):
        sizes = [r["count"] for r in scored.groupBy(score).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1 and sum(sizes) == people
    churn = churn_risk(star).cache()
    headline = summaries.churn_headline(churn).first()
    assert headline.active + headline.churned == headline.repeat_customers == churn.count()
    assert (summaries.churn_histogram(churn).agg(F.sum("customers")).first()[0]
            == headline.repeat_customers)
    totals.unpersist()
    churn.unpersist()
    share = basic.review_distribution(star).agg(F.sum("pct_of_total")).first()[0]
    assert abs(share - 100) <= Decimal("0.5")


def test_sample_is_repeatable_and_seeded(spark, star):
    scored = rfm.rfm_segments(star)
    first = rows(summaries.rfm_sample(scored, n=100))
    assert len(first) == 100
    assert first == rows(summaries.rfm_sample(scored.repartition(13), n=100))
    assert first != rows(summaries.rfm_sample(scored, n=100, seed=1))
    assert set(first) <= set(rows(summaries.rfm_sample(scored, n=2000)))


# --- plans ------------------------------------------------------------------------------------


@pytest.mark.parametrize("operator", [
    basic.top_products, basic.orders_in_range, basic.top_payments, joined.order_details,
    joined.above_average_spenders, lambda t: summaries.ltv_top_customers(customer_totals(t)),
    lambda t: summaries.churn_customers(churn_risk(t)),
])
def test_top_rows_need_no_full_sort(star, operator):
    assert "TakeOrderedAndProject" in plan(operator(star))


def test_no_python_in_any_plan(spark, sf_dir):
    for key, query in contract.queries().items():
        if key in contract.CORPUS_QUERIES:
            continue
        text = plan(query(spark, sf_dir))
        assert not re.search(r"Python|MapInPandas|CartesianProduct|BroadcastNestedLoop", text), key


def test_date_range_reaches_the_scan(star):
    text = plan(basic.orders_in_range(star, "1998-01-01", "1998-04-01"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "o_totalprice" not in text


@pytest.fixture
def no_broadcasts(spark):
    """Lets nothing be broadcast that is not asked for."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


@pytest.mark.parametrize("operator", [
    rfm.rfm_segments, joined.above_average_spenders, joined.seller_performance,
    lambda t: summaries.ltv_stats(customer_totals(t)),
    lambda t: summaries.cohort_matrix(cohort_retention(t)),
])
def test_results_read_twice_are_computed_once(star, operator):
    """Only written results are scanned, not the tables they come from."""
    scanned = re.findall(r"FileScan parquet \[(.*?)\]", plan(operator(star)))
    assert scanned and not re.search(r"\b[olcp]_", ",".join(scanned))


def raw_exchanges(text, column):
    """Exchanges that shuffle a source table's rows: nothing but filters in between."""
    lines = [line.lstrip(" :+-*(0123456789)") for line in text.splitlines()]
    found = 0
    for number, line in enumerate(lines):
        if line.startswith("Exchange hashpartitioning"):
            for below in lines[number + 1:]:
                if below.startswith("FileScan"):
                    found += column in below
                    break
                if not below.startswith(("Project", "Filter", "ColumnarToRow", "InputAdapter", "WholeStage")):
                    break
    return found


@pytest.mark.parametrize("operator", [
    lambda t: joined.underperforming_sellers(t, 500, 4), joined.seller_performance])
def test_items_are_shuffled_once(star, no_broadcasts, operator, monkeypatch):
    written = []
    monkeypatch.setattr(joined, "materialize", lambda df: written.append(df) or df)
    result = operator(star)
    assert raw_exchanges(plan((written or [result])[0]), "l_suppkey") == 1


@pytest.mark.parametrize("operator", [
    lambda t: joined.underperforming_sellers(t, 500, 4), joined.seller_performance])
def test_parts_of_items_follow_their_number(star, no_broadcasts, operator, monkeypatch):
    usual = operator(star).collect()
    monkeypatch.setattr(deal, "ROWS", 1000)
    parts = -(-star.order_items.count() // 1000)
    assert parts > 8 * deal.MERGED
    written = []
    monkeypatch.setattr(joined, "materialize", lambda df: written.append(df) or materialize(df))
    assert operator(star).collect() == usual
    result = operator(star)
    text = plan((written or [result])[-1])
    # Items once; orders; reviews to be folded, and then as the items are.
    dealt = re.findall(r"Exchange hashpartitioning\(order_id[^,]*, (\d+)\)", text)
    assert sorted(map(int, dealt)) == [8, parts, parts, parts]


def test_details_of_the_newest_shuffle_no_reviews(star, no_broadcasts):
    text = plan(joined.order_details(star))
    assert "BroadcastHashJoin" in text
    # Reviews derive from orders: their scan holds the union's two parts.
    assert not re.search(r"Exchange hashpartitioning\(order_id[^\n]*\n[^\n]*Union", text)
    assert raw_exchanges(text, "l_extendedprice") == 0


def test_all_details_shuffle_orders_columns_once_an_order(star, no_broadcasts):
    text = plan(joined.order_details(star, k=None))
    # Named items, placed orders and reviews: their join is not dealt again.
    assert text.count("Exchange hashpartitioning(order_id") == 3
    assert text.count("Exchange hashpartitioning(product_id") == 2
    assert raw_exchanges(text, "l_extendedprice") == 1


# --- written tables ---------------------------------------------------------------------------


def test_owned_tables_are_gone_afterwards(spark, star, tmp_path):
    folder = tables.scratch_folder(spark)
    before = set(os.listdir(folder))
    with tables.owned(spark):
        assert summaries.rfm_segment_counts(rfm.rfm_segments(star)).count() > 0
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_summaries_share_one_base(spark, star):
    with tables.owned(spark):
        base = materialize(rfm.rfm_segments(star))
        counts, headline = summaries.rfm_segment_counts(base), summaries.rfm_headline(base)
        assert sum(r["count"] for r in counts.collect()) == headline.first().total_customers
        assert "ranked" not in plan(counts) and "Window" not in plan(counts)


def test_summaries_of_one_result_compute_it_once(spark, sf_dir, monkeypatch):
    runs = []
    real = rfm.scored
    monkeypatch.setattr(rfm, "scored", lambda *a, **k: runs.append(1) or real(*a, **k))
    with tables.owned(spark):
        bases = []
        for _ in range(2):  # tables opened anew over the same files
            base = results.shared(rfm.rfm_segments, read_star(spark, sf_dir))
            bases.append(base.inputFiles())
        assert len(runs) == 1 and bases[0] == bases[1]
        results.shared(rfm.rfm_segments, read_star(spark, sf_dir), buckets=3)
        results.shared(rfm.rfm_segments, read_star(spark, sf_dir.replace("0.01", "0.001")))
        assert len(runs) == 3
    with tables.owned(spark):  # the owner's results went with it
        results.shared(rfm.rfm_segments, read_star(spark, sf_dir))
    assert len(runs) == 4


def test_a_shared_result_sees_new_files(spark, tmp_path):
    from souk.sources import files
    from tests.test_maintained import frames, make
    folder = str(tmp_path / "shop")
    made = make(2, orders=20)
    files.write_parquet(frames(spark, made), folder)
    with tables.owned(spark):
        def totals():
            return results.shared(customer_totals, files.read_parquet(spark, folder)).inputFiles()

        first = totals()
        files.append_parquet({"order_reviews": frames(spark, make(3, 2)).order_reviews}, folder)
        assert totals() == first  # nothing it reads
        files.append_parquet({"order_payments": frames(spark, make(3, 2)).order_payments}, folder)
        assert totals() != first


# --- checks -----------------------------------------------------------------------------------


def test_a_key_and_its_references_meet_in_one_shuffle(star, no_broadcasts):
    text = plan(quality.integrity(star))
    # Orders, and all that refer to them: one; likewise customers, products, sellers.
    assert len(re.findall(r"Exchange hashpartitioning\(key", text)) == 4
    assert "LeftAnti" not in text


def test_load_checks_read_each_table_once(spark, star, tmp_path):
    from souk.sources import files
    checks = quality.LoadChecks()
    with tables.owned(spark):
        files.write_parquet(star, str(tmp_path / "t"), watched=checks.watched)
    found = {(r.check_name, r.table_name, r.column_name): r.n for r in checks.report(spark).collect()}
    for name, df in star.items():
        assert found["rows", name, ""] == df.count()
    for r in quality.null_checks(star).collect():
        assert found["nulls", r.table_name, r.column_name] == r.n_null
    for r in quality.length_checks(star).collect():
        assert found["long", r.table_name, r.column_name] == r.n_long
