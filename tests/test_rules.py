"""Semantics that a plausible rewrite would get wrong, on hand-made tables."""

import itertools
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.functions import exact
from souk.operators import basic, joined, quality, summaries
from souk.operators.churn import churn_risk
from souk.operators.cohort import cohort_retention
from souk.operators.delivery import delivery_performance
from souk.operators.rfm import rfm_segments, segment
from souk.operators.value import customer_ltv
from souk.schema import Tables
from tests.tiny import rows, shop, tables

NOON = datetime(2018, 1, 1, 12)


def test_delivery_days_truncate_toward_zero(spark):
    lateness = {
        "a": timedelta(hours=-12), "b": timedelta(hours=-60), "c": timedelta(hours=20),
        "d": timedelta(days=7, hours=23), "e": timedelta(days=8),
    }
    t = tables(spark, orders=[
        {"order_id": k, "order_status": "delivered", "order_estimated_delivery_date": NOON,
         "order_delivered_customer_date": NOON + late}
        for k, late in lateness.items()
    ])
    result = delivery_performance(t).collect()
    assert [(r.delivery_bucket, r.order_count, r.avg_delta_days) for r in result] == [
        ("Early", 1, Decimal("-2.0")), ("On-Time", 2, Decimal("0.0")),
        ("Late (1–7 days)", 1, Decimal("7.0")), ("Late (>7 days)", 1, Decimal("8.0")),
    ]
    assert all(r.avg_review_score is None for r in result)
    assert "min_review" not in delivery_performance(t, extremes=False).columns


@pytest.mark.parametrize("total,count,digits,units,expected", [
    (25865, 2, 2, 100, "129.33"), (-25865, 2, 2, 100, "-129.33"), (1, 8, 2, 1, "0.13"),
    (-1, 8, 2, 1, "-0.13"), (5, 2, 0, 1, "3"), (2, 3, 1, 1, "0.7"), (7, 0, 1, 1, None),
])
def test_means_round_half_away_from_zero(spark, total, count, digits, units, expected):
    frame = spark.createDataFrame([(total, count)], "total bigint, count bigint")
    value = frame.select(exact.mean(F.col("total"), F.col("count"), digits, units)).first()[0]
    assert value == (expected and Decimal(expected))


def _fanout(spark):
    """One delivered order of three items by two sellers, reviewed twice."""
    return tables(
        spark,
        orders=[{"order_id": "o", "customer_id": "c", "order_status": "delivered",
                 "order_purchase_timestamp": NOON, "order_estimated_delivery_date": NOON,
                 "order_delivered_customer_date": NOON - timedelta(days=3)}],
        customers=[{"customer_id": "c", "customer_unique_id": "p"}],
        products=[{"product_id": "known", "product_category_name": "casa"},
                  {"product_id": "raw", "product_category_name": "moveis"},
                  {"product_id": "none"}],
        product_category_translation=[
            {"product_category_name": "casa", "product_category_name_english": "house"}],
        sellers=[{"seller_id": "s"}, {"seller_id": "u"}],
        order_items=[
            {"order_id": "o", "order_item_id": n, "product_id": product, "seller_id": seller,
             "price": Decimal("10.00")}
            for n, product, seller in [(1, "known", "s"), (2, "raw", "s"), (3, "none", "u")]
        ],
        order_reviews=[{"order_id": "o", "review_score": 5}, {"order_id": "o", "review_score": 2}],
        order_payments=[{"order_id": "o", "payment_value": Decimal("30.00")}],
    )


def test_reviews_repeat_items(spark):
    t = _fanout(spark)
    assert rows(joined.order_details(t), "order_item_id", "product_category_english",
                "review_score") == [
        (1, "house", 2), (1, "house", 5), (2, "moveis", 2), (2, "moveis", 5),
        (3, "unknown", 2), (3, "unknown", 5),
    ]
    assert joined.order_details(t, k=None).count() == 6
    assert joined.order_details(t, k=4).count() == 4
    assert rows(joined.underperforming_sellers(t, 1, 4)) == [
        ("s", 1, 4, Decimal("3.50"), Decimal("40.00")),
        ("u", 1, 2, Decimal("3.50"), Decimal("20.00")),
    ]
    assert rows(joined.seller_performance(t, 4), "seller_id", "items_sold", "distinct_orders",
                "unique_customers", "total_revenue", "avg_review",
                "avg_delivery_delta_days") == [
        ("s", 4, 1, 1, Decimal("40.00"), Decimal("3.50"), Decimal("-3.0")),
    ]


def test_details_reach_past_newest_orders_without_items(spark):
    newest = [{"order_id": f"n{i}", "customer_id": f"n{i}",
               "order_purchase_timestamp": NOON + timedelta(days=i)} for i in range(150)]
    t = tables(
        spark, orders=[{"order_id": "old", "customer_id": "c",
                        "order_purchase_timestamp": NOON}, *newest],
        customers=[{"customer_id": "c"}], products=[{"product_id": "p"}],
        order_items=[{"order_id": "old", "product_id": "p"}],
    )
    assert rows(joined.order_details(t), "order_id") == [("old",)]


@pytest.mark.parametrize("review,days,tier", [
    ([5], -1, joined.STAR), ([4], 0, joined.ABOVE), ([2], 0, joined.UNDER), ([5], 11, joined.UNDER),
    ([3], 5, joined.AVERAGE),
])
def test_seller_tiers(spark, review, days, tier):
    """A second seller at (4, 0) keeps the platform's means at or under 4.5 and 5.5 days."""
    t = tables(
        spark, customers=[{"customer_id": "a"}, {"customer_id": "b"}],
        sellers=[{"seller_id": "a"}, {"seller_id": "b"}],
        orders=[{"order_id": k, "customer_id": k, "order_status": "delivered",
                 "order_estimated_delivery_date": NOON,
                 "order_delivered_customer_date": NOON + timedelta(days=d)}
                for k, d in [("a", days), ("b", 0)]],
        order_items=[{"order_id": "a", "seller_id": "a"}, {"order_id": "b", "seller_id": "b"}],
        order_reviews=[{"order_id": "a", "review_score": s} for s in review]
        + [{"order_id": "b", "review_score": 4}],
    )
    found = dict(rows(joined.seller_performance(t, 1), "seller_id", "performance_tier"))
    assert found["a"] == tier


def test_tiers_and_orders_without_reviews_or_payments(spark):
    t = shop(spark, [
        ("a", "p", NOON, ["30.00", "19.99"], [5, 1]), ("b", "p", NOON, ["50.00"], []),
        ("c", "q", NOON, ["499.99"], [4]), ("d", "q", NOON, ["500.00"], [3]),
        ("unpaid", "r", NOON, [], [5]),
    ])
    assert [tuple(r) for r in joined.order_value_tiers(t).collect()] == [
        ("Low (<R$50)", 2, Decimal("49.99"), Decimal("3.00")),
        ("Medium (R$50–200)", 1, Decimal("50.00"), None),
        ("High (R$200–500)", 1, Decimal("499.99"), Decimal("4.00")),
        ("Premium (>R$500)", 1, Decimal("500.00"), Decimal("3.00")),
    ]
    assert {r[0] for r in rows(customer_ltv(t), "customer_unique_id")} == {"p", "q"}
    assert rows(joined.above_average_spenders(t), "customer_unique_id", "lifetime_spend") == [
        ("q", Decimal("999.99")),
    ]


def _same_time(spark):
    return shop(spark, [
        ("b", "p", NOON, ["2.00"], []), ("a", "p", NOON, ["1.00"], []),
        ("c", "p", NOON - timedelta(days=1), ["4.00"], []), ("z", "q", NOON, ["8.00"], []),
    ])


def test_ltv_orders_equal_times_by_order(spark):
    t = _same_time(spark)
    assert rows(customer_ltv(t), "customer_unique_id", "order_sequence",
                "order_id", "cumulative_revenue") == [
        ("p", 1, "c", Decimal("4.00")), ("p", 2, "a", Decimal("5.00")),
        ("p", 3, "b", Decimal("7.00")), ("q", 1, "z", Decimal("8.00")),
    ]
    assert [r.order_id for r in customer_ltv(t, ordered=True).collect()] == ["c", "a", "b", "z"]


def test_churn(spark):
    day = timedelta(days=1)
    t = shop(spark, [
        ("a1", "steady", NOON, [], []), ("a2", "steady", NOON + 10 * day, [], []),
        ("a3", "steady", NOON + 20.9 * day, [], []),  # 10 whole days later
        ("b1", "twice", NOON, [], []), ("b2", "twice", NOON, [], []),
        ("c1", "once", NOON + 36 * day, [], []),
        ("d1", "edge", NOON, [], []), ("d2", "edge", NOON + 10 * day, [], []),
        ("d3", "edge", NOON + 21 * day, [], []),
    ])
    assert rows(churn_risk(t), "customer_unique_id", "order_count",
                "avg_days_between", "days_since_last", "churn_threshold", "is_churned") == [
        # 11 and 10 average 10.5; one and a half times that rounds from 15.75 to 15.8.
        ("edge", 3, Decimal("10.5"), 15, Decimal("15.8"), False),
        # 15.1 days of silence count as 15, which is not more than the threshold.
        ("steady", 3, Decimal("10.0"), 15, Decimal("15.0"), False),
        ("twice", 2, Decimal("0.0"), 36, Decimal("0.0"), True),
    ]


def test_cohort_months_do_not_wrap(spark):
    t = shop(spark, [
        (str(i), "p", datetime(y, m, 15), [], [])
        for i, (y, m) in enumerate([(2016, 12), (2017, 1), (2017, 1), (2018, 1), (2023, 12)])
    ] + [("x", "q", datetime(2017, 1, 2), [], [])])
    assert rows(cohort_retention(t)) == [
        (date(2016, 12, 1), 1, n, 1, Decimal("100.00")) for n in (0, 1, 13)
    ] + [(date(2016, 12, 1), 1, 84, 1, Decimal("100.00")),
         (date(2017, 1, 1), 1, 0, 1, Decimal("100.00"))]
    matrix = summaries.cohort_matrix(cohort_retention(t), min_size=1)
    assert matrix.columns == ["cohort", "M0", "M1", "M13", "M84"]
    assert [tuple(r) for r in matrix.collect()][1] == ("2017-01", 100, 0, 0, 0)


# A line per recency score, a group per frequency score, a letter per money score.
CELLS = [
    "XHHHH HHHHH --RRR --RWW --RWW",
    "HHHHH SSSSS SSRRR SSRWW SSRWW",
    "MM--- MPPPP -PNLL -PLLL -PLLL",
    "YYYYY YPPPP -PLLL -PLCC -PLCC",
    "YYYYY YPPPP -PLLL -PLCC -PLCC",
]
LETTERS = {
    "C": "Champions", "W": "Can't Lose Them", "N": "Need Attention", "R": "At Risk",
    "L": "Loyal Customers", "P": "Potential Loyalists", "Y": "New Customers", "M": "Promising",
    "X": "Lost", "S": "About to Sleep", "H": "Hibernating", "-": "Others",
}


def test_segment_truth_table(spark):
    scores = [(r, f, m) for r, f, m in itertools.product(range(1, 6), repeat=3)]
    cells = spark.createDataFrame(scores, "r int, f int, m int")
    named = {tuple(r)[:3]: r[3] for r in cells.select("*", segment(*map(F.col, "rfm"))).collect()}
    for (r, f, m), name in named.items():
        assert name == LETTERS[CELLS[r - 1].split()[f - 1][m - 1]], (r, f, m)
    won = Counter(named.values())
    assert won == {
        "Champions": 8, "Can't Lose Them": 8, "Need Attention": 1, "At Risk": 10,
        "Loyal Customers": 18, "Potential Loyalists": 21, "New Customers": 12, "Promising": 3,
        "Lost": 1, "About to Sleep": 11, "Hibernating": 14, "Others": 18,
    }


@pytest.mark.parametrize("people", [0, 3, 5, 7])
def test_scores_of_few_people(spark, people):
    t = shop(spark, [
        (f"o{i}", f"p{i}", NOON - timedelta(days=i), [f"{i}.00"], []) for i in range(people)
    ])
    result = rows(rfm_segments(t), "recency_days", "r_score", "f_score", "m_score")
    sizes = [people // 5 + (b < people % 5) for b in range(5)]
    tiles = [b + 1 for b in range(5) for _ in range(sizes[b])]
    assert result == [(i, 6 - tiles[i], tiles[i], tiles[i]) for i in range(people)]


def test_null_scores_do_not_count_in_means(spark):
    late, seller = datetime(2018, 1, 9), {"seller_id": "s1"}
    t = tables(
        spark,
        orders=[dict(order_id=o, customer_id=o, order_status="delivered",
                     order_delivered_customer_date=late, order_estimated_delivery_date=late)
                for o in ("o1", "o2")],
        customers=[dict(customer_id=o, customer_unique_id=o) for o in ("o1", "o2")],
        order_items=[dict(order_id=o, order_item_id=1, **seller) for o in ("o1", "o2")],
        order_payments=[dict(order_id=o, payment_value=Decimal("10.00")) for o in ("o1", "o2")],
        sellers=[seller],
    )
    t = Tables(**dict(t.items()) | {"order_reviews": spark.createDataFrame(
        [("o1", 2), ("o1", None), ("o2", None)], "order_id string, review_score int")})
    (low,) = joined.underperforming_sellers(t, 3, 3).collect()
    assert (low.items_sold, low.avg_review_score) == (3, Decimal("2.00"))
    (tier,) = joined.order_value_tiers(t).collect()
    assert (tier.order_count, tier.avg_review_score) == (3, Decimal("2.00"))
    (graded,) = joined.seller_performance(t, 1).collect()
    assert (graded.items_sold, graded.avg_review) == (3, Decimal("2.00"))
    (bucket,) = delivery_performance(t).collect()
    assert (bucket.order_count, bucket.avg_review_score) == (3, Decimal("2.00"))


@pytest.mark.parametrize("values,median", [
    (["1.00"], 1), (["1.00", "2.00"], 2), (["0.01", "0.02", "9.00"], 0), ([], None),
])
def test_ltv_stats(spark, values, median):
    t = shop(spark, [(f"o{i}", f"p{i}", NOON, [v], []) for i, v in enumerate(values)])
    from souk.operators.orders import customer_totals
    result = summaries.ltv_stats(customer_totals(t)).first()
    assert result["median"] == median
    assert result["multi_order"] == 0


def test_summaries_of_nothing(spark):
    t = shop(spark, [("a", "p", NOON, ["1.00"], [])])
    headline = summaries.churn_headline(churn_risk(t)).first()
    assert (headline.repeat_customers, headline.active_pct, headline.avg_cadence_days) == (
        0, None, None)
    empty = summaries.delivery_headline(delivery_performance(t)).first()
    assert (empty.early_pct, empty.very_late_avg_review, empty.early_avg_delta_days) == (0, 0, None)
    cohorts = summaries.cohort_headline(cohort_retention(t), min_size=1).first()
    assert tuple(cohorts) == (1, 1, 0, 0)
    assert summaries.churn_histogram(churn_risk(t)).count() == 0
    assert cohort_retention(tables(spark)).count() == 0


def test_churn_customers_by_status(spark):
    day = timedelta(days=1)
    t = shop(spark, [
        ("a1", "on", NOON, [], []), ("a2", "on", NOON + 9 * day, [], []),
        ("b1", "off", NOON, [], []), ("b2", "off", NOON + day, [], []),
    ])
    churn = churn_risk(t)
    for status, people in {"all": ["off", "on"], "active": ["on"], "churned": ["off"]}.items():
        found = summaries.churn_customers(churn, status).collect()
        assert [r.customer_unique_id for r in found] == people


def test_quality(spark):
    t = tables(
        spark,
        customers=[{"customer_id": "a", "customer_state": "SPX"}, {"customer_id": "a"}],
        orders=[{"order_id": "o", "customer_id": "a"}, {"order_id": "p", "customer_id": "gone"}],
        order_reviews=[{"order_id": "o", "review_id": "r"}, {"order_id": "x", "review_id": "r"}],
    )
    checked = quality.row_count_validation(t, {"orders": 2, "customers": 3}).collect()
    counts = {r[0]: tuple(r)[1:] for r in checked}
    assert counts["orders"] == (2, 2, True) and counts["customers"] == (2, 3, False)
    assert counts["sellers"] == (0, None, None)
    keys = {r.table_name: r.n_dup_keys for r in quality.key_uniqueness(t).collect()}
    assert keys["customers"] == 1 and keys["order_reviews"] == 1 and keys["orders"] == 0
    orphans = {r.fk: r.n_orphans for r in quality.referential_integrity(t).collect()}
    assert orphans["orders.customer_id"] == 1 and orphans["order_reviews.order_id"] == 1
    long = {(r.table_name, r.column_name): r.n_long for r in quality.length_checks(t).collect()}
    assert long["customers", "customer_state"] == 1 and sum(long.values()) == 1
    assert all(r.n_null == 0 for r in quality.null_checks(t).collect())
    assert rows(quality.sparse_months(t, 3), "order_count") == [(2,)]


def test_null_counts(spark):
    t = tables(spark, orders=[{"order_id": "o"}])
    holes = t.orders.withColumn("customer_id", F.lit(None).cast("string"))
    from souk.schema import SCHEMAS, Tables
    broken = Tables(**{n: getattr(t, n) for n in SCHEMAS if n != "orders"}, orders=lambda: holes)
    found = {(r.table_name, r.column_name): r.n_null for r in quality.null_checks(broken).collect()}
    assert found["orders", "customer_id"] == 1 and found["orders", "order_id"] == 0
    assert ("orders", "order_approved_at") not in found


def test_categories_match_any_case_and_never_null(spark):
    t = tables(spark, products=[
        {"product_id": "1", "product_category_name": "Moveis_sala"},
        {"product_id": "2", "product_category_name": "cama_MOVEIS"},
        {"product_id": "3", "product_category_name": "cama_MOVEIS"},
        {"product_id": "4", "product_category_name": "casa"}, {"product_id": "5"},
    ])
    assert rows(basic.categories_like(t)) == [("Moveis_sala",), ("cama_MOVEIS",)]


def test_range_is_half_open(spark):
    t = shop(spark, [
        (k, "p", when, [], []) for k, when in [
            ("first", datetime(2018, 1, 1)), ("last", datetime(2018, 3, 31, 23, 59, 59)),
            ("after", datetime(2018, 4, 1)), ("before", datetime(2017, 12, 31, 23, 59, 59)),
        ]
    ])
    assert [r.order_id for r in basic.orders_in_range(t).collect()] == ["first", "last"]
