"""Views kept up to date equal views built anew, and read new files only."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from souk.operators.churn import churn_risk
from souk.operators.cohort import cohort_retention
from souk.operators.delivery import delivery_performance
from souk.operators.maintained import Maintained
from souk.operators.rfm import rfm_segments
from souk.operators.value import customer_ltv
from souk.plans import versions
from souk.schema import Tables
from souk.sources import files
from tests.tiny import rows, tables

ANEW = {
    "v_cohort_retention": cohort_retention, "v_clv": customer_ltv, "v_rfm_segments": rfm_segments,
    "v_churn_risk": churn_risk,
    "v_delivery_performance": lambda t: delivery_performance(t, extremes=False),
}


def make(seed, orders=120, people=25):
    """Rows of the four tables, by table, in the order of purchase."""
    draw = random.Random(seed)
    made = {"orders": [], "customers": [], "order_payments": [], "order_reviews": []}
    for i in range(orders):
        time = datetime(2016, 1, 1) + timedelta(hours=i * 7 + draw.randrange(5))
        if i % 10 == 9:
            time = made["orders"][-1]["order_purchase_timestamp"]
        order, person = f"o{i:04d}", f"p{draw.randrange(people)}" if i % 3 else "hot"
        late = draw.choice([None, -60, -12, 0, 30, 300])
        made["orders"].append({
            "order_id": order, "customer_id": f"c{i}", "order_purchase_timestamp": time,
            "order_status": draw.choice(["delivered", "delivered", "shipped"]),
            "order_delivered_customer_date": None if late is None else
            time + timedelta(hours=240 + late),
            "order_estimated_delivery_date": time + timedelta(days=10),
        })
        made["customers"].append({"customer_id": f"c{i}", "customer_unique_id": person})
        for n in range(draw.choice([0, 1, 1, 2])):
            made["order_payments"].append({
                "order_id": order, "payment_sequential": n, "payment_value": draw.randrange(9999) / 100})
        for _ in range(draw.choice([0, 1, 1, 2])):
            made["order_reviews"].append({
                "order_id": order, "review_id": order, "review_score": draw.randrange(1, 6)})
    return made


def frames(spark, made):
    from decimal import Decimal
    for row in made.get("order_payments", []):
        row["payment_value"] = Decimal(f"{row['payment_value']:.2f}")
    return tables(spark, **made)


def dealt(made, deal):
    """The rows of each batch: ``deal`` names the batch of a row."""
    out = {}
    for name, held in made.items():
        for i, row in enumerate(held):
            out.setdefault(deal(name, i, row), {}).setdefault(name, []).append(row)
    return [out[n] for n in sorted(out)]


def in_order(name, i, row):
    return int(row.get("order_id", "o" + row.get("customer_id", "c0")[1:].zfill(4))[1:]) // 45


def at_random(name, i, row):
    return random.Random(f"{name}{i}").randrange(3)


def check(spark, kept, folder):
    now = files.read_parquet(spark, folder)
    for name, view in kept.views().items():
        assert rows(view()) == rows(ANEW[name](now).select(*view().columns)), name


def test_rows_in_any_order_equal_a_full_rebuild(spark, tmp_path):
    folder, state = str(tmp_path / "shop"), str(tmp_path / "state")
    first, *later = dealt(make(1), at_random)
    files.write_parquet(frames(spark, first), folder)
    kept = Maintained(spark, folder, state)
    assert kept.refresh() and not kept.refresh()
    for batch in later:
        files.append_parquet({n: df for n, df in frames(spark, batch).items() if n in batch}, folder)
        assert kept.refresh()
    check(spark, kept, folder)
    assert kept.batches() == list(range(1, len(later) + 2))


def test_refresh_reads_only_new_files(spark, tmp_path):
    folder, state = str(tmp_path / "shop"), str(tmp_path / "state")
    first, second, *_ = dealt(make(3), in_order)
    files.write_parquet(frames(spark, first), folder)
    kept = Maintained(spark, folder, state)
    kept.refresh()
    place = files.current(spark, folder)
    for name in first:  # a refresh that opened an old file would fail
        for file in os.listdir(f"{place}/{name}"):
            if file.endswith(".parquet"):
                with open(f"{place}/{name}/{file}", "r+b") as old:
                    old.truncate(8)
    files.append_parquet({n: df for n, df in frames(spark, second).items() if n in second}, folder)
    assert kept.refresh()
    both = {n: first.get(n, []) + second.get(n, []) for n in first}
    whole = frames(spark, both)
    for name, view in kept.views().items():
        assert rows(view()) == rows(ANEW[name](whole).select(*view().columns)), name


def test_failed_refresh_leaves_no_batch(spark, tmp_path, monkeypatch):
    folder, state = str(tmp_path / "shop"), str(tmp_path / "state")
    first, second, *_ = dealt(make(4), in_order)
    files.write_parquet(frames(spark, first), folder)
    kept = Maintained(spark, folder, state)
    kept.refresh()
    before = rows(kept.rfm_segments())
    files.append_parquet({n: df for n, df in frames(spark, second).items() if n in second}, folder)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.refresh()
    assert kept.batches() == [1]
    assert rows(kept.rfm_segments()) == before
    assert kept.refresh() and kept.batches() == [1, 2]


def test_replaced_tables_start_anew(spark, tmp_path):
    folder, state = str(tmp_path / "shop"), str(tmp_path / "state")
    files.write_parquet(frames(spark, make(5)), folder)
    Maintained(spark, folder, state).refresh()
    files.write_parquet(frames(spark, make(6, orders=30)), folder)
    again = Maintained(spark, folder, state)
    assert again.batches() == [] and again.refresh() and again.batches() == [1]


def test_no_rows(spark, tmp_path):
    folder = str(tmp_path / "shop")
    files.write_parquet(tables(spark), folder)
    kept = Maintained(spark, folder, str(tmp_path / "state"))
    kept.refresh()
    assert all(view().count() == 0 for view in kept.views().values())


# --- versions ---------------------------------------------------------------------------------


def test_a_failed_load_leaves_the_old_tables(spark, tmp_path):
    folder = str(tmp_path / "shop")
    old = frames(spark, make(7, orders=20))
    files.write_parquet(old, folder)
    opened = files.read_parquet(spark, folder)
    broken = Tables(**dict(old.items()) | {
        "order_reviews": old.order_reviews.withColumn(
            "review_id", F.raise_error(F.lit("broken")).cast("string"))})
    with pytest.raises(Exception, match="broken"):
        files.write_parquet(broken, folder)
    for t in (opened, files.read_parquet(spark, folder)):
        assert t.orders.count() == 20 and rows(t.order_reviews) == rows(old.order_reviews)
    files.write_parquet(frames(spark, make(8, orders=5)), folder)
    assert opened.orders.count() == 20  # still there for who opened it
    assert files.read_parquet(spark, folder).orders.count() == 5
    files.write_parquet(old, folder)
    assert sorted(n for n in os.listdir(folder) if n.startswith("v")) == ["v2", "v3"]


def test_two_writers_do_not_mix(spark, tmp_path):
    folder = str(tmp_path / "shop")
    versions.commit(spark, folder, 1)
    with pytest.raises(FileExistsError):
        versions.commit(spark, folder, 1)


def test_nothing_to_read(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_parquet(spark, str(tmp_path / "none"))
