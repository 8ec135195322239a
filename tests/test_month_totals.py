from __future__ import annotations

import pathlib

import pytest
from helpers import day, rows
from pyspark.sql import functions as F
from test_month_store import DATA, FEB, fact

from ledgerlake.functions import dates
from ledgerlake.plans.month_totals import MonthTotals
from ledgerlake.plans.semantic import SemanticModel
from ledgerlake.sources.month_store import MonthStore

METRICS = ["total_revenue", "total_units", "total_orders", "total_customers", "average_order_value", "profit_margin_pct"]
PERIODS = [("2025-01-01", "2025-04-01"), ("2025-01-05", "2025-03-11"), ("2025-03-10", None), ("2024-01-01", None), ("2025-01-06", "2025-01-07"),
           ("2025-02-01", "2025-03-01"), ("2025-02-10", "2025-02-20")]


def bounds(period):
    return tuple(None if d is None else F.lit(d).cast("date") for d in period)


@pytest.fixture
def totals(spark, store, tmp_path):
    some = MonthTotals(store, str(tmp_path / "totals"), ["customer_segment", "category"], METRICS)
    assert some.publish() == sorted(store.months) and some.publish() == []
    return some


@pytest.fixture
def store(spark, tmp_path):
    """Invoice numbers and customers that go on over months, beside those of DATA; profit is known for some."""
    more = [(k, k % 3, f"2025-0{1 + k % 4}-{1 + k % 27:02d}", k % 7, ["B2B", "B2C", None][k % 3], float(k), 1.0, ["Leads", "Bowls"][k % 2], "Matched")
            for k in (*range(32760, 32790), *range(-20, 20), *range(100, 140))] + [
            (40, 9, f"2025-0{m}-15", 3, "B2B", 1.0, 1.0, "Leads", "Matched") for m in (1, 2, 3, 4)] + [
            (None, 1, "2025-02-02", None, "B2C", 1.0, 1.0, "Leads", "Matched")]
    data = fact(spark, DATA + more).withColumn("line_profit_dkk", F.col("line_revenue_dkk") / 3)
    one = MonthStore(spark, str(tmp_path / "store"), data.schema)
    one.publish(data, "v0")
    one.data = data
    return one


def near(result):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows(result)]


@pytest.mark.parametrize("period", PERIODS)
@pytest.mark.parametrize("dims", [[], ["customer_segment"], ["category", "customer_segment"]])
def test_totals_equal_the_lines(spark, store, totals, period, dims):
    plain = SemanticModel({"sales": lambda c: store.data.select(*c)}).query(dims=dims, metrics=METRICS, period=bounds(period))
    got = totals.query(dims, METRICS, bounds(period))
    assert near(got) == near(plain)


def test_totals_by_month_and_after_a_republication(spark, store, totals):
    def by_month():
        return near(totals.query(["sale_month"], ["total_orders", "total_revenue"], bounds(("2025-01-01", "2026-01-01"))))

    def plain(data):
        return near(data.where("sale_date >= '2025-01-01'").groupBy(F.trunc("sale_date", "MONTH")).agg(
            F.countDistinct("invoice_id"), F.sum("line_revenue_dkk")))

    assert by_month() == plain(store.data)
    less = store.data.where("sale_date <> '2025-02-15'")
    assert store.publish(less, "v1") == [FEB] and totals.publish() == [FEB]
    assert by_month() == plain(less)
    gone = less.where("sale_date < '2025-04-01'")
    assert store.publish(gone, "v2") == [day("2025-04-01")] and totals.publish() == []
    assert by_month() == plain(gone)


def test_values_that_are_no_whole_numbers_are_counted_exactly(spark, store, tmp_path):
    texts = store.data.withColumn("invoice_id", F.concat(F.lit("No "), F.col("invoice_id")))
    other = MonthStore(spark, str(tmp_path / "texts"), texts.schema)
    other.publish(texts)
    named = MonthTotals(other, str(tmp_path / "named"), ["category"], ["total_orders"])
    named.publish()
    assert named.whole == set()
    for period in PERIODS[:3]:
        got = named.query(["category"], ["total_orders"], bounds(period))
        assert rows(got) == rows(texts.where(dates.within(F.col("sale_date"), bounds(period))).groupBy("category").agg(F.countDistinct("invoice_id")))


def test_whole_months_read_no_lines(spark, store, totals):
    """With the lines of February spoilt, periods that hold it whole still have their answer, others do not."""
    whole, part = bounds(("2025-01-20", "2025-03-10")), bounds(("2025-02-03", "2025-03-10"))
    want = near(totals.query(["customer_segment"], METRICS, whole))
    for file in pathlib.Path(store.path).glob("data/version=0/sale_month=2025-02-01/*.parquet"):
        file.write_bytes(b"spoilt")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert near(totals.query(["customer_segment"], METRICS, whole)) == want
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        totals.query(["customer_segment"], METRICS, part).collect()
    with pytest.raises(ValueError):
        totals.query(["size"], ["total_orders"], whole)
    with pytest.raises(ValueError):
        MonthTotals(store, totals.path, ["category"], ["revenue_growth_yoy_pct"])
