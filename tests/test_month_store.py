from __future__ import annotations

import datetime as dt

import pytest
from helpers import day, plan, rows
from pyspark.sql import functions as F

from ledgerlake.functions import dates
from ledgerlake.plans import facts, reports, verified
from ledgerlake.plans.semantic import SemanticModel
from ledgerlake.sources.month_store import MonthStore
from ledgerlake.session import SORTED_SPLIT, small_splits
from ledgerlake.sources import store as stored_tables
from ledgerlake.sources.store import publish_by_month
from ledgerlake.workload import load_queries
from ledgerlake.workload import standins as st

AS_OF = "2025-03-15"
JAN, FEB, MAR = day("2025-01-01"), day("2025-02-01"), day("2025-03-01")
DATA = [
    # invoice, line, day, customer, segment, revenue, units, category, status
    (1, 1, "2025-01-05", 10, "B2B", 100.0, 1.0, "Leads", "Matched"), (1, 2, "2025-01-05", 10, "B2B", 50.0, 2.0, "Bowls", "Matched"),
    (2, 1, "2025-02-28", 11, "B2C", 10.0, 1.0, "Leads", "Matched"), (3, 1, "2025-03-10", 10, "B2B", 5.0, 1.0, "Leads", "Matched"),
    (4, 1, "2025-03-14", 12, "B2C", 7.0, 3.0, "Bowls", "Adjustment Item"), (5, 1, None, 12, "B2C", 7.0, 3.0, "Bowls", "Matched"),
    (6, 1, "2024-03-10", 12, "B2C", 70.0, 3.0, "Leads", "Matched"),
]


def fact(spark, data=DATA):
    some = spark.createDataFrame(data, "invoice_id long, line_id long, d string, customer_id long, customer_segment string, line_revenue_dkk double, "
                                       "quantity_sold double, category string, prestashop_match_status string")
    some = some.withColumn("sale_date", F.col("d").cast("date")).drop("d")
    missing = [c for c in facts.sales_columns() if c not in some.columns]
    return some.select(*[F.col(c) if c in some.columns else F.lit("x").alias(c) for c in facts.sales_columns() if c in some.columns or c in missing])


@pytest.fixture
def store(spark, tmp_path):
    one = MonthStore(spark, str(tmp_path / "store"), fact(spark).schema)
    one.publish(fact(spark), "v0")
    return one


def test_first_publication_has_every_dated_row(spark, store):
    assert sorted(store.months) == [day("2024-03-01"), JAN, FEB, MAR] and store.months[JAN].rows == 2
    assert rows(store.read(["invoice_id", "line_id", "sale_month"])) == [
        (1, 1, JAN), (1, 2, JAN), (2, 1, FEB), (3, 1, MAR), (4, 1, MAR), (6, 1, day("2024-03-01"))]
    assert rows(store.read(fact(spark).columns)) == rows(fact(spark).where("sale_date IS NOT NULL"))


def test_only_changed_months_are_written(spark, store):
    assert store.publish(fact(spark), "v0") == [] and store.publish(fact(spark).orderBy(F.desc("invoice_id")), "v1") == []
    changed = [r if r[0] != 4 else (*r[:5], 8.0, *r[6:]) for r in DATA]
    assert store.publish(fact(spark, changed), "v2") == [MAR]
    versions = {m: k.data_version for m, k in store.months.items()}
    assert versions == {day("2024-03-01"): 0, JAN: 0, FEB: 0, MAR: 2}
    other = MonthStore(spark, store.path, store.schema)
    assert (other.months, other.source, other.version) == (store.months, "v2", 2)
    assert other.read(["line_revenue_dkk"]).agg(F.sum("line_revenue_dkk")).first()[0] == 243.0


def test_a_row_that_moves_a_month_that_goes_and_one_that_comes(spark, store):
    moved = [r if r[0] != 2 else (2, 1, "2025-04-01", *r[3:]) for r in DATA]
    assert store.publish(fact(spark, moved), "v1") == [FEB, day("2025-04-01")]
    assert FEB not in store.months
    assert rows(store.read(["invoice_id"]).where("invoice_id = 2")) == [(2,)]


def test_equal_rows_and_swapped_values_are_changes(spark, store):
    assert store.publish(fact(spark, [*DATA, DATA[2]]), "v1") == [FEB]
    assert store.publish(fact(spark, [*DATA, DATA[2], DATA[2], DATA[2]]), "v2") == [FEB]
    swapped = [(*r[:5], {100.0: 50.0, 50.0: 100.0}.get(r[5], r[5]), *r[6:]) for r in [*DATA, DATA[2], DATA[2], DATA[2]]]
    assert store.publish(fact(spark, swapped), "v3") == [JAN]


def test_touched_months_follow_headers_and_lines(spark, store):
    old, new = "2025-03-01 00:00:00", "2025-03-20 00:00:00"
    invoices = spark.createDataFrame([(1, "2025-01-05", old), (2, "2025-04-02", new), (3, "2025-03-10", old), (7, None, new)], "invoice_number long, d string, t string")
    invoices = invoices.selectExpr("invoice_number", "cast(d AS date) invoice_date", "cast(t AS timestamp) api_timestamp")
    lines = spark.createDataFrame([(1, old), (3, new), (3, new)], "invoice_number long, t string").selectExpr("invoice_number", "cast(t AS timestamp) api_timestamp")
    touched = store.touched_months(invoices, lines, "2025-03-15 00:00:00")
    assert rows(touched) == [(FEB,), (MAR,), (day("2025-04-01"),)]
    data = [r if r[0] != 2 else (2, 1, "2025-04-02", *r[3:]) for r in DATA]
    data = [r if r[0] != 1 else (*r[:5], 0.0, *r[6:]) for r in data]  # not among the touched: stays as it was
    assert store.publish(fact(spark, data), "v1", touched) == [FEB, day("2025-04-01")]
    assert store.read(["line_revenue_dkk", "invoice_id"]).where("invoice_id = 1").agg(F.sum("line_revenue_dkk")).first()[0] == 150.0


def test_only_touched_days_reach_the_scan_of_a_publication(spark, store, tmp_path):
    fact(spark).write.parquet(str(tmp_path / "fact"))
    text = plan(spark.read.parquet(str(tmp_path / "fact")).where(store._within([JAN, FEB, day("2025-04-01")])))
    assert "2025-01-01" in text and "2025-03-01" in text and "2025-05-01" in text and "2025-02-01" not in text


def test_vacuum_leaves_the_current_months(spark, store):
    store.publish(fact(spark, DATA[:-1]), "v1")
    store.publish(fact(spark, [*DATA[:-1], DATA[0]]), "v2")
    before = rows(store.read(["invoice_id", "line_id"]))
    assert store.vacuum() == [0] and store.vacuum() == []
    assert rows(MonthStore(spark, store.path, store.schema).read(["invoice_id", "line_id"])) == before


def test_an_empty_fact(spark, tmp_path):
    empty = MonthStore(spark, str(tmp_path / "none"), fact(spark).schema)
    assert empty.publish(fact(spark).where("false"), "v0") == [] and empty.read(["invoice_id"]).count() == 0
    assert MonthStore(spark, empty.path, empty.schema).source == "v0"
    assert empty.publish(fact(spark), "v1") == [day("2024-03-01"), JAN, FEB, MAR]


QUESTIONS = {
    "last_week_revenue": "2025-03-01", "last_month_by_category": "2025-02-01", "segments_last_quarter": "2024-12-01", "top_products_this_month": "2025-03-01",
    "countries_last_month": "2025-02-01", "size_colour_this_year": "2025-01-01", "top_customers_last_quarter": "2024-12-01",
    "categories_by_segment": "2025-01-01",
}


def month_filters(text: str) -> str:
    assert "PartitionFilters" in text
    return " ".join(part.split("]", 1)[0] for part in text.split("PartitionFilters: [")[1:])


@pytest.mark.parametrize("name,first", QUESTIONS.items())
def test_questions_read_months_and_answer_as_before(spark, store, name, first):
    stored = SemanticModel({"sales": store.read}, month_partition="sale_month")
    plain = SemanticModel({"sales": lambda columns: fact(spark).select(*columns)})
    question = getattr(verified, name)
    assert rows(question(stored, AS_OF)) == rows(question(plain, AS_OF))
    assert "sale_month#" in month_filters(plan(question(stored, AS_OF))) and first in month_filters(plan(question(stored, AS_OF)))


def test_other_questions_read_months(spark, store):
    today, sales = dates.as_of_date(AS_OF), fact(spark)
    stored = SemanticModel({"sales": store.read}, month_partition="sale_month")
    for period, first, ask in (
        (dates.last_days(today, 14), "2025-03-01", lambda s: verified.week_over_week(s, AS_OF)),
        (dates.last_days(today, 7), "2025-03-01", lambda s: reports.weekly_kpis(s, AS_OF)),
        (dates.last_days(today, 14), "2025-03-01", lambda s: reports.sales_alert(s, 100, AS_OF)),
        ((dates.year_of(today, -1)[0], dates.year_of(today)[1]), "2024-01-01", lambda s: verified.category_growth(s, AS_OF)),
    ):
        read = store.read(facts.sales_columns(), period)
        assert rows(ask(read)) == rows(ask(sales)) and first in month_filters(plan(ask(read)))
    assert rows(verified.monthly_trend(stored, 2025)) == rows(verified.monthly_trend(SemanticModel({"sales": lambda c: sales.select(*c)}), 2025))
    names = ["last_week", "last_month", "last_year"]
    by_filter = stored.by_filter(names, ["total_revenue", "total_orders"], as_of=AS_OF)
    assert rows(by_filter) == rows(SemanticModel({"sales": lambda c: sales.select(*c)}).by_filter(names, ["total_revenue", "total_orders"], as_of=AS_OF))
    assert "2025-02-01" in month_filters(plan(by_filter))


def test_a_failed_publication_changes_nothing(spark, store):
    broken = fact(spark).withColumn("invoice_id", F.when(F.col("invoice_id") == 3, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("invoice_id")))
    with pytest.raises(Exception, match="boom"):
        store.publish(broken, "v1")
    again = MonthStore(spark, store.path, store.schema)
    assert again.version == 0 and again.read(["invoice_id"]).count() == 6
    assert dt.date(2025, 3, 1) in again.months



def test_a_publication_does_not_shuffle_the_fact(spark, tmp_path):
    """The widest rows stay where the joins left them; every month is complete whatever task wrote it."""
    path = str(tmp_path / "by_tasks")
    written = []
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("publish-by-month", "publish-by-month")
    try:
        publish_by_month(fact(spark).repartition(3, "line_id").localCheckpoint(), path)
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    for job in tracker.getJobIdsForGroup("publish-by-month"):
        written.append(len(tracker.getJobInfo(job).stageIds))
    assert written[-1] == 1
    back = spark.read.parquet(path).where("sale_month IS NOT NULL")
    assert rows(back.drop("sale_month").select(fact(spark).columns)) == rows(fact(spark).where("sale_date IS NOT NULL"))
    assert rows(back.select("sale_month").distinct()) == [(day("2024-03-01"),), (JAN,), (FEB,), (MAR,)]


def test_a_publication_reads_a_stored_fact_in_splits_it_can_sort(spark, tmp_path, monkeypatch):
    """One task that sorts 128 MB of a stored fact spills its rows."""
    settings = {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        fact(spark, [r for r in DATA if r[2] and r[2] >= "2025-03"] * 4).repartition(4).write.parquet(str(tmp_path / "fact"))
        one = spark.read.parquet(str(tmp_path / "fact"))
        assert one.rdd.getNumPartitions() == 1
        largest = max(f.stat().st_size for f in (tmp_path / "fact").glob("*.parquet"))
        monkeypatch.setattr(stored_tables, "small_splits", lambda session: small_splits(session, largest))
        publish_by_month(one, str(tmp_path / "published"))
        stored_tables.materialise(one, str(tmp_path / "again"))
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(list((tmp_path / "published" / "sale_month=2025-03-01").glob("*.parquet"))) == 4
    assert len(list((tmp_path / "again").glob("*.parquet"))) == 4
    assert rows(spark.read.parquet(str(tmp_path / "published")).select(one.columns)) == rows(one)


def test_small_splits_hold_while_a_store_is_written_only(spark, store, monkeypatch):
    name, seen = "spark.sql.files.maxPartitionBytes", []
    real = type(fact(spark).write).parquet
    monkeypatch.setattr(type(fact(spark).write), "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(name)), real(self, *a, **k))[1])
    before = spark.conf.get(name)
    store.publish(fact(spark, [*DATA, DATA[0]]), "v1")
    assert seen[0] == str(SORTED_SPLIT) and seen[-1] == spark.conf.get(name) == before
    spark.conf.set(name, "1m")
    try:
        with small_splits(spark):
            assert spark.conf.get(name) == "1m"
        spark.conf.set(name, "1g")
        with pytest.raises(ValueError, match="boom"), small_splits(spark):
            raise ValueError("boom")
        assert spark.conf.get(name) == "1g"
    finally:
        spark.conf.unset(name)


def test_add_stores_the_months_that_are_missing(spark, tmp_path):
    some = MonthStore(spark, str(tmp_path / "some"), fact(spark).schema)
    assert some.add(fact(spark), [MAR, day("2025-04-01")]) == [MAR] and sorted(some.months) == [MAR]
    assert some.add(fact(spark), [MAR]) == [] and some.add(fact(spark), [MAR, JAN]) == [JAN]
    assert {m: k.data_version for m, k in some.months.items()} == {MAR: 0, JAN: 1}
    assert rows(MonthStore(spark, some.path, some.schema).read(["invoice_id", "line_id"])) == [(1, 1), (1, 2), (3, 1), (4, 1)]
    whole = MonthStore(spark, str(tmp_path / "whole"), fact(spark).schema)
    whole.publish(fact(spark))
    assert some.publish(fact(spark), "v0") == [day("2024-03-01"), FEB]
    assert {m: (k.rows, k.digest) for m, k in some.months.items()} == {m: (k.rows, k.digest) for m, k in whole.months.items()}


def test_a_question_tells_the_ranges_it_reads(spark, store):
    told = []
    model = SemanticModel({"sales": store.read}, month_partition="sale_month",
                          prepare=lambda periods: told.append([str(start) for start, _ in periods]))
    model.query(metrics=["total_revenue"], filters=["last_week", "matched_products"], as_of=AS_OF)
    model.by_filter(["last_week", "last_month"], ["total_revenue"], as_of=AS_OF)
    model.by_filter(["last_week", "matched_products"], ["total_revenue"], as_of=AS_OF)
    model.query(metrics=["total_revenue"])
    week, month = (str(dates.last_days(dates.as_of_date(AS_OF), n)[0]) for n in (7, 30))
    assert told == [[week], [week, month], [], []]


def test_registered_questions_publish_only_the_months_they_read(spark, tmp_path):
    days = ["2001-08-01", "2001-07-31", "2001-07-02", "2001-06-20", "2000-09-09", "2000-03-03", "1999-01-01"]
    spark.createDataFrame([(k, 1, "O", 5000.0, d, "x") for k, d in enumerate(days)] + [(99, 1, "O", 5.0, "2001-08-01", "x")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string") \
        .withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, 1, 1, 1, 2.0, 100.0, 0.0, 0.0, "N", "O", dt.datetime(2001, 8, 2)) for k in [*range(len(days)), 99, None]], st.TABLE_SCHEMAS["lineitem"]) \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "C", 1, 1.0, "BUILDING")], st.TABLE_SCHEMAS["customer"]).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "red thing", "Brand#1", "PROMO", 4, 9.0)], st.TABLE_SCHEMAS["part"]).write.parquet(f"{tmp_path}/part.parquet")
    questions, sf = load_queries(), str(tmp_path)
    assert [r.orders for r in questions["vq8_from_month_totals"].run(spark, sf).orderBy("period").collect()] == [0, 2]
    stored, _ = st._PUBLISHED[spark.sparkContext.applicationId, sf]
    assert sorted(stored.months) == [day("2001-07-01"), day("2001-08-01")]
    assert [r.orders for r in questions["vq3_b2b_vs_b2c_last_quarter"].run(spark, sf).collect()] == [4]
    assert sorted(stored.months) == [day("2001-06-01"), day("2001-07-01"), day("2001-08-01")]
    assert [r.lines for r in questions["rpt10_packaging_match_quality"].run(spark, sf).collect()] == [5]
    assert sorted(r.orders for r in questions["sem9_calendar_filters"].run(spark, sf).collect()) == [1, 1, 2, 2, 3, 4]
    assert len(stored.months) == 5 and day("1999-01-01") not in stored.months
