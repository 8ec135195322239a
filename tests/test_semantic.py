from __future__ import annotations

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from ledgerlake.operators.joins import DuplicateKeyError
from ledgerlake.plans import reports, semantic, verified
from ledgerlake.plans.semantic import SemanticModel, UnknownNameError
from ledgerlake.sources import store

AS_OF = "2025-03-15"
COLUMNS = ("invoice_id bigint, sale_date date, customer_id bigint, customer_name string, customer_segment string, product_sku string, "
           "product_name string, category string, size string, color string, delivery_country string, market string, "
           "prestashop_match_status string, line_revenue_dkk double, line_profit_dkk double, product_revenue_dkk double, "
           "quantity_sold double, unit_price_dkk double")


def sale(invoice, date, revenue, segment="B2B", category="Harnesses", status="Matched", country="Denmark", customer=1, sku="A1",
         profit=None, quantity=1.0):
    import datetime as dt
    return (invoice, dt.date.fromisoformat(date), customer, f"C{customer}", segment, sku, sku, category, "S", "Black", country,
            "Nordics", status, float(revenue), float(revenue if profit is None else profit), max(float(revenue), 0.0), quantity,
            float(revenue))


SALES = [
    sale(1, "2025-03-14", 100), sale(1, "2025-03-14", 50, category="Leads"), sale(2, "2025-03-08", 30, "B2C", customer=2, sku="B1"),
    sale(3, "2025-03-15", 500, "B2C", "Bowls", customer=2), sale(4, "2025-03-07", 70, status="Adjustment Item", category="Adjustments"),
    sale(5, "2025-02-10", 40, country="Germany"), sale(6, "2024-03-10", 200), sale(7, "2024-12-31", 10, profit=5, country="France"),
    sale(8, "2023-01-01", 999, customer=3),
]


@pytest.fixture(scope="module")
def sales(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sales"))
    spark.createDataFrame(SALES, COLUMNS).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def model(spark, sales):
    customers = spark.createDataFrame([(1, "a@x"), (2, "b@x")], "customer_id bigint, email_address string")
    for name in semantic.CUSTOMER.dimensions:
        if name not in customers.columns:
            customers = customers.withColumn(name, F.lit("-"))
    return SemanticModel({"sales": lambda columns: sales.select(*columns), "customer": lambda columns: customers})


def test_model_has_all_names():
    assert (len(semantic.SALES_DIMENSIONS), len(semantic.SALES_FACTS), len(semantic.SALES_METRICS), len(semantic.SALES_FILTERS)) == (
        17, 7, 9, 17)
    assert sorted(f.aggregation for f in semantic.SALES_FACTS.values()) == ["avg", "avg", "sum", "sum", "sum", "sum", "sum"]


def test_names_and_synonyms_mean_the_same(model):
    by_name = model.query(dims=["customer_segment"], metrics=["total_revenue", "average_order_value"])
    by_synonym = model.query(dims=["Channel"], metrics=["Total Turnover", "AOV"])
    assert rows(by_name) == rows(by_synonym) and by_name.columns == by_synonym.columns


def test_facts_use_their_default_aggregation(model):
    got = model.query(dims=["category"], metrics=["revenue", "unit price"], filters=["last week"], as_of=AS_OF)
    assert rows(got) == [("Bowls", 500.0, 500.0), ("Harnesses", 130.0, 65.0), ("Leads", 50.0, 50.0)]


@pytest.mark.parametrize("call", [dict(dims=["planet"]), dict(metrics=["luck"]), dict(metrics=["revenue"], filters=["never"]),
                                  dict(dims=["warehouse.name"]), dict(dims=[("category", "month")])])
def test_unknown_names_raise(model, call):
    with pytest.raises(UnknownNameError):
        model.query(**call)


def orders(model, name):
    return model.query(metrics=["total_orders"], filters=[name], as_of=AS_OF).first()[0]


@pytest.mark.parametrize("name,want", [
    ("last_week", 3), ("last_month", 4), ("last_quarter", 6), ("current_year", 5), ("last_year", 2), ("this_month", 4),
    ("last_month_complete", 1), ("this_quarter", 5), ("last_quarter_complete", 1), ("matched_products", 7),
    ("product_sales_only", 7), ("b2b_only", 6), ("b2c_only", 2), ("top_categories", 6), ("scandinavia", 6), ("dach_region", 1),
    ("western_europe", 1)])
def test_filters(model, name, want):
    assert orders(model, name) == want


def test_by_filter_matches_single_queries(model):
    names = list(semantic.SALES_FILTERS)
    got = {r.filter_name: r.total_orders for r in model.by_filter(names, ["total_orders"], as_of=AS_OF).collect()}
    assert got == {n: orders(model, n) for n in names}


@pytest.mark.parametrize("metrics", [
    list(semantic.SALES_METRICS), ["total_customers", "aov", "line_revenue_dkk", "unit_price_dkk"], ["gross margin", "selling price"]])
def test_by_filter_gives_every_metric_as_query_does(model, metrics):
    names = list(semantic.SALES_FILTERS)
    got = {r.filter_name: r for r in model.by_filter(names, metrics, as_of=AS_OF).collect()}
    for name in names:
        want = model.query(metrics=metrics, filters=[name], as_of=AS_OF).first().asDict()
        some = orders(model, name) > 0
        assert (name in got) == some
        for metric, value in want.items() if some else ():
            assert got[name][metric] == (value if value is None else pytest.approx(value)), (name, metric)


def test_by_filter_copies_no_rows(model):
    text = plan(model.by_filter(list(semantic.SALES_FILTERS), ["total_revenue", "total_orders"], as_of=AS_OF))
    assert text.count("Generate") == 1 and "Expand" not in text
    assert text.index("Generate") < text.index("HashAggregate")  # on the single row of totals only


@pytest.mark.parametrize("name,first", [("current_year", "2025-01-01"), ("this_month", "2025-03-01"),
                                        ("last_quarter_complete", "2024-10-01"), ("last_week", "2025-03-08")])
def test_date_filters_reach_the_scan(model, name, first):
    text = plan(model.query(metrics=["total_revenue"], filters=[name], as_of=AS_OF))
    assert f"GreaterThanOrEqual(sale_date,{first})" in text


def test_growth_metrics(model):
    got = model.query(metrics=["yoy growth", "mom growth"], as_of=AS_OF).first()
    assert round(got[0], 4) == round((790 - 210) / 210 * 100, 4) and round(got[1], 4) == round((750 - 40) / 40 * 100, 4)


def test_ratio_of_nothing_is_null(model):
    got = model.query(metrics=["profit_margin_pct", "average_order_value"], where=[("category", lambda c: c == "none")])
    assert rows(got) == [(None, None)]


def test_related_dimensions_and_their_key_check(spark, sales, model):
    assert rows(model.query(dims=["customer.email"], metrics=["total_orders"])) == [("a@x", 5), ("b@x", 2), (None, 1)]
    doubled = SemanticModel({"sales": model.frames["sales"],
                             "customer": lambda columns: model.frames["customer"](columns).unionByName(model.frames["customer"](columns))})
    with pytest.raises(DuplicateKeyError):
        doubled.query(dims=["customer.email"], metrics=["total_orders"])


def test_dimensions_alone_are_distinct(model):
    assert rows(model.query(dims=["segment"])) == [("B2B",), ("B2C",)]


def test_verified_questions(model, sales):
    assert rows(verified.last_week_revenue(model, AS_OF)) == [(680.0, 3)]
    assert rows(verified.last_month_by_category(model, AS_OF), "category", "revenue") == [
        ("Bowls", 500.0), ("Harnesses", 130.0), ("Leads", 50.0)]
    assert rows(verified.segments_last_quarter(model, AS_OF), "customer_segment", "customers", "orders", "aov") == [
        ("B2B", 1, 4, 67.5), ("B2C", 1, 2, 265.0)]
    assert [r.product_sku for r in verified.top_products_this_month(model, AS_OF).collect()] == ["A1", "A1", "A1", "B1"]
    assert [(str(r.month), r.orders) for r in verified.monthly_trend(model, 2024).collect()] == [("2024-03-01", 1), ("2024-12-01", 1)]
    assert rows(verified.countries_last_month(model, AS_OF), "delivery_country", "revenue") == [("Denmark", 750.0)]
    assert verified.size_colour_this_year(model, AS_OF).first().revenue == 720.0
    assert rows(verified.week_over_week(sales, AS_OF)) == [("Last Week", 70.0, 1, 1.0), ("This Week", 680.0, 3, 4.0)]
    assert verified.top_customers_last_quarter(model, AS_OF, k=1).first().customer_name == "C2"
    assert rows(verified.categories_by_segment(model, AS_OF), "customer_segment", "category", "revenue") == [
        ("B2B", "Harnesses", 140.0), ("B2B", "Leads", 50.0), ("B2C", "Bowls", 500.0), ("B2C", "Harnesses", 30.0)]
    growth = {r.category: r.growth_pct for r in verified.category_growth(sales, AS_OF).collect()}
    assert round(growth["Harnesses"], 4) == round((170 - 210) / 210 * 100, 4) and growth["Bowls"] is None


def test_weekly_figures_end_before_the_day_but_splits_do_not(sales):
    got = reports.weekly_kpis(sales, AS_OF).first()
    assert (got.revenue, got.orders, got.aov) == (180.0, 2, 90.0)
    assert (got.top_category, got.top_category_revenue, got.b2b_revenue, got.b2c_revenue) == ("Bowls", 500.0, 150.0, 530.0)


def test_weekly_figures_without_sales(sales):
    got = reports.weekly_kpis(sales, "2030-01-01").first()
    assert (got.revenue, got.orders, got.aov, got.top_category) == (None, 0, None, None)


def test_alert(sales):
    low = reports.sales_alert(sales, 1000, AS_OF).first()
    assert (low.this_week_revenue, low.last_week_revenue, low.shortfall, low.is_alert) == (680.0, 70.0, 320.0, True)
    assert round(low.decline_pct, 4) == round((70 - 680) / 70 * 100, 4)
    assert not reports.sales_alert(sales, 100, AS_OF).first().is_alert
    silent = reports.sales_alert(sales, 100, "2030-01-01").first()
    assert silent.this_week_revenue is None and silent.is_alert is False


def test_audits(sales):
    shares = reports.match_status_audit(sales).collect()
    assert round(sum(r.pct_of_lines for r in shares)) == 100
    margins = {r.category: r for r in reports.category_margins(sales).collect()}
    assert "Adjustments" not in margins and margins["Harnesses"].sku_count == 2
    assert reports.size_colour_table(sales, 1).first().line_count == 8
    overview = {(r.market, r.category): r for r in reports.market_overview(sales, "2024-01-01").collect()}
    assert overview["Nordics", "Harnesses"].orders == 5


@pytest.mark.parametrize("name,months", [("last_week", {"2025-03-01"}), ("last_month", {"2025-03-01"}),
                                         ("last_year", {"2024-03-01", "2024-12-01"}), ("last_quarter_complete", {"2024-12-01"})])
def test_published_fact_reads_only_the_months_asked_for(spark, sales, model, tmp_path, name, months):
    path = str(tmp_path / "fact")
    store.publish_by_month(sales, path)
    by_month = SemanticModel({"sales": store.published(spark, path, sales.schema)}, month_partition="sale_month")
    got = by_month.query(dims=["category"], metrics=["total_revenue"], filters=[name], as_of=AS_OF)
    assert rows(got) == rows(model.query(dims=["category"], metrics=["total_revenue"], filters=[name], as_of=AS_OF))
    text = plan(got)
    assert "PartitionFilters: [isnotnull(sale_month" in text and "invoice_id" not in text
    assert {str(f).split("sale_month=")[1][:10] for f in stored_files(by_month, name)} == months


def stored_files(model, name):
    home = semantic.SALES
    rows_ = model._rows(home, {"line_revenue_dkk"}, [model._filter(home, name)], semantic.dates.as_of_date(AS_OF))
    return {r[0] for r in rows_.select(F.input_file_name()).distinct().collect()}
