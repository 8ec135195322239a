from __future__ import annotations

import pytest
from helpers import day, plan, rows
from fixtures import EXPIRED_ROWS, EXPIRED_SCHEMA, FIRST, SAMPLE_INVOICE, SAMPLE_LINES, SHOP_PAGES, customer, invoice, line
from pyspark.sql import functions as F

from ledgerlake.plans import bronze, dims, facts, packaging
from ledgerlake.plans.facts import SalesSources
from ledgerlake.plans.views import VIEWS, Warehouse, register_views
from ledgerlake.workload import end_to_end
from ledgerlake.workload import standins as st


@pytest.fixture
def sources(raw):
    rest = raw(
        "REST",
        (FIRST, "customers", 0, {"collection": [customer(1, "Alpha", 1, city="Aarhus", country="Denmark"), customer(2, "Beta", 5)]}),
        (FIRST, "products", 0, {"collection": [{"productNumber": "A1", "name": "Harness - Farve : Rød", "productGroup": {"name": "G1"}}]}),
        (FIRST, "invoices/booked", 0, {"collection": [
            SAMPLE_INVOICE, invoice(1, "2025-01-10", None, 1, "DK"), invoice(2, "2025-01-11", 100.0, 2, None, "Denmark"),
            invoice(3, "2025-01-12", 100.0, 7, "Atlantis"), invoice(4, "2025-01-13", 100.0, None),
            {**invoice(5), "date": None}]}))
    bulk = raw("OPENAPI", (FIRST, "invoices/booked/lines", 0, {"items": [
        *SAMPLE_LINES, line(1, 1, "A1", 200.0, 2, unitCostPrice=30), line(1, 2, "Diverse"), line(1, 3, "rabat", -20.0),
        line(2, 1, "fragt-x", 10.0), line(2, 2, "diff", 5.0), line(2, 3, "Z9", -7.0), line(3, 1, None, 4.0),
        line(4, 1, "Z9", 3.0), line(5, 1, "A1"), line(99, 1, "A1")]}))
    lines = bronze.invoice_lines(bulk, rest)
    catalogue = dims.dim_product_sku(dims.shop_catalogue(raw("SHOP", *SHOP_PAGES)))
    return SalesSources(lines, bronze.invoices(rest), bronze.customers(rest), bronze.products(rest),
                        dims.dim_product_sku_enriched(lines, catalogue))


def by_line(df):
    return {(r.invoice_id, r.line_id): r for r in df.collect()}


def test_one_row_per_dated_line(sources):
    fact = facts.sales_detail(sources)
    assert fact.count() == 10 and len(fact.columns) == 32 and fact.columns == facts.sales_columns()
    assert {r.invoice_id for r in fact.collect()} == {1, 2, 3, 4, 10001522}


def test_sample_invoice(sources):
    got = by_line(facts.sales_detail(sources, [*facts.sales_columns(), "market_standardized"]))
    goods, freight = got[10001522, 1], got[10001522, 2]
    assert (goods.line_revenue_dkk, goods.product_revenue_dkk) == (249.97, 249.97)
    assert (freight.line_revenue_dkk, freight.product_revenue_dkk) == (44.92, 0.0)
    assert (goods.delivery_country, goods.market, goods.market_standardized) == ("France", "Other", "Western Europe")
    assert goods.sale_date == day("2018-03-19") and goods.customer_name == "Unknown" and goods.customer_id == 1154


def test_special_skus(sources):
    got = by_line(facts.sales_detail(sources))
    seen = {k: (r.category, r.prestashop_match_status, r.product_revenue_dkk) for k, r in got.items()}
    assert seen[1, 1] == ("Harnesses", "Matched", 200.0)
    assert seen[1, 2] == ("B2B Wholesale", "B2B Wholesale", 100.0)
    assert seen[1, 3] == ("Adjustments", "Adjustment Item", 0.0)
    assert seen[2, 1] == ("Uncategorized", "Matched", 0.0)
    assert seen[2, 2] == ("Adjustments", "Adjustment Item", 5.0)
    assert seen[2, 3] == ("Uncategorized", "Matched", 0.0)
    assert seen[3, 1] == ("Uncategorized", "Not in PrestaShop", 4.0)


def test_geography_and_customers(sources):
    got = by_line(facts.sales_detail(sources))
    place = {k: (r.delivery_country, r.market) for k, r in got.items()}
    assert place[1, 1] == ("Denmark", "Other") and place[2, 1] == ("Denmark", "Nordics")
    assert place[3, 1] == ("Atlantis", "Other") and place[4, 1] == ("Unknown", "Other")
    assert (got[1, 1].customer_segment, got[1, 1].customer_city, got[2, 1].customer_segment) == ("B2C", "Aarhus", "B2B")
    assert (got[2, 1].customer_country, got[3, 1].customer_segment) == ("Unknown", "Unknown")


def test_names_cost_and_profit(sources):
    got = by_line(facts.sales_detail(sources))
    harness, other = got[1, 1], got[2, 3]
    assert (harness.product_name, harness.core_product_economic, harness.product_category_economic) == ("Harness", "Harness", "G1")
    assert (other.product_name, other.core_product_economic, other.product_category_economic) == ("Z9 text", "Z9 text", "Other")
    assert (harness.unit_cost_dkk, harness.line_cost_dkk, harness.line_profit_dkk) == (30.0, 60.0, 140.0)
    assert (other.unit_cost_dkk, other.line_profit_dkk) == (0.0, -7.0)


def test_lookups_are_joined_on_demand_only(sources):
    narrow = facts.sales_detail(sources, ["line_revenue_dkk", "invoice_id"])
    wide = facts.sales_detail(sources, ["invoice_id", "category", "core_product_economic"])
    assert plan(narrow).count("Join") < plan(wide).count("Join")
    assert rows(narrow) == rows(facts.sales_detail(sources).select("line_revenue_dkk", "invoice_id"))
    assert rows(wide) == rows(facts.sales_detail(sources).select("invoice_id", "category", "core_product_economic"))


def test_unneeded_sources_are_not_built(sources):
    def fail():
        raise AssertionError("built")
    deferred = facts.DeferredSources(lines=lambda: sources.lines, invoices=lambda: sources.invoices, customers=fail,
                                     products=fail, sku_dim=fail)
    assert facts.sales_detail(deferred, ["line_revenue_dkk", "delivery_country"]).count() == 10
    with pytest.raises(AttributeError):
        deferred.nothing


def test_epr_detail_and_summary(spark, sources):
    weights = spark.createDataFrame(
        [("A1", 100, 20, "2025-01-01 00:00:00"), ("A1", 200, None, "2025-02-01 00:00:00"), ("Q7", 1, 1, "2025-01-01 00:00:00")],
        "sku string, carton int, plastic int, at string").selectExpr(
        "sku", "cast(carton / 1000 as decimal(10,4)) carton_kg_per_unit", "cast(plastic / 1000 as decimal(10,4)) plastic_kg_per_unit",
        "cast(0 as decimal(10,4)) foam_kg_per_unit", "cast(at as timestamp) date_uploaded", "'f' source_file")
    pack = dims.dim_sku_packaging(weights, dims.product_master(sources.sku_dim))
    assert rows(pack, "sku", "carton_kg_per_unit", "prestashop_match_status")[1][2] == "Not in PrestaShop"
    detail = facts.epr_detail(facts.sales_detail(sources, facts.EPR_SALES_COLUMNS), pack)
    assert {r.sku for r in detail.collect()} == {"A1", "HAR111213", "fragt-x", "Z9"} and len(detail.columns) == 15
    summary = {(r.country, str(r.period)): r for r in facts.epr_summary(detail).collect()}
    danish = summary["Denmark", "2025-01-01"]
    assert round(danish.carton_kg, 4) == 0.4 and round(danish.total_kg, 4) == 0.4 and danish.units == 4.0


def test_packaging_cleaner(spark):
    sheet = spark.createDataFrame(
        [("ALL COLLARS", "1", "1"), ("nan", "1", "1"), (" ", "1", "1"), (None, "1", "1"), (" A1 ", "n/a", "12.5"), ("B1", "1500", None)],
        "`Varenummer` string, `Packaging - carton (g)` string, `Plastik i gram` string")
    got = packaging.clean_packaging(sheet, "2025-03-01 10:00:00")
    assert [(r.sku, r.carton_kg_per_unit and str(r.carton_kg_per_unit), r.plastic_kg_per_unit and str(r.plastic_kg_per_unit),
             str(r.foam_kg_per_unit), r.source_file) for r in got.orderBy("sku").collect()] == [
        ("A1", None, "0.0125", "0.0000", "EPR_Upload"), ("B1", "1.5000", None, "0.0000", "EPR_Upload")]
    assert rows(packaging.packaging_counts(got)) == [(2, 1, 1, 2)]


@pytest.mark.parametrize("columns,want", [
    (["SKU", "Pap", "Plastik"], {"SKU": "SKU", "Packaging - carton (g)": "Pap", "Packaging - plastic (g)": "Plastik"}),
    (["My sku no", "Total CARTON weight", "plastic"],
     {"SKU": "My sku no", "Packaging - carton (g)": "Total CARTON weight", "Packaging - plastic (g)": "plastic"})])
def test_headings(columns, want):
    assert packaging.resolve_headings(columns) == want


def test_missing_headings_are_named():
    with pytest.raises(ValueError, match="carton"):
        packaging.resolve_headings(["SKU", "Plastik"])


def test_fact_rows_do_not_multiply_when_lookups_are_unique(sources):
    dated = sources.invoices.filter(F.col("invoice_date").isNotNull())
    assert facts.sales_detail(sources).count() == sources.lines.join(dated, "invoice_number").count()


def test_hot_sku_is_split_even_when_the_aggregation_keeps_its_key(spark):
    """Most lines carry one SKU; the lookup join must not leave them in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    lines = spark.range(0, 40000, 1, 8).selectExpr(
        "id % 5000 as invoice_number", "id as line_number", "if(id % 3 = 0, 'hot', concat('S', id % 500)) as sku",
        "'x' as line_description", "1.0D as quantity", "1.0D as unit_net_price_base_currency",
        "1.0D as unit_cost_price_base_currency", "cast(hash(id) as double) as line_net_amount_base_currency",
        "cast(null as timestamp) as api_timestamp")
    invoices = spark.range(5000).selectExpr(
        "id as invoice_number", "date'2025-01-01' as invoice_date", "id as customer_number", "'DKK' as invoice_currency",
        "100.0D as exchange_rate", "'DK' as delivery_country", "'DK' as recipient_country")
    catalogue = spark.range(500).selectExpr("concat('S', id) as sku", "concat('C', id % 5) as product_group_name", "'n' as product_name")
    sources = facts.DeferredSources(lines=lambda: lines, invoices=lambda: invoices, products=lambda: catalogue)
    previous = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = facts.sales_detail(sources, ["product_sku", "product_category_economic", "line_revenue_dkk"])
        totals = fact.groupBy("product_sku", "product_category_economic").agg(F.sum("line_revenue_dkk").alias("r"))
        assert totals.collect() and "skew=true" in plan(totals)
    finally:
        for key, value in previous.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_views_answer_sql(spark, raw):
    rest = raw("REST", (FIRST, "invoices/booked", 0, {"collection": [SAMPLE_INVOICE]}))
    bulk = raw("OPENAPI", (FIRST, "invoices/booked/lines", 0, {"items": SAMPLE_LINES}))
    warehouse = Warehouse(rest, bulk, raw("SHOP", *SHOP_PAGES))
    created = register_views(spark, warehouse)
    assert "vw_sales_detail" in created and "vw_epr_detail" not in created and len(created) == 15
    got = spark.sql("SELECT delivery_country, round(sum(line_revenue_dkk), 2) r, sum(product_revenue_dkk) p "
                    "FROM vw_sales_detail GROUP BY 1")
    assert rows(got) == [("France", 294.89, 249.97)]
    full = Warehouse(rest, bulk, raw("SHOP", *SHOP_PAGES), spark.createDataFrame(EXPIRED_ROWS, EXPIRED_SCHEMA),
                     spark.createDataFrame([], "sku string, carton_kg_per_unit decimal(10,4), plastic_kg_per_unit decimal(10,4), "
                                               "foam_kg_per_unit decimal(10,4), date_uploaded timestamp, source_file string"))
    assert len(register_views(spark, full, "full_")) == len(VIEWS) == 22
    for name in VIEWS:
        spark.table(f"full_{name}").limit(1).collect()


def test_lines_meet_finished_headers_and_are_not_joined_by_customer(spark, sources):
    """Customers and countries are looked up by header, so that lines are shuffled by invoice and by SKU only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = facts.sales_detail(sources)._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in text.splitlines() if "Join " in line]
        depth = {kind: next(len(j) - len(j.lstrip(" :+-")) for j in joins if f"({kind}#" in j) for kind in ("customer_number", "invoice_number", "sku")}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert depth["sku"] < depth["invoice_number"] < depth["customer_number"]


def test_markets_and_segments_are_made_after_the_shuffle_by_sku(spark, sources):
    """Lines carry the country as written and the group through that shuffle, not the texts made of them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = facts.sales_detail(sources)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    by_sku = next(n for n, line in enumerate(lines) if "Join " in line and "(sku#" in line)
    above, below = "\n".join(lines[:by_sku]), "\n".join(lines[by_sku:])
    for made in ("AS customer_segment#", "AS market#"):
        assert made in above and made not in below
    assert "spelling#" in above and "AS h_country#" in below


def test_customers_of_equal_number_repeat_their_lines(spark, sources):
    twice = SalesSources(sources.lines, sources.invoices, sources.customers.unionByName(sources.customers), sources.products, sources.sku_dim)
    one, two = (rows(facts.sales_detail(s).groupBy("customer_id").count()) for s in (sources, twice))
    known = {r[0] for r in rows(sources.customers, "customer_number")}
    assert two == [(c, n * 2 if c in known else n) for c, n in one]


def test_stored_headers_have_the_columns_the_fact_reads(spark, monkeypatch, tmp_path):
    for name, schema in st.TABLE_SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    written = {}
    monkeypatch.setattr(end_to_end, "materialise", lambda df, path: written.setdefault(path.rsplit("/", 1)[-1].split("-")[0], df))
    end_to_end.full_warehouse(spark, str(tmp_path))
    end_to_end.monthly_revenue_from_pages(spark, str(tmp_path))
    assert written["invoices"].columns == written["headers"].columns == list(facts.HEADER_COLUMNS)
