"""Queries on the sales fact: view columns, packaging, semantic layer, verified questions, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import dates
from ledgerlake.operators.dedup import top_per_group
from ledgerlake.plans import dims, facts, reports, verified
from ledgerlake.plans.semantic import SemanticModel
from ledgerlake.session import scratch_path
from ledgerlake.sources import store
from ledgerlake.sources.month_store import MonthStore
from ledgerlake.workload import standins as st
from ledgerlake.workload.registry import query
from ledgerlake.workload.sql_parts import (
    AS_OF, CUSTOMERS, INVOICES, LINES, PACKAGING, SKU_DIM, on_epr, on_sales, with_parts,
)

AGG = "round(sum(line_revenue_dkk), 2) AS revenue, CAST(count(DISTINCT invoice_id) AS BIGINT) AS orders"
AOV = "round(sum(line_revenue_dkk) / nullif(count(DISTINCT invoice_id), 0), 6) AS aov"
UNITS = "round(sum(quantity_sold), 2) AS units"
MATCHED = "prestashop_match_status = 'Matched'"


def today():
    return dates.as_of_date(st.AS_OF)


# --- sales fact -----------------------------------------------------------------------------------------------------

FACT_COLUMNS = facts.sales_columns()
_ROUNDED = {"exchange_rate": 6, "quantity_sold": 2, "unit_price_dkk": 2, "line_revenue_dkk": 2, "product_revenue_dkk": 2,
            "unit_cost_dkk": 2, "line_cost_dkk": 2, "line_profit_dkk": 2}
_BIG = {"parent_category_id", "category_level", "prestashop_stock_qty"}


def _fact_select() -> str:
    def item(c: str) -> str:
        if c in _ROUNDED:
            return f"round({c}, {_ROUNDED[c]}) AS {c}"
        if c in _BIG:
            return f"CAST({c} AS BIGINT) AS {c}"
        return f"CAST({c} AS VARCHAR) AS {c}" if c in ("sale_date", "data_last_refreshed") else c
    return ", ".join(item(c) for c in FACT_COLUMNS)


@query("fct1_sales_detail", on_sales(f"SELECT {_fact_select()} FROM sales"), exchange_rate=6)
def fct1(spark, sf):
    return st.sales(spark, sf)


def _count_by(name: str, *columns: str) -> None:
    keys = ", ".join(columns)

    @query(name, on_sales(f"SELECT {keys}, CAST(count(*) AS BIGINT) AS line_count, "
                          f"round(sum(line_revenue_dkk), 2) AS revenue FROM sales GROUP BY {keys}"))
    def run(spark, sf):
        return st.sales(spark, sf, *columns, "line_revenue_dkk").groupBy(*columns).agg(
            F.count(F.lit(1)).alias("line_count"), F.sum("line_revenue_dkk").alias("revenue"))


_count_by("fct2_customer_segment", "customer_segment")
_count_by("fct3_category", "category")
_count_by("fct4_match_status", "prestashop_match_status", "has_prestashop_data")
_count_by("fct5_country", "delivery_country")
_count_by("fct6_market", "market")


@query("fct7_product_revenue", on_sales(
    "SELECT category, round(sum(product_revenue_dkk), 2) AS product_revenue, "
    "CAST(count(*) FILTER (product_revenue_dkk = 0) AS BIGINT) AS zero_lines FROM sales GROUP BY category"))
def fct7(spark, sf):
    return st.sales(spark, sf, "category", "product_revenue_dkk").groupBy("category").agg(
        F.sum("product_revenue_dkk").alias("product_revenue"),
        F.count_if(F.col("product_revenue_dkk") == 0).alias("zero_lines"))


@query("fct8_cost_profit", on_sales(
    "SELECT product_sku, round(sum(unit_cost_dkk), 2) AS unit_cost, round(sum(line_cost_dkk), 2) AS line_cost, "
    "round(sum(line_profit_dkk), 2) AS line_profit FROM sales GROUP BY product_sku"))
def fct8(spark, sf):
    return st.sales(spark, sf, "product_sku", "unit_cost_dkk", "line_cost_dkk", "line_profit_dkk") \
        .groupBy("product_sku").agg(
            F.sum("unit_cost_dkk").alias("unit_cost"), F.sum("line_cost_dkk").alias("line_cost"),
            F.sum("line_profit_dkk").alias("line_profit"))


_count_by("fct9_core_product", "core_product_economic", "product_category_economic")


@query("fct10_customer_master", with_parts("""
SELECT customer_number AS customer_id, customer_name, coalesce(city, 'Unknown') AS customer_city,
       coalesce(country, 'Unknown') AS customer_country, customer_group_number AS customer_group_id,
       CASE WHEN customer_group_number = 1 THEN 'B2C' WHEN customer_group_number >= 2 THEN 'B2B' ELSE 'Unknown' END
         AS customer_segment,
       email AS email_address, telephone AS phone_number, mobile_phone AS mobile_number,
       currency AS preferred_currency, payment_terms_number AS payment_terms_id, vatzone_number AS vat_zone_id,
       salesperson_employee_number AS sales_rep_id, CAST(last_updated AS VARCHAR) AS last_updated_date
FROM cu""", CUSTOMERS))
def fct10(spark, sf):
    return dims.customer_master(st.customers(spark, sf))


@query("fct11_product_master", with_parts(f"""
SELECT sku AS product_sku, combination_id AS variant_id, product_id AS parent_product_id, product_name,
       product_active AS is_active, CAST(category_id AS BIGINT) AS category_id, category_name,
       CAST(parent_category_id AS BIGINT) AS parent_category_id, CAST(category_level AS BIGINT) AS category_level,
       size, color, all_attributes AS all_attributes_text, ean13, price_impact,
       CAST(stock_quantity AS BIGINT) AS stock_quantity, '{st.FIRST_LOAD}' AS last_updated_date,
       '2024-01-01 00:00:00' AS dim_created_timestamp
FROM ps""", SKU_DIM))
def fct11(spark, sf):
    return dims.product_master(st.sku_dim(spark, sf))


def _packaging_dim(spark, sf):
    return dims.dim_sku_packaging(st.packaging(spark, sf), dims.product_master(st.sku_dim(spark, sf)))


def _epr(spark, sf):
    return facts.epr_detail(st.sales(spark, sf, *facts.EPR_SALES_COLUMNS), _packaging_dim(spark, sf))


@query("fct12_epr_detail", on_epr("""
SELECT CAST(sale_date AS VARCHAR) AS sale_date, customer_name, customer_segment, country, sku, product_name, category,
       size, color, round(quantity_sold, 2) AS quantity_sold,
       round(CAST(carton_kg_per_unit AS DOUBLE), 4) AS carton_kg_per_unit,
       round(CAST(plastic_kg_per_unit AS DOUBLE), 4) AS plastic_kg_per_unit,
       round(CAST(foam_kg_per_unit AS DOUBLE), 4) AS foam_kg_per_unit,
       round(line_revenue_dkk, 2) AS line_revenue_dkk, packaging_match_status
FROM epr"""), carton_kg_per_unit=4, plastic_kg_per_unit=4, foam_kg_per_unit=4)
def fct12(spark, sf):
    return _epr(spark, sf)


@query("fct13_epr_summary", on_epr("""
SELECT country, CAST(CAST(date_trunc('quarter', sale_date) AS DATE) AS VARCHAR) AS period,
       round(sum(quantity_sold), 2) AS units,
       round(sum(quantity_sold * coalesce(CAST(carton_kg_per_unit AS DOUBLE), 0)), 4) AS carton_kg,
       round(sum(quantity_sold * coalesce(CAST(plastic_kg_per_unit AS DOUBLE), 0)), 4) AS plastic_kg,
       round(sum(quantity_sold * coalesce(CAST(foam_kg_per_unit AS DOUBLE), 0)), 4) AS foam_kg,
       round(sum(quantity_sold * (coalesce(CAST(carton_kg_per_unit AS DOUBLE), 0)
             + coalesce(CAST(plastic_kg_per_unit AS DOUBLE), 0)
             + coalesce(CAST(foam_kg_per_unit AS DOUBLE), 0))), 4) AS total_kg
FROM epr GROUP BY 1, 2"""), carton_kg=4, plastic_kg=4, foam_kg=4, total_kg=4)
def fct13(spark, sf):
    return facts.epr_summary(_epr(spark, sf), "quarter")


@query("dim3_sku_packaging", with_parts("""
SELECT sku, round(CAST(carton_kg_per_unit AS DOUBLE), 4) AS carton_kg_per_unit,
       round(CAST(plastic_kg_per_unit AS DOUBLE), 4) AS plastic_kg_per_unit,
       round(CAST(foam_kg_per_unit AS DOUBLE), 4) AS foam_kg_per_unit, CAST(last_updated AS VARCHAR) AS last_updated,
       product_description, category_name, size, color, prestashop_match_status
FROM dim_pkg""", SKU_DIM, PACKAGING), scale=4)
def dim3(spark, sf):
    return _packaging_dim(spark, sf)


# --- semantic layer -------------------------------------------------------------------------------------------------

@query("sem1_dimensions", on_sales(f"SELECT category, size, color, market, invoice_currency, {AGG} FROM sales GROUP BY ALL"))
def sem1(spark, sf):
    return st.model(spark, sf).query(
        dims=["product line", "dog size", "colour", "market type", "currency"],
        metrics=["total revenue", "order count"]) \
        .toDF("category", "size", "color", "market", "invoice_currency", "revenue", "orders")


@query("sem2_time_grains", on_sales(f"""
SELECT 'week' AS grain, CAST(CAST(date_trunc('week', sale_date) AS DATE) AS VARCHAR) AS period, {AGG} FROM sales GROUP BY 1, 2
UNION ALL SELECT 'quarter', CAST(CAST(date_trunc('quarter', sale_date) AS DATE) AS VARCHAR), {AGG} FROM sales GROUP BY 1, 2
UNION ALL SELECT 'year', CAST(CAST(date_trunc('year', sale_date) AS DATE) AS VARCHAR), {AGG} FROM sales GROUP BY 1, 2"""))
def sem2(spark, sf):
    model = st.model(spark, sf)
    parts = [model.query(dims=[("sale date", g)], metrics=["total_revenue", "total_orders"])
             .toDF("period", "revenue", "orders").select(F.lit(g).alias("grain"), "period", "revenue", "orders")
             for g in ("week", "quarter", "year")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("sem3_facts", on_sales("""
SELECT category, round(sum(line_revenue_dkk), 2) AS line_revenue_dkk, round(sum(line_cost_dkk), 2) AS line_cost_dkk,
       round(sum(line_profit_dkk), 2) AS line_profit_dkk, round(sum(product_revenue_dkk), 2) AS product_revenue_dkk,
       round(sum(quantity_sold), 2) AS quantity_sold, round(avg(unit_price_dkk), 4) AS unit_price_dkk,
       round(avg(unit_cost_dkk), 4) AS unit_cost_dkk
FROM sales GROUP BY category"""), unit_price_dkk=4, unit_cost_dkk=4)
def sem3(spark, sf):
    return st.model(spark, sf).query(dims=["category"], metrics=[
        "line_revenue_dkk", "cogs", "earnings", "goods revenue", "qty", "selling price", "unit cost"])


@query("sem4_totals", on_sales("""
SELECT round(sum(line_revenue_dkk), 2) AS total_revenue, round(sum(line_profit_dkk), 2) AS total_profit,
       CAST(count(DISTINCT invoice_id) AS BIGINT) AS total_orders,
       CAST(count(DISTINCT customer_id) AS BIGINT) AS total_customers, round(sum(quantity_sold), 2) AS total_units
FROM sales"""))
def sem4(spark, sf):
    return st.model(spark, sf).query(
        metrics=["total_revenue", "total_profit", "total_orders", "total_customers", "total_units"])


@query("sem5_margin_and_order_value", on_sales("""
SELECT delivery_country, round(sum(line_profit_dkk) / nullif(sum(line_revenue_dkk), 0) * 100, 6) AS profit_margin_pct,
       round(sum(line_revenue_dkk) / nullif(count(DISTINCT invoice_id), 0), 6) AS average_order_value
FROM sales GROUP BY delivery_country"""), scale=6)
def sem5(spark, sf):
    return st.model(spark, sf).query(dims=["delivery_country"], metrics=["gross margin", "aov"])


_YEAR = "sum(CASE WHEN year(sale_date) = year({0}) - {1} THEN line_revenue_dkk ELSE 0 END)"
_MONTH = "sum(CASE WHEN date_trunc('month', sale_date) = date_trunc('month', {0} - INTERVAL {1} MONTH) " \
         "THEN line_revenue_dkk ELSE 0 END)"


def _growth_sql(template: str, name: str) -> str:
    new, old = template.format(AS_OF, 0), template.format(AS_OF, 1)
    return on_sales(f"SELECT category, round(({new} - {old}) / nullif({old}, 0) * 100, 6) AS {name} "
                    "FROM sales GROUP BY category")


@query("sem6_growth_yoy", _growth_sql(_YEAR, "revenue_growth_yoy_pct"), scale=6)
def sem6(spark, sf):
    return st.model(spark, sf).query(dims=["category"], metrics=["revenue_growth_yoy_pct"], as_of=st.AS_OF)


@query("sem7_growth_mom", _growth_sql(_MONTH, "revenue_growth_mom_pct"), scale=6)
def sem7(spark, sf):
    return st.model(spark, sf).query(dims=["category"], metrics=["mom growth"], as_of=st.AS_OF)


_FILTER_SQL = {
    "last_week": f"sale_date >= {AS_OF} - 7", "last_month": f"sale_date >= {AS_OF} - 30",
    "last_quarter": f"sale_date >= {AS_OF} - 90",
    "current_year": f"year(sale_date) = year({AS_OF})", "last_year": f"year(sale_date) = year({AS_OF}) - 1",
    "this_month": f"date_trunc('month', sale_date) = date_trunc('month', {AS_OF})",
    "last_month_complete": f"date_trunc('month', sale_date) = date_trunc('month', {AS_OF} - INTERVAL 1 MONTH)",
    "this_quarter": f"date_trunc('quarter', sale_date) = date_trunc('quarter', {AS_OF})",
    "last_quarter_complete": f"date_trunc('quarter', sale_date) = date_trunc('quarter', {AS_OF} - INTERVAL 3 MONTH)",
    "matched_products": MATCHED, "product_sales_only": MATCHED,
    "b2b_only": "customer_segment = 'B2B'", "b2c_only": "customer_segment = 'B2C'",
    "top_categories": "category IN ('Harnesses', 'Leads', 'Collars')",
    "scandinavia": "delivery_country IN ('Denmark', 'Norway', 'Sweden')",
    "dach_region": "delivery_country IN ('Germany', 'Austria', 'Switzerland')",
    "western_europe": "delivery_country IN ('France', 'United Kingdom', 'Netherlands', 'Belgium', 'Luxembourg')",
}


def _filters(name: str, names: list[str], model=st.model) -> None:
    sql = " UNION ALL ".join(
        f"SELECT '{n}' AS filter_name, {AGG} FROM sales WHERE {_FILTER_SQL[n]} HAVING count(*) > 0" for n in names)

    @query(name, on_sales(sql))
    def run(spark, sf):
        return model(spark, sf).by_filter(names, metrics=["total_revenue", "total_orders"], as_of=st.AS_OF) \
            .toDF("filter_name", "revenue", "orders")


_filters("sem8_rolling_filters", ["last_week", "last_month", "last_quarter"], st.stored_model)
_filters("sem9_calendar_filters", [
    "current_year", "last_year", "this_month", "last_month_complete", "this_quarter", "last_quarter_complete"],
         st.stored_model)
_filters("sem10_value_filters", [
    "matched_products", "product_sales_only", "b2b_only", "b2c_only", "top_categories", "scandinavia", "dach_region",
    "western_europe"])


@query("sem11_product_entity", with_parts("""
SELECT category_name, round(avg(price_impact), 4) AS price_impact FROM ps WHERE product_active GROUP BY category_name""",
                                          SKU_DIM), scale=4)
def sem11(spark, sf):
    return st.model(spark, sf).query("product", dims=["category"], metrics=["price modifier"], filters=["active only"])


@query("sem11_customer_entity", with_parts("""
SELECT DISTINCT CASE WHEN customer_group_number = 1 THEN 'B2C' WHEN customer_group_number >= 2 THEN 'B2B'
                     ELSE 'Unknown' END AS customer_segment,
       coalesce(city, 'Unknown') AS customer_city, currency AS preferred_currency
FROM cu""", CUSTOMERS))
def sem11_customer(spark, sf):
    return st.model(spark, sf).query("customer", dims=["segment", "town", "default currency"])


@query("sem12_relationships", on_sales("""
SELECT cu.email AS email_address, ps.product_active AS is_active, round(sum(line_revenue_dkk), 2) AS total_revenue
FROM sales LEFT JOIN cu ON sales.customer_id = cu.customer_number LEFT JOIN ps ON sales.product_sku = ps.sku
GROUP BY 1, 2"""))
def sem12(spark, sf):
    return st.model(spark, sf).query(dims=["customer.email", "product.is_active"], metrics=["total_revenue"])


@query("sem13_query", on_sales(f"""
SELECT customer_segment, market, {UNITS}, round(sum(line_revenue_dkk), 2) AS revenue
FROM sales WHERE year(sale_date) = year({AS_OF}) AND {MATCHED} AND customer_segment = 'B2B' AND size = '7'
GROUP BY 1, 2 ORDER BY revenue DESC LIMIT 5"""))
def sem13(spark, sf):
    return st.model(spark, sf).query(
        dims=["segment", "market"], metrics=["total_units", "total_revenue"], as_of=st.AS_OF,
        filters=["ytd", "matched only", "business sales"], where=[("size", lambda size: size == "7")],
        order_by=[("total_revenue", "desc")], limit=5).toDF("customer_segment", "market", "units", "revenue")


# --- verified questions ---------------------------------------------------------------------------------------------

@query("vq1_last_week_revenue", on_sales(
    f"SELECT round(sum(line_revenue_dkk), 2) AS total_revenue_dkk, CAST(count(DISTINCT invoice_id) AS BIGINT) AS orders "
    f"FROM sales WHERE sale_date >= {AS_OF} - 7"))
def vq1(spark, sf):
    return verified.last_week_revenue(st.stored_model(spark, sf), st.AS_OF)


@query("vq2_last_month_by_category", on_sales(
    f"SELECT category, {AGG}, {UNITS} FROM sales WHERE sale_date >= {AS_OF} - 30 AND {MATCHED} GROUP BY category"))
def vq2(spark, sf):
    return verified.last_month_by_category(st.stored_model(spark, sf), st.AS_OF)


@query("vq3_b2b_vs_b2c_last_quarter", on_sales(
    f"SELECT customer_segment, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers, {AGG}, {AOV} "
    f"FROM sales WHERE sale_date >= {AS_OF} - 90 GROUP BY customer_segment"), aov=6)
def vq3(spark, sf):
    return verified.segments_last_quarter(st.stored_model(spark, sf), st.AS_OF)


@query("vq4_top_products_this_month", on_sales(f"""
SELECT product_sku, product_name, category, size, color, {UNITS}, round(sum(line_revenue_dkk), 2) AS revenue
FROM sales WHERE sale_date >= date_trunc('month', {AS_OF}) AND {MATCHED}
GROUP BY 1, 2, 3, 4, 5 ORDER BY revenue DESC, product_sku LIMIT 10"""))
def vq4(spark, sf):
    return verified.top_products_this_month(st.stored_model(spark, sf), st.AS_OF)


@query("vq5_monthly_trend", on_sales(f"""
SELECT CAST(CAST(date_trunc('month', sale_date) AS DATE) AS VARCHAR) AS month, {AGG}, {AOV}
FROM sales WHERE year(sale_date) = {st.TREND_YEAR} GROUP BY 1"""), aov=6)
def vq5(spark, sf):
    return verified.monthly_trend(st.stored_model(spark, sf), st.TREND_YEAR)


@query("vq6_sales_by_country_last_month", on_sales(
    f"SELECT delivery_country, {AGG} FROM sales WHERE sale_date >= {AS_OF} - 30 GROUP BY delivery_country"))
def vq6(spark, sf):
    return verified.countries_last_month(st.stored_model(spark, sf), st.AS_OF)


@query("vq7_size_color_performance_ytd", on_sales(f"""
SELECT size, color, {UNITS}, round(sum(line_revenue_dkk), 2) AS revenue
FROM sales WHERE year(sale_date) = year({AS_OF}) AND {MATCHED} GROUP BY 1, 2
ORDER BY revenue DESC, size NULLS LAST, color NULLS LAST LIMIT 20"""))
def vq7(spark, sf):
    return verified.size_colour_this_year(st.stored_model(spark, sf), st.AS_OF)


@query("vq8_week_over_week", on_sales(f"""
SELECT CASE WHEN sale_date >= {AS_OF} - 7 THEN 'This Week' ELSE 'Last Week' END AS period, {AGG}, {UNITS}
FROM sales WHERE sale_date >= {AS_OF} - 14 GROUP BY 1"""))
def vq8(spark, sf):
    return verified.week_over_week(st.stored_sales(
        spark, sf, ["sale_date", "line_revenue_dkk", "invoice_id", "quantity_sold"], dates.last_days(today(), 14)), st.AS_OF)


@query("vq9_top_customers_last_quarter", on_sales(f"""
SELECT customer_name, customer_segment, delivery_country, {AGG} FROM sales WHERE sale_date >= {AS_OF} - 90
GROUP BY 1, 2, 3 ORDER BY revenue DESC, customer_name, delivery_country LIMIT 10"""))
def vq9(spark, sf):
    return verified.top_customers_last_quarter(st.stored_model(spark, sf), st.AS_OF)


@query("vq10_category_by_segment_this_year", on_sales(f"""
SELECT customer_segment, category, {UNITS}, round(sum(line_revenue_dkk), 2) AS revenue
FROM sales WHERE year(sale_date) = year({AS_OF}) AND {MATCHED} GROUP BY 1, 2"""))
def vq10(spark, sf):
    return verified.categories_by_segment(st.stored_model(spark, sf), st.AS_OF)


@query("vq11_yoy_growth_by_category", on_sales(f"""
SELECT category, round({_YEAR.format(AS_OF, 0)}, 2) AS current_year_revenue,
       round({_YEAR.format(AS_OF, 1)}, 2) AS last_year_revenue,
       round(({_YEAR.format(AS_OF, 0)} - {_YEAR.format(AS_OF, 1)}) / nullif({_YEAR.format(AS_OF, 1)}, 0) * 100, 6)
         AS growth_pct
FROM sales WHERE {MATCHED} AND year(sale_date) IN (year({AS_OF}), year({AS_OF}) - 1) GROUP BY category"""), growth_pct=6)
def vq11(spark, sf):
    years = dates.year_of(today(), -1)[0], dates.year_of(today())[1]
    return verified.category_growth(st.stored_sales(
        spark, sf, ["sale_date", "line_revenue_dkk", "category", "prestashop_match_status"], years), st.AS_OF)


# --- published fact -------------------------------------------------------------------------------------------------

_MONTH_ROWS = """
SELECT CAST(CAST(date_trunc('month', sale_date) AS DATE) AS VARCHAR) AS month, CAST(count(*) AS BIGINT) AS n,
       round(sum(line_revenue_dkk), 2) AS revenue FROM sales GROUP BY 1"""


def _stored_months(store):
    return store.read(["sale_month", "line_revenue_dkk"]).groupBy(F.col("sale_month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("line_revenue_dkk").alias("revenue"))


@query("pub1_publish_months", on_sales(_MONTH_ROWS))
def pub1(spark, sf):
    """A publication of the whole fact into a new store: what the questions on months save, and what it costs once."""
    return _stored_months(st.publish(spark, sf))


@query("pub2_republish_changed_months", on_sales(f"""
SELECT m.*, date_trunc('month', CAST(m.month AS DATE)) = date_trunc('month', {AS_OF}) AS rewritten FROM ({_MONTH_ROWS}) m"""))
def pub2(spark, sf):
    """A fact that lacks half of one month's lines, then the whole one: the second publication writes that month only. The fact is
    stored once, so that neither publication joins the lines again."""
    fact = store.materialise(st.sales(spark, sf), scratch_path(spark, "fact"))
    within = dates.within(F.col("sale_date"), dates.month_of(today())) & (F.col("line_id") % 2 == 0)
    months = MonthStore(spark, scratch_path(spark, "sales-again"), fact.schema)
    months.publish(fact.where(~within))
    changed = months.publish(fact)
    return _stored_months(months).withColumn("rewritten", F.col("month").isin(changed))


@query("vq3_from_published_fact", on_sales(
    f"SELECT customer_segment, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers, {AGG}, {AOV} "
    f"FROM sales WHERE sale_date >= {AS_OF} - 90 GROUP BY customer_segment"), aov=6)
def vq3_published(spark, sf):
    """The whole fact written by month, then the question on it: only the months of the period are read."""
    path, fact = scratch_path(spark, "sales"), st.sales(spark, sf)
    store.publish_by_month(fact, path)
    model = SemanticModel({"sales": store.published(spark, path, fact.schema)}, month_partition="sale_month")
    return verified.segments_last_quarter(model, st.AS_OF)


# --- totals of months: orders and order values without the lines of whole months ----------------------------------------

@query("vq3_from_month_totals", on_sales(
    f"SELECT customer_segment, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers, {AGG}, {AOV} "
    f"FROM sales WHERE sale_date >= {AS_OF} - 90 GROUP BY customer_segment"), aov=6)
def vq3_totals(spark, sf):
    period = dates.last_days(today(), 90)
    return st.month_totals(spark, sf, period).query(
        ["customer_segment"], ["total_customers", "total_revenue", "total_orders", "average_order_value"],
        period).toDF("customer_segment", "customers", "revenue", "orders", "aov")


@query("vq5_from_month_totals", on_sales(f"""
SELECT CAST(CAST(date_trunc('month', sale_date) AS DATE) AS VARCHAR) AS month, {AGG}, {AOV}
FROM sales WHERE year(sale_date) = {st.TREND_YEAR} GROUP BY 1"""), aov=6)
def vq5_totals(spark, sf):
    year = dates.year_of(F.lit(f"{st.TREND_YEAR}-01-01").cast("date"))
    return st.month_totals(spark, sf, year).query(
        ["sale_month"], ["total_revenue", "total_orders", "average_order_value"], year).toDF("month", "revenue", "orders", "aov")


@query("vq8_from_month_totals", on_sales(f"""
SELECT CASE WHEN sale_date >= {AS_OF} - 7 THEN 'This Week' ELSE 'Last Week' END AS period, {AGG}, {UNITS}
FROM sales WHERE sale_date >= {AS_OF} - 14 GROUP BY 1"""))
def vq8_totals(spark, sf):
    totals = st.month_totals(spark, sf, dates.last_days(today(), 14))
    this_week, last_week = (
        totals.query([], ["total_revenue", "total_orders", "total_units"], period).select(F.lit(name).alias("period"), "*")
        for name, period in (("This Week", dates.last_days(today(), 7)), ("Last Week", (F.date_sub(today(), 14), F.date_sub(today(), 7)))))
    return this_week.unionByName(last_week).toDF("period", "revenue", "orders", "units")


@query("sem4_totals_from_months", on_sales(f"""
SELECT round(sum(line_revenue_dkk), 2) AS total_revenue, CAST(count(DISTINCT invoice_id) AS BIGINT) AS total_orders,
       CAST(count(DISTINCT customer_id) AS BIGINT) AS total_customers FROM sales WHERE sale_date >= DATE '1996-02-11'
       AND sale_date < DATE '2000-11-20'"""))
def sem4_months(spark, sf):
    """Years of customers that bought in many months, counted once; the days at both ends come from the fact."""
    period = F.lit("1996-02-11").cast("date"), F.lit("2000-11-20").cast("date")
    return st.month_totals(spark, sf, period).query([], ["total_revenue", "total_orders", "total_customers"], period)


# --- reports --------------------------------------------------------------------------------------------------------

@query("rpt1_weekly_kpis", on_sales(f"""
SELECT round(sum(line_revenue_dkk) FILTER (sale_date < {AS_OF}), 2) AS revenue,
       CAST(count(DISTINCT invoice_id) FILTER (sale_date < {AS_OF}) AS BIGINT) AS orders,
       round(sum(line_revenue_dkk) FILTER (sale_date < {AS_OF})
             / nullif(count(DISTINCT invoice_id) FILTER (sale_date < {AS_OF}), 0), 6) AS aov,
       (SELECT category FROM sales WHERE sale_date >= {AS_OF} - 7 AND {MATCHED} GROUP BY category
        ORDER BY sum(line_revenue_dkk) DESC, category LIMIT 1) AS top_category,
       (SELECT round(sum(line_revenue_dkk), 2) AS r FROM sales WHERE sale_date >= {AS_OF} - 7 AND {MATCHED}
        GROUP BY category ORDER BY r DESC LIMIT 1) AS top_category_revenue,
       round(sum(CASE WHEN customer_segment = 'B2B' THEN line_revenue_dkk ELSE 0 END), 2) AS b2b_revenue,
       round(sum(CASE WHEN customer_segment = 'B2C' THEN line_revenue_dkk ELSE 0 END), 2) AS b2c_revenue
FROM sales WHERE sale_date >= {AS_OF} - 7"""), aov=6)
def rpt1(spark, sf):
    return reports.weekly_kpis(st.stored_sales(spark, sf, reports.WEEKLY_COLUMNS, dates.last_days(today(), 7)), st.AS_OF)


@query("rpt2_sales_alert", on_sales(f"""
SELECT *, 150000.0::DOUBLE AS threshold, round(150000 - this_week_revenue, 2) AS shortfall,
       round((last_week_revenue - this_week_revenue) / nullif(last_week_revenue, 0) * 100, 6) AS decline_pct,
       coalesce(this_week_revenue < 150000, FALSE) AS is_alert
FROM (SELECT round(sum(line_revenue_dkk) FILTER (sale_date >= {AS_OF} - 7), 2) AS this_week_revenue,
             round(sum(line_revenue_dkk) FILTER (sale_date < {AS_OF} - 7), 2) AS last_week_revenue,
             CAST(count(DISTINCT invoice_id) FILTER (sale_date >= {AS_OF} - 7) AS BIGINT) AS this_week_orders
      FROM sales WHERE sale_date >= {AS_OF} - 14)"""), decline_pct=6)
def rpt2(spark, sf):
    recent = st.stored_sales(spark, sf, ["sale_date", "line_revenue_dkk", "invoice_id"], dates.last_days(today(), 14))
    return reports.sales_alert(recent, 150000, st.AS_OF)


@query("rpt3_market_overview", on_sales(f"""
SELECT market, category, {AGG}, round(avg(line_profit_dkk / nullif(line_revenue_dkk, 0) * 100), 4) AS avg_margin
FROM sales WHERE sale_date >= DATE '2000-01-01' GROUP BY market, category"""), avg_margin=4)
def rpt3(spark, sf):
    return reports.market_overview(
        st.sales(spark, sf, "sale_date", "market", "category", "invoice_id", "line_revenue_dkk", "line_profit_dkk"),
        "2000-01-01")


@query("rpt4_match_status_audit", on_sales("""
SELECT prestashop_match_status, CAST(count(*) AS BIGINT) AS line_count,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_of_lines,
       round(sum(line_revenue_dkk), 2) AS revenue_dkk,
       round(sum(line_revenue_dkk) * 100.0 / sum(sum(line_revenue_dkk)) OVER (), 2) AS pct_of_revenue
FROM sales GROUP BY prestashop_match_status"""))
def rpt4(spark, sf):
    return reports.match_status_audit(st.sales(spark, sf, "prestashop_match_status", "line_revenue_dkk"))


@query("rpt5_category_margins", on_sales(f"""
SELECT category, CAST(count(DISTINCT product_sku) AS BIGINT) AS sku_count, round(sum(quantity_sold), 2) AS units_sold,
       round(sum(line_revenue_dkk), 2) AS revenue_dkk, round(sum(line_profit_dkk), 2) AS profit_dkk,
       round(sum(line_profit_dkk) / nullif(sum(line_revenue_dkk), 0) * 100, 2) AS margin_pct
FROM sales WHERE {MATCHED} AND product_revenue_dkk > 0 GROUP BY category"""))
def rpt5(spark, sf):
    return reports.category_margins(st.sales(
        spark, sf, "category", "product_sku", "quantity_sold", "line_revenue_dkk", "line_profit_dkk",
        "prestashop_match_status", "product_revenue_dkk"))


@query("rpt5_size_colour_table", on_sales(f"""
SELECT size, color, CAST(count(*) AS BIGINT) AS line_count, round(sum(quantity_sold), 2) AS units_sold,
       round(sum(line_revenue_dkk), 2) AS revenue_dkk
FROM sales WHERE {MATCHED} AND product_revenue_dkk > 0 GROUP BY size, color
ORDER BY revenue_dkk DESC, size NULLS LAST, color NULLS LAST LIMIT 20"""))
def rpt5_table(spark, sf):
    return reports.size_colour_table(st.sales(
        spark, sf, "size", "color", "quantity_sold", "line_revenue_dkk", "prestashop_match_status",
        "product_revenue_dkk"))


@query("rpt6_sku_match_rate", with_parts("""
SELECT has_prestashop_data, is_economic_only, CAST(count(*) AS BIGINT) AS sku_count,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
FROM ps GROUP BY 1, 2""", SKU_DIM))
def rpt6(spark, sf):
    return reports.sku_match_rate(st.sku_dim(spark, sf))


@query("rpt7_invoice_reconciliation", with_parts("""
SELECT inv.invoice_number, CAST(inv.invoice_date AS VARCHAR) AS invoice_date, inv.customer_number,
       inv.delivery_country, CAST(count(*) AS BIGINT) AS line_count,
       round(sum(line_net_amount_base_currency), 2) AS total_amount
FROM inv JOIN ln ON inv.invoice_number = ln.invoice_number GROUP BY 1, 2, 3, 4""", INVOICES, LINES))
def rpt7(spark, sf):
    return reports.invoice_reconciliation(st.invoices(spark, sf), st.lines(spark, sf))


@query("rpt10_packaging_match_quality", on_epr(f"""
SELECT packaging_match_status, CAST(count(*) AS BIGINT) AS lines, CAST(count(DISTINCT sku) AS BIGINT) AS unique_skus
FROM epr WHERE sale_date >= {AS_OF} - INTERVAL 1 YEAR GROUP BY 1"""))
def rpt10(spark, sf):
    year = st.stored_sales(spark, sf, facts.EPR_SALES_COLUMNS, (F.add_months(today(), -12), None))
    return reports.packaging_match_quality(facts.epr_detail(year, _packaging_dim(spark, sf)), st.AS_OF)


@query("rpt12_view_counts", on_sales("""
SELECT 'sales_detail' AS view_name, CAST(count(*) AS BIGINT) AS row_count FROM sales
UNION ALL SELECT 'customer_master', CAST(count(*) AS BIGINT) FROM cu
UNION ALL SELECT 'product_master', CAST(count(*) AS BIGINT) FROM ps"""))
def rpt12_counts(spark, sf):
    return reports.view_counts(sales_detail=st.sales(spark, sf, "invoice_id"),
                               customer_master=dims.customer_master(st.customers(spark, sf)),
                               product_master=dims.product_master(st.sku_dim(spark, sf)))


@query("rpt12_skus_per_category", with_parts(
    "SELECT category_name, CAST(count(*) AS BIGINT) AS sku_count FROM ps GROUP BY 1", SKU_DIM))
def rpt12_categories(spark, sf):
    return reports.skus_per(st.sku_dim(spark, sf), "category_name")


@query("rpt12_sku_uniqueness", with_parts(
    "SELECT CAST(count(*) AS BIGINT) AS total_skus, CAST(count(DISTINCT sku) AS BIGINT) AS unique_skus FROM ps", SKU_DIM))
def rpt12_unique(spark, sf):
    return reports.sku_uniqueness(st.sku_dim(spark, sf))


@query("rpt9_packaging_uploads", with_parts("""
SELECT CAST(date_uploaded AS VARCHAR) AS date_uploaded, source_file, CAST(count(*) AS BIGINT) AS row_count,
       CAST(count(DISTINCT sku) AS BIGINT) AS unique_skus
FROM pkg GROUP BY 1, 2""", SKU_DIM, PACKAGING))
def rpt9(spark, sf):
    return reports.packaging_uploads(st.packaging(spark, sf))


# --- the question "top customers in each of the top countries" ------------------------------------------------------

@query("srt4_top_customers_in_top_countries", on_sales("""
, per AS (SELECT delivery_country, customer_name, sum(line_revenue_dkk) AS total FROM sales GROUP BY 1, 2),
best AS (SELECT delivery_country FROM per GROUP BY 1 ORDER BY sum(total) DESC, 1 LIMIT 3)
SELECT delivery_country, customer_name, round(total, 2) AS total,
       CAST(row_number() OVER (PARTITION BY delivery_country ORDER BY total DESC, customer_name) AS BIGINT) AS rank
FROM per WHERE delivery_country IN (SELECT delivery_country FROM best)
QUALIFY rank <= 5"""))
def srt4(spark, sf):
    return top_per_group(st.sales(spark, sf, "delivery_country", "customer_name", "line_revenue_dkk"),
                         ["delivery_country"], ["customer_name"], F.col("line_revenue_dkk"), k=5, top_groups=3)


@query("dat_date_ranges", on_sales(f"""
SELECT CAST(date_trunc('month', sale_date)::DATE AS VARCHAR) AS month, CAST(year(sale_date) AS BIGINT) AS year,
       CAST(count(*) FILTER (sale_date >= {AS_OF} - INTERVAL 3 MONTH) AS BIGINT) AS recent_lines,
       CAST(count(*) AS BIGINT) AS line_count
FROM sales GROUP BY 1, 2"""))
def dat_ranges(spark, sf):
    today, day = dates.as_of_date(st.AS_OF), F.col("sale_date")
    return st.sales(spark, sf, "sale_date").groupBy(
        dates.truncate(day, "month").alias("month"), F.year(day).alias("year")).agg(
        F.count_if(day >= F.add_months(today, -3)).alias("recent_lines"), F.count(F.lit(1)).alias("line_count"))
