"""The whole path in one query: RAW pages, entities, SKU dimension, sales fact, monthly figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans import verified
from ledgerlake.plans.facts import HEADER_COLUMNS, sales_detail
from ledgerlake.plans.semantic import SemanticModel
from ledgerlake.plans.views import Warehouse, register_views
from ledgerlake.session import scratch_path
from ledgerlake.sources.store import materialise
from ledgerlake.workload import standins as st
from ledgerlake.workload.registry import query
from ledgerlake.workload.sql_parts import LINE_FIELDS, currency, rate

LINE_TIES = ("sku", "line_description", "quantity", "unit_net_price", "unit_cost_price", "line_net_amount",
             "discount_percentage", "vat_rate")


def erp_warehouse(spark: SparkSession, sf: str) -> Warehouse:
    """Without shop data: for questions that need no SKU attributes."""
    return Warehouse(st.rest_raw(spark, sf), st.bulk_raw(spark, sf), shop_raw=None, line_ties=LINE_TIES)


def full_warehouse(spark: SparkSession, sf: str) -> Warehouse:
    """With headers and lines stored: the fact, the SKU names and the rates all read them, and seven columns of a header."""
    found = Warehouse(st.rest_raw(spark, sf), st.bulk_raw(spark, sf), st.shop_raw(spark, sf), st.expired_list(spark, sf),
                      st.packaging(spark, sf), line_ties=LINE_TIES)
    path = scratch_path(spark, "entities")
    found.invoices = materialise(found.invoices.select(*HEADER_COLUMNS), f"{path}/invoices")
    found.invoice_lines = materialise(found.invoice_lines, f"{path}/invoice_lines")
    return found


def monthly_revenue_from_pages(spark: SparkSession, sf: str, year: int = st.TREND_YEAR) -> DataFrame:
    """Headers are flattened once and stored: the rates of the lines and the fact read them."""
    warehouse = erp_warehouse(spark, sf)
    warehouse.invoices = materialise(warehouse.invoices.select(*HEADER_COLUMNS), scratch_path(spark, "headers"))
    sources = warehouse.sources
    model = SemanticModel({"sales": lambda columns: sales_detail(sources, columns)})
    return verified.monthly_trend(model, year)


NEWEST = f"""versions AS (
  SELECT {LINE_FIELDS}, l_linestatus FROM lineitem),
newest AS (
  SELECT * FROM versions QUALIFY row_number() OVER (
    PARTITION BY invoice_number, line_number
    ORDER BY l_linestatus DESC, {', '.join(f'{c} DESC NULLS LAST' for c in LINE_TIES)}) = 1)"""


@query("entry_monthly_revenue_from_pages", f"""
WITH {NEWEST},
sold AS (
  SELECT CAST(o_orderdate AS DATE) AS day, invoice_number,
         round(line_net_amount * (coalesce({rate('o_orderkey')}, 100.0) / 100), 2) AS revenue
  FROM newest JOIN orders ON invoice_number = o_orderkey WHERE o_totalprice >= 2000)
SELECT CAST(CAST(date_trunc('month', day) AS DATE) AS VARCHAR) AS month, round(sum(revenue), 2) AS revenue,
       CAST(count(DISTINCT invoice_number) AS BIGINT) AS orders,
       round(sum(revenue) / nullif(count(DISTINCT invoice_number), 0), 6) AS aov
FROM sold WHERE year(day) = {st.TREND_YEAR} GROUP BY 1""", aov=6)
def entry_query(spark, sf):
    return monthly_revenue_from_pages(spark, sf)


@query("views_sql_on_lines", f"""
WITH {NEWEST}
SELECT {currency('o_orderkey')} AS invoice_currency, newest.sku, CAST(count(*) AS BIGINT) AS line_count,
       round(sum(quantity), 2) AS units, max(p_type) AS product_group_name
FROM newest JOIN orders ON invoice_number = o_orderkey LEFT JOIN part ON newest.sku = 'SKU' || p_partkey GROUP BY 1, 2""")
def views_sql(spark, sf):
    """SQL text on registered views."""
    register_views(spark, erp_warehouse(spark, sf), "ledgerlake_", "invoice_lines", "products")
    return spark.sql("""
        SELECT l.invoice_currency, l.sku, count(*) AS line_count, sum(l.quantity) AS units,
               max(p.product_group_name) AS product_group_name
        FROM ledgerlake_invoice_lines l LEFT JOIN ledgerlake_products p ON l.sku = p.sku
        GROUP BY l.invoice_currency, l.sku""")
