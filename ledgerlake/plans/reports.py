"""Weekly figures, alerts and audits."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import dates
from ledgerlake.functions.money import guarded_ratio, percent_change
from ledgerlake.operators.aggregates import row_count, share_of_total, sum_if
from ledgerlake.operators.joins import unmatched

Day = dt.date | str | None

WEEKLY_COLUMNS = ("sale_date", "invoice_id", "category", "customer_segment", "prestashop_match_status",
                  "line_revenue_dkk")


def weekly_kpis(sales: DataFrame, as_of: Day = None) -> DataFrame:
    """One row. Revenue and orders end before the reporting day; top category and segments have no upper bound.

    One pass over the lines: a rollup gives the figures of every category and of all, and the few category rows then compete.
    """
    day, today, revenue = F.col("sale_date"), dates.as_of_date(as_of), F.col("line_revenue_dkk")
    week = sales.filter(dates.within(day, dates.last_days(today, 7)))
    closed, segment, known = day < today, F.col("customer_segment"), F.col("prestashop_match_status") == "Matched"
    figures = week.rollup("category").agg(
        F.grouping("category").alias("_all"),
        F.count(F.when(known, True)).alias("_lines"), F.sum(F.when(known, revenue)).alias("_matched"),
        F.sum(F.when(closed, revenue)).alias("revenue"),
        F.countDistinct(F.when(closed, F.col("invoice_id"))).alias("orders"),
        sum_if(segment == "B2B", revenue).alias("b2b_revenue"), sum_if(segment == "B2C", revenue).alias("b2c_revenue"),
    )
    total, rival = F.col("_all") == 1, (F.col("_all") == 0) & (F.col("_lines") > 0)
    # The least by: known revenue first, higher revenue, known category first, category.
    place = F.struct(F.col("_matched").isNull().alias("no_revenue"), (-F.col("_matched")).alias("less"),
                     F.col("category").isNull().alias("no_category"), F.col("category").alias("category"),
                     F.col("_matched").alias("revenue"))
    top = figures.agg(
        *[F.max(F.when(total, F.col(c))).alias(c) for c in ("revenue", "b2b_revenue", "b2c_revenue")],
        F.coalesce(F.max(F.when(total, F.col("orders"))), F.lit(0).cast("bigint")).alias("orders"),
        F.min(F.when(rival, place)).alias("_top"))
    return top.select(
        "revenue", "orders", guarded_ratio(F.col("revenue"), F.col("orders").cast("double")).alias("aov"),
        F.col("_top.category").alias("top_category"), F.col("_top.revenue").alias("top_category_revenue"),
        "b2b_revenue", "b2c_revenue")


def sales_alert(sales: DataFrame, threshold: float, as_of: Day = None) -> DataFrame:
    """One row: the last 7 days against the threshold and the 7 days before. No revenue at all gives no alert."""
    day, today, revenue = F.col("sale_date"), dates.as_of_date(as_of), F.col("line_revenue_dkk")
    this_week = dates.within(day, dates.last_days(today, 7))
    figures = sales.filter(dates.within(day, dates.last_days(today, 14))).agg(
        F.sum(F.when(this_week, revenue)).alias("this_week_revenue"),
        F.sum(F.when(~this_week, revenue)).alias("last_week_revenue"),
        F.countDistinct(F.when(this_week, F.col("invoice_id"))).alias("this_week_orders"))
    limit, current, before = F.lit(float(threshold)), F.col("this_week_revenue"), F.col("last_week_revenue")
    return figures.select(
        "this_week_revenue", "last_week_revenue", "this_week_orders", limit.alias("threshold"),
        (limit - current).alias("shortfall"), (-percent_change(current, before)).alias("decline_pct"),
        F.coalesce(current < limit, F.lit(False)).alias("is_alert"))


def market_overview(sales: DataFrame, first_day: Day) -> DataFrame:
    """Orders, revenue and mean line margin by market and category."""
    margin = guarded_ratio(F.col("line_profit_dkk"), F.col("line_revenue_dkk")) * 100
    return sales.filter(F.col("sale_date") >= dates.as_of_date(first_day)).groupBy("market", "category").agg(
        F.countDistinct("invoice_id").alias("orders"), F.sum("line_revenue_dkk").alias("revenue"),
        F.avg(margin).alias("avg_margin")).orderBy(F.desc_nulls_last("revenue"))


def match_status_audit(sales: DataFrame) -> DataFrame:
    return share_of_total(sales, ["prestashop_match_status"], {
        "line_count": (row_count(), "pct_of_lines"),
        "revenue_dkk": (F.sum("line_revenue_dkk"), "pct_of_revenue"),
    })


def _goods(sales: DataFrame) -> DataFrame:
    return sales.filter((F.col("prestashop_match_status") == "Matched") & (F.col("product_revenue_dkk") > 0))


def category_margins(sales: DataFrame) -> DataFrame:
    margin = guarded_ratio(F.sum("line_profit_dkk"), F.sum("line_revenue_dkk")) * 100
    return _goods(sales).groupBy("category").agg(
        F.countDistinct("product_sku").alias("sku_count"), F.sum("quantity_sold").alias("units_sold"),
        F.sum("line_revenue_dkk").alias("revenue_dkk"), F.sum("line_profit_dkk").alias("profit_dkk"),
        F.round(margin, 2).alias("margin_pct")).orderBy(F.desc_nulls_last("revenue_dkk"))


def size_colour_table(sales: DataFrame, k: int = 20) -> DataFrame:
    return _goods(sales).groupBy("size", "color").agg(
        row_count().alias("line_count"), F.sum("quantity_sold").alias("units_sold"),
        F.sum("line_revenue_dkk").alias("revenue_dkk"),
    ).orderBy(F.desc_nulls_last("revenue_dkk"), F.asc_nulls_last("size"), F.asc_nulls_last("color")).limit(k)


def sku_match_rate(sku_dim: DataFrame) -> DataFrame:
    return share_of_total(sku_dim, ["has_prestashop_data", "is_economic_only"], {
        "sku_count": (row_count(), "percentage")})


def invoice_reconciliation(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines and base-currency total per invoice header; lines are summed before they meet the headers."""
    totals = lines.groupBy("invoice_number").agg(
        row_count().alias("line_count"), F.sum("line_net_amount_base_currency").alias("total_amount"))
    headers = invoices.select("invoice_number", "invoice_date", "customer_number", "delivery_country")
    return headers.join(totals, "invoice_number")


def lines_without_date(lines: DataFrame, invoices: DataFrame) -> DataFrame:
    """Number of lines whose invoice is missing or undated."""
    dated = invoices.filter(F.col("invoice_date").isNotNull())
    return unmatched(lines, dated, ["invoice_number"]).agg(row_count().alias("lines_without_date"))


def raw_coverage(**tables: DataFrame) -> DataFrame:
    """One row per RAW table."""
    def one(name: str, pages: DataFrame) -> DataFrame:
        return pages.agg(
            F.lit(name).alias("table_name"), row_count().alias("row_count"),
            F.countDistinct("api_endpoint").alias("unique_endpoints"),
            F.min("date_inserted").alias("first_load"), F.max("date_inserted").alias("last_load"))
    return reduce(DataFrame.unionByName, [one(name, pages) for name, pages in tables.items()])


def endpoint_coverage(pages: DataFrame) -> DataFrame:
    return pages.groupBy("api_endpoint").agg(
        F.sum("record_count_per_page").alias("total_records"), row_count().alias("page_count"),
        (F.max("page_number") + 1).alias("pages_loaded"), F.max("date_inserted").alias("last_load"))


def packaging_uploads(packaging: DataFrame) -> DataFrame:
    return packaging.groupBy("date_uploaded", "source_file").agg(
        row_count().alias("row_count"), F.countDistinct("sku").alias("unique_skus"))


def packaging_match_quality(detail: DataFrame, as_of: Day = None) -> DataFrame:
    """Lines and SKUs per packaging match status over the last year."""
    start = F.add_months(dates.as_of_date(as_of), -12)
    return detail.filter(F.col("sale_date") >= start).groupBy("packaging_match_status").agg(
        row_count().alias("lines"), F.countDistinct("sku").alias("unique_skus"))


def endpoint_counts(config: DataFrame) -> DataFrame:
    return config.groupBy("base", "active").agg(row_count().alias("endpoint_count"))


def sku_uniqueness(sku_dim: DataFrame) -> DataFrame:
    return sku_dim.agg(row_count().alias("total_skus"), F.countDistinct("sku").alias("unique_skus"))


def skus_per(sku_dim: DataFrame, *keys: str) -> DataFrame:
    return sku_dim.groupBy(*keys).agg(row_count().alias("sku_count"))


def id_range(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest id, and whether all are negative."""
    return df.agg(F.min(column).alias("min_id"), F.max(column).alias("max_id"),
                  (F.max(column) < 0).alias("all_negative"))


def view_counts(**views: DataFrame) -> DataFrame:
    counts = [v.agg(F.lit(name).alias("view_name"), row_count().alias("row_count")) for name, v in views.items()]
    return reduce(DataFrame.unionByName, counts)
