"""The verified business questions, as calls on the semantic model or plain aggregations where it has no name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import dates
from ledgerlake.functions.money import percent_change
from ledgerlake.operators.aggregates import sum_if
from ledgerlake.plans.semantic import SemanticModel

Day = dt.date | str | None


def last_week_revenue(model: SemanticModel, as_of: Day = None) -> DataFrame:
    return model.query(metrics=["total_revenue", "total_orders"], filters=["last_week"], as_of=as_of).select(
        F.col("total_revenue").alias("total_revenue_dkk"), F.col("total_orders").alias("orders"))


def last_month_by_category(model: SemanticModel, as_of: Day = None) -> DataFrame:
    result = model.query(dims=["category"], metrics=["total_revenue", "total_units", "total_orders"],
                         filters=["last_month", "matched_products"], as_of=as_of,
                         order_by=[("total_revenue", "desc")])
    return result.toDF("category", "revenue", "units", "orders")


def segments_last_quarter(model: SemanticModel, as_of: Day = None) -> DataFrame:
    result = model.query(dims=["customer_segment"],
                         metrics=["total_customers", "total_revenue", "total_orders", "average_order_value"],
                         filters=["last_quarter"], as_of=as_of, order_by=[("total_revenue", "desc")])
    return result.toDF("customer_segment", "customers", "revenue", "orders", "aov")


def top_products_this_month(model: SemanticModel, as_of: Day = None, k: int = 10) -> DataFrame:
    """From the first of the month, no upper bound."""
    start, _ = dates.month_of(dates.as_of_date(as_of))
    keys = ["product_sku", "product_name", "category", "size", "color"]
    result = model.query(dims=keys, metrics=["total_units", "total_revenue"], filters=["matched_products"],
                         period=(start, None), as_of=as_of,
                         order_by=[("total_revenue", "desc"), ("product_sku", "asc")], limit=k)
    return result.toDF(*keys, "units", "revenue")


def monthly_trend(model: SemanticModel, year: int) -> DataFrame:
    first = F.lit(f"{year}-01-01").cast("date")
    result = model.query(dims=[("sale_date", "month")], metrics=["total_revenue", "total_orders", "average_order_value"],
                         period=dates.year_of(first), order_by=[("sale_date_month", "asc")])
    return result.toDF("month", "revenue", "orders", "aov")


def countries_last_month(model: SemanticModel, as_of: Day = None) -> DataFrame:
    result = model.query(dims=["delivery_country"], metrics=["total_revenue", "total_orders"], filters=["last_month"],
                         as_of=as_of, order_by=[("total_revenue", "desc")])
    return result.toDF("delivery_country", "revenue", "orders")


def size_colour_this_year(model: SemanticModel, as_of: Day = None, k: int = 20) -> DataFrame:
    result = model.query(dims=["size", "color"], metrics=["total_units", "total_revenue"],
                         filters=["current_year", "matched_products"], as_of=as_of,
                         order_by=[("total_revenue", "desc"), ("size", "asc"), ("color", "asc")], limit=k)
    return result.toDF("size", "color", "units", "revenue")


def week_over_week(sales: DataFrame, as_of: Day = None) -> DataFrame:
    day, today = F.col("sale_date"), dates.as_of_date(as_of)
    recent = sales.filter(dates.within(day, dates.last_days(today, 14)))
    period = F.when(dates.within(day, dates.last_days(today, 7)), "This Week").otherwise("Last Week")
    return recent.groupBy(period.alias("period")).agg(
        F.sum("line_revenue_dkk").alias("revenue"), F.countDistinct("invoice_id").alias("orders"),
        F.sum("quantity_sold").alias("units")).orderBy(F.desc("period"))


def top_customers_last_quarter(model: SemanticModel, as_of: Day = None, k: int = 10) -> DataFrame:
    keys = ["customer_name", "customer_segment", "delivery_country"]
    result = model.query(dims=keys, metrics=["total_revenue", "total_orders"], filters=["last_quarter"], as_of=as_of,
                         order_by=[("total_revenue", "desc"), ("customer_name", "asc"), ("delivery_country", "asc")],
                         limit=k)
    return result.toDF(*keys, "revenue", "orders")


def categories_by_segment(model: SemanticModel, as_of: Day = None) -> DataFrame:
    keys = ["customer_segment", "category"]
    result = model.query(dims=keys, metrics=["total_units", "total_revenue"],
                         filters=["current_year", "matched_products"], as_of=as_of,
                         order_by=[("customer_segment", "asc"), ("total_revenue", "desc")])
    return result.toDF(*keys, "units", "revenue")


def category_growth(sales: DataFrame, as_of: Day = None) -> DataFrame:
    """Whole current year against whole last year; one range covers both, so the scan reads two years only."""
    day, today, revenue = F.col("sale_date"), dates.as_of_date(as_of), F.col("line_revenue_dkk")
    this_year, last_year = dates.year_of(today), dates.year_of(today, -1)
    both = dates.within(day, (last_year[0], this_year[1]))
    totals = sales.filter(both & (F.col("prestashop_match_status") == "Matched")).groupBy("category").agg(
        sum_if(dates.within(day, this_year), revenue).alias("current_year_revenue"),
        sum_if(dates.within(day, last_year), revenue).alias("last_year_revenue"))
    change = percent_change(F.col("current_year_revenue"), F.col("last_year_revenue"))
    return totals.withColumn("growth_pct", change).orderBy(F.desc_nulls_last("current_year_revenue"))
