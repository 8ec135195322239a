"""Typed entities from RAW pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.money import to_base_currency
from ledgerlake.operators.dedup import latest_per_key, newest_first
from ledgerlake.operators.variants import Fields, flatten, flatten_nested
from ledgerlake.plans import fields as f

POSITION = ("page_number", "position")


def _entity(
    raw: DataFrame, endpoint: str, array_path: str, fields: Fields, keys: Sequence[str], ties: Sequence[str],
    exact_money: bool = False, lenient: bool = False,
) -> DataFrame:
    layout = f.exact_money(fields) if exact_money else fields
    rows = flatten(raw, endpoint, array_path, layout, lenient=lenient)
    return latest_per_key(rows, keys, newest_first("api_timestamp", *ties)).drop(*POSITION)


def customers(raw: DataFrame, exact_money: bool = False, ties: Sequence[str] = POSITION) -> DataFrame:
    """Newest version per customer; within one load the last record wins."""
    return _entity(raw, "customers", "$.collection", f.CUSTOMER, ["customer_number"], ties, exact_money)


def products(raw: DataFrame, exact_money: bool = False, ties: Sequence[str] = POSITION) -> DataFrame:
    return _entity(raw, "products", "$.collection", f.PRODUCT, ["sku"], ties, exact_money)


def invoices(raw: DataFrame, ties: Sequence[str] = POSITION) -> DataFrame:
    return _entity(raw, "invoices/booked", "$.collection", f.INVOICE, ["invoice_number"], ties)


def invoice_lines(
    bulk_raw: DataFrame, rest_raw: DataFrame, ties: Sequence[str] = POSITION, headers: DataFrame | None = None,
) -> DataFrame:
    """Newest version per line with amounts in base currency.

    Every version meets its rate first. Rows partitioned by invoice are also partitioned by (invoice, line), so the newest
    version is picked where the join left them, and a later join with headers by invoice finds them in place: lines are
    shuffled once. An invoice that holds a large share of the lines is split by the adaptive join and shuffled a second time, by
    (invoice, line). The versions of one line meet in one task, which sorts them with spilling and keeps one row.

    ``headers`` takes already built invoices (for instance the materialised entity) instead of flattening the invoice
    pages a second time.
    """
    versions = flatten(bulk_raw, "invoices/booked/lines", "$.items", f.INVOICE_LINE)
    rates = (invoices(rest_raw) if headers is None else headers) \
        .select("invoice_number", "invoice_currency", "exchange_rate")
    rated = versions.join(rates, "invoice_number", "left")
    return in_base_currency(latest_per_key(rated, ["invoice_number", "line_number"], newest_first("api_timestamp", *ties)))


def in_base_currency(lines: DataFrame) -> DataFrame:
    """Lines that carry their invoice's currency and rate, with the three amounts converted."""
    rate = F.col("exchange_rate")
    return lines.select(
        "api_timestamp", "invoice_number", "line_number", "line_number_ui", "sku", "line_description", "quantity",
        "invoice_currency", "exchange_rate", "unit_net_price", "unit_cost_price", "line_net_amount",
        to_base_currency(F.col("unit_net_price"), rate).alias("unit_net_price_base_currency"),
        to_base_currency(F.col("unit_cost_price"), rate).alias("unit_cost_price_base_currency"),
        to_base_currency(F.col("line_net_amount"), rate).alias("line_net_amount_base_currency"),
        "discount_percentage", "vat_rate", "vat_amount",
    )


def ingestion_metadata(*raw_tables: DataFrame) -> DataFrame:
    """Load coverage per endpoint over all RAW tables; sort by last_ingestion where it is shown."""
    columns = ["api_endpoint", "date_inserted", "page_number", "record_count_per_page"]
    pages = reduce(DataFrame.unionByName, [t.select(*columns) for t in raw_tables])
    return pages.groupBy("api_endpoint").agg(
        F.min("date_inserted").alias("first_ingestion"), F.max("date_inserted").alias("last_ingestion"),
        F.count(F.lit(1)).alias("page_count"), F.sum("record_count_per_page").alias("total_records"),
        F.max("page_number").alias("max_page_number"),
    )


def _with_expired(active: DataFrame, expired: DataFrame | None) -> DataFrame:
    active = active.drop(*POSITION)
    if expired is None:
        return active
    typed = expired.select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in active.schema])
    return active.unionByName(typed)


def shop_products(shop_raw: DataFrame, expired: DataFrame | None = None) -> DataFrame:
    """Shop products and the expired ones; every load's version stays."""
    return _with_expired(flatten(shop_raw, "products", "$.products", f.SHOP_PRODUCT), expired)


def shop_categories(shop_raw: DataFrame, expired: DataFrame | None = None) -> DataFrame:
    return _with_expired(flatten(shop_raw, "categories", "$.categories", f.SHOP_CATEGORY), expired)


def shop_combinations(shop_raw: DataFrame, expired: DataFrame | None = None) -> DataFrame:
    return _with_expired(flatten(shop_raw, "combinations", "$.combinations", f.SHOP_COMBINATION), expired)


def shop_combination_options(shop_raw: DataFrame, expired: DataFrame | None = None) -> DataFrame:
    """Combination-to-option links; combinations without options stay with a NULL option."""
    links = flatten_nested(shop_raw, "combinations", "$.combinations", f.SHOP_COMBINATION_ID,
                           f.SHOP_OPTION_PATH, f.SHOP_OPTION_REF)
    return _with_expired(links, expired)


def shop_option_values(shop_raw: DataFrame, expired: DataFrame | None = None) -> DataFrame:
    return _with_expired(
        flatten(shop_raw, "product_option_values", "$.product_option_values", f.SHOP_OPTION_VALUE), expired)
