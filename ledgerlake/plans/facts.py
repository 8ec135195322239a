"""Line-level sales fact and the packaging detail built on it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import lookups as lk
from ledgerlake.functions.dates import truncate
from ledgerlake.functions.lookups import country_lookup
from ledgerlake.functions.text import core_name
from ledgerlake.plans.dims import UNCATEGORISED, UNKNOWN_PRODUCT, customer_segment


@dataclass(frozen=True)
class SalesSources:
    """Inputs of the sales fact. Each lookup side has one row per key."""

    lines: DataFrame
    invoices: DataFrame
    customers: DataFrame
    products: DataFrame
    sku_dim: DataFrame


class DeferredSources:
    """Sales fact inputs built at their first use: a lookup nobody asks for is not even planned."""

    def __init__(self, **builders: Callable[[], DataFrame]):
        self._builders = builders

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.__dict__.get("_builders", {}):
            raise AttributeError(name)
        frame = self._builders[name]()
        setattr(self, name, frame)
        return frame


def category_of(sku: Column, category: Column) -> Column:
    return (F.when(sku == lk.WHOLESALE_SKU, "B2B Wholesale").when(sku.isin(lk.ADJUSTMENT_SKUS), "Adjustments")
            .otherwise(F.coalesce(category, F.lit(UNCATEGORISED))))


def match_status(sku: Column, found: Column) -> Column:
    return (F.when(sku == lk.WHOLESALE_SKU, "B2B Wholesale").when(sku.isin(lk.ADJUSTMENT_SKUS), "Adjustment Item")
            .when(found, "Matched").otherwise("Not in PrestaShop"))


def product_revenue(sku: Column, revenue: Column) -> Column:
    """Revenue of goods: nothing for discounts and freight, nothing for negative lines."""
    excluded = sku.isin(lk.ZERO_REVENUE_SKUS) | sku.startswith(lk.FREIGHT_PREFIX)
    return F.when(excluded | (revenue < 0), 0.0).otherwise(revenue)


def _found(column: str, default: str) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def _unit_cost() -> Column:
    return F.coalesce(F.col("unit_cost_price_base_currency"), F.lit(0.0))


def _line_cost() -> Column:
    return _unit_cost() * F.col("quantity")


REVENUE = "line_net_amount_base_currency"
#: All that the fact, and the rates of lines, read of an invoice.
HEADER_COLUMNS = ("invoice_number", "invoice_date", "customer_number", "invoice_currency", "exchange_rate",
                  "delivery_country", "recipient_country")

# Output column -> (lookup it needs, expression). Line and invoice columns are always there.
_COLUMNS: dict[str, tuple[str | None, Callable[[], Column]]] = {
    "invoice_id": (None, lambda: F.col("invoice_number")),
    "line_id": (None, lambda: F.col("line_number")),
    "sale_date": (None, lambda: F.col("invoice_date")),
    "customer_id": (None, lambda: F.col("customer_number")),
    "customer_name": ("customer", lambda: _found("c_name", "Unknown")),
    "customer_city": ("customer", lambda: _found("c_city", "Unknown")),
    "customer_country": ("customer", lambda: _found("c_country", "Unknown")),
    "customer_segment": ("customer", lambda: customer_segment(F.col("c_group"))),
    "product_sku": (None, lambda: F.col("sku")),
    "product_name": ("sku", lambda: _found("s_name", UNKNOWN_PRODUCT)),
    "core_product_economic": (
        "product", lambda: core_name(F.col("p_name"), F.col("line_description"), F.lit(UNKNOWN_PRODUCT))),
    "product_category_economic": ("product", lambda: _found("p_group", "Other")),
    "category": ("sku", lambda: category_of(F.col("sku"), F.col("s_category"))),
    "parent_category_id": ("sku", lambda: F.col("s_parent_category")),
    "category_level": ("sku", lambda: F.col("s_level")),
    "size": ("sku", lambda: F.col("s_size")),
    "color": ("sku", lambda: F.col("s_color")),
    "ean13": ("sku", lambda: F.col("s_ean13")),
    "prestashop_stock_qty": ("sku", lambda: F.col("s_stock")),
    "prestashop_match_status": ("sku", lambda: match_status(F.col("sku"), F.col("s_found").isNotNull())),
    "delivery_country": (
        "country", lambda: F.coalesce("standard_country", "h_country", F.lit("Unknown"))),
    "market": ("country", lambda: _found("spelling_market", lk.OTHER_MARKET)),
    "invoice_currency": (None, lambda: F.col("invoice_currency")),
    "exchange_rate": (None, lambda: F.col("exchange_rate")),
    "quantity_sold": (None, lambda: F.col("quantity")),
    "unit_price_dkk": (None, lambda: F.col("unit_net_price_base_currency")),
    "line_revenue_dkk": (None, lambda: F.col(REVENUE)),
    "product_revenue_dkk": (None, lambda: product_revenue(F.col("sku"), F.col(REVENUE))),
    "unit_cost_dkk": (None, _unit_cost),
    "line_cost_dkk": (None, _line_cost),
    "line_profit_dkk": (None, lambda: F.col(REVENUE) - _line_cost()),
    "data_last_refreshed": (None, lambda: F.col("api_timestamp")),
    # Beyond the 32 columns of the view, on request only.
    "market_standardized": ("country", lambda: _found("standard_market", lk.OTHER_MARKET)),
    "has_prestashop_data": ("sku", lambda: F.coalesce(F.col("s_has_shop"), F.lit(False))),
}
EXTRA_COLUMNS = ("market_standardized", "has_prestashop_data")


def sales_columns() -> list[str]:
    """The columns of the sales view, in order."""
    return [c for c in _COLUMNS if c not in EXTRA_COLUMNS]


def _catalogue(sources: SalesSources | DeferredSources, needed: set[str | None]) -> DataFrame | None:
    """ERP product and SKU dimension as one lookup by SKU.

    The two small sides meet first, so the lines are shuffled by SKU once at most, and a SKU with a large share of the
    lines (freight, say) sits in a single join that adaptive execution can split.
    """
    sides = []
    if "product" in needed:
        sides.append(sources.products.select(
            "sku", F.col("product_name").alias("p_name"), F.col("product_group_name").alias("p_group")))
    if "sku" in needed:
        sides.append(sources.sku_dim.select(
            "sku", F.col("product_name").alias("s_name"), F.col("category_name").alias("s_category"),
            F.col("parent_category_id").alias("s_parent_category"), F.col("category_level").alias("s_level"),
            F.col("size").alias("s_size"), F.col("color").alias("s_color"), F.col("ean13").alias("s_ean13"),
            F.col("stock_quantity").alias("s_stock"), F.col("has_prestashop_data").alias("s_has_shop"),
            F.lit(True).alias("s_found")))
    return reduce(lambda left, right: left.join(right, "sku", "full_outer"), sides) if sides else None


def sales_detail(sources: SalesSources | DeferredSources, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per line whose invoice has a date.

    Every lookup side is unique, so a lookup changes no row count and is joined only when ``columns`` needs it:
    a revenue total joins lines to invoices and nothing else.
    """
    wanted = list(columns) if columns is not None else sales_columns()
    needed = {_COLUMNS[c][0] for c in wanted}

    # A NULL date drops the line whether or not there is a header, so the outer join is an inner one.
    headers = sources.invoices.filter(F.col("invoice_date").isNotNull()).select(*HEADER_COLUMNS)
    # Customers meet the headers before the lines do: lines are not shuffled by customer. What goes along is kept short for the shuffle
    # by SKU: the country as written and the customer's group, of which markets, names and segments are made after it.
    of_header = ["invoice_number", "invoice_date", "customer_number", "invoice_currency", "exchange_rate"]
    if "country" in needed:
        headers = headers.withColumn("h_country", F.coalesce("delivery_country", "recipient_country"))
        of_header.append("h_country")
    if "customer" in needed:
        headers = headers.join(sources.customers.select(
            "customer_number", F.col("customer_name").alias("c_name"), F.col("city").alias("c_city"),
            F.col("country").alias("c_country"), F.col("customer_group_number").alias("c_group"),
        ), "customer_number", "left")
        of_header += ["c_name", "c_city", "c_country", "c_group"]
    rows = sources.lines.drop("invoice_currency", "exchange_rate").join(headers.select(*of_header), "invoice_number")
    catalogue = _catalogue(sources, needed)
    if catalogue is not None:
        rows = rows.join(catalogue, "sku", "left")
    if "country" in needed:
        table = country_lookup(rows.sparkSession)
        rows = rows.join(table, rows["h_country"] == table["spelling"], "left")
    return rows.select(*[_COLUMNS[c][1]().alias(c) for c in wanted])


EPR_SALES_COLUMNS = (
    "sale_date", "customer_name", "customer_segment", "customer_country", "delivery_country", "product_sku",
    "product_name", "category", "size", "color", "quantity_sold", "line_revenue_dkk",
)


def epr_detail(sales: DataFrame, packaging: DataFrame) -> DataFrame:
    """Sold physical units with packaging weights; a NULL SKU is not a physical product."""
    physical = sales.filter(
        F.col("sale_date").isNotNull() & (F.col("quantity_sold") > 0)
        & ~F.col("product_sku").isin(*lk.ADJUSTMENT_SKUS, lk.WHOLESALE_SKU))
    weights = packaging.select(
        F.col("sku").alias("product_sku"), F.col("product_description").alias("k_name"),
        F.col("category_name").alias("k_category"), F.col("size").alias("k_size"), F.col("color").alias("k_color"),
        "carton_kg_per_unit", "plastic_kg_per_unit", "foam_kg_per_unit",
        F.col("prestashop_match_status").alias("packaging_match_status"))
    return physical.join(weights, "product_sku", "left").select(
        "sale_date", "customer_name", "customer_segment",
        F.coalesce("delivery_country", "customer_country", F.lit("Unknown")).alias("country"),
        F.col("product_sku").alias("sku"), F.coalesce("k_name", "product_name").alias("product_name"),
        F.coalesce("k_category", "category").alias("category"), F.coalesce("k_size", "size").alias("size"),
        F.coalesce("k_color", "color").alias("color"), "quantity_sold",
        "carton_kg_per_unit", "plastic_kg_per_unit", "foam_kg_per_unit", "line_revenue_dkk", "packaging_match_status",
    )


def epr_summary(detail: DataFrame, grain: str = "month") -> DataFrame:
    """Packaging kilograms by country and period; a missing weight counts as 0."""
    units = F.col("quantity_sold")

    def kilograms(material: str) -> Column:
        return F.sum(units * F.coalesce(F.col(f"{material}_kg_per_unit").cast("double"), F.lit(0.0)))

    totals = detail.groupBy("country", truncate(F.col("sale_date"), grain).alias("period")).agg(
        F.sum(units).alias("units"), kilograms("carton").alias("carton_kg"),
        kilograms("plastic").alias("plastic_kg"), kilograms("foam").alias("foam_kg"))
    return totals.withColumn("total_kg", F.col("carton_kg") + F.col("plastic_kg") + F.col("foam_kg"))
