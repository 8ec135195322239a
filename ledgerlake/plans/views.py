"""The whole chain under its SQL names, for users who query views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans import bronze, dims, facts
from ledgerlake.plans.expired import ExpiredCatalogue, expired_catalogue
from ledgerlake.plans.facts import DeferredSources


@dataclass
class Warehouse:
    """Entities, dimensions and facts over the inputs, each built at its first use.

    Assign a stored entity (``warehouse.invoices = store.materialise(warehouse.invoices, path)``) and everything built
    on it afterwards reads the table instead of parsing pages.
    """

    rest_raw: DataFrame
    bulk_raw: DataFrame
    shop_raw: DataFrame
    expired_list: DataFrame | None = None
    packaging: DataFrame | None = None
    line_ties: tuple[str, ...] = bronze.POSITION

    @cached_property
    def customers(self) -> DataFrame:
        return bronze.customers(self.rest_raw)

    @cached_property
    def products(self) -> DataFrame:
        return bronze.products(self.rest_raw)

    @cached_property
    def invoices(self) -> DataFrame:
        return bronze.invoices(self.rest_raw)

    @cached_property
    def invoice_lines(self) -> DataFrame:
        return bronze.invoice_lines(self.bulk_raw, self.rest_raw, ties=self.line_ties, headers=self.invoices)

    @cached_property
    def ingestion_metadata(self) -> DataFrame:
        return bronze.ingestion_metadata(self.rest_raw, self.bulk_raw, self.shop_raw)

    @cached_property
    def expired(self) -> ExpiredCatalogue | None:
        return None if self.expired_list is None else expired_catalogue(self.expired_list)

    @cached_property
    def shop(self) -> dims.ShopCatalogue:
        return dims.shop_catalogue(self.shop_raw, self.expired)

    @cached_property
    def dim_product_sku(self) -> DataFrame:
        return dims.dim_product_sku(self.shop)

    @cached_property
    def dim_product_sku_enriched(self) -> DataFrame:
        return dims.dim_product_sku_enriched(self.invoice_lines, self.dim_product_sku)

    @cached_property
    def vw_customer_master(self) -> DataFrame:
        return dims.customer_master(self.customers)

    @cached_property
    def vw_product_master(self) -> DataFrame:
        return dims.product_master(self.dim_product_sku_enriched)

    @cached_property
    def sources(self) -> DeferredSources:
        return DeferredSources(
            lines=lambda: self.invoice_lines, invoices=lambda: self.invoices, customers=lambda: self.customers,
            products=lambda: self.products, sku_dim=lambda: self.dim_product_sku_enriched)

    @cached_property
    def vw_sales_detail(self) -> DataFrame:
        return facts.sales_detail(self.sources)

    @cached_property
    def dim_sku_packaging(self) -> DataFrame:
        return dims.dim_sku_packaging(self.packaging, self.vw_product_master)

    @cached_property
    def vw_epr_detail(self) -> DataFrame:
        return facts.epr_detail(facts.sales_detail(self.sources, facts.EPR_SALES_COLUMNS), self.dim_sku_packaging)


# Names of the views users query.
VIEWS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "customers": lambda w: w.customers,
    "products": lambda w: w.products,
    "invoices": lambda w: w.invoices,
    "invoice_lines": lambda w: w.invoice_lines,
    "ingestion_metadata": lambda w: w.ingestion_metadata,
    "presta_products": lambda w: w.shop.products,
    "presta_categories": lambda w: w.shop.categories,
    "presta_combinations": lambda w: w.shop.combinations,
    "presta_combination_options": lambda w: w.shop.combination_options,
    "presta_option_values": lambda w: w.shop.option_values,
    "presta_products_expired": lambda w: w.expired.products,
    "presta_categories_expired": lambda w: w.expired.categories,
    "presta_combinations_expired": lambda w: w.expired.combinations,
    "presta_combination_options_expired": lambda w: w.expired.combination_options,
    "presta_option_values_expired": lambda w: w.expired.option_values,
    "dim_product_sku": lambda w: w.dim_product_sku,
    "dim_product_sku_enriched": lambda w: w.dim_product_sku_enriched,
    "dim_sku_packaging": lambda w: w.dim_sku_packaging,
    "vw_sales_detail": lambda w: w.vw_sales_detail,
    "vw_customer_master": lambda w: w.vw_customer_master,
    "vw_product_master": lambda w: w.vw_product_master,
    "vw_epr_detail": lambda w: w.vw_epr_detail,
}


def register_views(spark: SparkSession, warehouse: Warehouse, prefix: str = "", *names: str) -> list[str]:
    """Create temporary views, all that the inputs allow or just ``names``; returns what was created."""
    created = []
    for name in names or VIEWS:
        if (warehouse.expired_list is None and name.endswith("_expired")) or (
                warehouse.packaging is None and name in ("dim_sku_packaging", "vw_epr_detail")):
            continue
        VIEWS[name](warehouse).createOrReplaceTempView(prefix + name)
        created.append(prefix + name)
    return created
