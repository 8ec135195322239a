"""SKU dimension, its completion from invoice lines, packaging dimension, master views."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import lookups as lk
from ledgerlake.operators.aggregates import joined_in_pieces, mode_per_key
from ledgerlake.operators.dedup import latest_per_key, newest_first
from ledgerlake.operators.joins import lookup_where
from ledgerlake.plans import bronze
from ledgerlake.plans.expired import ExpiredCatalogue

UNKNOWN_PRODUCT, UNCATEGORISED = "Unknown Product", "Uncategorized"


@dataclass
class ShopCatalogue:
    """The five shop entities, active and expired together; each is planned when asked for."""

    shop_raw: DataFrame
    expired: ExpiredCatalogue | None = None

    @cached_property
    def products(self) -> DataFrame:
        return bronze.shop_products(self.shop_raw, self.expired and self.expired.products)

    @cached_property
    def categories(self) -> DataFrame:
        return bronze.shop_categories(self.shop_raw, self.expired and self.expired.categories)

    @cached_property
    def combinations(self) -> DataFrame:
        return bronze.shop_combinations(self.shop_raw, self.expired and self.expired.combinations)

    @cached_property
    def combination_options(self) -> DataFrame:
        return bronze.shop_combination_options(self.shop_raw, self.expired and self.expired.combination_options)

    @cached_property
    def option_values(self) -> DataFrame:
        return bronze.shop_option_values(self.shop_raw, self.expired and self.expired.option_values)


def shop_catalogue(shop_raw: DataFrame, expired: ExpiredCatalogue | None = None) -> ShopCatalogue:
    return ShopCatalogue(shop_raw, expired)


def _newest(df: DataFrame, *keys: str) -> DataFrame:
    """Newest load per key; the remaining columns settle ties so that reruns agree."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in (*keys, "api_timestamp")]
    return latest_per_key(df, list(keys), [*newest_first("api_timestamp"), *rest])


def variant_attributes(links: DataFrame, values: DataFrame) -> DataFrame:
    """Size, colour and all attribute texts per combination.

    The lowest option id decides when a combination has two sizes or two colours. Texts are joined in pieces, so a combination
    with very many options is worked on by several tasks.
    """
    named = links.join(values.drop("api_timestamp"), "option_value_id")
    option = F.struct(F.col("option_value_id").alias("id"), F.col("option_value_name").alias("name"))

    def lowest(of_group: int, name: str) -> tuple[Column, Column]:
        return F.min(F.when(F.col("option_group_id") == of_group, option)), F.min(name)["name"]

    return joined_in_pieces(
        named, ["combination_id"], "option_value_name", ["option_group_id", "option_value_id"], "all_attributes",
        size=lowest(lk.SIZE_GROUP, "size"), color=lowest(lk.COLOUR_GROUP, "color"))


def dim_product_sku(shop: ShopCatalogue) -> DataFrame:
    """One row per combination that has a SKU, with product, category and attributes."""
    combinations = _newest(shop.combinations, "combination_id").drop("api_timestamp").filter(F.col("sku").isNotNull())
    product = _newest(shop.products, "product_id").select(
        "product_id", "product_name", "id_category_default", F.col("active").alias("product_active"),
        F.col("date_updated").alias("last_updated"))
    category = _newest(shop.categories, "category_id").select(
        "category_id", "category_name_da", "parent_category_id", F.col("level_depth").alias("category_level"))
    attributes = variant_attributes(
        _newest(shop.combination_options, "combination_id", "option_value_id").drop("api_timestamp"),
        _newest(shop.option_values, "option_value_id"))

    name = F.col("category_name_da")
    described = combinations.join(product, "product_id", "left")
    placed = lookup_where(described, category, "id_category_default", "category_id",
                          (name != lk.ROOT_CATEGORY) | name.isNull())
    return placed.join(attributes, "combination_id", "left").select(
        "sku", "product_id", F.coalesce("product_name", F.lit(UNKNOWN_PRODUCT)).alias("product_name"),
        "product_active", "category_id", F.coalesce(name, F.lit(UNCATEGORISED)).alias("category_name"),
        "parent_category_id", "category_level", "size", "color", "all_attributes", "combination_id", "ean13",
        "price_impact", F.col("quantity_in_stock").alias("stock_quantity"), "last_updated",
        F.to_timestamp(F.lit(lk.EXPIRED_STAMP)).alias("dim_created_at"),
    )


def dim_product_sku_enriched(lines: DataFrame, sku_dim: DataFrame) -> DataFrame:
    """Every invoiced SKU once: the shop record with the highest combination id, else the usual line text.

    Shop records are cut to one per SKU before the join, so a SKU with many records never fans out.
    """
    invoiced = mode_per_key(lines.filter(F.col("sku").isNotNull()), ["sku"], "line_description", "invoice_name")
    rest = [F.col(c).asc_nulls_last() for c in sku_dim.columns if c not in ("sku", "combination_id")]
    best = latest_per_key(sku_dim, ["sku"], [*newest_first("combination_id"), *rest]) \
        .drop("dim_created_at").withColumn("_found", F.lit(True))
    found = F.coalesce("_found", F.lit(False))
    stamp = F.to_timestamp(F.lit(lk.EXPIRED_STAMP))
    return invoiced.join(best, "sku", "left").select(
        "sku", F.coalesce("product_id", F.lit(-1).cast("bigint")).alias("product_id"),
        F.coalesce("product_name", "invoice_name", F.lit(UNKNOWN_PRODUCT)).alias("product_name"),
        "product_active", "category_id", "category_name", "parent_category_id", "category_level", "size", "color",
        "all_attributes", "combination_id", "ean13", "price_impact", "stock_quantity",
        (~found).alias("is_economic_only"), found.alias("has_prestashop_data"),
        F.coalesce("last_updated", stamp).alias("last_updated"), stamp.alias("dim_created_at"),
    )


def product_master(sku_dim: DataFrame) -> DataFrame:
    """Product master view, one row per SKU."""
    return sku_dim.select(
        F.col("sku").alias("product_sku"), F.col("combination_id").alias("variant_id"),
        F.col("product_id").alias("parent_product_id"), "product_name", F.col("product_active").alias("is_active"),
        "category_id", "category_name", "parent_category_id", "category_level", "size", "color",
        F.col("all_attributes").alias("all_attributes_text"), "ean13", "price_impact", "stock_quantity",
        F.col("last_updated").alias("last_updated_date"), F.col("dim_created_at").alias("dim_created_timestamp"),
    )


def customer_segment(group_number: Column) -> Column:
    return F.when(group_number == 1, "B2C").when(group_number >= 2, "B2B").otherwise("Unknown")


def customer_master(customers: DataFrame) -> DataFrame:
    """Customer master view, one row per customer."""
    unknown = F.lit("Unknown")
    return customers.select(
        F.col("customer_number").alias("customer_id"), "customer_name",
        F.coalesce("city", unknown).alias("customer_city"), F.coalesce("country", unknown).alias("customer_country"),
        F.col("customer_group_number").alias("customer_group_id"),
        customer_segment(F.col("customer_group_number")).alias("customer_segment"),
        F.col("email").alias("email_address"), F.col("telephone").alias("phone_number"),
        F.col("mobile_phone").alias("mobile_number"), F.col("currency").alias("preferred_currency"),
        F.col("payment_terms_number").alias("payment_terms_id"), F.col("vatzone_number").alias("vat_zone_id"),
        F.col("salesperson_employee_number").alias("sales_rep_id"),
        F.col("last_updated").alias("last_updated_date"),
    )


def dim_sku_packaging(packaging: DataFrame, products: DataFrame) -> DataFrame:
    """Newest packaging weights per SKU with product attributes; ``products`` is the product master."""
    weights = ["carton_kg_per_unit", "plastic_kg_per_unit", "foam_kg_per_unit"]
    ties = [F.col(c).asc_nulls_last() for c in weights]
    newest = latest_per_key(packaging, ["sku"], [*newest_first("date_uploaded"), *ties])
    attributes = products.select(F.col("product_sku").alias("sku"), F.col("product_name").alias("product_description"),
                                 "category_name", "size", "color", F.lit(True).alias("_found"))
    return newest.join(attributes, "sku", "left").select(
        "sku", *weights, F.col("date_uploaded").alias("last_updated"), "product_description", "category_name", "size",
        "color", F.when(F.col("_found"), "Matched with PrestaShop").otherwise("Not in PrestaShop")
        .alias("prestashop_match_status"),
    )
