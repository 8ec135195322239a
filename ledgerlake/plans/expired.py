"""Synthetic shop records for the expired-SKU list, with negative ids."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import lookups as lk
from ledgerlake.functions.text import blank_to_null, normalise_sku, to_number
from ledgerlake.operators.keys import attach_key, dense_ranks_within, row_keys
from ledgerlake.sources.files import EXPIRED_COLUMNS


@dataclass
class ExpiredCatalogue:
    """Five synthetic frames sharing one set of ids: each distinct product, size and colour text gets one id, and each listed
    SKU row one combination id. Ids are numbered when the first frame that holds them is asked for."""

    expired: DataFrame

    @cached_property
    def products(self) -> DataFrame:
        known = self._rows.filter(F.col("PRODUCT").isNotNull()) \
            .select("product_name", to_number(F.col("CATEGORY_NO")).try_cast("bigint").alias("id_category_default")).distinct()
        return attach_key(known, self._product_ids, ["product_name"], "product_id").select(
            _stamp().alias("api_timestamp"), "product_id", "product_name", "id_category_default",
            F.lit(False).alias("active"), _stamp().alias("date_added"), _stamp().alias("date_updated"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        return self.expired.filter(F.col("CATEGORY_NO").isNotNull()).select(
            to_number(F.col("CATEGORY_NO")).try_cast("bigint").alias("category_id"),
            blank_to_null(F.col("CATEGORY_NAME")).alias("category_name_da"),
        ).distinct().select(
            _stamp().alias("api_timestamp"), "category_id", "category_name_da",
            F.lit(lk.EXPIRED_PARENT_CATEGORY).cast("bigint").alias("parent_category_id"), F.lit(True).alias("active"),
            F.lit(lk.EXPIRED_CATEGORY_DEPTH).cast("bigint").alias("level_depth"),
        )

    @cached_property
    def combinations(self) -> DataFrame:
        named = self._numbered.withColumn("product_name", blank_to_null(F.col("PRODUCT")))
        return attach_key(named, self._product_ids, ["product_name"], "product_id").select(
            _stamp().alias("api_timestamp"), "combination_id", "product_id", normalise_sku(F.col("SKU")).alias("sku"),
            blank_to_null(F.col("EAN")).alias("ean13"), F.lit(0).cast("decimal(38,0)").alias("price_impact"),
            F.lit(0).cast("bigint").alias("quantity_in_stock"),
        )

    @cached_property
    def combination_options(self) -> DataFrame:
        def links(keys: DataFrame, source: str, column: str) -> DataFrame:
            owned = self._numbered.select("combination_id", blank_to_null(F.col(source)).alias(column))
            return owned.join(keys, column).select(_stamp().alias("api_timestamp"), "combination_id", "option_value_id")

        return links(self._size_ids, "SIZE", "size_value").unionByName(links(self._colour_ids, "COLOR", "color_value"))

    @cached_property
    def option_values(self) -> DataFrame:
        def values(keys: DataFrame, column: str, group: int) -> DataFrame:
            return keys.select(_stamp().alias("api_timestamp"), "option_value_id",
                              F.lit(group).cast("bigint").alias("option_group_id"),
                              F.col(column).alias("option_value_name"))

        return values(self._size_ids, "size_value", lk.SIZE_GROUP) \
            .unionByName(values(self._colour_ids, "color_value", lk.COLOUR_GROUP))

    @cached_property
    def _rows(self) -> DataFrame:
        return self.expired.select(*EXPIRED_COLUMNS).withColumns(
            {name: blank_to_null(F.col(source)) for name, source in _TEXTS.values()})

    @cached_property
    def _ranks(self) -> DataFrame:
        texts = self._rows.select(F.explode(F.array(*[
            F.struct(F.lit(kind).alias("kind"), F.col(name).alias("text")) for kind, (name, _) in _TEXTS.items()])).alias("t"))
        named = texts.select("t.*").filter((F.col("kind") == "product") | F.col("text").isNotNull())
        return dense_ranks_within(named, "kind", "text", "rank")

    def _ids(self, kind: str, name: str, base: int) -> DataFrame:
        return self._ranks.filter(F.col("kind") == kind).select(
            F.col("text").alias(_TEXTS[kind][0]), (F.lit(base) - F.col("rank")).cast("bigint").alias(name))

    @cached_property
    def _product_ids(self) -> DataFrame:
        return self._ids("product", "product_id", 0)

    @cached_property
    def _size_ids(self) -> DataFrame:
        return self._ids("size", "option_value_id", lk.SIZE_KEY_BASE)

    @cached_property
    def _colour_ids(self) -> DataFrame:
        return self._ids("colour", "option_value_id", lk.COLOUR_KEY_BASE)

    @cached_property
    def _numbered(self) -> DataFrame:
        listed = self.expired.select(*EXPIRED_COLUMNS).filter(blank_to_null(F.col("SKU")).isNotNull())
        return row_keys(listed, ["SKU"], "combination_id")


#: Kinds of numbered texts: column name here, column of the list.
_TEXTS = {"product": ("product_name", "PRODUCT"), "size": ("size_value", "SIZE"), "colour": ("color_value", "COLOR")}


def _stamp() -> Column:
    return F.to_timestamp(F.lit(lk.EXPIRED_STAMP))


def expired_catalogue(expired: DataFrame) -> ExpiredCatalogue:
    """The catalogue of an expired list; no job runs before a frame with numbered ids is asked for."""
    return ExpiredCatalogue(expired)
