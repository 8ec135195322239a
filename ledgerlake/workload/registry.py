"""Registry of workload queries: a Spark callable and, where SQL can say it, the same result as SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import tune

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}

# Whole numbers with NULLs, and flags with NULLs, per query: data frames have no common type for them, so they are
# compared as DOUBLE and as text.
NULLABLE_WHOLE = {
    "fct1_sales_detail": ("parent_category_id", "category_level", "prestashop_stock_qty"),
    "fct10_customer_master": ("customer_group_id",),
    "fct11_product_master": ("variant_id", "category_id", "parent_category_id", "category_level", "stock_quantity"),
    "brz1_customers": ("due_amount", "attention_contact_number", "customer_contact_number"),
    "brz2_products": ("recommended_price", "cost_price"),
    "brz3_invoices": ("delivery_location_number", "layout_number"),
    "exp2_products": ("id_category_default",),
    "exp3_categories": ("category_id",),
    "brz6_shop_products": ("id_category_default",),
    "brz7_shop_categories": ("category_id",),
    "brz9_shop_combination_options": ("option_value_id",),
    "dim1_product_sku": ("category_id", "parent_category_id", "category_level"),
    "dim2_product_sku_enriched": ("category_id", "parent_category_id", "category_level", "combination_id",
                                  "price_impact", "stock_quantity"),
    "ded5_best_match": ("o_orderkey",),
    "inc3_new_marks": ("new_number",),
    "inc4_update_marks": ("last_invoice_number",),
    "inc5_seeded_marks": ("last_invoice_number",),
    "inc7_stream_landing": ("mark",),
    "inc10_mark_driven_landing": ("mark",),
    "cst1_try_number": ("number",),
}
NULLABLE_FLAGS = {
    "fct11_product_master": ("is_active",),
    "sem12_relationships": ("is_active",),
    "dim2_product_sku_enriched": ("product_active",),
}


def portable_sql(name: str, sql: str) -> str:
    """The query's SQL with its nullable whole numbers and flags in their comparable types."""
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in NULLABLE_WHOLE.get(name, ())]
    casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in NULLABLE_FLAGS.get(name, ())]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{sql}\n)" if casts else sql


def portable(df: DataFrame, name: str = "", scale: int = 2, scales: dict[str, int] | None = None) -> DataFrame:
    """Types both engines print alike: whole numbers as BIGINT, decimals as rounded DOUBLE, days and times as text."""
    whole, flags = NULLABLE_WHOLE.get(name, ()), NULLABLE_FLAGS.get(name, ())

    def plain(field: T.StructField):
        col = F.col(f"`{field.name}`")
        kind = field.dataType
        if field.name in whole:
            col = col.cast("double")
        elif field.name in flags:
            col = col.cast("string")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)) or (
                isinstance(kind, T.DecimalType) and kind.scale == 0):
            col = col.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
            col = F.round(col.cast("double"), (scales or {}).get(field.name, scale))
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        return col.alias(field.name)
    return df.select(*[plain(field) for field in df.schema])


def query(name: str, sql: str | None = None, scale: int = 2, **scales: int) -> Callable[[Run], Run]:
    """Register a query; ``scale`` and ``scales`` set the decimals of its DOUBLE columns."""
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def tuned(spark: SparkSession, sf: str) -> DataFrame:
            tune(spark)
            return portable(run(spark, sf), name, scale, scales)

        QUERIES[name] = Query(tuned, None if sql is None else portable_sql(name, sql))
        return run
    return register
