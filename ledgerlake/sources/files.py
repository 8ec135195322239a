"""Flat files: packaging and expired-SKU inputs, packaging table, CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.text import null_tokens

EXPIRED_COLUMNS = ["PRODUCT", "COLOR", "SIZE", "SKU", "EAN", "CATEGORY_NO", "CATEGORY_NAME"]


def read_packaging_csv(spark: SparkSession, path: str) -> DataFrame:
    """Exported spreadsheet with header, every column text, null markers as NULL."""
    raw = spark.read.option("header", True).option("sep", ",").option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    return raw.select(*[null_tokens(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_expired_list(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """Seven text columns; ``format`` is csv (with header) or parquet."""
    schema = ", ".join(f"{c} string" for c in EXPIRED_COLUMNS)
    reader = spark.read.schema(schema)
    return reader.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path) \
        if format == "csv" else reader.parquet(path)


def reload_table(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header; text is quoted where needed, line breaks included. One file per partition: order is not a property of the export."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
