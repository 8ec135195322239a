"""Materialised tables: entities as parquet, marks as versions of a small table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import small_splits

#: Tables stored whole are written once and read often. A task reads a row group at least, so groups are kept to the size of a sort.
STORED = {"partitionOverwriteMode": "static", "compression": "zstd", "parquet.block.size": 64 << 20}


def materialise(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write an entity once and read it back, so later queries neither parse JSON nor deduplicate again."""
    with small_splits(df.sparkSession):
        df.write.mode("overwrite").options(**STORED).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_by_month(fact: DataFrame, path: str, day: str = "sale_date", month: str = "sale_month") -> None:
    """Write a fact partitioned by month, so that questions about a period read that period only.

    Tasks write the months of the rows they hold, sorted locally: the fact's widest rows are not shuffled once more. A month has as
    many files as tasks had rows of it. A fact that is stored already is read in splits small enough to be sorted in memory: else
    its rows would be spilled, and rows are larger than the table.
    """
    dated = fact.withColumn(month, F.trunc(F.col(day), "MONTH"))
    with small_splits(fact.sparkSession):
        dated.write.mode("overwrite").options(**STORED).partitionBy(month).parquet(path)


def published(spark: SparkSession, path: str, schema: T.StructType, month: str = "sale_month") -> Callable[[list[str]], DataFrame]:
    """Column-wise reader of a published fact, for the semantic model with ``month_partition``."""
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField(month, T.DateType())])).parquet(path)
    return lambda columns: stored.select(*columns)


def save_bucketed(df: DataFrame, table: str, keys: tuple[str, ...], buckets: int) -> DataFrame:
    """Save as a table bucketed and sorted by its join key: joins of two such tables on it need no shuffle."""
    layout = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    layout.saveAsTable(table)
    return df.sparkSession.table(table)


def commit_marks(marks: DataFrame, path: str, version: int, batch: str = "") -> None:
    """Add a version of the marks of each base (API kind) in ``marks``; a replay replaces its own version. ``batch`` names
    what wrote it. Kinds do not touch each other's versions; one writer per kind at a time."""
    (marks.withColumns({"version": F.lit(version), "batch": F.lit(batch)}).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("base", "version").parquet(path))


def _mark_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(T.StructType(list(schema)).add("batch", T.StringType()).add("version", T.IntegerType())).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def mark_version(spark: SparkSession, path: str, schema: T.StructType, base: str, batch: str) -> int:
    """The version a batch has written for a base, or else the next one."""
    versions = _mark_versions(spark, path, schema)
    if versions is None:
        return 0
    own, last = versions.where(F.col("base") == base).agg(
        F.max(F.when(F.col("batch") == batch, F.col("version"))), F.max("version")).first()
    return own if own is not None else 0 if last is None else last + 1


def read_marks(
    spark: SparkSession, path: str, seed: Callable[[], DataFrame], before: int | None = None,
) -> DataFrame:
    """Per base the newest committed marks, or those before a version; the seed's for bases without any."""
    seeds = seed()
    versions = _mark_versions(spark, path, seeds.schema)
    if versions is None:
        return seeds
    if before is not None:
        versions = versions.filter(F.col("version") < before)
    newest = versions.groupBy("base").agg(F.max("version").alias("version"))
    committed = versions.join(newest, ["base", "version"]).select(*seeds.columns)
    return committed.unionByName(seeds.join(newest, "base", "left_anti").select(*seeds.columns))
