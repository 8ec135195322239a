"""Which pages a RAW store has: per load and batch the page numbers as bitmaps, and the marks the load began with.

The index lies beside the store (``<raw>-pages``) and is partitioned as the store is. A batch reads the partitions of its own
loads only, so what it costs does not grow with all that ever landed. One row has up to 32,768 page numbers in 4 KB;
unnumbered pages of a load count as one page and have a row without a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.pages import RAW_SCHEMA

Load = tuple[str | None, str | None]  # (api_endpoint, load_id)

INDEX_SCHEMA = "bucket bigint, pages binary, started int, api_endpoint string, load_id string, batch string"
PARTITIONS = ("api_endpoint", "load_id", "batch")


def index_path(raw_path: str) -> str:
    return raw_path.rstrip("/") + "-pages"


def loads_of(pages: DataFrame) -> list[Load]:
    """The loads of a batch: as many as it has files at most."""
    return [tuple(r) for r in pages.select("api_endpoint", "load_id").distinct().collect()]


def of_loads(loads: Iterable[Load]) -> Column:
    """Rows of these loads, as a filter on the partition columns."""
    by_endpoint: dict[str | None, list[str | None]] = {}
    for endpoint, load in loads:
        by_endpoint.setdefault(endpoint, []).append(load)

    def one(endpoint: str | None, names: list[str | None]) -> Column:
        known = [n for n in names if n is not None]
        named = F.col("load_id").isin(known) if known else F.lit(False)
        return F.col("api_endpoint").eqNullSafe(F.lit(endpoint)) & (named | F.col("load_id").isNull() if len(known) < len(names) else named)

    return reduce(or_, (one(e, names) for e, names in by_endpoint.items()), F.lit(False))


def stored_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _numbered(pages: DataFrame) -> DataFrame:
    return pages.groupBy(*PARTITIONS, F.bitmap_bucket_number("page_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("page_number")).alias("pages"))


def write_index(spark: SparkSession, raw_path: str, batch: str, started: dict[Load, int]) -> None:
    """Index the pages that a batch has landed; a replay replaces its own rows. ``started``: the version of the marks each
    load began with."""
    raw = spark.read.schema(RAW_SCHEMA).parquet(raw_path).where((F.col("batch") == batch) & of_loads(started))
    version = reduce(lambda rest, item: F.when(of_loads([item[0]]), item[1]).otherwise(rest), started.items(), F.lit(0))
    (_numbered(raw).withColumn("started", version.cast("int")).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(index_path(raw_path)))


def rebuild_index(spark: SparkSession, raw_path: str) -> None:
    """Index a whole store, for one that was filled without. Its loads count as begun before the first marks."""
    raw = spark.read.schema(RAW_SCHEMA).parquet(raw_path)
    (_numbered(raw).withColumn("started", F.lit(0)).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*PARTITIONS).parquet(index_path(raw_path)))


def read_index(spark: SparkSession, raw_path: str) -> DataFrame | None:
    """The index of a store, made first if the store has none; None for a store that does not exist."""
    if stored_or_none(spark, raw_path, RAW_SCHEMA) is None:
        return None
    if stored_or_none(spark, index_path(raw_path), INDEX_SCHEMA) is None:
        rebuild_index(spark, raw_path)
    return stored_or_none(spark, index_path(raw_path), INDEX_SCHEMA)


def landed_by_others(spark: SparkSession, raw_path: str, batch: str, loads: list[Load]) -> DataFrame | None:
    """Index rows of these loads that other batches have written."""
    index = read_index(spark, raw_path)
    return None if index is None else index.where((F.col("batch") != batch) & of_loads(loads))


def not_landed(pages: DataFrame, landed: DataFrame | None) -> DataFrame:
    """Pages that the index rows do not have. The index rows of a batch's loads (4 KB for 32,768 pages) go to where the pages are:
    pages of a load share few keys, so a join by key would bring a load's pages, JSON and all, to one task."""
    if landed is None:
        return pages
    index = landed.select(*[F.col(c).alias(f"_{c}") for c in ("api_endpoint", "load_id", "bucket", "pages")])
    asked = pages.withColumns({"_at": F.bitmap_bucket_number("page_number"), "_bit": F.bitmap_bit_position("page_number")})
    byte = F.conv(F.hex(F.expr("substring(_pages, int(_bit div 8) + 1, 1)")), 16, 10).cast("int")
    has = F.col("page_number").isNull() | (F.expr("shiftleft(1, int(_bit % 8))").bitwiseAND(byte) != 0)
    same = (F.col("api_endpoint").eqNullSafe(F.col("_api_endpoint")) & F.col("load_id").eqNullSafe(F.col("_load_id"))
            & F.col("_at").eqNullSafe(F.col("_bucket")))
    return asked.join(F.broadcast(index), same & has, "left_anti").drop("_at", "_bit")


def starts(landed: DataFrame | None, loads: list[Load], version: int) -> dict[Load, int]:
    """The version of the marks that each load began with: the least of its batches, this one's for a load that begins."""
    known = {} if landed is None else {
        (r.api_endpoint, r.load_id): r.started for r in landed.groupBy("api_endpoint", "load_id").agg(F.min("started").alias("started")).collect()}
    return {load: min(known.get(load, version), version) for load in loads}
