"""Landed API pages to RAW rows, and the RAW store.

A landing folder holds ``api_endpoint=<url-encoded endpoint>/load_id=<load>/`` with either one JSON page per file
(``page-<number>.json``) or JSON lines of ``{"page_number": n, "page": {...}}``. JSON lines keep the number of files
independent of the number of pages and are the form for large landings.

RAW columns: date_inserted, api_endpoint, page_number, record_count_per_page, collection_json, load_id. The store is also
partitioned by the batch that landed a page, so that a load may arrive in many batches and from several sources.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.variants import get, parse, record_count

# The array keys of each kind of page, in order of precedence.
ARRAY_KEYS = {
    "REST": ("collection",),
    "OPENAPI": ("items",),
    "SHOP": ("products", "combinations", "categories", "product_option_values"),
}
RAW_COLUMNS = ["date_inserted", "api_endpoint", "page_number", "record_count_per_page", "collection_json", "load_id"]
# A RAW row has a whole page of a thousand records. Parquet looks at sizes every 100 rows only, so that one of its pages, which
# codecs hold in memory outside the heap, would have tens of megabytes; and a reader's batch would be a whole file.
PAGE_LAYOUT = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "4", "parquet.block.row.count.limit": "64"}
LANDED_SCHEMA = "value string, api_endpoint string, load_id string"


def to_raw(pages: DataFrame, kind: str, inserted: Column | None = None) -> DataFrame:
    """RAW rows from (api_endpoint, load_id, page_number, collection_json)."""
    stamp = F.current_timestamp() if inserted is None else inserted
    return pages.select(
        stamp.cast("timestamp").alias("date_inserted"), F.url_decode("api_endpoint").alias("api_endpoint"),
        F.col("page_number").cast("bigint").alias("page_number"),
        record_count(F.col("collection_json"), *ARRAY_KEYS[kind.upper()]).alias("record_count_per_page"),
        "collection_json", "load_id",
    )


def parse_page_files(landed: DataFrame) -> DataFrame:
    """Whole-file pages; the page number is the number in the file name."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("bigint")
    return landed.select("api_endpoint", "load_id", number.alias("page_number"),
                         parse(F.col("value")).alias("collection_json"))


def parse_page_lines(landed: DataFrame) -> DataFrame:
    """JSON-lines pages."""
    line = landed.select("api_endpoint", "load_id", parse(F.col("value")).alias("line"))
    return line.select("api_endpoint", "load_id", get(F.col("line"), "$.page_number", "bigint").alias("page_number"),
                       get(F.col("line"), "$.page", "variant").alias("collection_json"))


def read_pages(
    spark: SparkSession, root: str, kind: str, lines: bool = False, inserted: Column | None = None,
) -> DataFrame:
    """RAW rows of a landing folder; ``kind`` is REST, OPENAPI or SHOP."""
    landed = spark.read.schema(LANDED_SCHEMA).option("wholetext", not lines).format("text").load(root)
    parsed = parse_page_lines(landed) if lines else parse_page_files(landed)
    return to_raw(parsed, kind, inserted)


def land_page_lines(pages: DataFrame, root: str) -> None:
    """Write (api_endpoint, load_id, page_number, page) in the JSON-lines form; ``page`` is a struct, a variant or JSON text. Text
    goes into the line as it is, without being parsed; line ends between its tokens become spaces."""
    line = F.to_json(F.struct("page_number", "page"))
    if isinstance(pages.schema["page"].dataType, T.StringType):
        number, page = F.col("page_number").cast("string"), F.translate("page", "\r\n", "  ")
        line = F.concat(F.lit("{"), F.concat_ws(",", F.concat(F.lit('"page_number":'), number), F.concat(F.lit('"page":'), page)), F.lit("}"))
    pages.select(line.alias("value"), F.url_encode("api_endpoint").alias("api_endpoint"), "load_id") \
        .write.mode("append").partitionBy("api_endpoint", "load_id").text(root)


def _with_batch(raw: DataFrame, batch: str) -> DataFrame:
    return raw.select(*RAW_COLUMNS, F.lit(batch).alias("batch"))


def append_raw(raw: DataFrame, path: str, batch: str = "once") -> None:
    """Add the pages of a batch; writing the same load and batch again replaces them instead of doubling them."""
    (_with_batch(raw, batch).write.mode("overwrite").options(**PAGE_LAYOUT).option("partitionOverwriteMode", "dynamic")
     .partitionBy("api_endpoint", "load_id", "batch").parquet(path))


def reload_raw(raw: DataFrame, path: str, batch: str = "once") -> None:
    """Truncate, then load: the store holds only the newest full refresh."""
    (_with_batch(raw, batch).write.mode("overwrite").options(**PAGE_LAYOUT).option("partitionOverwriteMode", "static")
     .partitionBy("api_endpoint", "load_id", "batch").parquet(path))


RAW_SCHEMA = (
    "date_inserted timestamp, page_number bigint, record_count_per_page bigint, collection_json variant, "
    "api_endpoint string, load_id string, batch string"
)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(path).select(*RAW_COLUMNS)


def drop_loads(spark: SparkSession, path: str, older: Callable[[str, str], bool]) -> None:
    """Remove the partitions of loads for which ``older`` (endpoint, load) holds. Only names are read, not pages."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "api_endpoint=*/load_id=*")) or ():
        folder = status.getPath()
        endpoint, load = (unquote(f.getName().split("=", 1)[1]) for f in (folder.getParent(), folder))
        if older(endpoint, load):
            fs.delete(folder, True)


def read_batch(spark: SparkSession, path: str, batch: str, of: Column | None = None) -> DataFrame:
    """The pages one batch has landed; ``of`` names its loads, so that no other partition is looked at."""
    stored = spark.read.schema(RAW_SCHEMA).parquet(path).where(F.col("batch") == batch)
    return (stored if of is None else stored.where(of)).select(*RAW_COLUMNS)
