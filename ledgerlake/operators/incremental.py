"""High-water marks, delta filters and load checks.

Marks are a small table keyed by (api_endpoint, base): one row per endpoint. Pages are committed before marks, so a
failed run is read again and latest-wins absorbs the repeats.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlake.functions.lookups import MARK_SEEDS
from ledgerlake.operators.variants import array_at, get
from ledgerlake.session import local_table

MARK_SCHEMA = (
    "api_endpoint string, base string, last_updated_timestamp timestamp, last_invoice_number bigint, "
    "last_ingestion_date timestamp, total_records_loaded bigint, last_run_records bigint, "
    "created_at timestamp, updated_at timestamp"
)


def seed_marks(spark: SparkSession, now: dt.datetime) -> DataFrame:
    rows = [(path, base, None, number, now, 0, 0, now, now) for path, base, number in MARK_SEEDS]
    return local_table(spark, rows, MARK_SCHEMA)


def delta_by_time(df: DataFrame, column: str, mark: dt.datetime | str | None) -> DataFrame:
    """Inclusive: the record at the mark is read again. No mark, no filter."""
    if mark is None:
        return df
    return df.filter(F.col(column) >= F.lit(mark).cast(df.schema[column].dataType))


def delta_by_number(df: DataFrame, column: str, mark: int | None) -> DataFrame:
    """Numbers above the mark; no filter for a missing mark or 0."""
    return df if not mark else df.filter(F.col(column) >= F.lit(mark + 1))


# What an endpoint's mark is compared with.
DELTA_COLUMNS = {
    "customers": ("last_updated", "last_updated_timestamp"),
    "products": ("last_updated", "last_updated_timestamp"),
    "invoices/booked": ("invoice_number", "last_invoice_number"),
    "invoices/booked/lines": ("invoice_number", "last_invoice_number"),
}


def new_records(records: DataFrame, endpoint: str, marks: DataFrame) -> DataFrame:
    """Records of an entity a run has to take, by the endpoint's mark; endpoints without a rule are taken whole."""
    if endpoint not in DELTA_COLUMNS:
        return records
    column, mark = DELTA_COLUMNS[endpoint]
    row = marks.filter(F.col("api_endpoint") == endpoint).select(F.max(mark)).first()
    delta = delta_by_time if mark == "last_updated_timestamp" else delta_by_number
    return delta(records, column, row[0])


# Where a record has what a mark is compared with, and the array of its pages, per API kind.
RECORD_DELTAS = {
    "REST": ("collection", {
        "customers": ("$.lastUpdated", "last_updated_timestamp"), "products": ("$.lastUpdated", "last_updated_timestamp"),
        "invoices/booked": ("$.bookedInvoiceNumber", "last_invoice_number")}),
    "OPENAPI": ("items", {"invoices/booked/lines": ("$.documentId", "last_invoice_number")}),
}


def cut_to_marks(pages: DataFrame, kind: str, marks: DataFrame) -> DataFrame:
    """Pages without the records that a load driven by marks would not ask for: changed before the mark (the record at it is taken
    again), or numbered up to it. ``marks``: a row per (api_endpoint, load_id). Endpoints without a rule and loads
    without a mark are taken whole. Records are cut inside their page, so all pages stay, some of them empty.
    """
    key, rules = RECORD_DELTAS[kind.upper()]
    of = marks.select(F.col("api_endpoint").alias("_endpoint"), F.col("load_id").alias("_load"), "last_updated_timestamp", "last_invoice_number")
    page, array = F.col("collection_json"), array_at(F.col("collection_json"), f"$.{key}")

    def wanted(record: Column) -> Column:
        keep = F.lit(True)
        for endpoint, (path, mark) in rules.items():
            if mark == "last_updated_timestamp":
                new = F.col(mark).isNull() | (get(record, path, "timestamp", lenient=True) >= F.col(mark))
            else:
                new = (F.coalesce(F.col(mark), F.lit(0)) <= 0) | (get(record, path, "bigint", lenient=True) > F.col(mark))
            keep = F.when(F.col("api_endpoint") == endpoint, F.coalesce(new, F.lit(False))).otherwise(keep)
        return keep

    rows = pages.join(of, F.col("api_endpoint").eqNullSafe(F.col("_endpoint")) & F.col("load_id").eqNullSafe(F.col("_load")), "left")
    rows = rows.withColumn("_kept", F.filter(array, wanted))
    parts = F.transform_values(page.cast("map<string,variant>"), lambda name, value: F.when(
        name == key, F.to_variant_object("_kept")).otherwise(value))
    cut = F.size("_kept") < F.size(array)
    return rows.select(*[
        F.when(cut, F.to_variant_object(parts)).otherwise(page).alias(c) if c == "collection_json"
        else F.when(cut, F.size("_kept")).otherwise(F.col(c)).cast("bigint").alias(c) if c == "record_count_per_page"
        else F.col(c) for c in pages.columns])


def page_highs(pages: DataFrame, base: str) -> DataFrame:
    """Per page the largest change time and document number, found inside the page without exploding it; a value that does not
    fit counts as missing."""
    key, number, changed = ("items", "documentId", None) if base.upper() == "OPENAPI" else ("collection", "bookedInvoiceNumber", "lastUpdated")
    fields = f"{number}: bigint" + (f", {changed}: timestamp" if changed else "")
    # One cast of the page's array reads these fields of all records; nothing else of a record is copied.
    records = F.try_variant_get(F.col("collection_json"), f"$.{key}", f"array<struct<{fields}>>")
    changed = F.array_max(records[changed]) if changed else F.lit(None).cast("timestamp")
    number = F.array_max(records[number])
    return pages.select("api_endpoint", F.lit(base.upper()).alias("base"), "record_count_per_page",
                        changed.alias("page_timestamp"), F.nullif(number, F.lit(0)).alias("page_number_high"))


def run_stats(pages: DataFrame, base: str) -> DataFrame:
    """New mark and record count of one run per endpoint."""
    return page_highs(pages, base).groupBy("api_endpoint", "base").agg(
        F.max("page_timestamp").alias("new_timestamp"), F.max("page_number_high").alias("new_number"),
        F.sum("record_count_per_page").alias("run_records"),
    )


def update_marks(marks: DataFrame, stats: DataFrame, now: dt.datetime) -> DataFrame:
    """Advance marks by a run's stats; endpoints without records keep theirs, unknown endpoints get a row."""
    stamp = F.lit(now).cast("timestamp")
    loaded = stats.filter("run_records > 0")
    joined = marks.join(loaded, ["api_endpoint", "base"], "full_outer")
    ran, fresh = F.col("run_records").isNotNull(), F.col("created_at").isNull()
    return joined.select(
        "api_endpoint", "base",
        F.coalesce("new_timestamp", "last_updated_timestamp").alias("last_updated_timestamp"),
        F.coalesce("new_number", "last_invoice_number").alias("last_invoice_number"),
        F.when(ran, stamp).otherwise(F.col("last_ingestion_date")).alias("last_ingestion_date"),
        (F.coalesce("total_records_loaded", F.lit(0)) + F.coalesce("run_records", F.lit(0)))
        .cast("bigint").alias("total_records_loaded"),
        F.coalesce("run_records", "last_run_records").cast("bigint").alias("last_run_records"),
        F.when(fresh, stamp).otherwise(F.col("created_at")).alias("created_at"),
        F.when(ran, stamp).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def load_completeness(pages: DataFrame, page_size: int, start_page: int = 0) -> DataFrame:
    """Per (endpoint, load): no page missing or repeated, only the last one short, and the last one short.

    Plain aggregates: an endpoint with most of the pages is reduced before the shuffle.
    """
    size, page = F.col("record_count_per_page"), F.col("page_number")
    grouped = pages.groupBy("api_endpoint", "load_id").agg(
        F.count(F.lit(1)).alias("page_count"), F.countDistinct("page_number").alias("distinct_pages"),
        F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"),
        F.sum("record_count_per_page").alias("records"),
        F.count_if(size < page_size).alias("short_pages"),
        F.max(F.when(size < page_size, page)).alias("last_short_page"),
    )
    gap_free = (F.col("last_page") - F.col("first_page") + 1 == F.col("distinct_pages")) \
        & (F.col("distinct_pages") == F.col("page_count")) & (F.col("first_page") == start_page)
    one_short = (F.col("short_pages") == 1) & (F.col("last_short_page") == F.col("last_page"))
    return grouped.select(
        "api_endpoint", "load_id", "page_count", "records", "first_page", "last_page", "short_pages",
        gap_free.alias("gap_free"), one_short.alias("ends_short"), (gap_free & one_short).alias("complete"),
    )


#: Page numbers that one task sorts at a time when it looks for runs.
RUN_BLOCK = 1 << 16


def page_runs(pages: DataFrame) -> DataFrame:
    """Runs of consecutive page numbers per (api_endpoint, load_id): first_page and last_page. Unnumbered pages are in none.

    Pages are read once and sorted within blocks of ``RUN_BLOCK`` page numbers, so a load with most of the pages is dealt
    over many tasks. What is left are the runs of each block; those that touch across a border are joined over these few rows.
    """
    load, page = ["api_endpoint", "load_id"], F.col("page_number")
    single = pages.where(page.isNotNull()).select(*load, page.alias("first_page"), page.alias("last_page"))
    parts = _coalesced(single, Window.partitionBy(*load, F.floor(F.col("first_page") / RUN_BLOCK)).orderBy("first_page"),
                       [*map(F.col, load), F.floor(F.col("first_page") / RUN_BLOCK).alias("_block")])
    return _coalesced(parts, Window.partitionBy(*load).orderBy("first_page"), [F.col(c) for c in load])


def _coalesced(runs: DataFrame, order: WindowSpec, group: list[Column]) -> DataFrame:
    """The runs of each window partition, those that touch or repeat put together."""
    begins = F.coalesce(F.col("first_page") > F.lag("last_page").over(order) + 1, F.lit(True))
    numbered = runs.withColumn("_begins", begins).withColumn("_run", F.count_if("_begins").over(order))
    return numbered.groupBy(*group, "_run").agg(F.min("first_page").alias("first_page"), F.max("last_page").alias("last_page")).drop("_run", "_block")


def page_gaps(pages: DataFrame) -> DataFrame:
    """Last page number before each gap of a load: the ends of its runs but the last."""
    later = Window.partitionBy("api_endpoint", "load_id").orderBy("first_page")
    ends = page_runs(pages).withColumn("_next", F.lead("first_page").over(later))
    return ends.where(F.col("_next").isNotNull()).select("api_endpoint", "load_id", F.col("last_page").alias("page_number"))


def ingest_summary(pages: DataFrame) -> DataFrame:
    """Records and pages per endpoint, and a total row with NULL endpoint."""
    return pages.rollup("api_endpoint").agg(
        F.sum("record_count_per_page").alias("records"), F.count(F.lit(1)).alias("pages"))
