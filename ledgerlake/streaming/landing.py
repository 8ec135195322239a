"""Landing pages, as one batch or as a file stream: every page file once, marks after pages."""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.incremental import cut_to_marks, run_stats, seed_marks, update_marks
from ledgerlake.session import local_table
from ledgerlake.sources.page_index import (
    Load, index_path, landed_by_others, loads_of, not_landed, of_loads, read_index, rebuild_index, starts, write_index,
)
from ledgerlake.sources.pages import (
    LANDED_SCHEMA, append_raw, drop_loads, parse_page_files, parse_page_lines, read_batch, read_pages, reload_raw, to_raw,
)
from ledgerlake.sources.config import active_endpoints
from ledgerlake.sources.store import commit_marks, mark_version, read_marks


def stream_pages(spark: SparkSession, root: str, lines: bool = False, files_per_batch: int = 1000) -> DataFrame:
    """Unbounded form of the landing folder reader."""
    landed = (spark.readStream.schema(LANDED_SCHEMA).option("wholetext", not lines)
              .option("maxFilesPerTrigger", files_per_batch).format("text").load(root))
    return parse_page_lines(landed) if lines else parse_page_files(landed)


def land_batch(
    kind: str, raw_path: str, marks_path: str, clock: Callable[[], dt.datetime], source: str = "batch",
    endpoints: DataFrame | None = None, only_new: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Per micro-batch: append the pages that RAW lacks, index them, then commit marks.

    A batch is known by its source and number. A replayed one rewrites its own RAW partitions and computes its marks from
    the version before its own, so running it twice gives the same state; batches of other sources are left alone. What
    has landed is asked of the page index, in the partitions of the batch's own loads. Shop pages are a full refresh per
    endpoint: the newest load of an endpoint replaces its older ones, whatever the loads of other endpoints are called.
    ``endpoints`` is the endpoint configuration; without one, all pages are taken. ``only_new`` cuts the records that the
    marks of the load's beginning rule out, for landings that hold more than was asked for; later batches of a load
    follow the same marks, in whatever order its pages come.
    """
    base = kind.upper()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, now, name = batch.sparkSession, clock(), f"{source}-{batch_id}"
        raw = to_raw(batch, kind, F.lit(now))
        if endpoints is not None:
            raw = raw.join(active_endpoints(endpoints, base).select(F.col("endpoint_path").alias("api_endpoint")), "api_endpoint", "left_semi")
        if base == "SHOP":
            _refresh(spark, raw, raw_path, name)
            return
        loads = loads_of(raw)
        landed = landed_by_others(spark, raw_path, name, loads)
        schema = seed_marks(spark, now).schema
        version = mark_version(spark, marks_path, schema, base, name)
        begun = starts(landed, loads, version)
        new = not_landed(raw, landed)
        if only_new and begun:
            new = cut_to_marks(new, kind, _start_marks(spark, marks_path, base, begun, now))
        # Written before it is counted: the pages found new must be the same ones in both.
        append_raw(new, raw_path, name)
        write_index(spark, raw_path, name, begun)
        added = read_batch(spark, raw_path, name, of_loads(loads))
        marks = read_marks(spark, marks_path, lambda: seed_marks(spark, now), before=version).where(F.col("base") == base)
        commit_marks(update_marks(marks, run_stats(added, kind), now), marks_path, version, name)
    return write


def _start_marks(spark: SparkSession, path: str, base: str, begun: dict[Load, int], now: dt.datetime) -> DataFrame:
    """The marks with which each load began, a row per load whose endpoint has any."""
    parts = []
    for version in sorted(set(begun.values())):
        marks = read_marks(spark, path, lambda: seed_marks(spark, now), before=version).where(F.col("base") == base)
        loads = local_table(spark, [load for load, began in begun.items() if began == version], "api_endpoint string, load_id string")
        parts.append(loads.join(marks, "api_endpoint").select("api_endpoint", "load_id", "last_updated_timestamp", "last_invoice_number"))
    return reduce(DataFrame.unionByName, parts)


def _refresh(spark: SparkSession, raw: DataFrame, raw_path: str, name: str) -> None:
    index = read_index(spark, raw_path)
    stored = {} if index is None else _newest_loads(index)
    current = {e: load for e, load in _newest_loads(raw).items() if load is not None and load >= (stored.get(e) or load)}
    if not current:
        return
    loads = list(current.items())
    landed = landed_by_others(spark, raw_path, name, loads)
    append_raw(not_landed(raw.where(of_loads(loads)), landed), raw_path, name)
    write_index(spark, raw_path, name, dict.fromkeys(loads, 0))
    for path in (raw_path, index_path(raw_path)):
        drop_loads(spark, path, lambda endpoint, load: load < current.get(endpoint, load))


def _newest_loads(pages: DataFrame) -> dict[str | None, str | None]:
    """Newest load per endpoint; endpoints are few."""
    return {r[0]: r[1] for r in pages.groupBy("api_endpoint").agg(F.max("load_id")).collect()}


def land_once(
    spark: SparkSession, root: str, kind: str, raw_path: str, marks_path: str, version: int, now: dt.datetime,
    lines: bool = False, source: str = "once", endpoints: DataFrame | None = None, only_new: bool = False,
) -> None:
    """One batch load of a landing folder, as batch ``version`` of its source. Shop pages are a full refresh and replace the
    store; of the others those that RAW lacks are added and advance the marks, so a second call adds nothing. ``only_new``:
    see ``land_batch``."""
    if kind.upper() == "SHOP":
        pages = read_pages(spark, root, kind, lines, F.lit(now))
        if endpoints is not None:
            pages = pages.join(active_endpoints(endpoints, "SHOP").select(F.col("endpoint_path").alias("api_endpoint")), "api_endpoint", "left_semi")
        reload_raw(pages, raw_path, f"{source}-{version}")
        rebuild_index(spark, raw_path)
        return
    landed = spark.read.schema(LANDED_SCHEMA).option("wholetext", not lines).format("text").load(root)
    land_batch(kind, raw_path, marks_path, lambda: now, source, endpoints, only_new)(
        parse_page_lines(landed) if lines else parse_page_files(landed), version)


def start_landing(
    spark: SparkSession, root: str, kind: str, raw_path: str, marks_path: str, checkpoint: str,
    clock: Callable[[], dt.datetime], lines: bool = False, files_per_batch: int = 1000, source: str | None = None,
    endpoints: DataFrame | None = None, only_new: bool = False,
) -> StreamingQuery:
    """Process what has landed and stop; start again with the same checkpoint for newer files. Batch numbers belong to the
    checkpoint, so without a name the source is named after it."""
    source = source or f"stream-{zlib.crc32(checkpoint.encode()):08x}"
    return (stream_pages(spark, root, lines, files_per_batch).writeStream
            .foreachBatch(land_batch(kind, raw_path, marks_path, clock, source, endpoints, only_new))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
