"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import posixpath
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlake.session import scratch_path, tune

#: Rows of an Arrow batch; texts are long, so the default of 10,000 would hold too much memory.
ARROW_ROWS = "500"


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators expect."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Write once to the shared folder and read from there: cuts the lineage, survives lost executors, and gives later
    joins a measured size."""
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[tuple]], schema: str | T.StructType,
             flush: int = 2000) -> DataFrame:
    """``mapInArrow`` by Python rows: ``rows`` gets dictionaries in partition order and yields tuples of ``schema``."""
    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dicts() -> Iterator[dict]:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    yield from batch.slice(start, 256).to_pylist()

        held: list[tuple] = []
        for row in rows(dicts()):
            held.append(row)
            if len(held) >= flush:
                yield pack(held, arrow)
                held = []
        if held:
            yield pack(held, arrow)
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back to the system: workers live on between tasks and stages, beside their executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library offers it
        ctypes.CDLL(None).malloc_trim(0)


def pack(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of letters: ``name`` or a longer one."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def filesystem(uri: str):
    """The file system of a shared path, and the path inside it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, parts: list[bytes]) -> str:
    """Write under a name no other attempt of the task uses; only attempts whose rows Spark commits are ever read."""
    uri = posixpath.join(folder, f"{name}-{uuid.uuid4().hex}")
    fs, path = filesystem(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        for part in parts:
            out.write(part)
    return uri
