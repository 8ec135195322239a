"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a following aggregation on the same key then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A lookup side whose measured partitions are small is hashed, so that the lines are not sorted for the join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}
#: Stored bytes that a task reads when it sorts what it reads: of the sales fact about 0.5 GB as rows, where Spark's 128 MB are 1.7 GB.
SORTED_SPLIT = 40 << 20
CLEANING = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(app: str = "ledgerlake", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the builders expect; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **CLEANING, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Apply the settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


@contextmanager
def small_splits(spark: SparkSession, most: int = SORTED_SPLIT) -> Iterator[None]:
    """What runs meanwhile scans at most ``most`` bytes a task, or one row group, so that a sort of what was scanned, for a shuffle or
    by partition, stays in memory."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) > most:
        spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a local run without one gets a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    fallback = spark.conf.get("spark.ledgerlake.localDir", None)
    if fallback is None:
        fallback = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.conf.set("spark.ledgerlake.localDir", fallback)
    return fallback


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/ledgerlake/{tag}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """``checkpoint()`` needs a directory; the session's own one wins."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "timestamp": pa.timestamp("us", "UTC")}


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table kept in the plan, so Spark knows its size; times are UTC."""
    fields = T.StructType.fromDDL(schema)
    columns = zip(*rows) if rows else [[] for _ in fields]
    return spark.createDataFrame(pa.table({
        f.name: pa.array(list(values), _ARROW[f.dataType.simpleString()]) for f, values in zip(fields, columns)}))
