"""Consecutive surrogate keys over a global order, without a one-task window.

Rows are range-partitioned by the order, numbered inside each partition, and shifted by the sizes of the partitions
before. Numbers and sizes must come from the same layout, so it is checkpointed; only one number per partition
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir

_PART, _POS = "_part", "_pos"
COPIES_PER_TASK_UNIT = 1 << 16


def _ordered_layout(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Checkpointed global sort with partition number and 0-based position inside it."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # monotonically_increasing_id carries the partition number above bit 33 and the row's position below it.
    numbered = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order) \
        .withColumn("_id", F.monotonically_increasing_id())
    split = numbered.withColumn(_PART, F.shiftright("_id", 33)) \
        .withColumn(_POS, F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id")
    return split.checkpoint()


def _with_offset(layout: DataFrame, sizes: Sequence[tuple[int, int]]) -> DataFrame:
    """Add the number of rows in earlier partitions; one row per partition is broadcast."""
    parts, offsets, seen = [], [], 0
    for part, size in sorted(sizes):
        parts.append(part)
        offsets.append(seen)
        seen += size
    table = pa.table({_PART: pa.array(parts, pa.int64()), "_offset": pa.array(offsets, pa.int64())})
    return layout.join(F.broadcast(layout.sparkSession.createDataFrame(table)), _PART)


def _nulls_last(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def dense_keys(df: DataFrame, cols: Sequence[str], name: str, base: int = 0, sign: int = -1) -> DataFrame:
    """One row per distinct value combination with its rank (1, 2, ...) as ``base + sign * rank``; NULL ranks last."""
    layout = _ordered_layout(df.select(*cols).distinct(), _nulls_last(cols))
    sizes = [(r[0], r[1]) for r in layout.groupBy(_PART).count().collect()]
    rank = F.col("_offset") + F.col(_POS) + 1
    return _with_offset(layout, sizes).select(*cols, (F.lit(base) + F.lit(sign) * rank).cast("bigint").alias(name))


def dense_ranks_within(df: DataFrame, group: str, col: str, name: str) -> DataFrame:
    """Rank 1, 2, ... of each distinct ``col`` within a ``group``, NULL last; one pass for all groups.

    Meant for a handful of groups: one row per partition and group reaches the driver. Groups are not NULL.
    """
    layout = _ordered_layout(df.select(group, col).distinct(), _nulls_last([group, col]))
    starts = layout.groupBy(group, _PART).agg(F.count(F.lit(1)), F.min(_POS)).collect()
    rows, seen = [], {}
    for value, part, size, first in sorted(starts, key=lambda r: (r[1], r[3])):
        rows.append((value, part, seen.get(value, 0) - first))
        seen[value] = seen.get(value, 0) + size
    shifts = df.sparkSession.createDataFrame(pa.table({
        group: pa.array([r[0] for r in rows], pa.string()), _PART: pa.array([r[1] for r in rows], pa.int64()),
        "_offset": pa.array([r[2] for r in rows], pa.int64())}))
    rank = (F.col("_offset") + F.col(_POS) + 1).cast("bigint")
    return layout.join(F.broadcast(shifts), [group, _PART]).select(group, col, rank.alias(name))


def attach_key(df: DataFrame, keys: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Null-safe lookup of ids made by :func:`dense_keys`."""
    renamed = keys.select(*[F.col(c).alias(f"_k_{c}") for c in cols], name)
    match = None
    for c in cols:
        same = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        match = same if match is None else match & same
    return df.join(renamed, match, "left").drop(*[f"_k_{c}" for c in cols])


def row_keys(df: DataFrame, order: Sequence[str], name: str, base: int = 0, sign: int = -1) -> DataFrame:
    """A consecutive number per row by ``order``, ties broken by all other columns.

    Equal rows are counted first and expanded again at the end, in bounded units, so
    neither the sort nor the expansion puts one value's rows into one task.
    """
    cols = [*order, *[c for c in df.columns if c not in order]]
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    layout = _ordered_layout(counted, _nulls_last(cols))
    stats = layout.groupBy(_PART).agg(F.sum("_copies")).collect()
    running = Window.partitionBy(_PART).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    placed = _with_offset(layout.withColumn("_upto", F.sum("_copies").over(running)), [(r[0], r[1]) for r in stats])
    first = F.col("_offset") + F.col("_upto") - F.col("_copies") + 1
    placed = placed.select(*df.columns, first.alias("_first"), (first + F.col("_copies") - 1).alias("_last"))
    units = F.sequence("_first", "_last", F.lit(COPIES_PER_TASK_UNIT))
    placed = (placed.withColumn("_from", F.explode(units)).repartition("_from")
              .withColumn("_last", F.least("_last", F.col("_from") + COPIES_PER_TASK_UNIT - 1))
              .withColumn("_first", F.col("_from")).drop("_from"))
    numbered = placed.withColumn("_number", F.explode(F.sequence("_first", "_last")))
    return numbered.select(*df.columns, (F.lit(base) + F.lit(sign) * F.col("_number")).cast("bigint").alias(name))
