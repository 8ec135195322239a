"""Totals per month and dimensions that merge for any period: sums, and exact numbers of distinct values.

Sums of months add up; numbers of distinct values do not. So each month keeps the values themselves: whole numbers as bitmaps of
32,768 neighbours, other types as a list of rows. A period takes the totals of the months it covers whole, makes the same parts
from the fact for the days at its edges, and merges both: sums are added, bitmaps joined by OR and counted, so that a value seen
in many months, or on both sides of an edge, counts once. The lines of whole months are not read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import dates
from ledgerlake.plans.semantic import SALES, SALES_METRICS, Metric
from ledgerlake.sources.month_store import MonthStore
from ledgerlake.sources.page_index import stored_or_none


SUMS = "sums"


class MonthTotals:
    """Totals of a store by ``dims`` for ``metrics`` of the sales view that do not look at the day."""

    def __init__(self, store: MonthStore, path: str, dims: Sequence[str], metrics: Sequence[str]):
        self.store, self.path, self.dims = store, path.rstrip("/"), list(dims)
        self.metrics: dict[str, Metric] = {name: SALES_METRICS[name] for name in metrics}
        dated = [name for name, m in self.metrics.items() if set(m.columns) & set(SALES.time_dimensions)]
        if dated:
            raise ValueError(f"totals of months cannot answer {dated}")
        self.distinct = list(dict.fromkeys(c for m in self.metrics.values() for c in m.parts.distinct))
        self.sums = {f"{name}_{n}": term for name, m in self.metrics.items() for n, term in enumerate(m.parts.sums)}
        self.whole = {c for c in self.distinct if isinstance(store.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))}

    def publish(self) -> list[dt.date]:
        """Make the totals of months that the store has written since; returns them. Totals of months that are gone stay unread."""
        done = stored_or_none(self.store.spark, f"{self.path}/done", f"`{self.store.month}` date, data_version int")
        have = set() if done is None else {tuple(r) for r in done.collect()}
        missing = {m: k.data_version for m, k in sorted(self.store.months.items()) if (m, k.data_version) not in have}
        if missing:
            rows = self.store.read([*self._columns(), self.store.month]).where(F.col(self.store.month).isin(list(missing)))
            version = F.create_map(*[F.lit(x) for pair in missing.items() for x in pair])[F.col(self.store.month)]
            for kind, parts in self._parts(rows).items():
                (parts.withColumn("data_version", version).hint("rebalance", self.store.month).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy(self.store.month, "data_version").parquet(f"{self.path}/{kind}"))
            # Last, so that a month counts when all its parts are there.
            self.store.spark.createDataFrame(list(missing.items()), f"`{self.store.month}` date, data_version int").coalesce(1).write.mode(
                "append").parquet(f"{self.path}/done")
        return list(missing)

    def query(self, dims: Sequence[str], metrics: Sequence[str], period: dates.Bounds) -> DataFrame:
        """Metrics by some of the dimensions, or the month, for the days from the first up to, not including, the second of
        ``period``."""
        if set(dims) - {*self.dims, self.store.month}:
            raise ValueError(f"totals by {self.dims} cannot answer by {list(dims)}")
        start, end = period
        month = F.col(self.store.month)
        inside = month >= start if end is None else (month >= start) & (F.add_months(month, 1) <= end)
        edges = self.store.read([*self._columns(), self.store.day, self.store.month], period)
        parts = self._parts(edges.where(dates.within(F.col(self.store.day), period) & ~inside))
        versions: dict[int, list[dt.date]] = {}
        for m, k in self.store.months.items():
            versions.setdefault(k.data_version, []).append(m)
        current = reduce(or_, ((F.col("data_version") == v) & month.isin(months) for v, months in versions.items()), F.lit(False))
        for kind, own in parts.items():
            schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema), "data_version int"])
            stored = stored_or_none(self.store.spark, f"{self.path}/{kind}", schema)
            if stored is not None:
                parts[kind] = own.unionByName(stored.where(inside & dates.within_month(month, period) & current).select(own.columns))
        wanted = {name: self.metrics[name] for name in metrics}
        result = parts[SUMS].groupBy(*dims).agg(F.sum("_rows").alias("_rows"), *[F.sum(s).alias(s) for s in self.sums])
        for c in dict.fromkeys(c for m in wanted.values() for c in m.parts.distinct):
            counts = self._counted(parts[c], dims, c).toDF(*[f"_{d}" for d in dims], f"_n_{c}")
            if dims:
                same = reduce(and_, (F.col(d).eqNullSafe(F.col(f"_{d}")) for d in dims))
                result = result.join(counts, same, "left").drop(*[f"_{d}" for d in dims])
            else:
                result = result.withColumn(f"_n_{c}", counts.scalar())
        return result.select(*dims, *[
            m.parts.combine([F.col(f"{name}_{n}") for n in range(len(m.parts.sums))],
                            [F.coalesce(F.col(f"_n_{c}"), F.lit(0)).cast("bigint") for c in m.parts.distinct]).alias(name)
            for name, m in wanted.items()])

    def _columns(self) -> list[str]:
        return list(dict.fromkeys([*self.dims, *(c for m in self.metrics.values() for c in m.columns)]))

    def _parts(self, rows: DataFrame) -> dict[str, DataFrame]:
        """Mergeable parts of rows, by month and dimensions."""
        keys = [self.store.month, *self.dims]
        sums = [F.sum(term(F.lit(None))).alias(name) for name, term in self.sums.items()]
        parts = {SUMS: rows.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias("_rows"))}
        for c in self.distinct:
            known = rows.where(F.col(c).isNotNull())
            if c in self.whole:
                parts[c] = known.groupBy(*keys, F.bitmap_bucket_number(c).alias("_bucket")).agg(
                    F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("_bits"))
            else:
                parts[c] = known.select(*keys, F.col(c).alias("_value")).distinct()
        return parts

    def _counted(self, parts: DataFrame, dims: Sequence[str], column: str) -> DataFrame:
        if column not in self.whole:
            return parts.groupBy(*dims).agg(F.countDistinct("_value"))
        merged = parts.groupBy(*dims, "_bucket").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
        return merged.groupBy(*dims).agg(F.sum("_n"))
