"""A fact stored by month: publishing replaces the months that changed, questions read the months they ask for.

``data/version=<n>/<month>`` has the rows of a month as publication n wrote them, ``manifest/version=<n>`` says which
version of each month holds since publication n, with a digest of its rows. The manifest is written last, so a publication that
fails leaves the store as it was, and a reader keeps the months it has begun with until ``vacuum``. One publisher at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import dates
from ledgerlake.sources.page_index import stored_or_none
from ledgerlake.sources.store import publish_by_month

MANIFEST_SCHEMA = "month date, data_version int, rows bigint, digest string, source string, version int"


@dataclass(frozen=True)
class Month:
    """What the manifest says of a month: the publication that wrote it, and the rows it wrote."""

    data_version: int
    rows: int
    digest: str


class MonthStore:
    """``schema``: the fact's columns. ``day`` gives a row its month; rows without one are not stored."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str = "sale_date", month: str = "sale_month"):
        self.spark, self.path, self.schema, self.day, self.month = spark, path.rstrip("/"), schema, day, month
        self.refresh()

    def refresh(self) -> None:
        """See what others have published since."""
        self.version, self.source, self.months = -1, None, {}
        found = stored_or_none(self.spark, f"{self.path}/manifest", MANIFEST_SCHEMA)
        # A row per month, and one without a month, so that an empty fact has a manifest too.
        for r in [] if found is None else found.where(F.col("version") == found.agg(F.max("version")).scalar()).collect():
            self.version, self.source = r.version, r.source
            if r.month is not None:
                self.months[r.month] = Month(r.data_version, r.rows, r.digest)

    def publish(self, fact: DataFrame, source: str | None = None, touched: DataFrame | None = None) -> list[dt.date]:
        """Replace the months in which ``fact`` differs from the store; returns them.

        ``source`` names the state of the inputs: the same name again publishes nothing, without looking at the fact.
        ``touched`` (one column: first days of months) names the only months that can have changed, so that no others are
        computed; see ``touched_months``. Without it the digests of all months are compared.
        """
        if source is not None and source == self.source:
            return []
        fact = fact.select(self.schema.names).where(F.col(self.day).isNotNull())
        version = self.version + 1
        if not self.months:
            self._write(fact, version)
            new = self._digests(self._read_version(version))
            changed = dict.fromkeys(new)
        else:
            among = None if touched is None else sorted(r[0] for r in touched.distinct().collect() if r[0] is not None)
            new = self._digests(fact if among is None else fact.where(self._within(among)))
            old = {m: known for m, known in self.months.items() if among is None or m in set(among)}
            changed = {m for m in new.keys() | old.keys() if m not in old or new.get(m) != (old[m].rows, old[m].digest)}
            if changed & new.keys():
                self._write(fact.where(self._within(sorted(changed & new.keys()))), version)
        months = {m: known for m, known in self.months.items() if m not in changed}
        months |= {m: Month(version, *new[m]) for m in changed if m in new}
        self._commit(version, source, months)
        return sorted(changed)

    def add(self, fact: DataFrame, months: Iterable[dt.date]) -> list[dt.date]:
        """Store those of ``months`` (first days) that the store lacks; returns the ones with rows.

        A question on a period so pays for the months it reads. Months the store has are not compared: that is ``publish``.
        """
        missing = sorted(set(months) - self.months.keys())
        if not missing:
            return []
        version = self.version + 1
        self._write(fact.select(self.schema.names).where(self._within(missing)), version)
        new = self._digests(self._read_version(version))
        self._commit(version, self.source, self.months | {m: Month(version, *found) for m, found in new.items()})
        return sorted(new)

    def read(self, columns: Iterable[str], period: dates.Bounds | None = None) -> DataFrame:
        """Columns of the fact, or its month; with a period, of the months it touches."""
        rows = self._read_paths([f"{self.path}/data/version={k.data_version}/{self.month}={m}" for m, k in sorted(self.months.items())])
        if period is not None:
            rows = rows.where(dates.within_month(F.col(self.month), period))
        return rows.select(*columns)

    def touched_months(self, invoices: DataFrame, lines: DataFrame, since: dt.datetime | str, key: str = "invoice_id") -> DataFrame:
        """Months of invoices that a load since ``since`` has brought or changed, by header or line: those the invoices are in now and
        those the store has them in. Changes of customers or products are not seen here."""
        new = F.col("api_timestamp") >= F.lit(since).cast("timestamp")
        changed = invoices.where(new).select("invoice_number").unionByName(lines.where(new).select("invoice_number")).distinct()
        now = invoices.join(changed, "invoice_number", "left_semi").select(F.trunc("invoice_date", "MONTH").alias("month"))
        before = self.read([F.col(key).alias("invoice_number"), F.col(self.month).alias("month")]).join(
            changed, "invoice_number", "left_semi").select("month")
        return now.unionByName(before).where(F.col("month").isNotNull()).distinct()

    def vacuum(self) -> list[int]:
        """Remove what publications have replaced; nobody may still read it. Returns the versions with anything removed."""
        jvm, removed = self.spark._jvm, set()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        current = {(k.data_version, f"{self.month}={m}") for m, k in self.months.items()}
        for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"data/version=*/{self.month}=*")) or ():
            folder = status.getPath()
            version = int(folder.getParent().getName().split("=")[1])
            if (version, folder.getName()) not in current:
                fs.delete(folder, True)
                removed.add(version)
        return sorted(removed)

    def _commit(self, version: int, source: str | None, months: dict[dt.date, Month]) -> None:
        rows = [(m, k.data_version, k.rows, k.digest, source) for m, k in months.items()] + [(None, None, None, None, source)]
        table = self.spark.createDataFrame(rows, "month date, data_version int, rows bigint, digest string, source string")
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
        self.version, self.source, self.months = version, source, months

    def _within(self, months: Sequence[dt.date]) -> Column:
        """Rows of these months, as ranges on the day that a scan can use; months that follow each other are one range."""
        ranges: list[list[dt.date]] = []
        for m in months:
            after = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
            if ranges and ranges[-1][1] == m:
                ranges[-1][1] = after
            else:
                ranges.append([m, after])
        return reduce(or_, (dates.within(F.col(self.day), (F.lit(a), F.lit(b))) for a, b in ranges), F.lit(False))

    def _write(self, fact: DataFrame, version: int) -> None:
        publish_by_month(fact, f"{self.path}/data/version={version}", self.day, self.month)

    def _digests(self, rows: DataFrame) -> dict[dt.date, tuple[int, str]]:
        """Number of rows and digest per month; a digest does not depend on the order of rows."""
        row = F.xxhash64(*self.schema.names)
        found = rows.groupBy(F.trunc(F.col(self.day), "MONTH").alias("month")).agg(
            F.count(F.lit(1)).alias("rows"), F.concat_ws(":", F.sum(row.cast("decimal(20,0)")), F.bit_xor(row)).alias("digest"))
        return {r.month: (r.rows, r.digest) for r in found.collect()}

    def _read_version(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/version={version}")

    def _read_paths(self, paths: list[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(self.month, T.DateType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("version", T.IntegerType())])
        return self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths)
