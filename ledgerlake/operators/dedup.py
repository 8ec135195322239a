"""Latest-wins and first-match picks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``; NULL keys form one group.

    ``row_number = 1`` lets Spark cut every map partition to one row per key before the shuffle, so a key that
    holds a large share of the rows does not reach one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(and_, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)))


def _loose_pairs(df: DataFrame, groups: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """(key, ts) pairs that may equal the newest of some other key because of a NULL in either.

    Two keys may be equal if they agree in the columns known on both sides. So each pair looks up every set of columns that a
    group may know, each group answers every set that a pair may know, and both write NULL in what either lacks: one
    equi-join by those sets, the common values and the time. Only data with NULL keys has such pairs at all.
    """
    sets = range(1 << len(keys))
    known = reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.col(k).isNotNull(), 1 << n).otherwise(0) for n, k in enumerate(keys)))
    names = [f"_v{n}" for n in range(len(keys))]

    def common(other: str) -> list[Column]:
        return [F.when((F.col("_own").bitwiseAND(1 << n) != 0) & (F.col(other).bitwiseAND(1 << n) != 0), F.col(k)).alias(v)
                for n, (k, v) in enumerate(zip(keys, names))]

    any_null = reduce(or_, (F.col(k).isNull() for k in keys))
    # Without NULL keys anywhere no pair passes, and what follows has no rows.
    nulls = df.agg(F.coalesce(F.bool_or(any_null), F.lit(False))).scalar()
    pairs = df.where(F.col(ts).isNotNull() & nulls).select(*keys, ts).distinct()
    asked = pairs.withColumn("_own", known).withColumn("_group", F.explode(F.array(*map(F.lit, sets)))).where(
        f"_own & _group != {len(sets) - 1}").withColumn("_at", F.explode(F.array(F.col(ts), F.lit(None)))).select(
        *keys, ts, F.col("_own").alias("_pair"), "_group", F.col("_at"), *common("_group"))
    answers = groups.withColumn("_own", known).withColumn("_pair", F.explode(F.array(*map(F.lit, sets)))).select(
        F.col("_pair").alias("_a_pair"), F.col("_own").alias("_a_group"), F.col("_newest").alias("_a_at"),
        *[c.alias(f"_a{c_name}") for c, c_name in zip(common("_pair"), names)]).distinct()
    theirs = ["_pair", "_group", "_at", *names]
    found = asked.join(answers, _null_safe(theirs, [f"_a{c}" for c in theirs]), "left_semi")
    return found.select(*keys, ts).distinct()


def _kept_pairs(df: DataFrame, keys: Sequence[str], ts: str) -> tuple[DataFrame, Column]:
    """The (key, ts) pairs, with known ``ts``, that are or may be the newest of a key; and the join with them."""
    groups = df.groupBy(*keys).agg(F.max(ts).alias("_newest"))
    newest = groups.where(F.col("_newest").isNotNull()).select(*keys, F.col("_newest").alias(ts))
    names = [f"_k_{n}" for n in range(len(keys) + 1)]
    kept = newest.unionByName(_loose_pairs(df, groups, keys, ts)).toDF(*names)
    return kept, _null_safe([*keys, ts], names)


def retain_latest(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """What stays after deleting every row whose (key, ``ts``) is NOT IN the (key, newest ``ts``) pairs of all keys; all rows of
    a tied newest ``ts`` stay.

    As in SQL, a comparison with a NULL is neither true nor false and deletes nothing: rows without ``ts`` stay, and so do rows that
    differ from a pair only where a NULL stands on either side.
    """
    dated = df.where(F.col(ts).isNotNull())
    return dated.join(*_kept_pairs(df, keys, ts), "left_semi").unionByName(df.where(F.col(ts).isNull()))


def superseded(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The rows a retention pass deletes: exactly those ``retain_latest`` does not keep."""
    return df.where(F.col(ts).isNotNull()).join(*_kept_pairs(df, keys, ts), "left_anti")


def top_per_group(
    df: DataFrame, group: Sequence[str], member: Sequence[str], measure: Column, k: int, top_groups: int | None = None,
) -> DataFrame:
    """The k best members of each group by summed measure, optionally only in the best groups.

    Everything is summed per (group, member) first, so ranking sees one row per member.
    """
    totals = df.groupBy(*group, *member).agg(F.sum(measure).alias("total"))
    if top_groups is not None:
        best = (totals.groupBy(*group).agg(F.sum("total").alias("_group_total"))
                .orderBy(F.desc_nulls_last("_group_total"), *[F.asc_nulls_last(g) for g in group])
                .limit(top_groups))
        totals = totals.join(F.broadcast(best.select(*group)), list(group), "left_semi")
    window = Window.partitionBy(*group).orderBy(F.desc_nulls_last("total"), *[F.asc_nulls_last(m) for m in member])
    return totals.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
