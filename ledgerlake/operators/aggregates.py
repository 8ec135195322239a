"""Aggregates that stay distributed when one group is large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.money import guarded_ratio


def mode_per_key(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-NULL value per key, the smallest on a tie; NULL for keys with NULLs only.

    Counts per (key, value) first: no task holds all values of a key.
    """
    counts = df.groupBy(*keys, value).agg(F.count(value).alias("_n"))
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))))
    return counts.groupBy(*keys).agg(best.alias("_best")).select(*keys, F.col("_best.v").alias(name))


def joined_text(value: str, order: Sequence[str], separator: str = " / ") -> Column:
    """Ordered concatenation; a group of NULLs gives an empty text."""
    by = ", ".join(order)
    return F.coalesce(F.expr(f"listagg({value}, '{separator}') within group (order by {by})"), F.lit(""))


def joined_in_pieces(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], name: str, separator: str = " / ", piece: int = 1024,
    **others: tuple[Column, Column],
) -> DataFrame:
    """``joined_text`` per key where one key may have very many values: pieces of neighbouring values are joined by tasks of
    their own, and the key's task joins the pieces.

    The last column of ``order`` is a whole number; a piece holds the values of ``piece`` neighbouring numbers under equal columns
    before it, so it is bounded where the numbers of a key differ. NULL numbers form one piece, the first. ``others`` maps further
    result names to (aggregate of a piece, aggregate of its results, found under the same name).
    """
    *before, last = order
    at = F.floor(F.col(last) / piece).alias("_piece")
    pieces = df.groupBy(*keys, *before, at).agg(
        F.expr(f"listagg({value}, '{separator}') within group (order by {last})").alias("_text"),
        *[inner.alias(other) for other, (inner, _) in others.items()])
    return pieces.groupBy(*keys).agg(
        joined_text("_text", [*before, "_piece"], separator).alias(name), *[outer.alias(other) for other, (_, outer) in others.items()])


def share_of_total(
    df: DataFrame, keys: Sequence[str], measures: dict[str, tuple[Column, str]], scale: int = 2,
) -> DataFrame:
    """Grouped aggregates with their percentage of the grand total.

    ``measures`` maps a result name to (aggregate, name of its percentage column). The grand totals are a one-row
    subquery over the same grouped result, whose exchange Spark reuses; groups are never gathered into one task.
    """
    grouped = df.groupBy(*keys).agg(*[agg.alias(name) for name, (agg, _) in measures.items()])
    totals = grouped.agg(F.struct(*[F.sum(name).cast("double").alias(name) for name in measures])).scalar()
    shares = [F.round(guarded_ratio(F.col(name) * 100.0, totals.getField(name)), scale).alias(share)
              for name, (_, share) in measures.items()]
    return grouped.select(*keys, *measures, *shares)


def sum_if(condition: Column, amount: Column) -> Column:
    """Conditional sum; rows outside count as 0."""
    return F.sum(F.when(condition, amount).otherwise(F.lit(0.0)))


def row_count() -> Column:
    return F.count(F.lit(1))
