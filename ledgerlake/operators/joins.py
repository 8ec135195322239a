"""Lookup joins and audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """The lookup side of a many-to-one join has a key twice."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a non-NULL key occurs more than once; at most one row comes back."""
    present = df.select(*keys).dropna(how="any")
    repeated = present.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise DuplicateKeyError(f"{list(keys)} repeats: {repeated[0].asDict()}")


def many_to_one(left: DataFrame, right: DataFrame, on: Sequence[str], check: bool = False) -> DataFrame:
    """Left lookup join that keeps the left row count; ``check`` verifies the right key first, which costs a job.

    No broadcast hint: Spark broadcasts the right side when its measured size is under the threshold and otherwise
    shuffles both, splitting a hot key on the left at run time.
    """
    if check:
        assert_unique(right, on)
    return left.join(right, list(on), "left")


def lookup_where(left: DataFrame, right: DataFrame, left_key: str, right_key: str, usable: Column) -> DataFrame:
    """Left join with a condition on the right side only: the parent row stays, the match is suppressed.

    The condition is applied before the join; for a one-sided condition both forms give the same rows.
    """
    return left.join(right.filter(usable), left[left_key] == right[right_key], "left")


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows without partner."""
    return left.join(right, list(on), "left_anti")


def matched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left_semi")
