"""Amounts and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_base_currency(amount: Column, rate: Column, scale: int = 2) -> Column:
    """Amount in base currency; rates are per 100 units and a missing one means base currency."""
    return F.round(amount * (F.coalesce(rate, F.lit(100.0)) / F.lit(100)), scale)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is 0."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def percent_change(new: Column, old: Column) -> Column:
    return guarded_ratio(new - old, old) * 100


def grams_to_kg(grams: Column) -> Column:
    return (grams / 1000).try_cast("decimal(10,4)")
