"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.lookups import COLOUR_SUFFIX


def blank_to_null(col: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def normalise_sku(col: Column) -> Column:
    return F.upper(F.trim(col))


def strip(col: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def core_name(*names: Column) -> Column:
    """First known name without its colour suffix."""
    return F.regexp_replace(F.coalesce(*names), COLOUR_SUFFIX, "")


def null_tokens(col: Column, tokens: tuple[str, ...] = ("NULL", "null", "")) -> Column:
    """File markers for a missing value become NULL."""
    return F.when(col.isin(*tokens), F.lit(None)).otherwise(col)


def to_number(col: Column) -> Column:
    """Whole number of up to 38 digits from text, NULL when it is not one (fractions round half up)."""
    return col.try_cast("decimal(38,0)")


def to_double(col: Column) -> Column:
    """Double from text, NULL when it is not a number."""
    parsed = col.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def money_text(col: Column) -> Column:
    """Amount with thousands separators and two decimals."""
    return F.format_number(col, 2)


def contains_space(col: Column) -> Column:
    return F.contains(col, F.lit(" "))
