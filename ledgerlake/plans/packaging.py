"""Cleaning of the packaging spreadsheet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.money import grams_to_kg
from ledgerlake.functions.text import contains_space, strip, to_double

# Accepted headings per column, in order of preference.
HEADINGS = {
    "SKU": ["SKU", "sku", "Varenummer"],
    "Packaging - carton (g)": ["Packaging - carton (g)", "carton", "Packaging - carton", "Pap"],
    "Packaging - plastic (g)": ["Packaging - plastic (g)", "plastic", "Packaging - plastic", "Plastik"],
}
SOURCE = "EPR_Upload"


def find_heading(columns: Sequence[str], accepted: Sequence[str]) -> str | None:
    """An exact heading if there is one, else the first column containing an accepted one in any case."""
    exact = next((name for name in accepted if name in columns), None)
    if exact is not None:
        return exact
    lowered = [name.lower() for name in accepted]
    return next((c for c in columns if any(name in c.lower() for name in lowered)), None)


def resolve_headings(columns: Sequence[str]) -> dict[str, str]:
    found = {wanted: find_heading(columns, accepted) for wanted, accepted in HEADINGS.items()}
    missing = [wanted for wanted, heading in found.items() if heading is None]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {list(columns)}")
    return found


def clean_packaging(sheet: DataFrame, uploaded: dt.datetime | str, source: str = SOURCE) -> DataFrame:
    """Kilograms per unit and SKU: heading lines, blanks and 'nan' markers go, unreadable weights become NULL."""
    heading = resolve_headings(sheet.columns)
    sku = strip(F.col(f"`{heading['SKU']}`"))
    carton, plastic = (F.col(f"`{heading[h]}`") for h in list(HEADINGS)[1:])
    return sheet.select(
        sku.alias("sku"), grams_to_kg(to_double(carton)).alias("carton_kg_per_unit"),
        grams_to_kg(to_double(plastic)).alias("plastic_kg_per_unit"),
        F.lit(0).cast("decimal(10,4)").alias("foam_kg_per_unit"),
        F.lit(str(uploaded)).cast("timestamp").alias("date_uploaded"), F.lit(source).alias("source_file"),
    ).filter((F.col("sku") != "") & (F.lower("sku") != "nan") & ~contains_space(F.col("sku")))


def packaging_counts(packaging: DataFrame) -> DataFrame:
    """Rows loaded and rows with a known weight per material."""
    return packaging.agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.count("carton_kg_per_unit").alias("with_carton"),
        F.count("plastic_kg_per_unit").alias("with_plastic"), F.count("foam_kg_per_unit").alias("with_foam"))
