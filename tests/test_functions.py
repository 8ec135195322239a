from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerlake.functions import dates, lookups, money, text


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column).first()[0]


@pytest.mark.parametrize("given,want", [
    ("Walk Harness : Color - Red", "Walk Harness"), ("Sele - Farve : Blå / M", "Sele"), ("Halsband - Färg : Röd", "Halsband"),
    ("Leash - Colour : Black", "Leash"), ("Leash - Color : Black - more", "Leash"), ("Plain", "Plain"),
])
def test_colour_suffix(spark, given, want):
    assert one(spark, text.core_name(F.col("x")), x=given) == want


@pytest.mark.parametrize("given,number,double", [
    ("12", 12, 12.0), (" 12.6 ", 13, 12.6), ("abc", None, None), ("", None, None), ("nan", None, None), ("1e2", 100, 100.0)])
def test_number_parsing(spark, given, number, double):
    assert one(spark, text.to_number(F.col("x")), x=given) == number
    assert one(spark, text.to_double(F.col("x")), x=given) == double


@pytest.mark.parametrize("amount,rate,want", [
    (33.56, 744.859813, 249.97), (6.03, 744.859813, 44.92), (10.0, None, 10.0), (10.0, 100.0, 10.0), (2.675, 100.0, 2.68)])
def test_base_currency(spark, amount, rate, want):
    got = one(spark, money.to_base_currency(F.col("a"), F.col("r").cast("double")), a=amount, r=rate)
    assert got == want


def test_ratio_guards(spark):
    assert one(spark, money.guarded_ratio(F.col("a"), F.col("b")), a=1.0, b=0.0) is None
    assert one(spark, money.percent_change(F.col("a"), F.col("b")), a=15.0, b=10.0) == 50.0
    assert str(one(spark, money.grams_to_kg(F.col("g")), g=1234.56)) == "1.2346"


def test_money_text_has_no_upper_limit(spark):
    assert one(spark, text.money_text(F.col("x")), x=12345678.9) == "12,345,678.90"


@pytest.mark.parametrize("as_of,offset,month,quarter,year", [
    ("2025-03-31", 0, ("2025-03-01", "2025-03-31"), ("2025-01-01", "2025-03-31"), ("2025-01-01", "2025-12-31")),
    ("2025-03-31", -1, ("2025-02-01", "2025-02-28"), ("2024-10-01", "2024-12-31"), ("2024-01-01", "2024-12-31")),
    ("2025-01-05", -1, ("2024-12-01", "2024-12-31"), ("2024-10-01", "2024-12-31"), ("2024-01-01", "2024-12-31")),
])
def test_calendar_periods(spark, as_of, offset, month, quarter, year):
    days = spark.sql("select explode(sequence(date'2023-12-01', date'2026-01-31')) d")
    for period, (first, last) in ((dates.month_of, month), (dates.quarter_of, quarter), (dates.year_of, year)):
        found = days.filter(dates.within(F.col("d"), period(dates.as_of_date(as_of), offset))).agg(F.min("d"), F.max("d")).first()
        assert (str(found[0]), str(found[1])) == (first, last)


def test_truncate_gives_dates(spark):
    day = F.lit("2025-05-14").cast("date")
    got = spark.range(1).select(*[dates.truncate(day, g).alias(g) for g in dates.GRAINS]).first().asDict()
    want = {"day": "2025-05-14", "week": "2025-05-12", "month": "2025-05-01", "quarter": "2025-04-01", "year": "2025-01-01"}
    assert {k: str(v) for k, v in got.items()} == want and isinstance(got["month"], dt.date)


def test_country_table_is_a_function_of_the_spelling(spark):
    table = lookups.country_table(spark)
    assert table.count() == table.select("spelling").distinct().count() == sum(map(len, lookups.COUNTRY_SPELLINGS.values()))
    assert len(lookups.COUNTRY_SPELLINGS) == 32
    assert rows(table.filter("spelling in ('DK', 'Denmark', 'France', 'FR')"), "spelling", "standard_country",
                "spelling_market", "standard_market") == [
        ("DK", "Denmark", None, "Nordics"), ("Denmark", "Denmark", "Nordics", "Nordics"),
        ("FR", "France", None, "Western Europe"), ("France", "France", "Western Europe", "Western Europe")]
