from __future__ import annotations

import decimal

import pytest
from helpers import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.operators import variants as v


def test_paths_are_case_sensitive_and_missing_is_null(raw):
    pages = raw("REST", ("2025-01-01 00:00:00", "e", 0, {"collection": [{"a": {"b": {"c": 7}}, "A": 1}]}))
    got = v.flatten(pages, "e", "$.collection", {"deep": ("$.a.b.c", "bigint"), "upper": ("$.A", "bigint"),
                                                 "none": ("$.a.B.c", "bigint")})
    assert rows(got, "deep", "upper", "none") == [(7, 1, None)]


def test_whole_number_money_rounds_half_up(raw):
    pages = raw("REST", ("2025-01-01 00:00:00", "e", 0, {"collection": [{"p": 2.5}, {"p": 2.49}, {"p": -2.5}]}))
    got = v.flatten(pages, "e", "$.collection", {"p": ("$.p", "decimal(38,0)")})
    assert sorted(r.p for r in got.collect()) == [decimal.Decimal(-3), decimal.Decimal(2), decimal.Decimal(3)]


def test_strict_raises_and_lenient_gives_null(raw):
    pages = raw("REST", ("2025-01-01 00:00:00", "e", 0, {"collection": [{"n": "many"}]}))
    fields = {"n": ("$.n", "bigint")}
    with pytest.raises(PySparkException):
        v.flatten(pages, "e", "$.collection", fields).collect()
    assert rows(v.flatten(pages, "e", "$.collection", fields, lenient=True), "n") == [(None,)]


def test_flatten_drops_or_keeps_pages_without_array(raw):
    pages = raw("REST", ("2025-01-01 00:00:00", "e", 0, {"collection": []}), ("2025-01-01 00:00:00", "e", 1, {"other": 1}),
                ("2025-01-01 00:00:00", "e", 2, {"collection": [{"n": 1}]}), ("2025-01-01 00:00:00", "f", 2, {"collection": [{"n": 9}]}))
    fields = {"n": ("$.n", "bigint")}
    assert rows(v.flatten(pages, "e", "$.collection", fields), "n", "page_number", "position") == [(1, 2, 0)]
    assert rows(v.flatten(pages, "e", "$.collection", fields, outer=True), "n", "page_number") == [
        (1, 2), (None, 0), (None, 1)]


def test_page_fields_travel_with_elements(raw):
    pages = raw("OPENAPI", ("2025-01-01 00:00:00", "e", 0, {"cursor": "x_1", "items": [{"n": 1}, {"n": 2}]}))
    got = v.flatten(pages, "e", "$.items", {"n": ("$.n", "bigint")}, keep={"cursor": ("$.cursor", "string")})
    assert rows(got, "cursor", "n") == [("x_1", 1), ("x_1", 2)]


def test_nested_flatten_keeps_childless_parents(raw):
    pages = raw("SHOP", ("2025-01-01 00:00:00", "c", 0, {"combinations": [
        {"id": 1, "o": {"v": [{"id": 5}, {"id": 6}]}}, {"id": 2}, {"id": 3, "o": {"v": []}}]}))
    got = v.flatten_nested(pages, "c", "$.combinations", {"id": ("$.id", "bigint")}, "$.o.v", {"opt": ("$.id", "bigint")})
    assert rows(got, "id", "opt") == [(1, 5), (1, 6), (2, None), (3, None)]


def test_record_count_takes_first_key_present(raw):
    pages = raw("SHOP", ("2025-01-01 00:00:00", "products", 0, {"products": [{}, {}], "categories": [{}]}),
                ("2025-01-01 00:00:00", "categories", 0, {"categories": [{}]}), ("2025-01-01 00:00:00", "x", 0, {"y": 1}))
    assert rows(pages, "api_endpoint", "record_count_per_page") == [("categories", 1), ("products", 2), ("x", 0)]


def test_text_round_trip(spark):
    df = spark.createDataFrame([('{"b": 1, "a": [true, null]}',)], "j string").select(v.parse(F.col("j")).alias("j"))
    assert df.select(v.to_text(F.col("j"))).first()[0] == '{"a":[true,null],"b":1}'
    bad = spark.createDataFrame([("{",)], "j string")
    assert bad.select(v.parse(F.col("j"), lenient=True).alias("j")).filter("j is null").count() == 1


def test_flat_fields_are_read_out_of_the_page_at_once(raw):
    """As typed structs; elements that are no objects, and pages without an array, give what single reads give."""
    fields = {"n": ("$.n", "bigint"), "t": ("$.t", "string"), "d": ("$.d", "decimal(38,0)")}
    at = "2025-01-01 00:00:00"
    pages = raw("REST", (at, "e", 0, {"c": [{"n": "5", "t": {"a": 1}, "d": 2.5}, {"N": 1, "t": 7}]}), (at, "e", 1, {"c": [None, 3, [{"n": 1}], {"n": 9}]}),
                (at, "e", 2, {"c": {"n": 1}}), (at, "e", 3, {"c": "x"}), (at, "e", 4, [1]))
    flat = v.flatten(pages, "e", "$.c", fields)
    assert "StructField(n,LongType,true),StructField(t,StringType,true)" in plan(flat)
    assert rows(flat, "page_number", "position", "n", "t", "d") == [
        (0, 0, 5, '{"a":1}', decimal.Decimal(3)), (0, 1, None, "7", None), (1, 0, None, None, None), (1, 1, None, None, None),
        (1, 2, None, None, None), (1, 3, 9, None, None)]
    assert rows(v.flatten(pages, "e", "$.c", fields, outer=True), "page_number", "n")[-3:] == [(2, None), (3, None), (4, None)]
    with pytest.raises(PySparkException):
        v.flatten(raw("REST", (at, "e", 0, {"c": [3, {"n": "many"}]})), "e", "$.c", fields).collect()
    # Two keys that differ in case only have no struct that tells them apart.
    both = v.flatten(raw("REST", (at, "e", 0, {"c": [{"n": 1, "N": 2}]})), "e", "$.c", {"a": ("$.n", "bigint"), "b": ("$.N", "bigint")})
    assert rows(both, "a", "b") == [(1, 2)]
