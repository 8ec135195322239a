from __future__ import annotations

import pytest
from helpers import rows
from fixtures import EXPIRED_ROWS, EXPIRED_SCHEMA, SHOP_PAGES
from pyspark.sql import functions as F

from ledgerlake.plans import dims
from ledgerlake.plans.expired import expired_catalogue


@pytest.fixture(scope="module")
def expired(spark):
    return expired_catalogue(spark.createDataFrame(EXPIRED_ROWS, EXPIRED_SCHEMA))


@pytest.fixture
def dim(raw, expired):
    return dims.dim_product_sku(dims.shop_catalogue(raw("SHOP", *SHOP_PAGES), expired))


def test_expired_ids_are_shared_negative_and_gap_free(expired):
    products = rows(expired.products, "product_id", "product_name", "id_category_default")
    assert products == [(-3, None, None), (-2, "Leash", 7), (-1, "Bowl", 8)]
    combos = rows(expired.combinations, "combination_id", "product_id", "sku", "ean13")
    assert combos == [(-4, -3, "EXP3", None), (-3, -2, "EXP2", None), (-2, -3, "A1", "59"), (-1, -2, "EXP1", "58")]


def test_expired_options_have_one_id_per_value(expired):
    assert rows(expired.option_values, "option_value_id", "option_group_id", "option_value_name") == [
        (-20002, 2, "Red"), (-20001, 2, "Blue"), (-10002, 1, "M"), (-10001, 1, "L")]
    ids = {r.sku: r.combination_id for r in expired.combinations.collect()}
    assert rows(expired.combination_options.filter(F.col("combination_id") == ids["EXP1"]), "option_value_id") == [
        (-20002,), (-10002,)]
    assert rows(expired.combination_options.filter(F.col("combination_id") == ids["EXP3"]), "option_value_id") == [(-20002,)]


def test_expired_categories_are_distinct(expired):
    assert rows(expired.categories, "category_id", "category_name_da", "parent_category_id", "level_depth") == [
        (7, "Leads", 2, 1), (8, None, 2, 1), (None, "Odd", 2, 1)]


def test_sku_dimension(dim):
    got = {(r.sku, r.combination_id > 0): r for r in dim.collect()}
    assert {k for k, _ in got} == {"A1", "B1", "C1", "EXP1", "EXP2", "EXP3"}
    first = got["A1", True]
    assert (first.product_name, first.category_name, first.category_level, first.product_active) == ("Harness", "Harnesses", 3, True)
    assert (first.size, first.color, first.all_attributes) == ("S", "Black", "S / M / Black / Soft")
    assert (int(first.price_impact), first.stock_quantity) == (3, 4)
    shop = got["B1", True]
    assert (shop.product_name, shop.category_id, shop.category_name) == ("Mystery", None, "Uncategorized")
    assert (shop.size, shop.all_attributes) == (None, None)
    assert got["C1", True].product_name == "Unknown Product"
    old = got["EXP1", False]
    assert (old.product_name, old.category_name, old.size, old.color, old.product_active) == ("Leash", "Leads", "M", "Red", False)


def test_enriched_dimension_has_every_invoiced_sku_once_and_prefers_active(spark, dim):
    lines = spark.createDataFrame(
        [("A1", "x"), ("A1", "y"), ("A1", "y"), ("Z9", "often"), ("Z9", "often"), ("Z9", "rare"), ("N0", None), (None, "gone")],
        "sku string, line_description string")
    got = {r.sku: r for r in dims.dim_product_sku_enriched(lines, dim).collect()}
    assert set(got) == {"A1", "Z9", "N0"}
    assert got["A1"].combination_id == 100 and got["A1"].has_prestashop_data and not got["A1"].is_economic_only
    assert (got["Z9"].product_name, got["Z9"].product_id, got["Z9"].is_economic_only) == ("often", -1, True)
    assert got["N0"].product_name == "Unknown Product" and got["N0"].category_name is None


def test_master_views(spark, dim):
    master = dims.product_master(dims.dim_product_sku_enriched(
        spark.createDataFrame([("A1", "x")], "sku string, line_description string"), dim))
    assert len(master.columns) == 17
    assert rows(master, "product_sku", "variant_id", "is_active", "all_attributes_text") == [
        ("A1", 100, True, "S / M / Black / Soft")]
    customers = spark.createDataFrame([(1, 1), (2, 2), (3, 0), (4, None)], "customer_number bigint, customer_group_number bigint")
    for column in ("customer_name", "city", "country", "email", "telephone", "mobile_phone", "currency"):
        customers = customers.withColumn(column, F.lit(None).cast("string"))
    for column in ("payment_terms_number", "vatzone_number", "salesperson_employee_number", "last_updated"):
        customers = customers.withColumn(column, F.lit(None).cast("bigint"))
    view = dims.customer_master(customers)
    assert len(view.columns) == 14
    assert rows(view, "customer_id", "customer_segment", "customer_city") == [
        (1, "B2C", "Unknown"), (2, "B2B", "Unknown"), (3, "Unknown", "Unknown"), (4, "Unknown", "Unknown")]


def test_categories_are_planned_without_a_job(spark, raw):
    pages = raw("SHOP", *SHOP_PAGES)
    listed = spark.createDataFrame(EXPIRED_ROWS, EXPIRED_SCHEMA)
    context = spark.sparkContext
    context.setJobGroup("planning categories", "")
    try:
        shop = dims.shop_catalogue(pages, expired_catalogue(listed))
        assert shop.categories.columns
        assert not context.statusTracker().getJobIdsForGroup("planning categories")
        assert shop.option_values.columns
        assert context.statusTracker().getJobIdsForGroup("planning categories")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
