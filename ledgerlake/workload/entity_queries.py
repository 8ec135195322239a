"""Queries on entities: bronze, expired-SKU synthesis, SKU dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import keys
from ledgerlake.plans import bronze, dims, expired, reports
from ledgerlake.plans.facts import sales_detail
from ledgerlake.plans.views import register_views
from ledgerlake.workload import standins as st
from ledgerlake.workload.end_to_end import LINE_TIES, full_warehouse
from ledgerlake.workload.registry import query
from ledgerlake.workload.sql_parts import (
    ADJUSTMENTS, COUNTRY_CASE, INVOICES, LINE_FIELDS, LINES, PACKAGING, currency, pick, rate, with_parts,
)

FIRST, SECOND = f"'{st.FIRST_LOAD}'", f"'{st.SECOND_LOAD}'"
NO_NUMBER, NO_TEXT, NO_AMOUNT = "CAST(NULL AS BIGINT)", "CAST(NULL AS VARCHAR)", "CAST(NULL AS DOUBLE)"

# --- ERP entities ---------------------------------------------------------------------------------------------------


@query("brz1_customers", f"""
SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN {SECOND} ELSE {FIRST} END AS api_timestamp,
       c_custkey AS customer_number, c_name AS customer_name,
       CAST(c_nationkey % 3 AS BIGINT) AS customer_group_number, {currency('c_nationkey')} AS currency,
       CAST(c_nationkey % 4 AS BIGINT) AS vatzone_number, CAST(round(c_acctbal) AS BIGINT) AS balance,
       {NO_NUMBER} AS due_amount, 'NATION_' || c_nationkey AS country, 'Main Street' AS address,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'New Town' ELSE 'Old Town' END AS city, {NO_TEXT} AS zip,
       lower(c_mktsegment) || '@example.com' AS email, {NO_TEXT} AS mobile_phone, {NO_TEXT} AS telephone,
       CAST(c_nationkey % 10 AS BIGINT) AS salesperson_employee_number,
       CAST(c_nationkey % 3 AS BIGINT) AS payment_terms_number, {NO_NUMBER} AS attention_contact_number,
       {NO_NUMBER} AS customer_contact_number,
       CAST(DATE '2024-01-01' + c_nationkey AS VARCHAR) || ' 08:00:00' AS last_updated
FROM customer""")
def brz1(spark, sf):
    return bronze.customers(st.raw(st.customer_pages(spark, sf), "REST"))


@query("brz2_products", f"""
SELECT CASE WHEN p_type = 'PROMO' THEN {SECOND} ELSE {FIRST} END AS api_timestamp, 'SKU' || p_partkey AS sku,
       CASE WHEN p_type = 'PROMO' THEN upper(p_name) ELSE p_name END AS product_name, p_type AS description,
       CAST(round(p_retailprice) AS BIGINT) AS sales_price, {NO_NUMBER} AS recommended_price,
       {NO_NUMBER} AS cost_price, p_size > 45 AS barred, CAST(length(p_type) AS BIGINT) AS product_group_number,
       p_type AS product_group_name, p_size % 2 = 0 AS inventory_enabled, 'stk.' AS unit_name,
       CAST(1 AS BIGINT) AS unit_number, '2024-01-15 08:00:00' AS last_updated
FROM part""")
def brz2(spark, sf):
    return bronze.products(st.raw(st.product_pages(spark, sf), "REST"))


@query("brz3_invoices", f"""
SELECT CASE WHEN o_orderstatus = 'P' THEN {SECOND} ELSE {FIRST} END AS api_timestamp, o_orderkey AS invoice_number,
       CASE WHEN o_totalprice >= 2000 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS invoice_date,
       CASE WHEN o_totalprice >= 2000 THEN CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) END AS due_date,
       o_custkey AS customer_number, {currency('o_orderkey')} AS invoice_currency,
       {rate('o_orderkey')} AS exchange_rate, round(o_totalprice, 6) AS net_amount,
       {NO_AMOUNT} AS net_amount_base_currency, {NO_AMOUNT} AS gross_amount, {NO_AMOUNT} AS gross_amount_base_currency,
       {NO_AMOUNT} AS vat_amount, {NO_AMOUNT} AS rounding_amount,
       CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE round(o_totalprice, 6) END AS remainder,
       {NO_AMOUNT} AS remainder_base_currency, {NO_TEXT} AS delivery_address, {NO_TEXT} AS delivery_city,
       {pick('o_custkey', st.DELIVERY_COUNTRIES)} AS delivery_country, {NO_TEXT} AS delivery_zip,
       {NO_NUMBER} AS delivery_location_number, {NO_TEXT} AS recipient_name, {NO_TEXT} AS recipient_address,
       {NO_TEXT} AS recipient_city, {pick('o_orderkey', st.RECIPIENT_COUNTRIES)} AS recipient_country,
       {NO_TEXT} AS recipient_zip, o_orderkey % 3 AS recipient_vatzone_number,
       o_orderkey % 11 AS sales_person_employee_number, o_orderkey % 13 AS customer_contact_number,
       o_orderkey % 4 AS payment_terms_number, CAST(30 AS BIGINT) AS payment_days_of_credit,
       {NO_NUMBER} AS layout_number, o_orderkey AS order_number
FROM orders""", scale=6)
def brz3(spark, sf):
    return bronze.invoices(st.raw(st.invoice_pages(spark, sf), "REST"))


@query("brz4_invoice_lines", f"""
WITH versions AS (
  SELECT {LINE_FIELDS}, CASE WHEN l_linestatus = 'O' THEN {SECOND} ELSE {FIRST} END AS api_timestamp FROM lineitem),
newest AS (
  SELECT * FROM versions QUALIFY row_number() OVER (
    PARTITION BY invoice_number, line_number
    ORDER BY api_timestamp DESC, {', '.join(f'{c} DESC NULLS LAST' for c in LINE_TIES)}) = 1),
rated AS (
  SELECT newest.*, {currency('o_orderkey')} AS invoice_currency, {rate('o_orderkey')} AS exchange_rate
  FROM newest LEFT JOIN orders ON invoice_number = o_orderkey)
SELECT api_timestamp, invoice_number, line_number, line_number AS line_number_ui, sku, line_description, quantity,
       invoice_currency, exchange_rate, unit_net_price, unit_cost_price, line_net_amount,
       round(unit_net_price * (coalesce(exchange_rate, 100.0) / 100), 2) AS unit_net_price_base_currency,
       round(unit_cost_price * (coalesce(exchange_rate, 100.0) / 100), 2) AS unit_cost_price_base_currency,
       round(line_net_amount * (coalesce(exchange_rate, 100.0) / 100), 2) AS line_net_amount_base_currency,
       discount_percentage, vat_rate, {NO_AMOUNT} AS vat_amount
FROM rated""", scale=6)
def brz4(spark, sf):
    return bronze.invoice_lines(st.bulk_raw(spark, sf), st.raw(st.invoice_pages(spark, sf), "REST"), ties=LINE_TIES)


def _pages_sql(endpoint: str, at: str, key: str, source: str) -> str:
    return (f"SELECT '{endpoint}' AS api_endpoint, {at} AS loaded, CAST(floor({key} / 1000) AS BIGINT) AS page, "
            f"count(*) AS n FROM {source} GROUP BY 3")


REST_PAGES_SQL = " UNION ALL ".join([
    _pages_sql("customers", FIRST, "c_custkey", "customer"),
    _pages_sql("customers", SECOND, "c_custkey", "(FROM customer WHERE c_mktsegment = 'BUILDING')"),
    _pages_sql("products", FIRST, "p_partkey", "part"),
    _pages_sql("products", SECOND, "p_partkey", "(FROM part WHERE p_type = 'PROMO')"),
    _pages_sql("invoices/booked", FIRST, "o_orderkey", "orders"),
    _pages_sql("invoices/booked", SECOND, "o_orderkey", "(FROM orders WHERE o_orderstatus = 'P')"),
])
_BRANDS = "(SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS b FROM part)"
_VALUES = ("(SELECT DISTINCT 100 + p_size AS id FROM part UNION ALL SELECT 2000 + ascii(w) "
           "FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part))")
SHOP_PAGES_SQL = " UNION ALL ".join([
    _pages_sql("products", FIRST, "b", _BRANDS), _pages_sql("products", SECOND, "b", f"(FROM {_BRANDS} WHERE b >= 10)"),
    _pages_sql("categories", FIRST, "(r_regionkey + 1)", "region"),
    _pages_sql("combinations", FIRST, "p_partkey", "part"), _pages_sql("product_option_values", FIRST, "id", _VALUES),
])
BULK_PAGES_SQL = _pages_sql("invoices/booked/lines", FIRST, "event_id", "events")
COVERAGE = ("CAST(count(*) AS BIGINT) AS page_count, CAST(sum(n) AS BIGINT) AS total_records")


@query("brz5_ingestion_metadata", f"""
SELECT api_endpoint, min(loaded) AS first_ingestion, max(loaded) AS last_ingestion, {COVERAGE}, max(page) AS max_page_number
FROM ({REST_PAGES_SQL} UNION ALL {SHOP_PAGES_SQL} UNION ALL {BULK_PAGES_SQL}) GROUP BY api_endpoint""")
def brz5(spark, sf):
    return bronze.ingestion_metadata(
        st.rest_raw(spark, sf), st.raw(st.event_pages(spark, sf), "OPENAPI"), st.shop_raw(spark, sf)) \
        .orderBy(F.desc_nulls_last("last_ingestion"))


@query("rpt8_raw_coverage", f"""
SELECT 'rest' AS table_name, CAST(count(*) AS BIGINT) AS row_count,
       CAST(count(DISTINCT api_endpoint) AS BIGINT) AS unique_endpoints, min(loaded) AS first_load, max(loaded) AS last_load
FROM ({REST_PAGES_SQL})
UNION ALL SELECT 'bulk', CAST(count(*) AS BIGINT), CAST(count(DISTINCT api_endpoint) AS BIGINT), min(loaded), max(loaded)
FROM ({BULK_PAGES_SQL})""")
def rpt8(spark, sf):
    return reports.raw_coverage(rest=st.rest_raw(spark, sf), bulk=st.raw(st.event_pages(spark, sf), "OPENAPI"))


@query("rpt8_endpoint_coverage", f"""
SELECT api_endpoint, {COVERAGE}, max(page) + 1 AS pages_loaded, max(loaded) AS last_load
FROM ({REST_PAGES_SQL}) GROUP BY api_endpoint""")
def rpt8_endpoints(spark, sf):
    return reports.endpoint_coverage(st.rest_raw(spark, sf))


# --- expired SKUs ---------------------------------------------------------------------------------------------------

_EXPIRED_TIES = ", ".join(f"{c} NULLS LAST" for c in ["SKU", "PRODUCT", "COLOR", "SIZE", "EAN", "CATEGORY_NO", "CATEGORY_NAME"])
STAMP = "'2024-01-01 00:00:00'"  # a fixed value
EXPIRED = f"""ex AS (
  SELECT CASE WHEN p_size = 1 THEN '  ' WHEN p_size <> 2 THEN ' ' || p_name END AS PRODUCT,
         CASE WHEN p_size <> 3 THEN split_part(p_name, ' ', 1) END AS COLOR,
         CASE WHEN p_size = 4 THEN ' ' ELSE p_size || ' cm' END AS SIZE,
         CASE WHEN p_size = 5 THEN '' WHEN p_size > 44 THEN ' sku' || p_partkey || ' '
              ELSE ' exp' || (p_partkey // 2) || ' ' END AS SKU,
         CASE WHEN p_size > 10 THEN '58' || p_partkey ELSE ' ' END AS EAN,
         CASE WHEN p_size = 6 THEN 'abc' WHEN p_size <> 7 THEN CAST(p_size % 9 + 1 AS VARCHAR) END AS CATEGORY_NO,
         CASE WHEN p_size <> 8 THEN 'Old ' || (p_size % 9) END AS CATEGORY_NAME
  FROM part),
product_ids AS (
  SELECT name, -dense_rank() OVER (ORDER BY name NULLS LAST) AS product_id
  FROM (SELECT DISTINCT nullif(trim(PRODUCT), '') AS name FROM ex)),
size_ids AS (
  SELECT v, -10000 - dense_rank() OVER (ORDER BY v) AS id
  FROM (SELECT DISTINCT nullif(trim(SIZE), '') AS v FROM ex) WHERE v IS NOT NULL),
colour_ids AS (
  SELECT v, -20000 - dense_rank() OVER (ORDER BY v) AS id
  FROM (SELECT DISTINCT nullif(trim(COLOR), '') AS v FROM ex) WHERE v IS NOT NULL),
listed AS (
  SELECT *, -row_number() OVER (ORDER BY {_EXPIRED_TIES}) AS combination_id
  FROM ex WHERE SKU IS NOT NULL AND trim(SKU) <> ''),
ex_combinations AS (
  SELECT combination_id, product_id, upper(trim(SKU)) AS sku, nullif(trim(EAN), '') AS ean13
  FROM listed LEFT JOIN product_ids ON nullif(trim(PRODUCT), '') IS NOT DISTINCT FROM name),
ex_products AS (
  SELECT DISTINCT product_id, name AS product_name, TRY_CAST(CATEGORY_NO AS BIGINT) AS category
  FROM ex JOIN product_ids ON nullif(trim(PRODUCT), '') IS NOT DISTINCT FROM name WHERE PRODUCT IS NOT NULL),
ex_categories AS (
  SELECT DISTINCT TRY_CAST(CATEGORY_NO AS BIGINT) AS category_id, nullif(trim(CATEGORY_NAME), '') AS name
  FROM ex WHERE CATEGORY_NO IS NOT NULL),
ex_links AS (
  SELECT combination_id, id FROM listed JOIN size_ids ON nullif(trim(SIZE), '') = v
  UNION ALL SELECT combination_id, id FROM listed JOIN colour_ids ON nullif(trim(COLOR), '') = v)"""


def _catalogue(spark, sf):
    return expired.expired_catalogue(st.expired_list(spark, sf))


@query("exp1_combinations", with_parts(f"""
SELECT {STAMP} AS api_timestamp, combination_id, product_id, sku, ean13, CAST(0 AS BIGINT) AS price_impact,
       CAST(0 AS BIGINT) AS quantity_in_stock FROM ex_combinations""", EXPIRED))
def exp1(spark, sf):
    return _catalogue(spark, sf).combinations


@query("exp2_products", with_parts(f"""
SELECT {STAMP} AS api_timestamp, product_id, product_name, category AS id_category_default, FALSE AS active,
       {STAMP} AS date_added, {STAMP} AS date_updated FROM ex_products""", EXPIRED))
def exp2(spark, sf):
    return _catalogue(spark, sf).products


@query("exp3_categories", with_parts(f"""
SELECT {STAMP} AS api_timestamp, category_id, name AS category_name_da, CAST(2 AS BIGINT) AS parent_category_id,
       TRUE AS active, CAST(1 AS BIGINT) AS level_depth FROM ex_categories""", EXPIRED))
def exp3(spark, sf):
    return _catalogue(spark, sf).categories


@query("exp4_option_values", with_parts(f"""
SELECT {STAMP} AS api_timestamp, id AS option_value_id, CAST(1 AS BIGINT) AS option_group_id, v AS option_value_name
FROM size_ids UNION ALL SELECT {STAMP}, id, 2, v FROM colour_ids""", EXPIRED))
def exp4(spark, sf):
    return _catalogue(spark, sf).option_values


@query("exp5_combination_options", with_parts(
    f"SELECT {STAMP} AS api_timestamp, combination_id, id AS option_value_id FROM ex_links", EXPIRED))
def exp5(spark, sf):
    return _catalogue(spark, sf).combination_options


@query("exp6_row_key", """
SELECT event_type, user_id, event_id, -10000 - row_number() OVER (ORDER BY event_type, user_id, event_id) AS key
FROM events""")
def exp6(spark, sf):
    rows = st.table(spark, sf, "events").select("event_type", "user_id", "event_id")
    return keys.row_keys(rows, ["event_type"], "key", base=-10000)


@query("exp6_row_key_equal_rows", """
SELECT event_type, row_number() OVER (ORDER BY event_type) AS key FROM events""")
def exp6_equal(spark, sf):
    return keys.row_keys(st.table(spark, sf, "events").select("event_type"), ["event_type"], "key", sign=1)


@query("exp7_dense_key", with_parts("""
SELECT sku, -dense_rank() OVER (ORDER BY sku NULLS LAST) AS key, CAST(count(*) AS BIGINT) AS line_count
FROM ln GROUP BY sku""", LINES))
def exp7(spark, sf):
    lines = st.lines(spark, sf).select("sku")
    ids = keys.dense_keys(lines, ["sku"], "key")
    counts = lines.groupBy("sku").agg(F.count(F.lit(1)).alias("line_count"))
    return keys.attach_key(counts, ids, ["sku"], "key").select("sku", "key", "line_count")


@query("rpt12_expired_id_ranges", with_parts("""
SELECT 'combination' AS id, min(combination_id) AS min_id, max(combination_id) AS max_id, max(combination_id) < 0 AS all_negative
FROM ex_combinations
UNION ALL SELECT 'option', min(id), max(id), max(id) < 0 FROM (FROM size_ids UNION ALL FROM colour_ids)""", EXPIRED))
def rpt12_ranges(spark, sf):
    found = _catalogue(spark, sf)
    return reports.id_range(found.combinations, "combination_id").select(F.lit("combination").alias("id"), "*").unionByName(
        reports.id_range(found.option_values, "option_value_id").select(F.lit("option").alias("id"), "*"))


# --- shop entities and SKU dimensions -------------------------------------------------------------------------------

SHOP = f"""words AS (
  SELECT w, CAST(2000 + ascii(w) AS BIGINT) AS id
  FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part)),
brands AS (SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS b, p_brand FROM part),
all_products AS (
  SELECT {FIRST} AS loaded, b AS product_id, lower(p_brand) AS product_name, b % 6 + 1 AS category, b % 2 = 0 AS active,
         '2024-01-10 10:00:00' AS updated FROM brands
  UNION ALL SELECT {SECOND}, b, p_brand, b % 6 + 1, b % 2 = 0, '2024-01-10 10:00:00' FROM brands WHERE b >= 10
  UNION ALL SELECT {STAMP}, product_id, product_name, category, FALSE, {STAMP} FROM ex_products),
all_categories AS (
  SELECT {FIRST} AS loaded, CAST(r_regionkey + 1 AS BIGINT) AS category_id,
         CASE WHEN r_regionkey = 0 THEN 'Shop' ELSE r_name END AS name, CAST(2 AS BIGINT) AS parent, TRUE AS active,
         CAST((r_regionkey + 1) % 3 AS BIGINT) AS depth FROM region
  UNION ALL SELECT {STAMP}, category_id, name, 2, TRUE, 1 FROM ex_categories),
all_combinations AS (
  SELECT {FIRST} AS loaded, p_partkey + 1 AS combination_id, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS product_id,
         CASE WHEN p_size <> 50 THEN 'SKU' || p_partkey END AS sku, '57' || p_partkey AS ean13,
         CAST(round(p_retailprice) AS BIGINT) AS price_impact, CAST(p_size AS BIGINT) AS quantity FROM part
  UNION ALL SELECT {STAMP}, combination_id, product_id, sku, ean13, 0, 0 FROM ex_combinations),
all_links AS (
  SELECT {FIRST} AS loaded, p_partkey + 1 AS combination_id, CAST(100 + p_size AS BIGINT) AS option_value_id
  FROM part WHERE p_size <= 45
  UNION ALL SELECT {FIRST}, p_partkey + 1, words.id FROM part JOIN words ON split_part(p_name, ' ', 1) = w
            WHERE p_size <= 45
  UNION ALL SELECT {FIRST}, p_partkey + 1, NULL FROM part WHERE p_size > 45
  UNION ALL SELECT {STAMP}, combination_id, id FROM ex_links),
all_values AS (
  SELECT DISTINCT {FIRST} AS loaded, CAST(100 + p_size AS BIGINT) AS option_value_id, 1 AS grp, CAST(p_size AS VARCHAR) AS name
  FROM part
  UNION ALL SELECT {FIRST}, id, 2, w FROM words
  UNION ALL SELECT {STAMP}, id, 1, v FROM size_ids UNION ALL SELECT {STAMP}, id, 2, v FROM colour_ids)"""


def _shop(spark, sf):
    return dims.shop_catalogue(st.shop_raw(spark, sf), _catalogue(spark, sf))


@query("brz6_shop_products", with_parts("""
SELECT loaded AS api_timestamp, product_id, product_name, category AS id_category_default, active, updated AS date_added,
       updated AS date_updated FROM all_products""", EXPIRED, SHOP))
def brz6(spark, sf):
    return _shop(spark, sf).products


@query("brz7_shop_categories", with_parts("""
SELECT loaded AS api_timestamp, category_id, name AS category_name_da, parent AS parent_category_id, active,
       depth AS level_depth FROM all_categories""", EXPIRED, SHOP))
def brz7(spark, sf):
    return _shop(spark, sf).categories


@query("brz8_shop_combinations", with_parts("""
SELECT loaded AS api_timestamp, combination_id, product_id, sku, ean13, price_impact, quantity AS quantity_in_stock
FROM all_combinations""", EXPIRED, SHOP))
def brz8(spark, sf):
    return _shop(spark, sf).combinations


@query("brz9_shop_combination_options", with_parts(
    "SELECT loaded AS api_timestamp, combination_id, option_value_id FROM all_links", EXPIRED, SHOP))
def brz9(spark, sf):
    return _shop(spark, sf).combination_options


@query("brz10_shop_option_values", with_parts("""
SELECT loaded AS api_timestamp, option_value_id, CAST(grp AS BIGINT) AS option_group_id, name AS option_value_name
FROM all_values""", EXPIRED, SHOP))
def brz10(spark, sf):
    return _shop(spark, sf).option_values


DIM = f"""products AS (
  SELECT * FROM all_products QUALIFY row_number() OVER (
    PARTITION BY product_id ORDER BY loaded DESC, product_name NULLS LAST, category NULLS LAST) = 1),
categories AS (
  SELECT * FROM all_categories QUALIFY row_number() OVER (
    PARTITION BY category_id ORDER BY loaded DESC, name NULLS LAST) = 1),
attributes AS (
  SELECT combination_id, min_by(name, option_value_id) FILTER (grp = 1) AS size,
         min_by(name, option_value_id) FILTER (grp = 2) AS color,
         string_agg(name, ' / ' ORDER BY grp, option_value_id) AS all_attributes
  FROM all_links JOIN all_values USING (option_value_id) GROUP BY combination_id),
dim AS (
  SELECT c.sku, c.product_id, coalesce(p.product_name, 'Unknown Product') AS product_name, p.active AS product_active,
         g.category_id, coalesce(g.name, 'Uncategorized') AS category_name, g.parent AS parent_category_id,
         g.depth AS category_level, a.size, a.color, a.all_attributes, c.combination_id, c.ean13, c.price_impact,
         c.quantity AS stock_quantity, p.updated AS last_updated, {STAMP} AS dim_created_at
  FROM all_combinations c LEFT JOIN products p ON c.product_id = p.product_id
  LEFT JOIN categories g ON p.category = g.category_id AND (g.name <> 'Shop' OR g.name IS NULL)
  LEFT JOIN attributes a ON c.combination_id = a.combination_id
  WHERE c.sku IS NOT NULL)"""


@query("dim1_product_sku", with_parts("SELECT * FROM dim", EXPIRED, SHOP, DIM))
def dim1(spark, sf):
    return dims.dim_product_sku(_shop(spark, sf))


ENRICHED = f"""names AS (
  SELECT sku, line_description AS name FROM ln WHERE sku IS NOT NULL GROUP BY sku, line_description
  QUALIFY row_number() OVER (PARTITION BY sku ORDER BY count(*) DESC, line_description) = 1),
enriched AS (
  SELECT n.sku, coalesce(d.product_id, -1) AS product_id,
         coalesce(d.product_name, n.name, 'Unknown Product') AS product_name, d.product_active, d.category_id,
         d.category_name, d.parent_category_id, d.category_level, d.size, d.color, d.all_attributes, d.combination_id,
         d.ean13, d.price_impact, d.stock_quantity, d.sku IS NULL AS is_economic_only,
         d.sku IS NOT NULL AS has_prestashop_data, coalesce(d.last_updated, {STAMP}) AS last_updated,
         {STAMP} AS dim_created_at
  FROM names n LEFT JOIN dim d ON n.sku = d.sku
  QUALIFY row_number() OVER (PARTITION BY n.sku ORDER BY d.combination_id DESC NULLS LAST) = 1)"""


@query("dim2_product_sku_enriched", with_parts("SELECT * FROM enriched", EXPIRED, SHOP, DIM, LINES, ENRICHED))
def dim2(spark, sf):
    return dims.dim_product_sku_enriched(st.lines(spark, sf), dims.dim_product_sku(_shop(spark, sf)))


# --- the whole path -------------------------------------------------------------------------------------------------

NEWEST_LINES = f"""versions AS (
  SELECT {LINE_FIELDS}, l_linestatus FROM lineitem),
ln AS (
  SELECT *, round(line_net_amount * (coalesce({rate('invoice_number')}, 100.0) / 100), 2) AS revenue
  FROM versions QUALIFY row_number() OVER (
    PARTITION BY invoice_number, line_number
    ORDER BY l_linestatus DESC, {', '.join(f'{c} DESC NULLS LAST' for c in LINE_TIES)}) = 1)"""


@query("entry_category_revenue_from_pages", with_parts(f"""
SELECT CASE WHEN ln.sku = 'Diverse' THEN 'B2B Wholesale' WHEN ln.sku IN {ADJUSTMENTS} THEN 'Adjustments'
            ELSE coalesce(e.category_name, 'Uncategorized') END AS category,
       coalesce(e.size, 'none') AS size, {COUNTRY_CASE} AS delivery_country,
       CASE c_nationkey % 3 WHEN 1 THEN 'B2C' WHEN 2 THEN 'B2B' ELSE 'Unknown' END AS customer_segment,
       round(sum(revenue), 2) AS revenue
FROM ln JOIN (SELECT *, coalesce(delivery_country, recipient_country) AS raw_country FROM inv) i
       ON ln.invoice_number = i.invoice_number AND invoice_date IS NOT NULL
  JOIN customer ON customer_number = c_custkey LEFT JOIN enriched e ON ln.sku = e.sku
GROUP BY ALL""", EXPIRED, SHOP, DIM, INVOICES, NEWEST_LINES, ENRICHED))
def category_revenue_from_pages(spark, sf):
    """Every lookup of the fact on entities built from pages."""
    by = ["category", "size", "delivery_country", "customer_segment"]
    rows = sales_detail(full_warehouse(spark, sf).sources, [*by, "line_revenue_dkk"]).fillna("none", ["size"])
    return rows.groupBy(*by).agg(F.sum("line_revenue_dkk").alias("revenue"))


@query("views_sql_on_packaging", with_parts(f"""
SELECT CASE c_nationkey % 3 WHEN 1 THEN 'B2C' WHEN 2 THEN 'B2B' ELSE 'Unknown' END AS customer_segment,
       k.prestashop_match_status AS packaging_match_status, CAST(count(*) AS BIGINT) AS lines,
       round(sum(ln.quantity * k.carton_kg_per_unit::DOUBLE), 3) AS carton_kg
FROM ln JOIN inv ON ln.invoice_number = inv.invoice_number AND invoice_date IS NOT NULL
  JOIN customer ON customer_number = c_custkey LEFT JOIN dim_pkg k ON ln.sku = k.sku
WHERE ln.quantity > 0 AND ln.sku NOT IN {ADJUSTMENTS} AND ln.sku <> 'Diverse'
GROUP BY ALL""", EXPIRED, SHOP, DIM, INVOICES, NEWEST_LINES, ENRICHED, "ps AS (FROM enriched)", PACKAGING), carton_kg=3)
def views_sql_packaging(spark, sf):
    """SQL text on the packaging view, with every view of the chain behind it."""
    register_views(spark, full_warehouse(spark, sf), "ledgerlake_", "vw_epr_detail")
    return spark.sql("""
        SELECT customer_segment, packaging_match_status, count(*) AS lines,
               sum(quantity_sold * carton_kg_per_unit) AS carton_kg
        FROM ledgerlake_vw_epr_detail GROUP BY customer_segment, packaging_match_status""")
