"""Queries for sources, sinks, JSON operators and incremental loading.

The landing queries write page files derived from the driver tables under the shared folder and read them back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import incremental as inc
from ledgerlake.operators import variants
from ledgerlake.plans import bronze
from ledgerlake.plans import packaging as pkg
from ledgerlake.plans import reports
from ledgerlake.session import scratch_path
from ledgerlake.sources import config, files, page_index, pages, store
from ledgerlake.streaming.landing import land_once, start_landing
from ledgerlake.workload import standins as st
from ledgerlake.workload.entity_queries import BULK_PAGES_SQL, EXPIRED, REST_PAGES_SQL, SHOP_PAGES_SQL
from ledgerlake.workload.registry import query
from ledgerlake.workload.sql_parts import SKU_DIM, PACKAGING, with_parts

NOW = dt.datetime(2024, 3, 1, 12, 0, 0)
N = "CAST(count(*) AS BIGINT) AS n"


def _landed(spark: SparkSession, landed: DataFrame) -> str:
    root = scratch_path(spark, "landing")
    pages.land_page_lines(landed, root)
    return root


def _read_back(spark: SparkSession, landed: DataFrame, kind: str) -> DataFrame:
    raw = pages.read_pages(spark, _landed(spark, landed), kind, lines=True, inserted=F.lit(NOW))
    return raw.select("api_endpoint", "load_id", "page_number", "record_count_per_page")


def _pages_back(sql: str) -> str:
    return (f"SELECT api_endpoint, loaded AS load_id, page AS page_number, CAST(n AS BIGINT) AS record_count_per_page "
            f"FROM ({sql})")


@query("src1_rest_pages", _pages_back(REST_PAGES_SQL))
def src1(spark, sf):
    landed = st.customer_pages(spark, sf).unionByName(st.product_pages(spark, sf)).unionByName(st.invoice_pages(spark, sf))
    return _read_back(spark, landed, "REST")


@query("src2_bulk_pages", _pages_back(BULK_PAGES_SQL))
def src2(spark, sf):
    return _read_back(spark, st.event_pages(spark, sf), "OPENAPI")


@query("src3_shop_pages", _pages_back(SHOP_PAGES_SQL))
def src3(spark, sf):
    """Two full refreshes; the store holds the last one."""
    store_path = scratch_path(spark, "shop-raw")
    raw = st.shop_raw(spark, sf)
    pages.reload_raw(raw.filter("api_endpoint = 'categories'"), store_path)
    pages.reload_raw(raw, store_path)
    return pages.read_raw(spark, store_path).select("api_endpoint", "load_id", "page_number", "record_count_per_page")


@query("src4_record_counts", f"""
SELECT api_endpoint, CAST(sum(n) AS BIGINT) AS records, CAST(sum(n) AS BIGINT) AS elements, CAST(0 AS BIGINT) AS other_key
FROM ({REST_PAGES_SQL}) GROUP BY 1""")
def src4(spark, sf):
    raw = st.rest_raw(spark, sf)
    page = F.col("collection_json")
    return raw.groupBy("api_endpoint").agg(
        F.sum("record_count_per_page").alias("records"),
        F.sum(F.size(variants.array_at(page, "$.collection"))).alias("elements"),
        F.sum(variants.record_count(page, "items")).alias("other_key"))


@query("src5_active_endpoints", f"""
SELECT api_endpoint, CAST(1000 AS BIGINT) AS default_pagesize, {N} FROM ({REST_PAGES_SQL}) GROUP BY 1""")
def src5(spark, sf):
    configured = config.configured_pages(st.rest_raw(spark, sf), config.endpoints(spark, NOW), "rest")
    return configured.groupBy("api_endpoint", "default_pagesize").agg(F.count(F.lit(1)).alias("n"))


CLEAN = """sheet AS (
  SELECT CASE WHEN p_size = 1 THEN 'ALL COLLARS' WHEN p_size = 2 THEN 'nan' WHEN p_size = 3 THEN ''
              WHEN p_size = 4 THEN NULL ELSE 'SKU' || p_partkey END AS sku,
         CASE WHEN p_size <> 5 THEN p_size / 1000.0 END AS carton, CASE WHEN p_size <> 6 THEN p_size * 2 / 1000.0 END AS plastic
  FROM part),
clean AS (SELECT * FROM sheet WHERE sku <> '' AND lower(sku) <> 'nan' AND NOT contains(sku, ' '))"""


def _csv_sheet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sheet")
    files.export_csv(st.packaging_sheet(spark, sf), path)
    return files.read_packaging_csv(spark, path)


@query("src6_packaging_csv", with_parts("""
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (p_size <> 4 AND p_size <> 3) AS BIGINT) AS skus,
       CAST(count(*) FILTER (p_size <> 6) AS BIGINT) AS plastic FROM part""", SKU_DIM))
def src6(spark, sf):
    sheet = _csv_sheet(spark, sf)
    return sheet.agg(F.count(F.lit(1)).alias("n"), F.count(F.nullif(F.trim("Varenummer"), F.lit(""))).alias("skus"),
                     F.count("Plastik i gram").alias("plastic"))


@query("src7_expired_list", with_parts(f"SELECT CATEGORY_NO AS category_no, COLOR AS color, {N} FROM ex GROUP BY 1, 2", EXPIRED))
def src7(spark, sf):
    path = scratch_path(spark, "expired")
    st.expired_list(spark, sf).write.parquet(path)
    return files.read_expired_list(spark, path, "parquet").groupBy(
        F.col("CATEGORY_NO").alias("category_no"), F.col("COLOR").alias("color")).agg(F.count(F.lit(1)).alias("n"))


@query("epr1_packaging_cleaner", with_parts(f"""
SELECT sku, round(carton, 4)::DOUBLE AS carton_kg_per_unit, round(plastic, 4)::DOUBLE AS plastic_kg_per_unit,
       0.0::DOUBLE AS foam_kg_per_unit, '{st.UPLOADED}' AS date_uploaded, 'EPR_Upload' AS source_file FROM clean""",
                                            CLEAN), scale=4)
def epr1(spark, sf):
    return pkg.clean_packaging(_csv_sheet(spark, sf), st.UPLOADED)


@query("agg12_packaging_counts", with_parts("""
SELECT CAST(count(*) AS BIGINT) AS rows_loaded, CAST(count(carton) AS BIGINT) AS with_carton,
       CAST(count(plastic) AS BIGINT) AS with_plastic, CAST(count(*) AS BIGINT) AS with_foam FROM clean""", CLEAN))
def agg12_packaging(spark, sf):
    return pkg.packaging_counts(pkg.clean_packaging(_csv_sheet(spark, sf), st.UPLOADED))


@query("snk1_truncate_reload", with_parts(f"SELECT CAST(date_uploaded AS VARCHAR) AS date_uploaded, {N} FROM pkg GROUP BY 1",
                                          SKU_DIM, PACKAGING))
def snk1(spark, sf):
    path, table = scratch_path(spark, "packaging"), st.packaging(spark, sf)
    files.reload_table(table.filter("carton_kg_per_unit > 0.01"), path)
    files.reload_table(table, path)
    return spark.read.schema(table.schema).parquet(path).groupBy("date_uploaded").agg(F.count(F.lit(1)).alias("n"))


@query("snk2_csv_export", "SELECT c_custkey, c_name, 'say \"' || c_mktsegment || '\", twice' AS note FROM customer")
def snk2(spark, sf):
    path = scratch_path(spark, "export")
    result = st.table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.concat(F.lit('say "'), "c_mktsegment", F.lit('", twice')).alias("note"))
    files.export_csv(result, path)
    return spark.read.schema(result.schema).option("header", True).option("escape", '"').csv(path)


# --- JSON -----------------------------------------------------------------------------------------------------------

@query("jsn1_parse", f"SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, {N} FROM events GROUP BY 1")
def jsn1(spark, sf):
    parsed = st.table(spark, sf, "events").select(variants.parse(F.col("props")).alias("doc"))
    return parsed.groupBy(variants.get(F.col("doc"), "$.k", "bigint").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("jsn2_path_access", """
SELECT c_custkey, CAST(c_nationkey % 3 AS BIGINT) AS grp, CAST(NULL AS VARCHAR) AS missing FROM customer
UNION ALL SELECT c_custkey, CAST(c_nationkey % 3 AS BIGINT), NULL FROM customer WHERE c_mktsegment = 'BUILDING'""")
def jsn2(spark, sf):
    raw = st.raw(st.customer_pages(spark, sf), "REST")
    return variants.flatten(raw, "customers", "$.collection", {
        "c_custkey": ("$.customerNumber", "bigint"), "grp": ("$.customerGroup.customerGroupNumber", "bigint"),
        "missing": ("$.customergroup.customerGroupNumber", "string")}).select("c_custkey", "grp", "missing")


@query("jsn3_typed_casts", f"""
SELECT o_orderkey AS number, CAST(round(o_totalprice) AS BIGINT) AS whole, o_totalprice AS amount,
       CAST(o_orderkey AS VARCHAR) AS text,
       CASE WHEN o_totalprice >= 2000 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day, load_id
FROM (SELECT *, '{st.FIRST_LOAD}' AS load_id FROM orders
      UNION ALL SELECT *, '{st.SECOND_LOAD}' FROM orders WHERE o_orderstatus = 'P')""")
def jsn3(spark, sf):
    raw = st.raw(st.invoice_pages(spark, sf), "REST")
    return variants.flatten(raw, "invoices/booked", "$.collection", {
        "number": ("$.bookedInvoiceNumber", "bigint"), "whole": ("$.netAmount", "decimal(38,0)"),
        "amount": ("$.netAmount", "double"), "text": ("$.bookedInvoiceNumber", "string"),
        "day": ("$.date", "date")}).select("number", "whole", "amount", "text", "day", F.col("api_timestamp").cast("string").alias("load_id"))


@query("jsn4_flatten", """
SELECT event_id, event_id // 1000 AS page_number, event_type, value FROM events""")
def jsn4(spark, sf):
    raw = st.raw(st.event_pages(spark, sf), "OPENAPI")
    return variants.flatten(raw, "invoices/booked/lines", "$.items", {
        "event_id": ("$.documentId", "bigint"), "event_type": ("$.productNumber", "string"),
        "value": ("$.totalNetAmount", "double")}).select("event_id", "page_number", "event_type", "value")


@query("jsn5_flatten_outer", """
SELECT p_partkey + 1 AS combination_id, CASE WHEN p_size <= 45 THEN 2 ELSE 1 END::BIGINT AS n,
       CASE WHEN p_size <= 45 THEN 2 ELSE 0 END::BIGINT AS options FROM part""")
def jsn5(spark, sf):
    links = bronze.shop_combination_options(st.shop_raw(spark, sf))
    return links.groupBy("combination_id").agg(F.count(F.lit(1)).alias("n"), F.count("option_value_id").alias("options"))


@query("jsn6_nested_flatten", """
SELECT p_partkey + 1 AS combination_id, 'SKU' || p_partkey AS sku, CAST(100 + p_size AS BIGINT) AS first_option
FROM part WHERE p_size <= 45""")
def jsn6(spark, sf):
    rows = variants.flatten_nested(
        st.shop_raw(spark, sf), "combinations", "$.combinations",
        {"combination_id": ("$.id", "bigint"), "sku": ("$.reference", "string")},
        "$.associations.product_option_values", {"option_id": ("$.id", "bigint")})
    return rows.groupBy("combination_id", "sku").agg(F.min("option_id").alias("first_option")) \
        .filter(F.col("first_option").isNotNull())


@query("jsn7_to_text", f"SELECT '{{\"k\":' || json_extract_string(props, '$.k') || '}}' AS doc, {N} FROM events GROUP BY 1")
def jsn7(spark, sf):
    docs = st.table(spark, sf, "events").select(variants.parse(F.col("props")).alias("doc"))
    return docs.groupBy(variants.to_text(F.col("doc")).alias("doc")).agg(F.count(F.lit(1)).alias("n"))


# --- incremental loading --------------------------------------------------------------------------------------------

@query("inc1_delta_by_time", "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'")
def inc1(spark, sf):
    rows = st.table(spark, sf, "events")
    return inc.delta_by_time(rows, "ts", "2024-01-10 00:00:00").select("event_id", "user_id")


@query("inc2_delta_by_number", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 1001")
def inc2(spark, sf):
    return inc.delta_by_number(st.table(spark, sf, "orders"), "o_orderkey", 1000).select("o_orderkey", "o_custkey")


STATS_SQL = f"""
SELECT 'customers' AS api_endpoint, 'REST' AS base,
       CAST(DATE '2024-01-01' + max(c_nationkey) AS VARCHAR) || ' 08:00:00' AS new_timestamp, CAST(NULL AS BIGINT) AS new_number,
       CAST(count(*) + count(*) FILTER (c_mktsegment = 'BUILDING') AS BIGINT) AS run_records FROM customer
UNION ALL SELECT 'products', 'REST', '2024-01-15 08:00:00', NULL, CAST(count(*) + count(*) FILTER (p_type = 'PROMO') AS BIGINT) FROM part
UNION ALL SELECT 'invoices/booked', 'REST', NULL, max(o_orderkey),
       CAST(count(*) + count(*) FILTER (o_orderstatus = 'P') AS BIGINT) FROM orders"""


@query("inc3_new_marks", STATS_SQL)
def inc3(spark, sf):
    return inc.run_stats(st.rest_raw(spark, sf), "REST")


@query("inc4_update_marks", f"""
WITH seeds(api_endpoint, base, number) AS (
  VALUES ('customers', 'REST', NULL), ('products', 'REST', NULL), ('invoices/booked', 'REST', 0), ('invoices/booked/lines', 'OPENAPI', 0)),
stats AS ({STATS_SQL})
SELECT s.api_endpoint, s.base, t.new_timestamp AS last_updated_timestamp, coalesce(t.new_number, s.number)::BIGINT AS last_invoice_number,
       coalesce(t.run_records, 0) AS total_records_loaded, coalesce(t.run_records, 0) AS last_run_records
FROM seeds s LEFT JOIN stats t USING (api_endpoint, base)""")
def inc4(spark, sf):
    marks = inc.update_marks(inc.seed_marks(spark, NOW), inc.run_stats(st.rest_raw(spark, sf), "REST"), NOW)
    path = scratch_path(spark, "marks")
    store.commit_marks(marks, path, 1)
    return store.read_marks(spark, path, lambda: inc.seed_marks(spark, NOW)).select(
        "api_endpoint", "base", "last_updated_timestamp", "last_invoice_number", "total_records_loaded", "last_run_records")


@query("inc5_seeded_marks", f"""
SELECT api_endpoint, CASE WHEN api_endpoint = 'invoices/booked' THEN 0 END::BIGINT AS last_invoice_number, {N}
FROM ({REST_PAGES_SQL}) GROUP BY 1""")
def inc5(spark, sf):
    marks = inc.seed_marks(spark, NOW).filter("base = 'REST'").select("api_endpoint", "last_invoice_number")
    return st.rest_raw(spark, sf).join(marks, "api_endpoint").groupBy(
        "api_endpoint", "last_invoice_number").agg(F.count(F.lit(1)).alias("n"))


@query("inc7_stream_landing", f"""
SELECT api_endpoint, CAST(sum(n) AS BIGINT) AS records, CAST(count(*) AS BIGINT) AS pages,
       CASE api_endpoint WHEN 'invoices/booked' THEN (SELECT max(o_orderkey) FROM orders) END AS mark
FROM ({REST_PAGES_SQL}) GROUP BY 1""")
def inc7(spark, sf):
    landed = st.customer_pages(spark, sf).unionByName(st.product_pages(spark, sf)).unionByName(st.invoice_pages(spark, sf))
    root, base = _landed(spark, landed), scratch_path(spark, "stream")
    raw_path, marks_path = f"{base}/raw", f"{base}/marks"
    start_landing(spark, root, "REST", raw_path, marks_path, f"{base}/checkpoint", lambda: NOW, lines=True).awaitTermination()
    marks = store.read_marks(spark, marks_path, lambda: inc.seed_marks(spark, NOW)).select(
        "api_endpoint", F.nullif("last_invoice_number", F.lit(0)).alias("mark"))
    totals = pages.read_raw(spark, raw_path).groupBy("api_endpoint").agg(
        F.sum("record_count_per_page").alias("records"), F.count(F.lit(1)).alias("pages"))
    return totals.join(marks, "api_endpoint", "left")


@query("inc7_page_index", f"""
SELECT api_endpoint, loaded AS load_id, CAST(count(*) AS BIGINT) AS pages, CAST(0 AS BIGINT) AS again
FROM ({REST_PAGES_SQL}) GROUP BY 1, 2""")
def inc7_index(spark, sf):
    """The same folder landed by two sources: the second finds every page in the index of its load."""
    landed = st.customer_pages(spark, sf).unionByName(st.product_pages(spark, sf)).unionByName(st.invoice_pages(spark, sf))
    root, base = _landed(spark, landed), scratch_path(spark, "index")
    for source in ("one", "two"):
        land_once(spark, root, "REST", f"{base}/raw", f"{base}/marks", 0, NOW, lines=True, source=source)
    found = page_index.read_index(spark, f"{base}/raw").groupBy("api_endpoint", "load_id", "batch").agg(
        F.sum(F.bitmap_count("pages")).alias("pages"))
    again = F.coalesce(F.sum(F.when(F.col("batch") == "two-0", F.col("pages"))), F.lit(0))
    return found.groupBy("api_endpoint", "load_id").agg(
        F.sum(F.when(F.col("batch") == "one-0", F.col("pages"))).alias("pages"), again.alias("again"))


EARLY = "o_orderkey < 9000"


@query("inc10_mark_driven_landing", f"""
WITH mark AS (SELECT max(o_orderkey) AS m FROM orders WHERE {EARLY}),
late AS (SELECT o_orderkey FROM orders, mark WHERE o_orderkey > m)
SELECT 'invoices/booked' AS api_endpoint, (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE {EARLY}) AS first_load,
       (SELECT CAST(count(*) AS BIGINT) FROM late) AS second_load,
       (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE {EARLY}) + (SELECT CAST(count(*) AS BIGINT) FROM late) AS total,
       (SELECT greatest(max(o_orderkey), (SELECT m FROM mark)) FROM orders) AS mark
UNION ALL
SELECT 'customers', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (c_nationkey >= (SELECT max(c_nationkey) FROM customer)) AS BIGINT),
       CAST(count(*) + count(*) FILTER (c_nationkey >= (SELECT max(c_nationkey) FROM customer)) AS BIGINT), NULL FROM customer""")
def inc10(spark, sf):
    """Two loads, the second with all records of the table: only those beyond the marks of the first reach RAW."""
    orders, key = st.table(spark, sf, "orders"), F.col("o_orderkey")
    record = F.struct(key.alias("bookedInvoiceNumber"), F.col("o_totalprice").alias("netAmount"))
    people = st.customer_record(F.lit("Old Town"))
    base = scratch_path(spark, "driven")
    for version, (load, rows) in enumerate(((st.FIRST_LOAD, orders.where(EARLY)), (st.SECOND_LOAD, orders))):
        landed = st.landed(rows, "invoices/booked", "collection", load, st.page_of(key), record).unionByName(
            st.landed(st.table(spark, sf, "customer"), "customers", "collection", load, st.page_of(F.col("c_custkey")), people))
        land_once(spark, _landed(spark, landed), "REST", f"{base}/raw", f"{base}/marks", version, NOW, lines=True, only_new=True)
    records = {name: F.sum(F.when(F.col("load_id") == load, F.col("record_count_per_page"))).alias(name)
               for name, load in (("first_load", st.FIRST_LOAD), ("second_load", st.SECOND_LOAD))}
    marks = store.read_marks(spark, f"{base}/marks", lambda: inc.seed_marks(spark, NOW)).select(
        "api_endpoint", F.col("total_records_loaded").alias("total"), F.nullif("last_invoice_number", F.lit(0)).alias("mark"))
    return pages.read_raw(spark, f"{base}/raw").groupBy("api_endpoint").agg(*records.values()).join(marks, "api_endpoint")


@query("inc8_load_completeness", """
WITH p AS (SELECT event_id // 1000 AS page, count(*) AS n FROM events GROUP BY 1)
SELECT 'invoices/booked/lines' AS api_endpoint, CAST(count(*) AS BIGINT) AS page_count, CAST(sum(n) AS BIGINT) AS records,
       min(page) AS first_page, max(page) AS last_page, CAST(count(*) FILTER (n < 1000) AS BIGINT) AS short_pages,
       max(page) - min(page) + 1 = count(*) AND min(page) = 0 AS gap_free,
       count(*) FILTER (n < 1000) = 1 AND max(page) FILTER (n < 1000) = max(page) AS ends_short,
       max(page) - min(page) + 1 = count(*) AND min(page) = 0 AND count(*) FILTER (n < 1000) = 1
         AND coalesce(max(page) FILTER (n < 1000) = max(page), FALSE) AS complete
FROM p""")
def inc8(spark, sf):
    return inc.load_completeness(st.raw(st.event_pages(spark, sf), "OPENAPI"), 1000).drop("load_id")


@query("inc8_page_gaps", f"""
WITH p AS (SELECT DISTINCT api_endpoint, loaded AS load_id, page FROM ({REST_PAGES_SQL}))
SELECT api_endpoint, load_id, page AS page_number FROM p
WHERE (api_endpoint, load_id, page + 1) NOT IN (SELECT (api_endpoint, load_id, page) FROM p)
  AND (api_endpoint, load_id, page) NOT IN (SELECT (api_endpoint, load_id, max(page)) FROM p GROUP BY api_endpoint, load_id)""")
def inc8_gaps(spark, sf):
    return inc.page_gaps(st.rest_raw(spark, sf))


@query("inc9_ingest_summary", f"""
SELECT api_endpoint, CAST(sum(n) AS BIGINT) AS records, CAST(count(*) AS BIGINT) AS pages
FROM ({REST_PAGES_SQL}) GROUP BY ROLLUP (api_endpoint)""")
def inc9(spark, sf):
    return inc.ingest_summary(st.rest_raw(spark, sf))


@query("rpt11_endpoint_counts", f"""
SELECT base, active, CAST(count(*) AS BIGINT) AS endpoint_count, CAST(sum(pages) AS BIGINT) AS pages FROM (
  SELECT DISTINCT 'REST' AS base, TRUE AS active, api_endpoint, (SELECT count(*) FROM ({REST_PAGES_SQL}) q WHERE q.api_endpoint = r.api_endpoint) AS pages
  FROM ({REST_PAGES_SQL}) r
  UNION ALL SELECT 'REST', FALSE, 'other' || i, 0 FROM range(5) t(i)
  UNION ALL SELECT 'OPENAPI', TRUE, 'lines', 0 UNION ALL SELECT 'OPENAPI', FALSE, 'other' || i, 0 FROM range(2) t(i))
GROUP BY 1, 2""")
def rpt11(spark, sf):
    """Configured endpoints per kind and flag, with the REST pages landed for them."""
    endpoints = config.endpoints(spark, NOW)
    landed = st.rest_raw(spark, sf).groupBy(F.col("api_endpoint").alias("endpoint_path")).agg(F.count(F.lit(1)).alias("pages"))
    counts = reports.endpoint_counts(endpoints)
    pages_per = endpoints.join(landed, "endpoint_path", "left").groupBy("base", "active").agg(
        F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"))
    return counts.join(pages_per, ["base", "active"])
