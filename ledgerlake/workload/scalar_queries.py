"""Queries for column functions, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import dates, money, text
from ledgerlake.functions.lookups import COLOUR_SUFFIX
from ledgerlake.workload import standins as st
from ledgerlake.workload.entity_queries import EXPIRED
from ledgerlake.workload.registry import query
from ledgerlake.workload.sql_parts import AS_OF, INVOICES, LINES, PRODUCTS, with_parts

N = "CAST(count(*) AS BIGINT) AS n"


@query("str1_trim_upper", with_parts(
    f"SELECT upper(trim(SKU)) AS sku, {N} FROM ex GROUP BY 1", EXPIRED))
def str1(spark, sf):
    return st.expired_list(spark, sf).groupBy(text.normalise_sku(F.col("SKU")).alias("sku")).agg(F.count(F.lit(1)).alias("n"))


@query("str2_blank_to_null", with_parts(
    f"SELECT nullif(trim(PRODUCT), '') AS product, nullif(trim(SIZE), '') AS size, {N} FROM ex GROUP BY 1, 2", EXPIRED))
def str2(spark, sf):
    return st.expired_list(spark, sf).groupBy(
        text.blank_to_null(F.col("PRODUCT")).alias("product"), text.blank_to_null(F.col("SIZE")).alias("size")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("str3_strip_colour", with_parts(f"""
SELECT sku, product_name, regexp_replace(product_name, '{COLOUR_SUFFIX}', '', 'g') AS core FROM pr""", PRODUCTS))
def str3(spark, sf):
    return st.products(spark, sf).select("sku", "product_name", text.core_name(F.col("product_name")).alias("core"))


@query("str4_like_prefix", with_parts(f"SELECT sku, {N} FROM ln WHERE sku LIKE 'fragt%' GROUP BY 1", LINES))
def str4(spark, sf):
    return st.lines(spark, sf).filter(F.col("sku").like("fragt%")).groupBy("sku").agg(F.count(F.lit(1)).alias("n"))


@query("str5_concat", "SELECT c_custkey, c_name || ' / ' || c_mktsegment AS label FROM customer")
def str5(spark, sf):
    return st.table(spark, sf, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(" / "), "c_mktsegment").alias("label"))


@query("str6_money_text", "SELECT o_orderkey, format('{:,.2f}', round(o_totalprice, 2)) AS amount FROM orders")
def str6(spark, sf):
    return st.table(spark, sf, "orders").select("o_orderkey", text.money_text(F.col("o_totalprice")).alias("amount"))


@query("str7_contains", f"""
SELECT lang, {N}, CAST(count(*) FILTER (contains(lower(trim(text)), 'license')) AS BIGINT) AS with_word
FROM documents GROUP BY 1""")
def str7(spark, sf):
    found = F.contains(F.lower(F.trim("text")), F.lit("license"))
    return st.table(spark, sf, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(found).alias("with_word"))


@query("cnd1_case", f"""
SELECT CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS class, {N}
FROM part GROUP BY 1""")
def cnd1(spark, sf):
    size = F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large")
    return st.table(spark, sf, "part").groupBy(size.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("cnd2_coalesce", with_parts(f"""
SELECT coalesce(delivery_country, recipient_country, 'Unknown') AS country, {N} FROM inv GROUP BY 1""", INVOICES))
def cnd2(spark, sf):
    country = F.coalesce("delivery_country", "recipient_country", F.lit("Unknown"))
    return st.invoices(spark, sf).groupBy(country.alias("country")).agg(F.count(F.lit(1)).alias("n"))


@query("cnd3_nullif", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, nullif(l_tax, 0) AS tax FROM lineitem")
def cnd3(spark, sf):
    return st.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"))


@query("cnd4_not_in", with_parts(f"""
SELECT {N}, CAST(count(*) FILTER (sku IS NULL) AS BIGINT) AS null_skus
FROM ln WHERE sku NOT IN ('rabat', 'fragtum', 'fragtmm', 'diff', 'Diverse')""", LINES))
def cnd4(spark, sf):
    kept = st.lines(spark, sf).filter(~F.col("sku").isin("rabat", "fragtum", "fragtmm", "diff", "Diverse"))
    return kept.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sku").isNull()).alias("null_skus"))


@query("cnd5_predicates", with_parts(f"""
SELECT {N} FROM inv WHERE invoice_date IS NOT NULL AND (exchange_rate IS NULL OR exchange_rate >= 100)
  AND invoice_currency <> 'SEK' AND customer_number > 0""", INVOICES))
def cnd5(spark, sf):
    rate = F.col("exchange_rate")
    return st.invoices(spark, sf).filter(
        F.col("invoice_date").isNotNull() & (rate.isNull() | (rate >= 100)) & (F.col("invoice_currency") != "SEK")
        & (F.col("customer_number") > 0)).agg(F.count(F.lit(1)).alias("n"))


@query("mth1_base_currency", with_parts("""
SELECT invoice_number, line_number, quantity, line_net_amount, line_net_amount_base_currency AS base FROM ln""", LINES))
def mth1(spark, sf):
    return st.lines(spark, sf).select(
        "invoice_number", "line_number", "quantity", "line_net_amount",
        money.to_base_currency(F.col("line_net_amount"), F.col("exchange_rate")).alias("base"))


@query("mth2_percent_change", """
SELECT c_custkey, round((c_acctbal - c_nationkey) / nullif(c_nationkey::DOUBLE, 0) * 100, 4) AS change, -c_nationkey::BIGINT AS negated
FROM customer""", scale=4)
def mth2(spark, sf):
    nation = F.col("c_nationkey").cast("double")
    return st.table(spark, sf, "customer").select(
        "c_custkey", money.percent_change(F.col("c_acctbal"), nation).alias("change"),
        (-F.col("c_nationkey")).alias("negated"))


@query("mth3_grams_to_kg", "SELECT p_partkey, round(p_size / 1000.0, 4)::DOUBLE AS kg FROM part", scale=4)
def mth3(spark, sf):
    return st.table(spark, sf, "part").select("p_partkey", money.grams_to_kg(F.col("p_size")).alias("kg"))


@query("cst1_try_number", with_parts(
    f"""SELECT CATEGORY_NO AS given, CAST(TRY_CAST(CATEGORY_NO AS DECIMAL(38,0)) AS VARCHAR) AS number,
       CAST(TRY_CAST(CATEGORY_NO || '00000000000000000000' AS DECIMAL(38,0)) AS VARCHAR) AS long_number, {N} FROM ex GROUP BY 1, 2, 3""", EXPIRED))
def cst1(spark, sf):
    return st.expired_list(spark, sf).groupBy(
        F.col("CATEGORY_NO").alias("given"), text.to_number(F.col("CATEGORY_NO")).cast("string").alias("number"),
        text.to_number(F.concat("CATEGORY_NO", F.lit("0" * 20))).cast("string").alias("long_number")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("cst2_coerce_number", f"""
SELECT CASE WHEN p_size <> 5 THEN CAST(p_size AS DOUBLE) END AS grams, {N} FROM part GROUP BY 1""")
def cst2(spark, sf):
    grams = text.to_double(F.col("`Packaging - carton (g)`"))
    return st.packaging_sheet(spark, sf).groupBy(grams.alias("grams")).agg(F.count(F.lit(1)).alias("n"))


@query("cst3_timestamp_literal", f"""
SELECT '2024-01-01 00:00:00' AS stamp, CAST(count(*) FILTER (ts < TIMESTAMP '2024-01-02 00:00:00') AS BIGINT) AS first_day, {N}
FROM events""")
def cst3(spark, sf):
    next_day = F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00"))
    return st.table(spark, sf, "events").agg(
        F.max(F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))).alias("stamp"),
        F.count_if(F.col("ts") < next_day).alias("first_day"), F.count(F.lit(1)).alias("n"))


@query("dat1_as_of", f"SELECT {N}, CAST(max({AS_OF} - CAST(o_orderdate AS DATE)) AS BIGINT) AS oldest_days FROM orders")
def dat1(spark, sf):
    age = F.datediff(dates.as_of_date(st.AS_OF), F.col("o_orderdate").cast("date"))
    return st.table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n"), F.max(age).alias("oldest_days"))


@query("dat2_date_add", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 7 AS VARCHAR) AS week_before,
       CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month_before,
       CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS quarter_before,
       CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS year_before
FROM orders""")
def dat2(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return st.table(spark, sf, "orders").select(
        "o_orderkey", F.date_sub(day, 7).alias("week_before"), F.add_months(day, -1).alias("month_before"),
        F.add_months(day, -3).alias("quarter_before"), F.add_months(day, -12).alias("year_before"))


@query("dat3_date_trunc", """
SELECT o_orderkey, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month,
       CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) AS quarter FROM orders""")
def dat3(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return st.table(spark, sf, "orders").select(
        "o_orderkey", dates.truncate(day, "month").alias("month"), dates.truncate(day, "quarter").alias("quarter"))


@query("dat4_year", f"SELECT CAST(year(o_orderdate) AS BIGINT) AS year, {N} FROM orders GROUP BY 1")
def dat4(spark, sf):
    return st.table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
