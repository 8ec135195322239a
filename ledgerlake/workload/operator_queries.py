"""Queries for the reusable operators, on the driver tables as they are."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import dates
from ledgerlake.functions.money import guarded_ratio
from ledgerlake.operators import aggregates, dedup, joins, keys
from ledgerlake.plans import reports
from ledgerlake.plans.facts import sales_detail
from ledgerlake.workload import standins as st
from ledgerlake.workload.registry import query
from ledgerlake.workload.sql_parts import INVOICES, LINES, on_sales, with_parts

N = "CAST(count(*) AS BIGINT) AS n"

# --- latest-wins ----------------------------------------------------------------------------------------------------


def _latest_events(spark, sf):
    return dedup.latest_per_key(st.table(spark, sf, "events"), ["user_id"], dedup.newest_first("ts", "event_id"))


LATEST_EVENTS = """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


# A tenth of the keys is NULL; as text, which both sides print alike.
_PART_OR_NULL = "CASE WHEN l_partkey % 10 <> 3 THEN CAST(l_partkey AS STRING) END AS l_partkey"


@query("ded1_latest_per_key", LATEST_EVENTS)
def ded1(spark, sf):
    return _latest_events(spark, sf).select("user_id", "event_id", "event_type", "value")


@query("ded2_qualify", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def ded2(spark, sf):
    newest = dedup.latest_per_key(st.table(spark, sf, "orders"), ["o_custkey"],
                                  dedup.newest_first("o_orderdate", "o_orderkey"))
    return newest.select("o_custkey", "o_orderkey", "o_totalprice")


@query("ded3_composite_key", with_parts("""
SELECT sku, line_number, invoice_number, line_net_amount FROM ln
QUALIFY row_number() OVER (PARTITION BY sku, line_number ORDER BY invoice_number DESC, line_net_amount DESC) = 1""", LINES))
def ded3(spark, sf):
    return dedup.latest_per_key(st.lines(spark, sf).select("sku", "line_number", "invoice_number", "line_net_amount"),
                                ["sku", "line_number"], dedup.newest_first("invoice_number", "line_net_amount"))


@query("ded4_first_by_order", """
SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority, min(o_orderkey) AS first_order
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey""")
def ded4(spark, sf):
    customers = st.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return st.table(spark, sf, "orders").join(customers, "o_custkey").groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"), F.min("o_orderkey").alias("first_order"))


@query("ded5_best_match", """
SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN
  (SELECT * FROM orders WHERE o_totalprice > 300000) ON c_custkey = o_custkey
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey DESC NULLS LAST) = 1""")
def ded5(spark, sf):
    large = st.table(spark, sf, "orders").filter("o_totalprice > 300000")
    best = dedup.latest_per_key(large, ["o_custkey"], dedup.newest_first("o_orderkey"))
    customers = st.table(spark, sf, "customer")
    return customers.join(best, customers["c_custkey"] == best["o_custkey"], "left") \
        .select("c_custkey", "o_orderkey", "o_totalprice")


# Rows with and without a key and a day; no key of a day is NULL, so that a row may match a pair only in part.
_RETENTION = """
r AS (SELECT CASE WHEN l_partkey % 10 <> 3 THEN CAST(l_partkey AS VARCHAR) END AS l_partkey,
             CASE WHEN l_quantity <> 11 THEN CAST(l_shipdate AS VARCHAR) END AS l_shipdate,
             l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem),
newest AS (SELECT l_partkey, max(l_shipdate) FROM r GROUP BY l_partkey)"""


def _retention_rows(spark, sf):
    return st.table(spark, sf, "lineitem").selectExpr(
        _PART_OR_NULL, "CASE WHEN l_quantity <> 11 THEN CAST(l_shipdate AS STRING) END AS l_shipdate", "l_orderkey", "l_linenumber")


@query("ded6_retention", f"""
WITH {_RETENTION}
SELECT * FROM r WHERE ((l_partkey, l_shipdate) NOT IN (SELECT * FROM newest)) IS NOT TRUE""")
def ded6(spark, sf):
    return dedup.retain_latest(_retention_rows(spark, sf), ["l_partkey"], "l_shipdate")


@query("ded6_composite_retention", """
WITH r AS (SELECT CASE WHEN o_custkey % 5 <> 2 THEN CAST(o_custkey % 97 AS VARCHAR) END AS who,
                  CASE WHEN o_orderkey % 7 <> 1 THEN o_orderpriority END AS priority,
                  CASE WHEN o_totalprice >= 20000 THEN CAST(o_orderdate AS VARCHAR) END AS day, o_orderkey FROM orders)
SELECT * FROM r WHERE ((who, priority, day) NOT IN (SELECT who, priority, max(day) FROM r GROUP BY who, priority)) IS NOT TRUE""")
def ded6_composite(spark, sf):
    rows = st.table(spark, sf, "orders").selectExpr(
        "CASE WHEN o_custkey % 5 <> 2 THEN CAST(o_custkey % 97 AS STRING) END AS who",
        "CASE WHEN o_orderkey % 7 <> 1 THEN o_orderpriority END AS priority",
        "CASE WHEN o_totalprice >= 20000 THEN CAST(o_orderdate AS STRING) END AS day", "o_orderkey")
    return dedup.retain_latest(rows, ["who", "priority"], "day")


@query("win1_row_number", """
SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS BIGINT) AS position
FROM events QUALIFY position <= 3""")
def win1(spark, sf):
    ranked = dedup.top_per_group(st.table(spark, sf, "events"), ["user_id"], ["event_id"], F.col("value"), k=3)
    return ranked.select("user_id", "event_id", F.col("rank").alias("position"))


@query("win2_dense_rank", """
SELECT brand, dense_rank() OVER (ORDER BY brand) AS position, n FROM
  (SELECT p_brand AS brand, CAST(count(*) AS BIGINT) AS n FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1)""")
def win2(spark, sf):
    part = st.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    per_part = st.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    counts = per_part.join(part, "l_partkey").groupBy("brand").agg(F.sum("n").alias("n"))
    ranks = keys.dense_keys(part, ["brand"], "position", sign=1)
    return keys.attach_key(counts, ranks, ["brand"], "position").select("brand", "position", "n")


@query("win3_share_of_total", """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS orders, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_orders,
       round(sum(o_totalprice), 2) AS amount,
       round(sum(o_totalprice) * 100.0 / sum(sum(o_totalprice)) OVER (), 2) AS pct_amount
FROM orders GROUP BY o_orderpriority""")
def win3(spark, sf):
    return aggregates.share_of_total(st.table(spark, sf, "orders"), ["o_orderpriority"], {
        "orders": (aggregates.row_count(), "pct_orders"), "amount": (F.sum("o_totalprice"), "pct_amount")})


# --- joins ----------------------------------------------------------------------------------------------------------

@query("joi1_inner", f"""
SELECT p_brand, {N}, round(sum(l_extendedprice), 2) AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def joi1(spark, sf):
    line, part = st.table(spark, sf, "lineitem"), st.table(spark, sf, "part")
    return line.join(part, line["l_partkey"] == part["p_partkey"]).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("amount"))


@query("joi2_left_lookup", f"""
SELECT c_mktsegment, {N} FROM orders LEFT JOIN (FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey GROUP BY 1""")
def joi2(spark, sf):
    known = st.table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.many_to_one(st.table(spark, sf, "orders"), known, ["o_custkey"], check=False) \
        .groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("joi3_suppressed_match", f"""
SELECT n_name, {N} FROM customer LEFT JOIN nation
  ON c_nationkey = n_nationkey AND (n_name <> 'NATION_7' OR n_name IS NULL) GROUP BY 1""")
def joi3(spark, sf):
    nation = st.table(spark, sf, "nation")
    usable = (F.col("n_name") != "NATION_7") | F.col("n_name").isNull()
    return joins.lookup_where(st.table(spark, sf, "customer"), nation, "c_nationkey", "n_nationkey", usable) \
        .groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))


@query("joi4_left_then_not_null", with_parts(f"""
SELECT invoice_currency, {N}, round(sum(line_net_amount), 2) AS amount
FROM ln LEFT JOIN inv USING (invoice_number) WHERE invoice_date IS NOT NULL GROUP BY 1""", INVOICES, LINES))
def joi4(spark, sf):
    lines = st.lines(spark, sf).drop("invoice_currency")
    return lines.join(st.invoices(spark, sf), "invoice_number", "left").filter(F.col("invoice_date").isNotNull()) \
        .groupBy("invoice_currency").agg(F.count(F.lit(1)).alias("n"), F.sum("line_net_amount").alias("amount"))


@query("joi5_star_join", on_sales(f"""
SELECT customer_segment, market, category, product_category_economic, {N}, round(sum(line_revenue_dkk), 2) AS revenue
FROM sales GROUP BY 1, 2, 3, 4"""))
def joi5(spark, sf):
    by = ["customer_segment", "market", "category", "product_category_economic"]
    return sales_detail(st.sources(spark, sf), [*by, "line_revenue_dkk"]).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum("line_revenue_dkk").alias("revenue"))


@query("joi6_many_to_one", f"""
SELECT n_name, {N}, round(sum(o_totalprice), 2) AS amount
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def joi6(spark, sf):
    customer = st.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = st.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    placed = joins.many_to_one(st.table(spark, sf, "orders"), customer, ["o_custkey"])
    return joins.many_to_one(placed, nation, ["c_nationkey"]).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("amount"))


@query("joi7_lines_without_date", with_parts("""
SELECT CAST(count(*) AS BIGINT) AS lines_without_date
FROM ln LEFT JOIN inv USING (invoice_number) WHERE invoice_date IS NULL""", INVOICES, LINES))
def joi7(spark, sf):
    return reports.lines_without_date(st.lines(spark, sf), st.invoices(spark, sf))


@query("joi8_composite_not_in", f"""
WITH {_RETENTION}
SELECT l_partkey, {N} FROM r WHERE (l_partkey, l_shipdate) NOT IN (SELECT * FROM newest) GROUP BY 1""")
def joi8(spark, sf):
    return dedup.superseded(_retention_rows(spark, sf), ["l_partkey"], "l_shipdate").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"))


@query("joi9_duplicate_safe_lookup", f"""
SELECT event_type, {N} FROM customer LEFT JOIN ({LATEST_EVENTS}) ON c_custkey = user_id GROUP BY 1""")
def joi9(spark, sf):
    newest = _latest_events(spark, sf).select(F.col("user_id").alias("c_custkey"), "event_type")
    return joins.many_to_one(st.table(spark, sf, "customer"), newest, ["c_custkey"], check=False) \
        .groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# --- aggregates -----------------------------------------------------------------------------------------------------

@query("agg1_basic", f"""
SELECT l_returnflag, l_linestatus, {N}, round(sum(l_extendedprice), 2) AS amount, min(l_quantity) AS low,
       max(l_quantity) AS high FROM lineitem GROUP BY 1, 2""")
def agg1(spark, sf):
    return st.table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("amount"), F.min("l_quantity").alias("low"),
        F.max("l_quantity").alias("high"))


@query("agg2_count_distinct", f"""
SELECT l_returnflag, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS orders, {N}, round(sum(l_quantity), 2) AS units
FROM lineitem GROUP BY 1""")
def agg2(spark, sf):
    return st.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"), F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("units"))


@query("agg3_avg", "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean_balance FROM customer GROUP BY 1", scale=4)
def agg3(spark, sf):
    return st.table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("mean_balance"))


@query("agg4_mode", """
SELECT user_id, event_type AS usual FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1""")
def agg4(spark, sf):
    return aggregates.mode_per_key(st.table(spark, sf, "events"), ["user_id"], "event_type", "usual")


@query("agg5_listagg", """
SELECT p_brand, string_agg(p_type, ' / ' ORDER BY p_type) AS types
FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY 1""")
def agg5(spark, sf):
    distinct = st.table(spark, sf, "part").select("p_brand", "p_type").distinct()
    return distinct.groupBy("p_brand").agg(aggregates.joined_text("p_type", ["p_type"]).alias("types"))


@query("agg6_conditional_sum", """
SELECT event_type, round(sum(CASE WHEN user_id < 10 THEN value ELSE 0 END), 2) AS early,
       round(sum(CASE WHEN user_id >= 10 THEN value ELSE 0 END), 2) AS late FROM events GROUP BY 1""")
def agg6(spark, sf):
    early = F.col("user_id") < 10
    return st.table(spark, sf, "events").groupBy("event_type").agg(
        aggregates.sum_if(early, F.col("value")).alias("early"), aggregates.sum_if(~early, F.col("value")).alias("late"))


@query("agg7_guarded_ratio", """
SELECT l_tax, round(sum(l_extendedprice) / nullif(sum(l_tax), 0), 4) AS ratio FROM lineitem GROUP BY 1""", scale=4)
def agg7(spark, sf):
    return st.table(spark, sf, "lineitem").groupBy("l_tax").agg(
        guarded_ratio(F.sum("l_extendedprice"), F.sum("l_tax")).alias("ratio"))


@query("agg8_distinct", "SELECT DISTINCT p_brand, p_type, p_size::BIGINT AS p_size FROM part")
def agg8(spark, sf):
    return st.table(spark, sf, "part").select("p_brand", "p_type", "p_size").distinct()


@query("agg9_global", f"""
SELECT {N}, round(sum(o_totalprice), 2) AS amount, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers FROM orders""")
def agg9(spark, sf):
    return st.table(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("amount"), F.countDistinct("o_custkey").alias("customers"))


@query("agg10_by_expression", f"""
SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, {N} FROM orders GROUP BY 1""")
def agg10(spark, sf):
    return st.table(spark, sf, "orders").groupBy(
        dates.truncate(F.col("o_orderdate").cast("date"), "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("agg11_arithmetic_on_aggregate", "SELECT max(l_linenumber)::BIGINT + 1 AS pages, max(l_orderkey) + 1 AS keys FROM lineitem")
def agg11(spark, sf):
    return st.table(spark, sf, "lineitem").agg(
        (F.max("l_linenumber") + 1).alias("pages"), (F.max("l_orderkey") + 1).alias("keys"))


@query("agg12_non_null_counts", with_parts("""
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(sku) AS BIGINT) AS with_sku,
       CAST(count(unit_cost_price) AS BIGINT) AS with_cost FROM ln""", LINES))
def agg12(spark, sf):
    return st.lines(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.count("sku").alias("with_sku"), F.count("unit_cost_price").alias("with_cost"))


# --- sort, limit, set -----------------------------------------------------------------------------------------------

@query("srt1_order_by", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC NULLS LAST")
def srt1(spark, sf):
    return st.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal").orderBy(
        F.asc_nulls_last("c_mktsegment"), F.desc_nulls_last("c_acctbal"))


@query("srt2_top_k", """
SELECT l_partkey, round(sum(l_extendedprice), 2) AS amount FROM lineitem GROUP BY 1
ORDER BY amount DESC, l_partkey LIMIT 10""")
def srt2(spark, sf):
    return st.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("amount")) \
        .orderBy(F.desc_nulls_last("amount"), F.asc_nulls_last("l_partkey")).limit(10)


@query("srt3_limit", "SELECT * FROM (SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 20)")
def srt3(spark, sf):
    return st.table(spark, sf, "events").select("event_id", "event_type").orderBy("event_id").limit(20)


@query("set1_union_all", f"""
SELECT kind, {N}, round(sum(amount), 2) AS amount FROM (
  SELECT 'order' AS kind, o_totalprice AS amount FROM orders UNION ALL SELECT 'line', l_extendedprice FROM lineitem
  UNION ALL SELECT 'event', value FROM events) GROUP BY 1""")
def set1(spark, sf):
    def part(kind: str, table: str, amount: str):
        return st.table(spark, sf, table).select(F.lit(kind).alias("kind"), F.col(amount).alias("amount"))
    rows = part("order", "orders", "o_totalprice").unionByName(part("line", "lineitem", "l_extendedprice")) \
        .unionByName(part("event", "events", "value"))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
