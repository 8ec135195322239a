"""Shared SQL parts: the stand-in entities and the views over them, written independently of the Spark builders."""

from __future__ import annotations

from ledgerlake.workload import standins as st


def sql_list(values: list, type_: str = "VARCHAR") -> str:
    def literal(value) -> str:
        if value is None:
            return "NULL"
        return repr(value) if isinstance(value, float) else "'" + str(value).replace("'", "''") + "'"
    return f"CAST([{', '.join(literal(v) for v in values)}] AS {type_}[])"


def pick(index: str, values: list, type_: str = "VARCHAR") -> str:
    return f"{sql_list(values, type_)}[CAST({index} % {len(values)} + 1 AS INTEGER)]"


def currency(key: str) -> str:
    return pick(key, [c for c, _ in st.CURRENCIES])


def rate(key: str) -> str:
    return pick(key, [r for _, r in st.CURRENCIES], "DOUBLE")


AS_OF = f"DATE '{st.AS_OF}'"
CATEGORY_CASE = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in st.CATEGORIES.items()) + " END"
# Fixed values, written out here once more so that the SQL does not depend on the engine's own lookups.
COUNTRY_CASE = """CASE
  WHEN raw_country IN ('United Kingdom', 'England', 'GB', 'Great Britain', 'UK') THEN 'United Kingdom'
  WHEN raw_country IN ('JP', 'Japan') THEN 'Japan'
  WHEN raw_country IN ('Danmark', 'Denmark', 'DK') THEN 'Denmark'
  WHEN raw_country IN ('SE', 'Sweden', 'Sverige') THEN 'Sweden'
  WHEN raw_country IN ('NO', 'Norway', 'Norge') THEN 'Norway'
  WHEN raw_country IN ('FR', 'France') THEN 'France'
  WHEN raw_country IN ('BE', 'Belgium', 'Belgique', 'België') THEN 'Belgium'
  WHEN raw_country IN ('FI', 'Finland', 'Suomi') THEN 'Finland'
  WHEN raw_country IN ('DE', 'Germany', 'Deutschland') THEN 'Germany'
  WHEN raw_country IN ('NL', 'Netherlands', 'Nederland', 'Holland') THEN 'Netherlands'
  WHEN raw_country IN ('US', 'USA', 'United States', 'United States of America') THEN 'United States'
  WHEN raw_country IN ('CH', 'Switzerland', 'Schweiz', 'Suisse') THEN 'Switzerland'
  WHEN raw_country IN ('AT', 'Austria', 'Österreich') THEN 'Austria'
  WHEN raw_country IN ('IT', 'Italy', 'Italia') THEN 'Italy'
  WHEN raw_country IN ('ES', 'Spain', 'España') THEN 'Spain'
  WHEN raw_country IN ('CN', 'China') THEN 'China'
  WHEN raw_country IN ('PL', 'Poland', 'Polska') THEN 'Poland'
  WHEN raw_country IN ('LT', 'Lithuania', 'Lietuva') THEN 'Lithuania'
  WHEN raw_country IN ('AU', 'Australia') THEN 'Australia'
  WHEN raw_country IN ('EE', 'Estonia', 'Eesti') THEN 'Estonia'
  WHEN raw_country IN ('SG', 'Singapore') THEN 'Singapore'
  WHEN raw_country IN ('NZ', 'New Zealand') THEN 'New Zealand'
  WHEN raw_country IN ('GR', 'Greece', 'Ελλάδα') THEN 'Greece'
  WHEN raw_country IN ('LU', 'Luxembourg', 'Luxemburg', 'Lëtzebuerg') THEN 'Luxembourg'
  WHEN raw_country IN ('PT', 'Portugal') THEN 'Portugal'
  WHEN raw_country IN ('IS', 'Iceland', 'Ísland') THEN 'Iceland'
  WHEN raw_country IN ('CA', 'Canada') THEN 'Canada'
  WHEN raw_country IN ('HU', 'Hungary', 'Magyarország') THEN 'Hungary'
  WHEN raw_country IN ('JE', 'Jersey') THEN 'Jersey'
  WHEN raw_country IN ('IE', 'Ireland', 'Éire') THEN 'Ireland'
  WHEN raw_country IN ('RO', 'Romania', 'România') THEN 'Romania'
  WHEN raw_country IN ('BG', 'Bulgaria', 'България') THEN 'Bulgaria'
  ELSE coalesce(raw_country, 'Unknown') END"""
MARKET_CASE = """CASE
  WHEN raw_country IN ('Denmark', 'Sweden', 'Norway', 'Finland', 'Iceland') THEN 'Nordics'
  WHEN raw_country IN ('United Kingdom', 'Ireland', 'France', 'Belgium', 'Netherlands', 'Germany', 'Switzerland', 'Austria',
                       'Luxembourg', 'Jersey') THEN 'Western Europe'
  WHEN raw_country IN ('Spain', 'Portugal', 'Italy', 'Greece') THEN 'Southern Europe'
  WHEN raw_country IN ('Poland', 'Hungary', 'Romania', 'Bulgaria', 'Lithuania', 'Estonia') THEN 'Central & Eastern Europe'
  WHEN raw_country IN ('United States', 'Canada') THEN 'North America'
  WHEN raw_country IN ('Japan', 'China', 'Singapore', 'Australia', 'New Zealand') THEN 'Asia-Pacific'
  ELSE 'Other' END"""
ADJUSTMENTS = "('rabat', 'fragtum', 'fragtmm', 'diff')"
NO_REVENUE = "('rabat', 'fragtmm', 'fragtum')"
COLOUR_TAIL = " : Color - .*$| - Color : .*$| - Farve : .*$| - Färg : .*$| - Colour : .*$"


INVOICES = f"""inv AS (
  SELECT o_orderkey AS invoice_number,
         CASE WHEN o_totalprice >= 2000 THEN CAST(o_orderdate AS DATE) END AS invoice_date,
         o_custkey AS customer_number, {currency('o_orderkey')} AS invoice_currency,
         {rate('o_orderkey')} AS exchange_rate,
         {pick('o_custkey', st.DELIVERY_COUNTRIES)} AS delivery_country,
         {pick('o_orderkey', st.RECIPIENT_COUNTRIES)} AS recipient_country
  FROM orders)"""

LINE_FIELDS = f"""l_orderkey AS invoice_number, CAST(l_linenumber AS BIGINT) AS line_number,
         CASE WHEN l_linenumber = 7 AND l_quantity <= 7
              THEN {sql_list(st.SPECIAL_SKUS)}[CAST(l_quantity AS INTEGER)]
              ELSE 'SKU' || l_partkey END AS sku,
         'Item ' || l_returnflag || ' - Farve : ' || l_linestatus AS line_description,
         l_quantity AS quantity, CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS unit_net_price,
         CASE WHEN l_tax > 0 THEN CAST(floor(l_extendedprice / 100) AS DOUBLE) END AS unit_cost_price,
         CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN -l_extendedprice ELSE l_extendedprice END
           AS line_net_amount,
         l_discount AS discount_percentage, l_tax AS vat_rate"""

LINES = f"""ln0 AS (
  SELECT {LINE_FIELDS}, {rate('l_orderkey')} AS rate, CAST(l_shipdate AS TIMESTAMP) AS api_timestamp FROM lineitem),
ln AS (
  SELECT *, round(unit_net_price * (coalesce(rate, 100.0) / 100), 2) AS unit_net_price_base_currency,
         round(unit_cost_price * (coalesce(rate, 100.0) / 100), 2) AS unit_cost_price_base_currency,
         round(line_net_amount * (coalesce(rate, 100.0) / 100), 2) AS line_net_amount_base_currency
  FROM ln0)"""

CUSTOMERS = f"""cu AS (
  SELECT c_custkey AS customer_number, c_name AS customer_name,
         CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey % 3 AS BIGINT) END AS customer_group_number,
         {currency('c_nationkey')} AS currency, CAST(c_nationkey % 4 AS BIGINT) AS vatzone_number,
         CASE WHEN c_nationkey <> 7 THEN 'City ' || c_nationkey END AS city,
         CASE WHEN c_nationkey <> 9 THEN 'NATION_' || c_nationkey END AS country,
         lower(c_mktsegment) || '@example.com' AS email, CAST(NULL AS VARCHAR) AS mobile_phone, '555' AS telephone,
         CAST(c_nationkey % 3 AS BIGINT) AS payment_terms_number,
         CAST(c_nationkey % 10 AS BIGINT) AS salesperson_employee_number,
         TIMESTAMP '{st.FIRST_LOAD}' AS last_updated
  FROM customer)"""

PRODUCTS = """pr AS (
  SELECT 'SKU' || p_partkey AS sku, p_name || ' - Colour : ' || p_brand AS product_name,
         CASE WHEN p_size > 2 THEN p_type END AS product_group_name
  FROM part WHERE p_size <= 40)"""

SKU_DIM = f"""ps AS (
  SELECT 'SKU' || p_partkey AS sku, CASE WHEN p_size <= 45 THEN p_partkey ELSE -1 END AS product_id,
         p_name AS product_name, CASE WHEN p_size <= 45 THEN p_size % 2 = 0 END AS product_active,
         CASE WHEN p_size <= 45 THEN length(p_type) END AS category_id,
         CASE WHEN p_size <= 45 THEN {CATEGORY_CASE} END AS category_name,
         CASE WHEN p_size <= 45 THEN 2 END AS parent_category_id,
         CASE WHEN p_size <= 45 THEN p_size % 3 END AS category_level,
         CASE WHEN p_size <= 45 THEN CAST(p_size AS VARCHAR) END AS size,
         CASE WHEN p_size <= 45 THEN split_part(p_name, ' ', 1) END AS color,
         CASE WHEN p_size <= 45 THEN p_size || ' / ' || split_part(p_name, ' ', 1) END AS all_attributes,
         CASE WHEN p_size <= 45 THEN p_partkey END AS combination_id,
         CASE WHEN p_size <= 45 THEN '57' || p_partkey END AS ean13,
         CASE WHEN p_size <= 45 THEN round(p_retailprice) END AS price_impact,
         CASE WHEN p_size <= 45 THEN p_size * 2 END AS stock_quantity,
         p_size > 45 AS is_economic_only, p_size <= 45 AS has_prestashop_data
  FROM part)"""

SALES = f"""joined AS (
  SELECT ln.*, inv.invoice_date, inv.customer_number, inv.invoice_currency, inv.exchange_rate,
         coalesce(inv.delivery_country, inv.recipient_country) AS raw_country,
         cu.customer_name, cu.city, cu.country, cu.customer_group_number,
         pr.product_name AS erp_name, pr.product_group_name, ps.sku AS dim_sku, ps.product_name AS dim_name,
         ps.category_name, ps.parent_category_id, ps.category_level, ps.size, ps.color, ps.ean13,
         ps.stock_quantity, ps.has_prestashop_data
  FROM ln JOIN inv ON ln.invoice_number = inv.invoice_number
  LEFT JOIN cu ON inv.customer_number = cu.customer_number
  LEFT JOIN pr ON ln.sku = pr.sku LEFT JOIN ps ON ln.sku = ps.sku
  WHERE inv.invoice_date IS NOT NULL),
sales AS (
  SELECT invoice_number AS invoice_id, line_number AS line_id, invoice_date AS sale_date,
         customer_number AS customer_id, coalesce(customer_name, 'Unknown') AS customer_name,
         coalesce(city, 'Unknown') AS customer_city, coalesce(country, 'Unknown') AS customer_country,
         CASE WHEN customer_group_number = 1 THEN 'B2C' WHEN customer_group_number >= 2 THEN 'B2B'
              ELSE 'Unknown' END AS customer_segment,
         sku AS product_sku, coalesce(dim_name, 'Unknown Product') AS product_name,
         regexp_replace(coalesce(erp_name, line_description, 'Unknown Product'), '{COLOUR_TAIL}', '', 'g')
           AS core_product_economic,
         coalesce(product_group_name, 'Other') AS product_category_economic,
         CASE WHEN sku = 'Diverse' THEN 'B2B Wholesale' WHEN sku IN {ADJUSTMENTS} THEN 'Adjustments'
              WHEN category_name IS NOT NULL THEN category_name ELSE 'Uncategorized' END AS category,
         parent_category_id, category_level, size, color, ean13, stock_quantity AS prestashop_stock_qty,
         CASE WHEN sku = 'Diverse' THEN 'B2B Wholesale'
              WHEN sku IN {ADJUSTMENTS} THEN 'Adjustment Item'
              WHEN dim_sku IS NOT NULL THEN 'Matched' ELSE 'Not in PrestaShop' END AS prestashop_match_status,
         {COUNTRY_CASE} AS delivery_country, {MARKET_CASE} AS market,
         invoice_currency, exchange_rate, quantity AS quantity_sold,
         unit_net_price_base_currency AS unit_price_dkk, line_net_amount_base_currency AS line_revenue_dkk,
         CASE WHEN sku IN {NO_REVENUE} OR sku LIKE 'fragt%' THEN 0
              WHEN line_net_amount_base_currency < 0 THEN 0
              ELSE line_net_amount_base_currency END AS product_revenue_dkk,
         coalesce(unit_cost_price_base_currency, 0) AS unit_cost_dkk,
         coalesce(unit_cost_price_base_currency, 0) * quantity AS line_cost_dkk,
         line_net_amount_base_currency - coalesce(unit_cost_price_base_currency, 0) * quantity AS line_profit_dkk,
         coalesce(has_prestashop_data, FALSE) AS has_prestashop_data, api_timestamp AS data_last_refreshed
  FROM joined)"""

PACKAGING = f"""pkg_rows AS (
  SELECT 'SKU' || p_partkey AS sku, p_size AS grams, TIMESTAMP '{st.FIRST_LOAD}' AS date_uploaded
  FROM part WHERE p_size <= 48
  UNION ALL
  SELECT 'SKU' || p_partkey, p_size + 100, TIMESTAMP '{st.SECOND_LOAD}' FROM part WHERE p_size <= 48 AND p_size % 2 = 0),
pkg AS (
  SELECT sku, grams / 1000.0 AS carton_kg_per_unit,
         CASE WHEN grams <> 11 THEN grams / 500.0 END AS plastic_kg_per_unit, 0.0 AS foam_kg_per_unit,
         date_uploaded, 'EPR_Upload' AS source_file
  FROM pkg_rows),
dim_pkg AS (
  SELECT k.sku, k.carton_kg_per_unit, k.plastic_kg_per_unit, k.foam_kg_per_unit, k.date_uploaded AS last_updated,
         ps.product_name AS product_description, ps.category_name, ps.size, ps.color,
         CASE WHEN ps.sku IS NOT NULL THEN 'Matched with PrestaShop' ELSE 'Not in PrestaShop' END
           AS prestashop_match_status
  FROM (SELECT * FROM pkg QUALIFY row_number() OVER (PARTITION BY sku ORDER BY date_uploaded DESC) = 1) k
  LEFT JOIN ps ON k.sku = ps.sku)"""

EPR = f"""epr AS (
  SELECT s.sale_date, s.customer_name, s.customer_segment,
         coalesce(s.delivery_country, s.customer_country, 'Unknown') AS country, s.product_sku AS sku,
         coalesce(k.product_description, s.product_name) AS product_name, coalesce(k.category_name, s.category) AS category,
         coalesce(k.size, s.size) AS size, coalesce(k.color, s.color) AS color, s.quantity_sold,
         k.carton_kg_per_unit, k.plastic_kg_per_unit, k.foam_kg_per_unit, s.line_revenue_dkk,
         k.prestashop_match_status AS packaging_match_status
  FROM sales s LEFT JOIN dim_pkg k ON s.product_sku = k.sku
  WHERE s.sale_date IS NOT NULL AND s.quantity_sold > 0
    AND s.product_sku NOT IN {ADJUSTMENTS} AND s.product_sku <> 'Diverse')"""


def with_parts(body: str, *parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


def on_sales(body: str, *extra: str) -> str:
    return with_parts(body, INVOICES, LINES, CUSTOMERS, PRODUCTS, SKU_DIM, SALES, *extra)


def on_epr(body: str) -> str:
    return on_sales(body, PACKAGING, EPR)
