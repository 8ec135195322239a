"""Fixed values that decide results: country spellings, markets, special SKUs, name patterns, endpoint seeds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Standard country name -> accepted spellings.
COUNTRY_SPELLINGS = {
    "United Kingdom": ["United Kingdom", "England", "GB", "Great Britain", "UK"],
    "Japan": ["JP", "Japan"],
    "Denmark": ["Danmark", "Denmark", "DK"],
    "Sweden": ["SE", "Sweden", "Sverige"],
    "Norway": ["NO", "Norway", "Norge"],
    "France": ["FR", "France"],
    "Belgium": ["BE", "Belgium", "Belgique", "België"],
    "Finland": ["FI", "Finland", "Suomi"],
    "Germany": ["DE", "Germany", "Deutschland"],
    "Netherlands": ["NL", "Netherlands", "Nederland", "Holland"],
    "United States": ["US", "USA", "United States", "United States of America"],
    "Switzerland": ["CH", "Switzerland", "Schweiz", "Suisse"],
    "Austria": ["AT", "Austria", "Österreich"],
    "Italy": ["IT", "Italy", "Italia"],
    "Spain": ["ES", "Spain", "España"],
    "China": ["CN", "China"],
    "Poland": ["PL", "Poland", "Polska"],
    "Lithuania": ["LT", "Lithuania", "Lietuva"],
    "Australia": ["AU", "Australia"],
    "Estonia": ["EE", "Estonia", "Eesti"],
    "Singapore": ["SG", "Singapore"],
    "New Zealand": ["NZ", "New Zealand"],
    "Greece": ["GR", "Greece", "Ελλάδα"],
    "Luxembourg": ["LU", "Luxembourg", "Luxemburg", "Lëtzebuerg"],
    "Portugal": ["PT", "Portugal"],
    "Iceland": ["IS", "Iceland", "Ísland"],
    "Canada": ["CA", "Canada"],
    "Hungary": ["HU", "Hungary", "Magyarország"],
    "Jersey": ["JE", "Jersey"],
    "Ireland": ["IE", "Ireland", "Éire"],
    "Romania": ["RO", "Romania", "România"],
    "Bulgaria": ["BG", "Bulgaria", "България"],
}

# Market -> countries, by standard name.
MARKETS = {
    "Nordics": ["Denmark", "Sweden", "Norway", "Finland", "Iceland"],
    "Western Europe": [
        "United Kingdom", "Ireland", "France", "Belgium", "Netherlands",
        "Germany", "Switzerland", "Austria", "Luxembourg", "Jersey",
    ],
    "Southern Europe": ["Spain", "Portugal", "Italy", "Greece"],
    "Central & Eastern Europe": ["Poland", "Hungary", "Romania", "Bulgaria", "Lithuania", "Estonia"],
    "North America": ["United States", "Canada"],
    "Asia-Pacific": ["Japan", "China", "Singapore", "Australia", "New Zealand"],
}
OTHER_MARKET = "Other"

# SKUs that are not catalogue products.
WHOLESALE_SKU = "Diverse"
ADJUSTMENT_SKUS = ["rabat", "fragtum", "fragtmm", "diff"]
ZERO_REVENUE_SKUS = ["rabat", "fragtmm", "fragtum"]
FREIGHT_PREFIX = "fragt"

# Colour suffixes cut from product names, and the shop category that does not count as one.
COLOUR_SUFFIX = r" : Color - .*$| - Color : .*$| - Farve : .*$| - Färg : .*$| - Colour : .*$"
ROOT_CATEGORY = "Shop"

# Numeric conventions of the synthetic catalogue entries.
EXPIRED_STAMP = "2024-01-01 00:00:00"
SIZE_GROUP, COLOUR_GROUP = 1, 2
SIZE_KEY_BASE, COLOUR_KEY_BASE = -10000, -20000
EXPIRED_PARENT_CATEGORY, EXPIRED_CATEGORY_DEPTH = 2, 1

# Endpoint seeds as (path, base, description, active); page size 1000, first page 0.
ERP_ENDPOINTS = [
    ("customers", "REST", "Customer master data", True),
    ("products", "REST", "Product catalog", True),
    ("invoices/booked", "REST", "Booked invoices", True),
    ("invoices/drafts", "REST", "Draft invoices", False),
    ("accounting-years", "REST", "Accounting years info", False),
    ("accounting-years/2024/entries", "REST", "Accounting entries for 2024", False),
    ("accounting-years/2024/periods", "REST", "Accounting periods for 2024", False),
    ("accounting-years/2024/totals", "REST", "Accounting totals for 2024", False),
    ("invoices/booked/lines", "OPENAPI", "Booked invoice lines - bulk", True),
    ("journalsapi/v1.0.0/entries/booked", "OPENAPI", "Booked journal entries", False),
    ("customersapi/v3.0.1/Contacts/paged", "OPENAPI", "Customer contacts (paged)", False),
]
SHOP_ENDPOINTS = [
    ("products", "REST", "Products master data", True),
    ("combinations", "REST", "Product variant/SKU for joining invoice to products", True),
    ("categories", "REST", "Product hierarchy", True),
    ("product_option_values", "REST", "Product details -> sizes and colors", True),
]
PAGE_SIZE, START_PAGE = 1000, 0

# Seeded high-water marks as (endpoint, base, last invoice number).
MARK_SEEDS = [
    ("customers", "REST", None),
    ("products", "REST", None),
    ("invoices/booked", "REST", 0),
    ("invoices/booked/lines", "OPENAPI", 0),
]


def country_table(spark: SparkSession) -> DataFrame:
    """One row per accepted spelling: standard name, market of the spelling, market of the standard name.

    The market as written looks at the raw spelling, so only the spelling equal to the standard name has one.
    """
    market_of = {country: market for market, countries in MARKETS.items() for country in countries}
    rows = [(s, c, market_of.get(s), market_of.get(c)) for c, spellings in COUNTRY_SPELLINGS.items() for s in spellings]
    names = ["spelling", "standard_country", "spelling_market", "standard_market"]
    return spark.createDataFrame(pa.table({n: pa.array(v, pa.string()) for n, v in zip(names, zip(*rows))}))


def country_lookup(spark: SparkSession) -> DataFrame:
    """The spelling table marked for broadcast: its size is fixed by the values above."""
    return F.broadcast(country_table(spark))
