"""Endpoint configuration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.lookups import ERP_ENDPOINTS, PAGE_SIZE, SHOP_ENDPOINTS, START_PAGE
from ledgerlake.session import local_table

ENDPOINT_SCHEMA = (
    "endpoint_path string, base string, description string, default_pagesize bigint, default_startpage bigint, "
    "active boolean, updated_at timestamp"
)


def endpoints(spark: SparkSession, now: dt.datetime, shop: bool = False) -> DataFrame:
    seeds = SHOP_ENDPOINTS if shop else ERP_ENDPOINTS
    rows = [(path, base, text, PAGE_SIZE, START_PAGE, active, now) for path, base, text, active in seeds]
    return local_table(spark, rows, ENDPOINT_SCHEMA)


def active_endpoints(config: DataFrame, base: str) -> DataFrame:
    """Endpoints to load for an API kind."""
    return config.filter(F.col("active") & (F.upper("base") == base.upper()))


def configured_pages(raw: DataFrame, config: DataFrame, base: str) -> DataFrame:
    """Pages of active endpoints, with the endpoint's page size; Spark broadcasts the configuration by its size."""
    active = active_endpoints(config, base).select(F.col("endpoint_path").alias("api_endpoint"), "default_pagesize")
    return raw.join(active, "api_endpoint")
