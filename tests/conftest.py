from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.operators.variants import parse  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402
from ledgerlake.sources.pages import to_raw  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """RAW rows from (load time, endpoint, page number, document)."""
    def build(kind: str, *pages):
        rows = [(at, endpoint, number, json.dumps(page)) for at, endpoint, number, page in pages]
        df = spark.createDataFrame(rows, "load_id string, api_endpoint string, page_number bigint, page string")
        return to_raw(df.withColumn("collection_json", parse(F.col("page"))), kind, F.to_timestamp("load_id"))
    return build
