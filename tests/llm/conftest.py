from __future__ import annotations

import pytest

from ledgerlake.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text)."""
    def build(*rows, extra: str = ""):
        df = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS)
        return df.selectExpr("*", *([extra] if extra else []))
    return build


@pytest.fixture
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
