from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"
QUICK = [
    "vq1_last_week_revenue", "vq9_top_customers_last_quarter", "rpt1_weekly_kpis", "rpt2_sales_alert", "fct13_epr_summary",
    "brz4_invoice_lines", "exp1_combinations", "exp6_row_key", "dim2_product_sku_enriched", "sem9_calendar_filters",
    "ded3_composite_key", "win2_dense_rank", "agg4_mode", "inc4_update_marks", "epr1_packaging_cleaner",
]


def test_queries_and_sql_load_without_a_session():
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
            "assert set(s) <= set(q) and len(q) > 130, (len(q), set(s) - set(q))")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, env={**os.environ, "PYTHONPATH": str(ROOT)})


@pytest.mark.skipif(not Path(SF).is_dir(), reason="driver tables not present")
@pytest.mark.parametrize("name", QUICK)
def test_query_matches_its_sql(spark, name):
    from __spark_entry__ import oracle_sql, queries
    from check_queries import compare, connect

    assert compare(spark, connect(SF), name, queries()[name], oracle_sql()[name], SF).startswith("ok")
