from __future__ import annotations

import decimal

from helpers import plan, rows
from fixtures import FIRST, SAMPLE_INVOICE, SAMPLE_LINES, SECOND, customer, invoice, line
from pyspark.sql import functions as F

from ledgerlake.operators.joins import unmatched
from ledgerlake.plans import bronze, reports
from ledgerlake.sources.store import materialise, save_bucketed


def invoice_pages(*docs, at=FIRST, number=0):
    return (at, "invoices/booked", number, {"collection": list(docs)})


def line_pages(*docs, at=FIRST, number=0):
    return (at, "invoices/booked/lines", number, {"items": list(docs), "cursor": "x"})


def test_newest_load_wins_and_last_record_within_a_load(raw):
    pages = raw("REST", (FIRST, "customers", 0, {"collection": [customer(1, "old"), customer(2, "first"), customer(2, "last")]}),
                (SECOND, "customers", 0, {"collection": [customer(1, "new")]}), (FIRST, "products", 0, {"collection": [customer(9)]}))
    got = bronze.customers(pages)
    assert rows(got, "customer_number", "customer_name") == [(1, "new"), (2, "last")]
    assert len(got.columns) == 20


def test_money_is_whole_by_default_and_exact_on_request(raw):
    pages = raw("REST", (FIRST, "products", 0, {"collection": [
        {"productNumber": "A1", "salesPrice": 79.95, "costPrice": 40, "productGroup": {"name": "G", "inventoryEnabled": False}}]}))
    assert rows(bronze.products(pages), "sales_price", "cost_price", "inventory_enabled") == [(80, 40, False)]
    assert rows(bronze.products(pages, exact_money=True), "sales_price") == [(decimal.Decimal("79.95"),)]
    assert len(bronze.products(pages).columns) == 14


def test_sample_invoice_converts_to_its_header_amount(raw):
    rest, bulk = raw("REST", invoice_pages(SAMPLE_INVOICE)), raw("OPENAPI", line_pages(*SAMPLE_LINES))
    lines = bronze.invoice_lines(bulk, rest)
    assert rows(lines, "line_number", "line_net_amount_base_currency") == [(1, 249.97), (2, 44.92)]
    assert len(lines.columns) == 18 and len(bronze.invoices(rest).columns) == 32
    total = lines.agg(F.round(F.sum("line_net_amount_base_currency"), 2)).first()[0]
    assert total == bronze.invoices(rest).first().net_amount_base_currency


def test_missing_rate_and_missing_header_mean_base_currency(raw):
    rest = raw("REST", invoice_pages(invoice(1), invoice(2, rate=100.0)))
    bulk = raw("OPENAPI", line_pages(line(1, 1), line(2, 1), line(3, 1)))
    lines = bronze.invoice_lines(bulk, rest)
    assert rows(lines, "invoice_number", "line_net_amount_base_currency") == [(1, 100.0), (2, 100.0), (3, 100.0)]
    assert unmatched(lines, bronze.invoices(rest), ["invoice_number"]).count() == 1
    assert reports.lines_without_date(lines, bronze.invoices(rest)).first()[0] == 1


def test_duplicate_headers_do_not_multiply_lines(raw):
    rest = raw("REST", invoice_pages(invoice(1, rate=50.0), invoice(1, rate=200.0)), invoice_pages(invoice(1, rate=300.0), at=SECOND))
    bulk = raw("OPENAPI", line_pages(line(1, 1), line(1, 1, amount=7.0)), line_pages(line(1, 1, amount=10.0), at=SECOND))
    assert rows(bronze.invoice_lines(bulk, rest), "line_net_amount", "line_net_amount_base_currency") == [(10.0, 30.0)]


def test_lines_are_shuffled_once_also_with_their_headers(spark, raw):
    rest = raw("REST", invoice_pages(invoice(1), invoice(2)))
    bulk = raw("OPENAPI", line_pages(line(1, 1), line(1, 2), line(2, 1)), line_pages(line(1, 1, amount=3.0), at=SECOND))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        headers = bronze.invoices(rest)
        lines = bronze.invoice_lines(bulk, rest)
        dated = lines.join(headers.select("invoice_number", "invoice_date"), "invoice_number")
        # Rates and dates take a shuffle of headers each.
        assert plan(lines).count("Exchange hashpartitioning") == 2 and plan(dated).count("Exchange hashpartitioning") == 3
        assert rows(dated, "invoice_number", "line_number", "line_net_amount") == [(1, 1, 3.0), (1, 2, 100.0), (2, 1, 100.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_loading_twice_gives_the_same_entities(raw):
    once = raw("REST", invoice_pages(invoice(1), invoice(2)), (FIRST, "customers", 0, {"collection": [customer(1)]}))
    twice = once.unionByName(once.withColumn("date_inserted", F.to_timestamp(F.lit(SECOND))))
    for build in (bronze.invoices, bronze.customers):
        assert rows(build(once).drop("api_timestamp")) == rows(build(twice).drop("api_timestamp"))


def test_prebuilt_headers_give_the_same_lines(raw):
    rest, bulk = raw("REST", invoice_pages(SAMPLE_INVOICE)), raw("OPENAPI", line_pages(*SAMPLE_LINES))
    assert rows(bronze.invoice_lines(bulk, rest)) == rows(bronze.invoice_lines(bulk, rest, headers=bronze.invoices(rest)))


def test_ingestion_metadata_merges_tables_by_endpoint(raw):
    rest = raw("REST", (FIRST, "products", 0, {"collection": [{}]}), (SECOND, "products", 3, {"collection": []}))
    shop = raw("SHOP", (FIRST, "products", 1, {"products": [{}, {}]}))
    got = bronze.ingestion_metadata(rest, shop)
    assert rows(got, "api_endpoint", "page_count", "total_records", "max_page_number") == [("products", 3, 3, 3)]


def test_materialised_entity_prunes_columns_and_pushes_filters(raw, tmp_path):
    rest = raw("REST", invoice_pages(*[invoice(i, f"2025-01-{i:02d}") for i in range(1, 29)]))
    table = materialise(bronze.invoices(rest), str(tmp_path / "invoices"))
    recent = table.filter(F.col("invoice_date") >= F.lit("2025-01-20").cast("date")).select("invoice_number")
    text = plan(recent)
    assert "GreaterThanOrEqual(invoice_date,2025-01-20)" in text and "recipient_city" not in text
    assert recent.count() == 9


def test_bucketed_entities_join_without_shuffle(spark):
    big = spark.range(1000).selectExpr("id % 100 as invoice_number", "id as v")
    heads = spark.range(100).selectExpr("id as invoice_number", "id * 2 as w")
    left, right = save_bucketed(big, "b_lines", ("invoice_number",), 4), save_bucketed(heads, "b_heads", ("invoice_number",), 4)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "invoice_number")
        assert "Exchange" not in plan(joined) and joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
