from __future__ import annotations

import datetime as dt
import json
import urllib.parse

import pytest
from helpers import plan, rows
from fixtures import FIRST, SECOND, customer, invoice, line
from pyspark.sql import functions as F

from ledgerlake.operators import incremental as inc
from ledgerlake.operators.variants import parse
from ledgerlake.plans import bronze, reports
from ledgerlake.sources import config, files, page_index, pages, store
from ledgerlake.streaming.landing import land_batch, land_once, start_landing

T1, T2 = dt.datetime(2025, 1, 1, 6), dt.datetime(2025, 2, 1, 6)


def land(root, endpoint, load, number, page):
    folder = root / f"api_endpoint={urllib.parse.quote(endpoint, safe='')}" / f"load_id={load}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"page-{number:04d}.json").write_text(json.dumps(page, indent=1, ensure_ascii=False))


def test_page_files(spark, tmp_path):
    land(tmp_path, "invoices/booked", "2025", 0, {"collection": [invoice(1), invoice(2)]})
    land(tmp_path, "invoices/booked", "2025", 12, {"collection": []})
    land(tmp_path, "customers", "2025", 0, {"pagination": {}})
    raw = pages.read_pages(spark, str(tmp_path), "REST", inserted=F.lit(T1))
    assert raw.columns == pages.RAW_COLUMNS
    assert rows(raw, "api_endpoint", "load_id", "page_number", "record_count_per_page") == [
        ("customers", "2025", 0, 0), ("invoices/booked", "2025", 0, 2), ("invoices/booked", "2025", 12, 0)]
    assert bronze.invoices(raw).count() == 2


def test_page_lines_round_trip(spark, tmp_path, raw):
    source = raw("OPENAPI", (FIRST, "invoices/booked/lines", 3, {"items": [line(1, 1, "Å / ø")], "cursor": "c"}))
    landed = source.select("api_endpoint", "load_id", "page_number", F.col("collection_json").alias("page"))
    pages.land_page_lines(landed, str(tmp_path / "l"))
    back = pages.read_pages(spark, str(tmp_path / "l"), "OPENAPI", lines=True)
    assert rows(back.select("api_endpoint", "load_id", "page_number", F.to_json("collection_json").alias("j"))) == rows(
        source.select("api_endpoint", "load_id", "page_number", F.to_json("collection_json").alias("j")))


def test_append_is_idempotent_and_reload_replaces(spark, tmp_path, raw):
    path, shop = str(tmp_path / "raw"), str(tmp_path / "shop")
    one = raw("REST", (FIRST, "customers", 0, {"collection": [customer(1)]}))
    two = raw("REST", (SECOND, "customers", 0, {"collection": [customer(2)]}), (SECOND, "invoices/booked", 0, {"collection": []}))
    for load in (one, two, two):
        pages.append_raw(load, path)
    assert rows(pages.read_raw(spark, path), "api_endpoint", "load_id") == [
        ("customers", FIRST), ("customers", SECOND), ("invoices/booked", SECOND)]
    assert rows(bronze.customers(pages.read_raw(spark, path)), "customer_number") == [(1,), (2,)]
    for load in (two, one):
        pages.reload_raw(load, shop)
    assert rows(pages.read_raw(spark, shop), "load_id") == [(FIRST,)]


def test_endpoint_configuration(spark, raw):
    erp, shop = config.endpoints(spark, T1), config.endpoints(spark, T1, shop=True)
    assert {r.endpoint_path for r in config.active_endpoints(erp, "rest").collect()} == {"customers", "products", "invoices/booked"}
    assert rows(config.active_endpoints(erp, "OpenApi"), "endpoint_path") == [("invoices/booked/lines",)]
    assert rows(reports.endpoint_counts(erp)) == [("OPENAPI", False, 2), ("OPENAPI", True, 1), ("REST", False, 5), ("REST", True, 3)]
    assert shop.count() == 4
    kept = config.configured_pages(raw("REST", (FIRST, "customers", 0, {}), (FIRST, "invoices/drafts", 0, {})), erp, "REST")
    assert rows(kept, "api_endpoint", "default_pagesize") == [("customers", 1000)]


def test_csv_files(spark, tmp_path):
    (tmp_path / "p.csv").write_text('SKU,Pap,Note\n"A,1",NULL,"say ""hi"""\nnull,,x\n')
    sheet = files.read_packaging_csv(spark, str(tmp_path / "p.csv"))
    assert rows(sheet) == [("A,1", None, 'say "hi"'), (None, None, "x")]
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "n int, t string")
    for _ in range(2):
        files.export_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert rows(back) == [("1", 'a "b", c'), ("2", None)]
    (tmp_path / "e.csv").write_text("PRODUCT,COLOR,SIZE,SKU,EAN,CATEGORY_NO,CATEGORY_NAME\nLeash,Red,07,x,0012,3,Leads\n")
    assert rows(files.read_expired_list(spark, str(tmp_path / "e.csv"))) == [("Leash", "Red", "07", "x", "0012", "3", "Leads")]


def test_delta_filters(spark):
    df = spark.createDataFrame([(1, T1), (2, T2), (3, None)], "n bigint, at timestamp")
    assert rows(inc.delta_by_time(df, "at", T2), "n") == [(2,)]
    assert inc.delta_by_time(df, "at", None).count() == 3
    assert rows(inc.delta_by_number(df, "n", 1), "n") == [(2,), (3,)]
    assert inc.delta_by_number(df, "n", 0).count() == inc.delta_by_number(df, "n", None).count() == 3


def test_marks_advance_only_for_endpoints_with_records(spark, raw):
    run = raw("REST", (FIRST, "customers", 0, {"collection": [customer(1, lastUpdated="2025-01-02T00:00:00Z"), customer(2)]}),
              (FIRST, "products", 0, {"collection": []}), (FIRST, "invoices/booked", 0, {"collection": [invoice(7), invoice(5)]}),
              (FIRST, "invoices/drafts", 0, {"collection": [{"x": 1}]}))
    marks = inc.update_marks(inc.seed_marks(spark, T1), inc.run_stats(run, "REST"), T2)
    got = {r.api_endpoint: r for r in marks.collect()}
    assert str(got["customers"].last_updated_timestamp) == "2025-01-02 00:00:00" and got["customers"].updated_at == T2
    assert got["customers"].created_at == T1 and got["customers"].last_invoice_number is None
    assert (got["invoices/booked"].last_invoice_number, got["invoices/booked"].total_records_loaded) == (7, 2)
    assert (got["products"].updated_at, got["products"].last_run_records) == (T1, 0)
    assert got["invoices/booked/lines"].last_invoice_number == 0
    assert (got["invoices/drafts"].created_at, got["invoices/drafts"].last_run_records) == (T2, 1)
    again = inc.update_marks(marks, inc.run_stats(raw("REST", (SECOND, "invoices/booked", 0, {"collection": [invoice(9)]})), "REST"), T2)
    kept = {r.api_endpoint: r for r in again.collect()}
    assert (kept["invoices/booked"].last_invoice_number, kept["invoices/booked"].total_records_loaded,
            kept["invoices/booked"].last_run_records) == (9, 3, 1)
    assert kept["customers"].last_updated_timestamp == got["customers"].last_updated_timestamp


def test_new_records_follow_the_endpoint_rule(spark, raw):
    run = raw("REST", (FIRST, "customers", 0, {"collection": [
        customer(1, lastUpdated="2025-01-02T00:00:00Z"), customer(2, lastUpdated="2024-01-02T00:00:00Z")]}),
        (FIRST, "invoices/booked", 0, {"collection": [invoice(7), invoice(5)]}))
    marks = inc.update_marks(inc.seed_marks(spark, T1), inc.run_stats(run, "REST"), T2)
    assert rows(inc.new_records(bronze.customers(run), "customers", marks), "customer_number") == [(1,)]
    assert inc.new_records(bronze.invoices(run), "invoices/booked", marks).count() == 0
    assert inc.new_records(bronze.invoices(run), "invoices/booked", inc.seed_marks(spark, T1)).count() == 2
    assert inc.new_records(bronze.invoices(run), "invoices/drafts", marks).count() == 2


def test_bulk_marks_follow_document_numbers(raw):
    run = raw("OPENAPI", (FIRST, "invoices/booked/lines", 0, {"items": [line(4, 1), line(11, 1)]}),
              (FIRST, "invoices/booked/lines", 1, {"items": [line(8, 1)]}))
    assert rows(inc.run_stats(run, "OPENAPI"), "api_endpoint", "base", "new_number", "run_records") == [
        ("invoices/booked/lines", "OPENAPI", 11, 3)]


def test_mark_versions(spark, tmp_path):
    path = str(tmp_path / "marks")

    def seed():
        return inc.seed_marks(spark, T1)
    assert store.read_marks(spark, path, seed).count() == 4
    for version, number in ((0, 5), (1, 9), (1, 8)):
        store.commit_marks(seed().withColumn("last_invoice_number", F.lit(number).cast("bigint")), path, version)
    assert {r.last_invoice_number for r in store.read_marks(spark, path, seed).collect()} == {8}
    assert {r.last_invoice_number for r in store.read_marks(spark, path, seed, before=1).collect()} == {5}
    assert store.read_marks(spark, path, seed, before=0).filter("total_records_loaded > 0").count() == 0


@pytest.mark.parametrize("sizes,gap_free,ends_short", [
    ({0: 2, 1: 2, 2: 1}, True, True), ({0: 2, 1: 2, 2: 0}, True, True), ({0: 2, 1: 2}, True, False),
    ({0: 2, 2: 1}, False, True), ({1: 2, 2: 1}, False, True), ({0: 1, 1: 2, 2: 1}, True, False), ({0: 0}, True, True)])
def test_load_completeness(raw, sizes, gap_free, ends_short):
    run = raw("REST", *[(FIRST, "e", n, {"collection": [{}] * size}) for n, size in sizes.items()])
    got = inc.load_completeness(run, 2).first()
    assert (got.gap_free, got.ends_short, got.complete) == (gap_free, ends_short, gap_free and ends_short)


def test_repeated_page_is_not_gap_free(raw):
    run = raw("REST", (FIRST, "e", 0, {"collection": [{}] * 2}), (FIRST, "e", 0, {"collection": [{}] * 2}), (FIRST, "e", 1, {}))
    assert inc.load_completeness(run, 2).first().gap_free is False


def test_page_gaps(raw):
    run = raw("REST", *[(FIRST, "e", n, {}) for n in (0, 1, 3, 4, 9)], *[(SECOND, "e", n, {}) for n in (0, 1, 2)])
    assert rows(inc.page_gaps(run)) == [("e", FIRST, 1), ("e", FIRST, 4)]


def test_page_runs_across_blocks(spark, raw, monkeypatch):
    monkeypatch.setattr(inc, "RUN_BLOCK", 4)
    numbers = [0, 1, 2, 3, 4, 5, 9, 9, 10, 11, 12, 30, 31, 33]
    run = raw("REST", *[(FIRST, "e", n, {}) for n in numbers], *[(SECOND, "f", n, {}) for n in (7, 8)])
    odd = run.unionByName(run.limit(1).withColumn("page_number", F.lit(None).cast("bigint")))
    runs = [("e", FIRST, 0, 5), ("e", FIRST, 9, 12), ("e", FIRST, 30, 31), ("e", FIRST, 33, 33), ("f", SECOND, 7, 8)]
    assert rows(inc.page_runs(odd), "api_endpoint", "load_id", "first_page", "last_page") == runs
    assert rows(inc.page_gaps(odd)) == [("e", FIRST, 5), ("e", FIRST, 12), ("e", FIRST, 31)]
    assert inc.page_gaps(odd.where("false")).count() == 0


def test_page_gaps_read_pages_once(spark, tmp_path):
    spark.range(100).selectExpr("'e' AS api_endpoint", "'l' AS load_id", "id AS page_number").write.parquet(str(tmp_path / "p"))
    text = plan(inc.page_gaps(spark.read.parquet(str(tmp_path / "p"))))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_ingest_summary_has_a_total(raw):
    run = raw("REST", (FIRST, "a", 0, {"collection": [{}]}), (FIRST, "a", 1, {}), (FIRST, "b", 0, {"collection": [{}, {}]}))
    assert rows(inc.ingest_summary(run)) == [("a", 1, 2), ("b", 2, 1), (None, 3, 3)]


def test_coverage_reports(raw):
    run = raw("REST", (FIRST, "a", 0, {"collection": [{}]}), (SECOND, "a", 4, {}))
    assert rows(reports.endpoint_coverage(run), "total_records", "page_count", "pages_loaded") == [(1, 2, 5)]
    assert rows(reports.raw_coverage(one=run, two=run), "table_name", "row_count", "unique_endpoints") == [("one", 2, 1), ("two", 2, 1)]


def test_stream_lands_each_file_once(spark, tmp_path):
    root, raw_path, marks_path, check = (str(tmp_path / d) for d in ("in", "raw", "marks", "check"))

    def run(now):
        start_landing(spark, root, "REST", raw_path, marks_path, check, lambda: now).awaitTermination()
        marks = store.read_marks(spark, marks_path, lambda: inc.seed_marks(spark, T1))
        found = {r.api_endpoint: r for r in marks.collect()}
        return found, pages.read_raw(spark, raw_path).count()

    land(tmp_path / "in", "invoices/booked", "a", 0, {"collection": [invoice(1), invoice(2)]})
    land(tmp_path / "in", "invoices/booked", "a", 1, {"collection": [invoice(3)]})
    marks, count = run(T1)
    assert (count, marks["invoices/booked"].last_invoice_number, marks["invoices/booked"].total_records_loaded) == (2, 3, 3)
    marks, count = run(T2)
    assert count == 2 and marks["invoices/booked"].total_records_loaded == 3
    land(tmp_path / "in", "invoices/booked", "b", 0, {"collection": [invoice(9), invoice(3, delivery="FR")]})
    marks, count = run(T2)
    assert (count, marks["invoices/booked"].last_invoice_number, marks["invoices/booked"].total_records_loaded) == (3, 9, 5)
    got = bronze.invoices(pages.read_raw(spark, raw_path))
    assert rows(got, "invoice_number", "delivery_country") == [(1, None), (2, None), (3, "FR"), (9, None)]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    land(tmp_path / "in", "invoices/booked", "a", 0, {"collection": [invoice(1), invoice(2)]})
    raw_path, marks_path = str(tmp_path / "raw"), str(tmp_path / "marks")
    landed = spark.read.schema(pages.LANDED_SCHEMA).option("wholetext", True).format("text").load(str(tmp_path / "in"))
    write = land_batch("REST", raw_path, marks_path, lambda: T1)
    for _ in range(2):
        write(pages.parse_page_files(landed), 0)
    assert pages.read_raw(spark, raw_path).count() == 1
    marks = store.read_marks(spark, marks_path, lambda: inc.seed_marks(spark, T1))
    assert marks.filter("api_endpoint = 'invoices/booked'").first().total_records_loaded == 2


def test_batch_loads_add_or_replace(spark, tmp_path):
    raw_path, shop_path, marks_path = (str(tmp_path / d) for d in ("raw", "shop", "marks"))
    for version, number in ((0, 4), (1, 6), (1, 6)):
        root = tmp_path / f"in{version}"
        land(root, "invoices/booked", f"l{version}", 0, {"collection": [invoice(number)]})
        land(tmp_path / f"shop{version}", "products", f"l{version}", 0, {"products": [{"id": number}]})
        land_once(spark, str(root), "REST", raw_path, marks_path, version, T1)
        land_once(spark, str(tmp_path / f"shop{version}"), "SHOP", shop_path, marks_path, version, T1)
    marks = {r.api_endpoint: r for r in store.read_marks(spark, marks_path, lambda: inc.seed_marks(spark, T1)).collect()}
    assert (marks["invoices/booked"].last_invoice_number, marks["invoices/booked"].total_records_loaded) == (6, 2)
    assert rows(bronze.invoices(pages.read_raw(spark, raw_path)), "invoice_number") == [(4,), (6,)]
    assert rows(bronze.shop_products(pages.read_raw(spark, shop_path)), "product_id") == [(6,)]


def _marks(spark, path):
    return {r.api_endpoint: r for r in store.read_marks(spark, path, lambda: inc.seed_marks(spark, T1)).collect()}


def test_sources_share_folders_without_loss(spark, tmp_path):
    """A batch load, a stream and a stream with a new checkpoint add to one load; bulk marks live beside REST marks."""
    raw_path, bulk_path, marks_path = (str(tmp_path / d) for d in ("raw", "bulkraw", "marks"))
    rest, bulk = tmp_path / "rest", tmp_path / "bulk"
    for n in range(3):
        land(rest, "invoices/booked", "a", n, {"collection": [invoice(n + 1)]})
    for version in (0, 1):  # the second run adds nothing
        land_once(spark, str(rest), "REST", raw_path, marks_path, version, T1)
    assert pages.read_raw(spark, raw_path).count() == 3 and _marks(spark, marks_path)["invoices/booked"].total_records_loaded == 3
    for n, check in ((3, "c1"), (4, "c2")):
        land(rest, "invoices/booked", "a", n, {"collection": [invoice(n + 1)] * (n == 3)})
        start_landing(spark, str(rest), "REST", raw_path, marks_path, str(tmp_path / check), lambda: T2, files_per_batch=1).awaitTermination()
    land(bulk, "invoices/booked/lines", "a", 0, {"items": [line(4, 1)]})
    start_landing(spark, str(bulk), "OPENAPI", bulk_path, marks_path, str(tmp_path / "c3"), lambda: T2).awaitTermination()
    found = pages.read_raw(spark, raw_path)
    assert rows(found, "load_id", "page_number") == [("a", n) for n in range(5)]
    check = inc.load_completeness(found, 1).first()
    assert (check.load_id, check.page_count, check.complete) == ("a", 5, True)
    marks = _marks(spark, marks_path)
    assert (marks["invoices/booked"].total_records_loaded, marks["invoices/booked"].last_invoice_number) == (4, 4)
    assert marks["invoices/booked/lines"].total_records_loaded == 1 and len(marks) == 4


def test_shop_stream_replaces_per_load(spark, tmp_path):
    root, raw_path, check = (str(tmp_path / d) for d in ("in", "raw", "check"))
    for load, ids in (("a", (1, 2)), ("b", (3, 4))):
        for n, i in enumerate(ids):
            land(tmp_path / "in", "products", load, n, {"products": [{"id": i}]})
        start_landing(spark, root, "SHOP", raw_path, str(tmp_path / "marks"), check, lambda: T1, files_per_batch=1).awaitTermination()
        assert rows(pages.read_raw(spark, raw_path), "load_id", "page_number") == [(load, 0), (load, 1)]


def test_inactive_endpoints_are_not_landed(spark, tmp_path):
    from ledgerlake.sources.config import ENDPOINT_SCHEMA

    config = spark.createDataFrame([("customers", "REST", None, 1000, 0, False, T1), ("invoices/booked", "REST", None, 1000, 0, True, T1)], ENDPOINT_SCHEMA)
    land(tmp_path / "in", "customers", "a", 0, {"collection": [{"customerNumber": 1}]})
    land(tmp_path / "in", "invoices/booked", "a", 0, {"collection": [invoice(1)]})
    raw_path, marks_path = str(tmp_path / "raw"), str(tmp_path / "marks")
    land_once(spark, str(tmp_path / "in"), "REST", raw_path, marks_path, 0, T1, endpoints=config)
    assert rows(pages.read_raw(spark, raw_path), "api_endpoint") == [("invoices/booked",)]
    assert _marks(spark, marks_path)["customers"].total_records_loaded == 0


def test_shop_endpoints_may_have_different_loads(spark, tmp_path):
    """Loads of one run named apart per endpoint: each endpoint keeps its newest one."""
    root, raw_path, check = (str(tmp_path / d) for d in ("in", "raw", "check"))

    def run():
        start_landing(spark, root, "SHOP", raw_path, str(tmp_path / "marks"), check, lambda: T1, files_per_batch=2).awaitTermination()
        return rows(pages.read_raw(spark, raw_path), "api_endpoint", "load_id", "page_number")

    land(tmp_path / "in", "products", "2025-01-01 06:00", 0, {"products": [{"id": 1}]})
    land(tmp_path / "in", "products", "2025-01-01 06:00", 1, {"products": [{"id": 2}]})
    land(tmp_path / "in", "categories", "2025-01-01 06:07", 0, {"categories": [{"id": 1}]})
    land(tmp_path / "in", "combinations", "2025-01-01 06:09", 0, {"combinations": [{"id": 1}]})
    first = [("categories", "2025-01-01 06:07", 0), ("combinations", "2025-01-01 06:09", 0),
             ("products", "2025-01-01 06:00", 0), ("products", "2025-01-01 06:00", 1)]
    assert run() == first
    land(tmp_path / "in", "products", "2025-02-01 06:00", 0, {"products": [{"id": 3}]})
    land(tmp_path / "in", "categories", "2024-12-01 06:00", 0, {"categories": [{"id": 9}]})  # older than what is there
    assert run() == [*first[:2], ("products", "2025-02-01 06:00", 0)]
    index = page_index.read_index(spark, raw_path)
    assert rows(index.select("api_endpoint", "load_id").distinct()) == [(e, at) for e, at, _ in [*first[:2], ("products", "2025-02-01 06:00", 0)]]


def test_a_batch_meets_its_own_loads_only(spark, tmp_path):
    raw_path, marks_path = str(tmp_path / "raw"), str(tmp_path / "marks")
    for version, load in enumerate("abc"):
        for n in (0, 40_000):
            land(tmp_path / load, "invoices/booked", load, n, {"collection": [invoice(n + version)]})
        land_once(spark, str(tmp_path / load), "REST", raw_path, marks_path, version, T1)
    batch = pages.read_pages(spark, str(tmp_path / "b"), "REST")
    loads = page_index.loads_of(batch)
    landed = page_index.landed_by_others(spark, raw_path, "once-9", loads)
    assert {r[0].split("load_id=")[1][0] for r in landed.select(F.input_file_name()).collect()} == {"b"}
    text = plan(page_index.not_landed(batch, landed))
    assert "PartitionFilters" in text and "load_id#" in text.split("PartitionFilters: [")[-1].split("]")[0]
    assert page_index.not_landed(batch, landed).count() == 0
    assert page_index.not_landed(batch, page_index.landed_by_others(spark, raw_path, "once-1", loads)).count() == 2
    mine = pages.read_batch(spark, raw_path, "once-1", page_index.of_loads(loads))
    assert {r[0].split("load_id=")[1][0] for r in mine.select("page_number").select(F.input_file_name()).collect()} <= {"b"}


def test_index_of_odd_page_numbers(spark, tmp_path, raw):
    numbers = [0, 1, 7, 8, 32767, 32768, 32769, -1, -32768, 10**12]
    path = str(tmp_path / "raw")
    some = raw("REST", *[(FIRST, "e", n, {}) for n in numbers[::2]])
    nameless = some.limit(1).withColumn("page_number", F.lit(None).cast("bigint"))
    pages.append_raw(some, path, "one")  # a store without an index gets one
    asked = raw("REST", *[(FIRST, "e", n, {}) for n in numbers]).unionByName(nameless)
    loads = page_index.loads_of(asked)
    new = page_index.not_landed(asked, page_index.landed_by_others(spark, path, "two", loads))
    assert sorted(r.page_number for r in new.collect() if r.page_number is not None) == sorted(numbers[1::2])
    pages.append_raw(nameless, path, "three")
    page_index.write_index(spark, path, "three", {load: 5 for load in loads})
    landed = page_index.landed_by_others(spark, path, "two", loads)
    assert page_index.not_landed(asked, landed).where("page_number IS NULL").count() == 0
    assert page_index.starts(landed, [*loads, ("e", "new")], 7) == {loads[0]: 0, ("e", "new"): 7}


def test_only_records_beyond_the_marks_land(spark, tmp_path):
    raw_path, bulk_path, marks_path = (str(tmp_path / d) for d in ("raw", "bulk", "marks"))

    def run(folder, kind, version, path):
        land_once(spark, str(tmp_path / folder), kind, path, marks_path, version, T1, only_new=True)
        return _marks(spark, marks_path)

    land(tmp_path / "a", "customers", "a", 0, {"collection": [customer(1, lastUpdated="2025-01-02T00:00:00Z"), customer(2)], "pagination": {"n": 1}})
    land(tmp_path / "a", "invoices/booked", "a", 0, {"collection": [invoice(4), invoice(6)]})
    land(tmp_path / "a", "other", "a", 0, {"collection": [{"x": 1}]})
    land(tmp_path / "al", "invoices/booked/lines", "a", 0, {"items": [line(4, 1), line(6, 1)]})
    assert run("a", "REST", 0, raw_path)["invoices/booked"].total_records_loaded == 2
    run("al", "OPENAPI", 0, bulk_path)
    land(tmp_path / "b", "customers", "b", 0, {"collection": [
        customer(1, lastUpdated="2025-01-01T00:00:00Z"), customer(3, lastUpdated="2025-01-02T00:00:00Z"),
        customer(4, lastUpdated="2025-03-02T00:00:00Z")], "pagination": {"n": 2}})
    land(tmp_path / "b", "invoices/booked", "b", 0, {"collection": [invoice(5), invoice(6)]})
    land(tmp_path / "b", "invoices/booked", "b", 1, {"collection": [invoice(9), invoice(2)]})
    land(tmp_path / "b", "other", "b", 0, {"collection": [{"x": 1}]})
    land(tmp_path / "bl", "invoices/booked/lines", "b", 0, {"items": [line(6, 2), line(7, 1)]})
    for _ in range(2):
        marks = run("b", "REST", 1, raw_path)
        assert (marks["invoices/booked"].total_records_loaded, marks["invoices/booked"].last_run_records) == (3, 1)
        assert (marks["customers"].total_records_loaded, str(marks["customers"].last_updated_timestamp)) == (4, "2025-03-02 00:00:00")
        assert (marks["invoices/booked"].last_invoice_number, marks["other"].total_records_loaded) == (9, 2)
    assert run("bl", "OPENAPI", 1, bulk_path)["invoices/booked/lines"].total_records_loaded == 3
    second = pages.read_raw(spark, raw_path).where("load_id = 'b'")
    assert rows(second, "api_endpoint", "page_number", "record_count_per_page") == [
        ("customers", 0, 2), ("invoices/booked", 0, 0), ("invoices/booked", 1, 1), ("other", 0, 1)]
    kept = second.where("api_endpoint = 'customers'").select(F.to_json("collection_json").alias("j")).first().j
    assert [r["customerNumber"] for r in json.loads(kept)["collection"]] == [3, 4] and json.loads(kept)["pagination"] == {"n": 2}
    assert rows(bronze.invoices(pages.read_raw(spark, raw_path)), "invoice_number") == [(4,), (6,), (9,)]


def test_pages_of_a_load_follow_the_marks_it_began_with(spark, tmp_path):
    """The page with high numbers comes first; the marks it sets must not cut the other pages of its load."""
    root, raw_path, marks_path = (str(tmp_path / d) for d in ("in", "raw", "marks"))
    land(tmp_path / "in", "invoices/booked", "a", 0, {"collection": [invoice(3)]})
    for n, numbers in ((0, (8, 9)), (1, (2, 4, 5))):
        start_landing(spark, root, "REST", raw_path, marks_path, str(tmp_path / "check"), lambda: T1, only_new=True).awaitTermination()
        land(tmp_path / "in", "invoices/booked", "b", n, {"collection": [invoice(i) for i in numbers]})
    start_landing(spark, root, "REST", raw_path, marks_path, str(tmp_path / "check"), lambda: T1, only_new=True).awaitTermination()
    assert rows(bronze.invoices(pages.read_raw(spark, raw_path)), "invoice_number") == [(3,), (4,), (5,), (8,), (9,)]
    mark = _marks(spark, marks_path)["invoices/booked"]
    assert mark.total_records_loaded == 5


def test_pages_stay_where_they_are_when_the_index_is_asked(spark, tmp_path):
    """All pages of a load share a key of the index: without a broadcast whatever its size they would meet in one task."""
    raw_path = str(tmp_path / "raw")
    for n in (0, 1):
        land(tmp_path / "in", "invoices/booked", "a", n, {"collection": [invoice(n)]})
    land_once(spark, str(tmp_path / "in"), "REST", raw_path, str(tmp_path / "marks"), 0, T1)
    batch = pages.read_pages(spark, str(tmp_path / "in"), "REST")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = page_index.not_landed(batch, page_index.landed_by_others(spark, raw_path, "two-0", page_index.loads_of(batch)))
        assert left.count() == 0 and "Exchange hashpartitioning" not in plan(left)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_files_have_small_pages_and_row_groups(spark, tmp_path):
    """Parquet pages of wide RAW rows do not grow to a hundred rows, nor a reader's batch to a file."""
    import pyarrow.parquet as pq
    wide = spark.range(0, 200, 1, 1).select(
        F.lit(T1).alias("date_inserted"), F.lit("e").alias("api_endpoint"), F.col("id").alias("page_number"), F.lit(1).cast("bigint").alias("record_count_per_page"),
        parse(F.to_json(F.struct(F.repeat(F.sha2(F.col("id").cast("string"), 512), 500).alias("t")))).alias("collection_json"), F.lit("l").alias("load_id"))
    for write, name in ((pages.append_raw, "a"), (pages.reload_raw, "r")):
        write(wide, str(tmp_path / name))
        stored, = (tmp_path / name).rglob("*.parquet")
        meta = pq.ParquetFile(stored).metadata
        assert [meta.row_group(g).num_rows for g in range(meta.num_row_groups)] == [64, 64, 64, 8]
        assert rows(pages.read_raw(spark, str(tmp_path / name)).select("page_number", F.to_json("collection_json"))) == rows(
            wide.select("page_number", F.to_json("collection_json")))


def test_json_text_is_landed_as_it_is(spark, tmp_path):
    texts = ['{"collection": [{"a": "x\\ny \u00c5", "n": 1.50}],\n "next":\r\n null}', "[]", "null", None]
    landed = spark.createDataFrame([("e / 1", "l", n, t) for n, t in enumerate(texts)] + [("e / 1", "l", None, "{}")],
                                   "api_endpoint string, load_id string, page_number bigint, page string")
    variant = landed.withColumn("page", parse(F.col("page")))
    seen = []
    for name, some in (("text", landed), ("variant", variant)):
        pages.land_page_lines(some, str(tmp_path / name))
        back = pages.read_pages(spark, str(tmp_path / name), "REST", lines=True)
        seen.append(rows(back.select("api_endpoint", "load_id", "page_number", "record_count_per_page", F.to_json("collection_json").alias("j"))))
    assert seen[0] == seen[1] and len(seen[0]) == 5


def test_highs_of_odd_records(spark, raw):
    odd = raw("REST", (FIRST, "a", 0, {"collection": [
        {"lastUpdated": "2024-01-01T08:00:00Z", "bookedInvoiceNumber": 5}, {"lastUpdated": "x", "bookedInvoiceNumber": "7"}, 3, None, "s", [1],
        {"bookedInvoiceNumber": 9.5}, {"bookedInvoiceNumber": {"a": 1}}]}), (FIRST, "b", 0, {"collection": {"a": 1}}), (FIRST, "c", 0, {}))
    highs = inc.page_highs(odd, "rest")
    assert rows(highs.select("api_endpoint", "record_count_per_page", F.col("page_timestamp").cast("string"), "page_number_high")) == [
        ("a", 8, "2024-01-01 08:00:00", 9), ("b", 0, None, None), ("c", 0, None, None)]
    assert "transform(" not in plan(highs)
