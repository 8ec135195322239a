from __future__ import annotations

import re
from collections import Counter

import pytest
from helpers import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from ledgerlake.operators import aggregates, dedup, joins, keys

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
texts = hs.one_of(hs.none(), hs.sampled_from(["", "a", "b", "B", "ø", "zz"]))


def nulls_last(value):
    return (value is None, (value or "").encode())


@FEW
@given(data=hs.lists(hs.tuples(texts, hs.integers(0, 3)), min_size=1, max_size=25))
def test_latest_per_key_matches_brute_force(spark, data):
    data = [(k, ts, i) for i, (k, ts) in enumerate(data)]
    got = dedup.latest_per_key(spark.createDataFrame(data, "k string, ts int, id int"), ["k"],
                               dedup.newest_first("ts", "id"))
    best = {}
    for k, ts, i in data:
        best[k] = max(best.get(k, (-1, -1)), (ts, i))
    assert {(r.k, r.ts, r.id) for r in got.collect()} == {(k, *v) for k, v in best.items()}


@FEW
@given(data=hs.lists(hs.tuples(texts, texts), min_size=1, max_size=25))
def test_dense_keys_match_brute_force(spark, data):
    got = keys.dense_keys(spark.createDataFrame(data, "a string, b string"), ["a", "b"], "id", base=-100)
    order = sorted(set(data), key=lambda r: (nulls_last(r[0]), nulls_last(r[1])))
    assert {(r.a, r.b): r.id for r in got.collect()} == {r: -101 - i for i, r in enumerate(order)}


@FEW
@given(data=hs.lists(hs.tuples(hs.sampled_from(["x", "y", "z"]), texts), min_size=1, max_size=25))
def test_dense_ranks_within_groups_match_brute_force(spark, data):
    got = keys.dense_ranks_within(spark.createDataFrame(data, "g string, t string"), "g", "t", "rank")
    want = {}
    for g in {g for g, _ in data}:
        for i, t in enumerate(sorted({t for h, t in data if h == g}, key=nulls_last)):
            want[g, t] = i + 1
    assert {(r.g, r.t): r["rank"] for r in got.collect()} == want


@pytest.mark.parametrize("unit", [1 << 16, 3])
def test_row_keys_number_equal_rows_and_split_them(spark, monkeypatch, unit):
    monkeypatch.setattr(keys, "COPIES_PER_TASK_UNIT", unit)
    data = [("b", 1)] * 10 + [("a", 2), ("a", 1), (None, 5), ("b", 0)]
    got = keys.row_keys(spark.createDataFrame(data, "k string, v int"), ["k"], "id", base=-10000)
    order = sorted(data, key=lambda r: (nulls_last(r[0]), r[1]))
    assert sorted((r.id, r.k, r.v) for r in got.collect()) == sorted((-10001 - i, *r) for i, r in enumerate(order))


def test_row_keys_never_gather_rows_in_one_partition(spark):
    got = keys.row_keys(spark.range(200).selectExpr("id % 7 as k", "id"), ["k"], "key", sign=1)
    assert "SinglePartition" not in plan(got)
    assert sorted(r.key for r in got.collect()) == list(range(1, 201))


def test_keys_of_empty_input(spark):
    empty = spark.createDataFrame([], "k string")
    assert keys.dense_keys(empty, ["k"], "id").collect() == []
    assert keys.row_keys(empty, ["k"], "id").collect() == []


def test_attach_key_is_null_safe(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    ids = keys.dense_keys(df, ["k"], "id")
    assert rows(keys.attach_key(df, ids, ["k"], "id"), "k", "id") == [("a", -1), ("b", -2), (None, -3)]


def test_latest_per_key_cuts_rows_before_the_shuffle(spark):
    df = dedup.latest_per_key(spark.range(100).selectExpr("id % 3 as k", "id"), ["k"], dedup.newest_first("id"))
    text = plan(df)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_retention_keeps_ties_and_complements(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 5)], "k string, ts int")
    assert rows(dedup.retain_latest(df, ["k"], "ts")) == [("a", 2), ("a", 2), ("b", 5)]
    assert rows(dedup.superseded(df, ["k"], "ts")) == [("a", 1)]


def test_top_per_group_in_top_groups(spark):
    df = spark.createDataFrame([("x", "p", 5.0), ("x", "q", 6.0), ("x", "p", 3.0), ("y", "r", 4.0), ("z", "s", 1.0)],
                               "g string, m string, v double")
    got = dedup.top_per_group(df, ["g"], ["m"], F.col("v"), k=1, top_groups=2)
    assert rows(got, "g", "m", "total") == [("x", "p", 8.0), ("y", "r", 4.0)]


@FEW
@given(data=hs.lists(hs.tuples(hs.integers(0, 2), texts), min_size=1, max_size=30))
def test_mode_matches_brute_force(spark, data):
    got = aggregates.mode_per_key(spark.createDataFrame(data, "k int, v string"), ["k"], "v", "m")
    want = {}
    for k in {k for k, _ in data}:
        counts = Counter(v for j, v in data if j == k and v is not None)
        want[k] = min(counts, key=lambda v: (-counts[v], v.encode())) if counts else None
    assert {r.k: r.m for r in got.collect()} == want


def test_joined_text_orders_and_handles_null_groups(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, None)], "k int, g int, v string")
    got = df.groupBy("k").agg(aggregates.joined_text("v", ["g"]).alias("t"))
    assert rows(got) == [(1, "a / b"), (2, "")]


@FEW
@given(data=hs.lists(hs.tuples(hs.integers(0, 2), hs.one_of(hs.none(), hs.integers(0, 1)), hs.integers(-9, 9), texts),
                     max_size=30, unique_by=lambda r: r[:3]))
def test_text_in_pieces_equals_text_at_once(spark, data):
    df = spark.createDataFrame(data, "k int, g int, n long, v string")
    low = F.min(F.struct("n", "v"))
    got = aggregates.joined_in_pieces(df, ["k"], "v", ["g", "n"], "t", piece=4, low=(low, F.min("low")["v"]))
    want = df.groupBy("k").agg(aggregates.joined_text("v", ["g", "n"]).alias("t"), low["v"].alias("low"))
    assert rows(got, "k", "t", "low") == rows(want, "k", "t", "low")


def test_a_long_text_is_made_by_several_tasks(spark):
    df = spark.range(200_000).selectExpr("id div 200000 AS k", "id div 300000 AS g", "id", "string(id) AS v")
    got = aggregates.joined_in_pieces(df, ["k"], "v", ["g", "id"], "t")
    assert re.search(r"Exchange hashpartitioning\(k#\d+L, g#\d+L, _groupingexpression#", plan(got))
    assert got.first().t == " / ".join(map(str, range(200_000)))


def test_shares_sum_to_hundred_and_reuse_the_exchange(spark):
    df = spark.createDataFrame([(k, float(k)) for k in (1, 1, 2, 3, 4, 4, 4, 5)], "k int, v double")
    got = aggregates.share_of_total(df, ["k"], {"n": (F.count(F.lit(1)), "pn"), "s": (F.sum("v"), "ps")})
    data = got.collect()
    assert abs(sum(r.pn for r in data) - 100) < 0.05 and abs(sum(r.ps for r in data) - 100) < 0.05
    assert "ReusedExchange" in plan(got)


def test_share_of_zero_total_is_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0)], "k int, v double")
    got = aggregates.share_of_total(df, ["k"], {"s": (F.sum("v"), "ps")})
    assert rows(got, "ps") == [(None,), (None,)]


def test_many_to_one_checks_and_keeps_row_count(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (3, "c"), (None, "x"), (None, "y")], "k int, v string")
    assert rows(joins.many_to_one(left, right, ["k"])) == [(1, "a"), (1, "a"), (2, None), (None, None)]
    with pytest.raises(joins.DuplicateKeyError):
        joins.many_to_one(left, right.unionByName(right), ["k"], check=True)


def test_one_sided_condition_suppresses_the_match_only(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    right = spark.createDataFrame([(1, "Shop"), (2, None), (3, "Leads")], "id int, name string")
    usable = (F.col("name") != "Shop") | F.col("name").isNull()
    assert rows(joins.lookup_where(left, right, "c", "id", usable), "c", "id", "name") == [
        (1, None, None), (2, 2, None), (3, 3, "Leads")]


def _equal(a, b):
    return None if a is None or b is None else a == b


def _not_in(row, pairs):
    """SQL's row NOT IN (pairs): True, False or None."""
    unknown = False
    for pair in pairs:
        same = [_equal(a, b) for a, b in zip(row, pair)]
        if all(same):
            return False
        unknown |= False not in same
    return None if unknown else True


def test_retention_treats_nulls_as_not_in_does(spark):
    from ledgerlake.operators import dedup

    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 2), ("b", None)], "k string, t int")
    assert rows(dedup.retain_latest(df, ["k"], "t")) == [("a", 2), ("b", None), (None, 1), (None, 2)]
    assert rows(dedup.superseded(df, ["k"], "t")) == [("a", 1)]


@pytest.mark.parametrize("seed,nulls", [(1, 0.0), (2, 0.15), (3, 0.4), (4, 0.8)])
@pytest.mark.parametrize("width", [1, 2])
def test_retention_equals_not_in_row_by_row(spark, seed, nulls, width):
    import random

    from ledgerlake.operators import dedup

    rnd = random.Random(seed)
    data = [tuple(None if rnd.random() < nulls * (0.6 if n == width else 1) else rnd.randrange(9 if n == width else 5) for n in range(width + 1))
            for _ in range(60)]
    pairs = [(*key, max((r[-1] for r in data if r[:-1] == key and r[-1] is not None), default=None)) for key in {r[:-1] for r in data}]
    keys = [f"k{n}" for n in range(width)]
    df = spark.createDataFrame(data, ", ".join(f"{k} int" for k in keys) + ", t int").withColumn("payload", F.lit("x"))
    ordered = sorted(data, key=lambda r: [(v is None, v or 0) for v in r])
    want = {True: [r for r in ordered if _not_in(r, pairs) is True], False: [r for r in ordered if _not_in(r, pairs) is not True]}
    assert rows(dedup.superseded(df, keys, "t"), *keys, "t") == want[True]
    assert rows(dedup.retain_latest(df, keys, "t"), *keys, "t") == want[False]
    loops = plan(dedup.superseded(df, keys, "t")).count("NestedLoop") + plan(dedup.retain_latest(df, keys, "t")).count("NestedLoop")
    assert loops == 0
