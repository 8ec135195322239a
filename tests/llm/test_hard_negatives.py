"""Hard negatives against all inner products, by whole numbers of any size."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from ledgerlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    out = []
    for a_id, a_label, a in kept:
        if a_id % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(a, v)), i, lab == a_label) for i, lab, v in kept if i != a_id), key=lambda s: s[:2])
        for less, p_id, _ in [s for s in scored if s[2]][:5]:
            good = [(-s, i) for s, i, same in scored if not same and -30 * less <= -100 * s <= -90 * less][:10]
            out += [(a_id, p_id, k + 1, i, -less, s) for k, (s, i) in enumerate(good)]
    return sorted(out)


def mined(spark, rows, *extra):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *extra)
    return sorted(tuple(r) for r in hn.mine(df).collect())


def some(n, seed, wide=6, step=0.25):
    """Coarse components, so that scores tie."""
    rnd = random.Random(seed)
    return [(k, [rnd.randint(-4, 4) * step for _ in range(wide)], rnd.randint(0, 3)) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_with_ties(spark, monkeypatch, seed):
    monkeypatch.setattr(hn, "BLOCK", 70)
    monkeypatch.setattr(hn, "PIECE", 3)
    rows = some(900, seed)
    want = brute(rows)
    assert mined(spark, rows) == want and len(want) > 200


def test_copies_of_one_vector_and_ids_below_zero(spark):
    rows = some(300, 3) + [(1000 + k, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0], 2) for k in range(400)] + [(-k, v, lab) for k, v, lab in some(120, 4) if k]
    want = brute(rows)
    # Remainders of ids below zero have the sign of the id, as in SQL; -100 is an anchor all the same.
    assert mined(spark, rows) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = some(250, 5) + [
        (None, [1.0] * 6, 1), (301, None, 1), (302, [1.0] * 6, None), (303, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (304, [nan] * 6, 1),
        (305, [inf] * 6, 2), (306, [-inf] * 6, 2), (307, [], 1), (308, [1.0], 1), (309, [0.5] * 9, 1), (400, [0.0] * 6, 1), (500, [], 1)]
    want = brute(rows)
    assert mined(spark, rows, "'x' AS packed", "1 AS n", "2 AS rank", "'y' AS vector") == want
    assert mined(spark, rows[:0]) == [] and mined(spark, [(1, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1)]) == [] and mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 3)]) == brute(
        [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 3)])


def test_large_components_are_exact(spark):
    rnd = random.Random(6)
    for size in (1e3, 1e5, 5e6):
        rows = [(k, [rnd.uniform(-size, size) for _ in range(4)], rnd.randint(0, 2)) for k in range(220)]
        assert mined(spark, rows) == brute(rows)
    rows = [(k, [(-1) ** k * 1e300 * k], 1 + k % 2) for k in range(120)]
    assert all(abs(r[4]) <= 2**63 for r in mined(spark, rows))


def test_repeated_ids(spark):
    rows = some(200, 7)
    twice = rows + [(100, rows[3][1], rows[100][2]), (5, rows[5][1], rows[5][2])]
    got = mined(spark, twice)
    assert {r[0] for r in got} <= {0, 100} and not any(r[1] == r[0] or r[3] == r[0] for r in got)
    assert [r for r in got if r[0] == 0] == [r for r in brute(twice) if r[0] == 0]


def test_lists_stop_before_their_end(monkeypatch):
    """On rows of few directions the threshold stops the search, and the answer is that of all rows."""
    rnd = np.random.default_rng(4)
    rows = np.floor(rnd.standard_normal((4000, 3)) ** 3 * 100)
    read = []
    monkeypatch.setattr(hn, "scores", lambda a, x, real=hn.scores: read.append(len(x)) or real(a, x))
    lists = hn.SortedLists(np.arange(4000), np.zeros(4000, np.int64), rows)
    anchor = rows[np.abs(rows).sum(axis=1).argmax()][None]
    low, high = np.full((1, 1), np.iinfo(np.int64).min), np.full((1, 1), np.iinfo(np.int64).max)
    _, _, row, score = lists.search(anchor, np.array([-1]), low, high, 5)
    assert score.tolist() == sorted((rows @ anchor[0]).astype(int).tolist(), reverse=True)[:5] and sum(read) < 2000
