"""Spelling variants against a comparison of all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import queries, spelling


def edits(a, b):
    """Whether one inserted, deleted or replaced letter turns a into b."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def brute_words(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{low}".encode())
            if h % 199 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            found[low] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def brute(rows):
    n = brute_words(rows)
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and edits(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


def test_query_equals_brute_force(spark, sample):
    want = brute([(r.doc_id, r.text) for r in sample.collect()])
    assert result(queries.op12_spelling_gram_blocks(spark, "/root/testdata/sf0.001")) == want
    assert sum(w[4] > 0 for w in want.values()) > 50


@pytest.fixture
def varied(docs):
    rnd = random.Random(11)
    pool = ["".join(rnd.choice("abé") for _ in range(rnd.randint(6, 8))) for _ in range(150)] + ["ÀÉÎÕüÿ" + "x" * k for k in range(4)]
    chain = ["colour"] * 4000 + ["colours"] * 700 + ["coloursz"] * 130 + ["colourszz"] * 20 + ["coloor"] * 700
    # A third of all words share one cell: the same letters in other orders.
    mixed = ["".join(rnd.sample("abcdefgh", 8)) for _ in range(900)]
    words = chain + [w for w in set(mixed) for _ in range(5)] + [rnd.choice(pool) for _ in range(4000)]
    rnd.shuffle(words)
    return [(k, " ".join(words[k::60])) for k in range(60)]


def test_crowded_cells_chains_and_ties(docs, varied, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 40)
    want = brute(varied)
    assert result(spelling.spelling_forms(docs(*varied))) == want
    assert want["colourszz"][1:3] == ("coloursz", "colour") and want["coloor"][2] == "colour"


def test_one_edit_on_random_pairs():
    rnd = random.Random(2)
    pairs = []
    for _ in range(4000):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9)))
        b = "".join(rnd.choice("ab") for _ in range(len(a) - rnd.randint(0, 1)))
        pairs.append((a.encode(), b.encode()))
    got = spelling._one_edit([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [edits(a.decode(), b.decode()) for a, b in pairs]


def test_every_near_pair_meets_once():
    """The cells of two near words share exactly one meeting that counts."""
    rnd = random.Random(8)
    words = {"".join(rnd.choice("abcxyz") for _ in range(rnd.randint(5, 7))).encode() for _ in range(1500)}
    import pyarrow as pa

    texts = sorted(w.decode() for w in words)
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([1] * len(texts))], names=["word", "n"])
    cells = {}
    for out in spelling._cell_copies(iter([batch])):
        for cell, role, word, _ in zip(*(c.to_pylist() for c in out.columns)):
            cells.setdefault(cell, []).append((word.encode(), role))
    met = Counter()
    for members in cells.values():
        names = [m[0] for m in members]
        zeros = np.zeros(len(members), np.int64)
        left, right = spelling._near(names, np.array([m[1] for m in members]), zeros, zeros, zeros > 0)
        met.update(tuple(sorted((names[a], names[b]))) for a, b in zip(left.tolist(), right.tolist()))
    assert set(met.values()) == {1}
    assert set(met) == {(a.encode(), b.encode()) for a in texts for b in texts if a < b and abs(len(a) - len(b)) < 2 and edits(a, b)}


def test_odd_rows(docs):
    long = "q" * 3000
    rows = [(1, None), (2, ""), (None, "wonder wonder"), (None, "wonder wonder"), (3, "Wonder wonders " * 5), (3, "Wonder wonders " * 5),
            (4, f"{long} " * 30 + f"{long}q " * 6 + "abĀcdefgh " * 9)]
    df = docs(*rows, extra="'x' AS word").selectExpr("*", "1 AS n", "2 AS cell", "3 AS _key")
    assert result(spelling.spelling_forms(df)) == brute(rows)
    assert spelling.spelling_forms(df.where("false")).count() == 0
    assert spelling.spelling_forms(df.where("doc_id = 1")).count() == 0
