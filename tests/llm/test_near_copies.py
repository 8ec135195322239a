"""The pipeline's near-duplicate stage against brute force."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from ledgerlake.llm import near_copies

from test_duplicates import slow_fingerprint

NEAR_STAGE = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def survivors(rows):
    """Smallest id of each group by comparing all pairs."""
    sets, prints, parent = {i: shingles(t) for i, t in rows}, {i: slow_fingerprint(t) for i, t in rows}, {}

    def root(i):
        while parent.get(i, i) != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if (prints[a] ^ prints[b]).bit_count() <= 3 or both and both >= 0.8 * len(sets[a] | sets[b]):
                if root(a) != root(b):
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    return sorted({root(i) for i in ids})


@pytest.mark.parametrize("block", [2048, 3])
def test_copies_with_edited_words_go(spark, docs, monkeypatch, block):
    """2 % of the words edited here and there, and 4 to 10 % in one place."""
    monkeypatch.setattr(near_copies, "BLOCK_NODES", block)
    rnd = random.Random(7)
    rows = []
    for base in range(0, 120, 10):
        words = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(300, 900))]
        rows.append((base, " ".join(words)))
        for k, share in enumerate((0.04, 0.07, 0.1)):
            at, n = rnd.randrange(len(words) // 2), int(share * len(words))
            rows.append((base + 1 + k, " ".join(words[:at] + ["new"] * n + words[at + n:])))
        spread = list(words)
        for at in rnd.sample(range(len(words)), len(words) // 50):
            spread[at] = "other"
        rows += [(base + 4, " ".join(spread)), (base + 5, " ".join(words[:len(words) // 2] + [f"x{k}" for k in range(len(words))]))]
    want = survivors(rows)
    assert all((base + 3 in want, base + 5 in want) == (False, True) for base in range(0, 120, 10))
    assert sorted(r.doc_id for r in NEAR_STAGE(spark, docs(*rows), "").collect()) == want


def test_stage_equals_all_pairs(spark, sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert sorted(r.doc_id for r in NEAR_STAGE(spark, sample, "").collect()) == survivors(rows)


def test_copies_without_an_id(spark, docs):
    words = [f"w{k}" for k in range(400)]
    edited = " ".join(words[:100] + ["new"] * 20 + words[120:])
    got = NEAR_STAGE(spark, docs((None, " ".join(words)), (None, edited), (None, "lonely words"), (3, "a b"), (None, "A  b")), "").collect()
    assert sorted((r.doc_id or 0, len(r.text.split())) for r in got) == [(0, 2), (0, 400), (3, 2)]
