"""Near duplicates, fingerprints, repeated passages and leaks against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import components, decontamination, fingerprints, simhash_mih, substrings


def slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints: dict) -> dict:
    ids, parent = sorted(prints), {}

    def root(i):
        while parent.get(i, i) != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3 and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in ids}


def test_near_duplicates_equal_brute_force(sample):
    texts = {r.doc_id: r.text for r in sample.collect()}
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    got = {r.doc_id: r for r in simhash_mih.near_duplicates(sample).collect()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == classes(prints)


def test_near_duplicate_edge_cases(docs):
    df = docs((3, ""), (1, None), (2, " \t\n"), (5, "a b"), (4, "A  B"), (7, "x " * 30000), (7, "x " * 30000), (None, "a b"), (None, "lonely words"),
              extra="'q' AS fingerprint")
    got = [tuple(r) for r in simhash_mih.near_duplicates(df).collect()]
    by = {(i, f): c for i, f, c in got}
    assert len(got) == 9 and {by[i, "0" * 16] for i in (1, 2, 3)} == {1}
    assert by[4, f"{slow_fingerprint('a b'):016x}"] == by[5, f"{slow_fingerprint('a b'):016x}"] == by[None, f"{slow_fingerprint('a b'):016x}"] == 4
    assert by[None, f"{slow_fingerprint('lonely words'):016x}"] is None
    assert simhash_mih.near_duplicates(docs()).count() == 0


def test_links_find_all_pairs_in_crowded_halves(spark, monkeypatch):
    """Fingerprints that share a half, spread over several blocks."""
    rnd = random.Random(1)
    base = rnd.getrandbits(64)
    prints = {k: base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for k in range(400)}
    prints = {i: p for i, p in {p: i for i, p in prints.items()}.items() for p, i in [(i, p)]}
    monkeypatch.setattr(simhash_mih, "BLOCK", 50)
    nodes = spark.createDataFrame([(i, simhash_mih._signed(p)) for i, p in prints.items()], "node long, fp long")
    found = {r.node: r.component for r in components.components(simhash_mih.links(nodes)).collect()}
    want = classes(prints)
    assert {i: found.get(i, i) for i in prints} == want


def test_components(spark):
    rnd = random.Random(5)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(5001, 5200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def root(i):
        while parent.get(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        if root(a) != root(b):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {i: root(i) for a, b in links if a != b for i in (a, b)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_compare_with_next(docs, sample):
    for df in (sample, docs((9, "only one document of words")), docs((2, ""), (1, None), (3, "abc def"), (3, "abc"), (None, "zz y"), extra="'p' AS part")):
        rows = sorted(((r.doc_id is not None, r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0], r[1] or 0, r[2]))
        want = []
        for k, (_, doc_id, text) in enumerate(rows):
            following, half = rows[(k + 1) % len(rows)][2], len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            a, b, c = map(fingerprints.fingerprint, (text, edited, following))
            want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
        got = [tuple(r) for r in fingerprints.compare_with_next(df).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert fingerprints.compare_with_next(docs()).count() == 0


def test_fingerprint_bits_by_plain_votes():
    """Votes added one term at a time in plain numbers; equal bits wherever a vote is not a tie."""
    def mixed(x):
        x = (x ^ x >> 32) * 0x9E3779B97F4A7C15 % 2**64
        x = (x ^ x >> 29) * 0xC2B2AE3D27D4EB4F % 2**64
        return x ^ x >> 32

    words = [f"w{n % 23}" for n in range(70)] + ["é", "w1"]
    single = [xxhash.xxh3_64_intdigest(w.encode()) for w in words]
    pairs = [mixed(a * 0x9E3779B97F4A7C15 + (b ^ 0xC2B2AE3D27D4EB4F) & 2**64 - 1) for a, b in zip(single, single[1:])]
    votes = [0.0] * 128
    for terms, factor in ((Counter(single), 1), (Counter(pairs), 2)):
        for term, n in terms.items():
            spread = b"".join(mixed((term + (k + 1) * 0xC2B2AE3D27D4EB4F) % 2**64).to_bytes(8, "little") for k in range(2))
            for bit in range(128):
                votes[bit] += factor * (1 + math.log(n)) * (1 if spread[bit // 8] >> 7 - bit % 8 & 1 else -1)
    got = fingerprints.fingerprint(" ".join(words))
    clear = [bit for bit in range(128) if abs(votes[bit]) > 1e-3]
    assert len(clear) > 120 and all((got[b // 8] >> 7 - b % 8 & 1) == (votes[b] > 0) for b in clear)


def test_near_counts_equal_brute_force_in_crowded_leads(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "CROWD", 8)
    rng = random.Random(5)
    near = [0xABCDEF << 100 | rng.getrandbits(3) << 64 | rng.getrandbits(2) for _ in range(150)]
    rows = [(n if n % 9 else None, f"{p:032x}", "x") for n, p in enumerate([*near, *(rng.getrandbits(128) for _ in range(60)), 0, 0, 0])]
    got = fingerprints.count_near(spark.createDataFrame(rows, "doc_id long, fingerprint string, found string"), every=4).collect()
    values = [int(p, 16) for _, p, _ in rows]
    want = [(i, p, x, sum((int(p, 16) ^ v).bit_count() <= 3 for v in values) if i is not None and i % 4 == 0 else None) for i, p, x in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_permuted_tables_find_all(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(128) for _ in range(5)]
    prints = [f"{rnd.choice(base) ^ sum(1 << b for b in rnd.sample(range(128), rnd.randint(0, 5))):032x}" for _ in range(300)]
    index = spark.createDataFrame([(p,) for p in prints], "fingerprint string")
    queries = index.limit(40)
    for radius, blocks in ((3, 4), (2, 8), (0, 4)):
        got = {tuple(r) for r in fingerprints.search(index, queries, radius, blocks).collect()}
        asked = {r[0] for r in queries.collect()}
        want = {(q, f, (int(q, 16) ^ int(f, 16)).bit_count()) for q in asked for f in prints}
        assert got == {w for w in want if w[2] <= radius}


def brute_repeats(rows, width=20):
    def place(row, at):
        return row[0] is not None, row[0] or 0, substrings.tag_of(row[1]), at

    seen, out = {}, {}
    for row in rows:
        words = (row[1] or "").encode().split()
        for at in range(len(words) - width + 1):
            key = tuple(words[at:at + width])
            seen[key] = min(seen.get(key, place(row, at)), place(row, at))
    for row in rows:
        words, gone = (row[1] or "").encode().split(), set()
        for at in range(len(words) - width + 1):
            if seen[tuple(words[at:at + width])] < place(row, at):
                gone |= set(range(at, at + width))
        kept = [w for n, w in enumerate(words) if n not in gone]
        out.setdefault(row[0], []).append((len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_sha256))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("seed", range(3))
def test_repeats_equal_brute_force(docs, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(60):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            a = rnd.randint(0, 40)
            words += passage[a:a + rnd.randint(5, 60)] + [rnd.choice(vocabulary)]
        words += ["same"] * rnd.choice([0, 0, 19, 20, 45])
        rows.append((rnd.choice([i, i, i, 7, None]), rnd.choice([" ", "\n", " \t"]).join(words)))
    rows += [(100, None), (101, ""), (102, "é x " * 30), (103, rows[0][1])]
    got = substrings.remove_repeats(docs(*rows, extra="'r' AS row"), chunk=rnd.choice([50, 300, 1 << 20]), bucket_bytes=3000)
    assert grouped(got.collect()) == brute_repeats(rows)


def test_repeats_on_sample(sample, docs):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert grouped(substrings.remove_repeats(sample).collect()) == brute_repeats(rows)
    assert substrings.remove_repeats(docs()).count() == 0


def slow_distance(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for k, p in enumerate(pattern):
            new.append(min(row[k] + (p != c), row[k + 1] + 1, new[k] + 1))
        row = new
        best = min(best, row[-1])
    return best


@settings(max_examples=150, deadline=None)
@given(st.text("ab ", min_size=1, max_size=90), st.text("ab ", max_size=120), st.integers(0, 20))
def test_myers(pattern, text, most):
    want = slow_distance(pattern, text)
    assert decontamination.myers(pattern, text, most) == (want if want <= most else None)


def test_leaks_with_edits(spark, docs):
    rnd = random.Random(4)
    items = ["".join(rnd.choice("abcdefgh  ") for _ in range(rnd.randint(40, 160))) for _ in range(25)] + ["short", None, "?!", items_text := "x" * 30, items_text]
    rows = []
    for i in range(80):
        item = normal = rnd.choice(items[:25])
        chars = list(item.upper() if i % 3 else item)
        for _ in range(rnd.randint(0, int(len(normal) * 0.12))):
            k = rnd.randrange(len(chars))
            chars[k:k + 1] = rnd.choice([[], ["z"], [chars[k], "q"]])
        rows.append((i, "before it, " + "".join(chars) + "! after it"))
    rows += [(200, None), (201, ""), (202, "short"), (203, "clean words " * 2000), (None, items[0]), (204, "- " + items_text + " -"), (204, "- " + items_text + " -")]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for i, t in rows:
        for n, item in enumerate(items):
            plain = decontamination.normalise(item)
            if len(plain) - 2 >= decontamination.MIN_CHARS:
                d = slow_distance(plain, decontamination.normalise(t)) if len(t or "") < 1000 else 999
                if d <= int(decontamination.RATE * len(plain)):
                    want.add((i, n, d))
    for block_chars in (4_000_000, 600):
        got = [(r.doc_id, r.item_id, r.edits) for r in decontamination.find_items(docs(*rows, extra="1 AS budget"), benchmark, block_chars=block_chars).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    kept = decontamination.without_items(docs(*rows), benchmark)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _, _ in want}
    # Rows go by their own text: without an id, and beside a leaking row of the same id.
    mixed = docs((None, items[0]), (None, "clean words"), (7, "so: " + items[1]), (7, "clean too"), extra="1 AS _found")
    left = decontamination.without_items(mixed, benchmark)
    assert sorted(r.text for r in left.collect()) == ["clean too", "clean words"] and left.columns == mixed.columns
    assert kept.columns == docs().columns and decontamination.find_items(docs(), benchmark).count() == 0
    assert decontamination.find_items(docs((1, "x")), benchmark.limit(0)).count() == 0


def test_short_items_unchanged_as_whole_words(spark, docs):
    items = ["What is 12 x 9?", "cat", "日本の首都はどこですか", "?!", "", "ไทย", "what  is 12 X 9"]
    rows = [(1, "so: what is 12 x 9 ?"), (2, "what is 12 x 99"), (3, "concatenate"), (4, "a Cat."), (5, "問題「日本の首都はどこですか」"),
            (6, "次の日本の首都はどこですか答え"), (7, "日本の首都は"), (8, None), (9, "what is 13 x 9"), (10, "x" * 50 + " cat cat")]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {tuple(r) for r in decontamination.find_items(docs(*rows), benchmark, short=True).collect()}
    assert got == {(1, 0, 0, 0), (1, 6, 0, 0), (4, 1, 0, 0), (5, 2, 0, 0), (6, 2, 0, 0), (10, 1, 0, 0)}
    kept = decontamination.without_items(docs(*rows), benchmark, short=True)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 7, 8, 9]


def test_short_items_in_query_and_pipeline(spark, docs, tmp_path):
    import corpus_pipeline
    from ledgerlake.llm import queries

    df = docs((1, "they ask what is 12 x 9 there"), (2, "nothing of that"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "What is 12 x 9?")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [tuple(r) for r in queries.op7_benchmark_decontamination(spark, str(tmp_path)).collect()] == [(1, 7, 0, 0)]
    assert [r.doc_id for r in dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, df, str(tmp_path)).collect()] == [2]


def test_words_are_cut_out_of_the_text_as_it_is():
    rnd = random.Random(9)
    for _ in range(400):
        words = ["w%d" % rnd.randrange(9) for _ in range(rnd.randint(1, 30))]
        text = rnd.choice(["", " ", "\n"]) + "".join(w + rnd.choice([" ", "  ", "\n", "\n\n", "\t"]) for w in words[:-1]) + words[-1] + rnd.choice(["", "\n"])
        free = np.array(sorted(rnd.sample(range(len(words)), rnd.randint(1, len(words)))))
        new = substrings.cut_out(text, free)
        assert new.split() == [words[k] for k in free]
        if len(free) == len(words):
            assert new == text
    assert substrings.cut_out("\tTitle\n\na b c d\ne  f\n", np.array([0, 1, 4, 5, 6])[:4]) == "\tTitle\n\na d\ne"
    assert substrings.cut_out("one\n\nx y\nz two", np.array([0, 4])) == "one\n\ntwo"


def test_parts_are_those_of_the_column(spark, docs):
    rows = [(None, None), (None, "a"), (None, "b c"), (5, "ü"), (5, "x" * 100), (-7, ""), (2**62, "z")]
    df = docs(*rows).selectExpr(f"coalesce(doc_id, {substrings.NO_ID}) AS doc_id", "text").withColumn("tag", substrings._tag("text"))
    got = df.selectExpr("doc_id", "text", "tag", "cast(pmod(xxhash64(doc_id, tag), 97) as int) AS part").collect()
    assert [r.tag for r in got] == [substrings.tag_of(r.text) for r in got] and min(r.tag for r in got) >= 0
    assert substrings.part_of(np.array([r.doc_id for r in got]), np.array([r.tag for r in got]), 97).tolist() == [r.part for r in got]


def test_places_round_trip():
    rnd = np.random.default_rng(1)
    ids = np.array([5, 5, 5, -(1 << 63), -(1 << 63), 9, 5, 5, 5], np.int64)
    places = np.array([3, 9, 2, 0, 70000, 1, 4, 4, 1 << 30], np.int64)
    for n in (0, 1, len(ids)):
        a, b = substrings.unpack_places(substrings.pack_places(ids[:n], places[:n]), n)
        assert a.tolist() == ids[:n].tolist() and b.tolist() == places[:n].tolist()
    ids = rnd.integers(-(1 << 62), 1 << 62, 500)
    assert substrings.unpack_places(substrings.pack_places(ids, ids & 0xFFFF), 500)[0].tolist() == ids.tolist()
