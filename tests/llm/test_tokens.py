"""Tokenizer, packing, token files, quality and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlake.llm import decontamination, packing, quality, repair, simhash_mih, substrings, tokens
from ledgerlake.llm.queries import tokenizer_path
from ledgerlake.llm.tokens import WordEncoder
from ledgerlake.session import scratch_path

from test_duplicates import brute_repeats
from test_near_copies import survivors

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"


def library(name):
    t = Tokenizer.from_file(tokenizer_path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name,spaced", [(BYTES, True), (WORDS, False)])
def test_words_encode_as_the_whole_text(name, spaced, sample):
    rnd, whole, own = random.Random(1), library(name), WordEncoder(tokenizer_path(name), spaced)
    odd = ["", None, " ", "  a b", "a  b", "a \n b", "don't it's we'll", "x's.'s", "a1b2", "é ñ̃ ñ", "a\tb", "İx ΑΣ.", "日本語 テ。", "<|endoftext|> a",
           "a\r\nb", "ﬁ ﬁ.x", "ß.ß ÀÉ× ÷", "a　b", "a ́b"]
    odd += ["".join(rnd.choice(list("ab A.,!' \n\t1é́$ñ'sß  ÀÿΣ")) for _ in range(rnd.randint(1, 40))) for _ in range(3000)]
    for text in odd + [r.text for r in sample.collect()]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == whole(text), text


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y <|ENDOFTEXT|>", "a <| b |> c", "no such <endoftext>", "<|endoftext|><|endoftext|> z"]


@pytest.mark.parametrize("name,spaced", [(BYTES, True), (WORDS, False)])
def test_added_tokens_as_the_library_has_them(name, spaced, sample):
    default, own = Tokenizer.from_file(tokenizer_path(name)), tokens.encoder(tokenizer_path(name), spaced)
    for text in ADDED + [r.text for r in sample.collect()]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == default.encode(text or "", add_special_tokens=False).ids, text


def test_added_tokens_in_packing_and_token_files(docs):
    df = docs(*enumerate(ADDED))
    for name, end, rows in ((BYTES, packing.END_ID, packing.pack_documents(df, tokenizer_path(BYTES))),
                            (WORDS, repair.END_ID, repair.round_trip(df, tokenizer_path(WORDS)))):
        default = Tokenizer.from_file(tokenizer_path(name))
        want = {i: zlib.crc32(np.array(default.encode(t, add_special_tokens=False).ids + [end], "<u4").tobytes()) for i, t in enumerate(ADDED)}
        assert all(r.start == 0 or name == WORDS for r in rows.collect())
        assert {r.doc_id: r.ids_crc32 for r in rows.collect() if name == WORDS or r.length == r.doc_tokens} .items() <= want.items()


def checked_pieces(rows, texts):
    whole, ids = library(BYTES), {}
    for i, t in texts:
        ids.setdefault(i, []).append(whole(t) + [1])
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, copies in ids.items():
        want = Counter()
        for own in copies:
            at = 0
            for n in packing.cuts(len(own)):
                want[at, n, zlib.crc32(np.array(own[at:at + n], "<u4").tobytes()), len(own)] += 1
                at += n
            assert at == len(own)
        assert Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[i]) == want
    for members in by_sequence.values():
        members.sort(key=lambda r: r.offset)
        at = 0
        for r in members:
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW and (members[0].tier == packing.WINDOW or at == members[0].tier)
    sizes = [sum(r.length for r in m) for m in by_sequence.values()]
    return sum(sizes) / sum(n if n & (n - 1) == 0 else packing.WINDOW for n in sizes)


def test_packing(sample, docs):
    texts = [(r.doc_id, r.text) for r in sample.collect()]
    rows = packing.pack_documents(sample, tokenizer_path(BYTES)).collect()
    assert checked_pieces(rows, texts) > 0.99
    steps = Counter()
    for r in {r.sequence_id: r for r in rows}.values():
        steps[r.step_group, r.tier] += r.tier
    assert max(steps.values()) <= packing.STEP_IDS
    odd = [(1, None), (2, ""), (None, "a b"), (3, "x y " * 40000), (4, "same"), (4, "same")]
    checked_pieces(packing.pack_documents(docs(*odd, extra="1 AS tier"), tokenizer_path(BYTES)).collect(), odd)
    assert packing.pack_documents(docs(), tokenizer_path(BYTES)).count() == 0


def test_grammar_round_trip():
    rnd = np.random.default_rng(3)
    for ids in (np.zeros(0), np.array([2]), np.full(999, 7), rnd.zipf(1.4, 20000).clip(3, 65000), np.tile([5, 6, 7, 8, 2], 400), rnd.integers(0, 90000, 5000)):
        ids = ids.astype(np.uint32)
        base, rules, symbols = repair.compress(ids)
        assert repair.expand(base, rules, symbols).tolist() == ids.tolist()
        lengths = repair.expansion_lengths(base, rules)
        assert [len(repair.expand(base, rules, np.array([base + k], np.uint32))) for k in range(len(rules))] == lengths.tolist()
    assert len(repair.compress(np.tile(np.arange(3, 11, dtype=np.uint32), 500))[2]) < 4000 / 4


def test_rounds_go_on_until_no_pair_is_frequent():
    rnd = np.random.default_rng(5)
    passage = rnd.integers(3, 40_000, 1000).astype(np.uint32)
    once = np.tile(passage, 500)
    apart = np.concatenate([np.concatenate((rnd.integers(3, 40_000, rnd.integers(1, 9)), passage, [2])) for _ in range(500)]).astype(np.uint32)
    text = rnd.zipf(1.3, 60_000).clip(3, 30_000).astype(np.uint32)
    for ids, most in ((once, 0.01), (apart, 0.02), (text, 1)):
        base, rules, symbols = repair.compress(ids)
        assert repair.expand(base, rules, symbols).tolist() == ids.tolist() and len(symbols) <= most * len(ids)
        # Occurrences as pairs are replaced: from the left, without overlap within a run of one pair.
        left = Counter()
        for a, b, c in zip(symbols.tolist(), symbols[1:].tolist(), [*symbols[2:].tolist(), -1]):
            left[a, b] += a != 2 and b != 2
        assert max(left.values()) < 2 * repair.LEAST_COUNT, max(left.values())
    image = len(repair.encode_shard([1], once.tobytes(), [len(once)]))
    assert image < 0.02 * once.nbytes


def test_ranges_begin_and_end_inside_rules():
    rnd = np.random.default_rng(6)
    passage = rnd.integers(3, 500, 700)
    ids = np.concatenate([np.append(np.tile(passage, 30), 2), np.append(rnd.integers(3, 9, 5000), 2)]).astype("<u4")
    shard = repair.Shard(repair.encode_shard([1, 2], ids.tobytes(), [30 * 700 + 1, 5001]))
    assert shard.lengths.max() >= 64
    for start, stop in [(0, len(ids)), (-5, len(ids) + 5), *sorted(map(sorted, rnd.integers(0, len(ids), (300, 2)).tolist())), (9, 9), (9, 3)]:
        assert shard.ids(start, stop).tolist() == ids[max(0, start):max(0, stop)].tolist()


def test_shard_random_access():
    rnd = np.random.default_rng(4)
    documents = [np.append(rnd.zipf(1.5, n).clip(3, 4000), 2).astype("<u4") for n in (0, 50, 3000, 1, 700, 0)]
    ids = np.concatenate(documents)
    shard = repair.Shard(repair.encode_shard([3, None, 5, -6, 7, 8], ids.tobytes(), [len(d) for d in documents]))
    assert shard.doc_ids == [3, None, 5, -6, 7, 8] and shard.all_ids().tolist() == ids.tolist()
    assert [shard.document(k).tolist() for k in range(6)] == [d.tolist() for d in documents]
    for start, stop in ((0, 1), (10, 60), (51, 3100), (0, len(ids)), (len(ids) - 1, len(ids)), (40, 40)):
        assert shard.ids(start, stop).tolist() == ids[start:stop].tolist()


def test_token_files(sample, docs):
    whole = library(WORDS)
    for df in (sample, docs((5, None), (None, "first of all"), (2, ""), (9, "word " * 50000), (2, "b a"), extra="1 AS part")):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want, at = [], 0
        for i, t in rows:
            ids = np.array(whole(t) + [2], "<u4")
            want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
        got = repair.round_trip(df, tokenizer_path(WORDS)).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert repair.round_trip(docs(), tokenizer_path(WORDS)).count() == 0


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.classify(docs, labels).collect()
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert sum(p == q for _, p, q in held) >= 0.95 * len(held)
    good, bad = [s for s, _, q in held if q], [s for s, _, q in held if not q]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) >= 0.97 * len(good) * len(bad)
    # Held-out labels teach nothing.
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    assert {r.doc_id: r.score for r in quality.classify(docs, flipped).collect()} == {r.doc_id: r.score for r in rows}


def test_quality_edge_cases(spark, docs):
    df = docs((1, "plain words here"), (1, "plain words here"), (None, "x"), (3, None), (4, ""), (5, "long " * 60000), extra="0.1 AS score_")
    for labels in ([], [(1, 1)], [(1, None), (2, 0), (None, 1), (1, 1), (1, 0)]):
        rows = quality.classify(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows) and len({r.score for r in rows if r.doc_id == 1}) == 1
    assert quality.classify(docs(), spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0


def test_pipeline_equals_plain_python(spark, tmp_path):
    """Stage by stage: each against brute force on what its predecessor kept."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, benchmark = docs.columns, [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages) and len(stages) == 5

    def run(name, df):
        path = scratch_path(spark, "stage")
        stages[name](spark, df, sf).write.parquet(path)
        return spark.read.parquet(path)

    kept = run("quality classifier", docs)
    scores = {r.doc_id: r.predicted for r in quality.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, p in scores.items() if p} and kept.columns == columns
    unique = run("SimHash near-dedup", kept)
    assert sorted(r.doc_id for r in unique.collect()) == survivors([(r.doc_id, r.text) for r in kept.collect()]) and unique.columns == columns
    stripped = run("substring dedup", unique)
    before, after = {r.doc_id: r.text for r in unique.collect()}, {r.doc_id: r for r in stripped.collect()}
    import hashlib
    for i, v in brute_repeats(list(before.items())).items():
        n, removed, digest = v[0]
        if removed == n and n:
            assert i not in after
        elif removed:
            words = after[i].text.encode().split()
            assert hashlib.sha256(b" ".join(words)).hexdigest() == digest and after[i].n_chars == len(after[i].text)
        else:
            assert after[i].text == before[i]
    assert stripped.columns == columns
    clean = run("benchmark decontamination", stripped)
    plain = [decontamination.normalise(b) for b in benchmark]
    exact = {i for i, r in after.items() if any(p in decontamination.normalise(r.text) for p in plain)}
    left = {r.doc_id for r in clean.collect()}
    assert not exact & left and len(after) - len(left) <= len(exact) + 2 and clean.columns == columns
    packed = run("packing", clean)
    assert checked_pieces(packed.collect(), [(r.doc_id, r.text) for r in clean.collect()]) > 0.98


#: Names that the stages use inside.
CLASHING = ["_score", "_key", "_group", "_nth", "_found", "_text", "node", "key", "part", "places", "row", "digest", "tag", "component"]


def test_pipeline_stages_on_odd_rows(spark, docs):
    sf = "/root/testdata/sf0.001"
    odd = docs((1, None), (2, ""), (None, "alone here"), (None, "alone here"), (5, "same text twice"), (5, "same text twice"), (6, "word " * 9000),
               extra="1 AS tier").selectExpr("*", *[f"'kept' AS {c}" for c in CLASHING])
    for df in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, sf)
            assert out.columns == df.columns, name
            assert all(r[c] == "kept" for r in out.collect() for c in CLASHING), name
    packed = corpus_pipeline.STAGES[-1][1](spark, odd, sf)
    assert packed.count() >= odd.count() and not set(CLASHING) & set(packed.columns)
    once = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, odd, sf).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in once) == [(False, 0), (True, 1), (True, 5), (True, 6)]
    assert simhash_mih.fingerprint(None) == 0 and substrings.words_of(None) == []
