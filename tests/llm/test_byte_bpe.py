"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerlake.llm import byte_bpe, queries
from ledgerlake.llm.queries import tokenizer_path

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
ODD = ["", None, " ", "  a b", "a  b", "a \n b", "don't it's we'll", "日本語 テ。", "a\tb", "<|endoftext|> x", " a", "a ", "\n", "a\n b", "a　b c",
       "a\u0085 b", "a\x1c b", "x" * 3000, "ab" * 700, " " * 700, "日本" * 400, "é" * 127, "é" * 128, "a" * 255, "a" * 256, "a" * 257, "a" * 17]


def library(path):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})


def texts():
    rnd = random.Random(3)
    some = ["".join(rnd.choice("ab A.,!' \n\t1é́$ñ'sß  ÀÿΣ日") for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    return ODD + some + ["".join(rnd.choice("abcdefghe") for _ in range(rnd.randint(200, 900))) for _ in range(30)]


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("cuts", [True, False])
def test_ids_are_those_of_the_library(name, cuts):
    whole, own = library(tokenizer_path(name)), byte_bpe.codec(tokenizer_path(name), public_tokenizers.PATTERN, cuts)
    given = texts()
    for text, ids in zip(given, own.encode(given)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode_ordinary(text or ""), text
        assert own.decode(ids).decode() == (text or "")


def test_matrices_and_heap_merge_alike(monkeypatch):
    own = byte_bpe.codec(tokenizer_path(FILES[0]), public_tokenizers.PATTERN)
    given = [t.encode() for t in texts() if t and len(t.encode()) <= byte_bpe.WIDE]
    rows = own.merge(given)
    monkeypatch.setattr(byte_bpe, "WIDE", 0)
    assert own.merge(given) == rows


def test_a_full_word_table_changes_nothing():
    path = tokenizer_path(FILES[0])
    small = byte_bpe.Codec(byte_bpe.load_ranks(path), public_tokenizers.PATTERN, words=3)
    given = texts()
    assert [ids for t in given for ids in small.encode([t])] == list(byte_bpe.codec(path, public_tokenizers.PATTERN).encode(given))


def test_pair_table_finds_every_pair_and_no_other():
    rnd = random.Random(5)
    pairs = {(rnd.randrange(60), rnd.randrange(60)): k for k in range(900)}
    left, right = np.divmod(np.arange(3600, dtype=np.int32), 60)
    found = byte_bpe.PairTable(pairs).ranks(left.astype(np.int32), right.astype(np.int32)).tolist()
    assert found == [pairs.get((k // 60, k % 60), byte_bpe.NONE) for k in range(3600)]
    assert byte_bpe.PairTable(pairs).ranks(np.array([3, -1], np.int32), np.array([-1, 3], np.int32)).tolist() == [byte_bpe.NONE] * 2


def digest(ids):
    return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_query_equals_the_library(spark, sample):
    whole = library(tokenizer_path(FILES[0]))
    got = {r.doc_id: r for r in queries.op11_byte_bpe_matrices(spark, "/root/testdata/sf0.001").collect()}
    for r in sample.collect():
        ids = whole.encode_ordinary(r.text or "")
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids), digest(ids))
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert len(got) == sample.count()


def test_odd_rows(docs):
    path, pattern = tokenizer_path(FILES[0]), public_tokenizers.PATTERN
    long = "wordy " * 400_000
    df = docs((1, None), (1, None), (None, "a b"), (3, long), (4, ""), extra="'x' AS ids")
    df = df.selectExpr("*", "1 AS _key", "2 AS n_tokens")
    out = sorted((r.doc_id or 0, r.n_tokens) for r in byte_bpe.round_trip(df, path, pattern).collect())
    assert out == [(0, 2), (1, 0), (1, 0), (3, len(library(path).encode_ordinary(long))), (4, 0)]
    assert byte_bpe.round_trip(df.where("false"), path, pattern).count() == 0
    back = byte_bpe.decode(byte_bpe.encode(df, path, pattern), path, pattern)
    assert sorted((r.doc_id or 0, bytes(r.bytes).decode()) for r in back.collect()) == [(0, "a b"), (1, ""), (1, ""), (3, long), (4, "")]
