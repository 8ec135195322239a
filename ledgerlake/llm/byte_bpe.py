"""Byte-level BPE ids of whole texts, and their bytes again, by rounds of merges over numpy matrices.

A text is taken apart by the tokenizer's pattern; every match is encoded by itself. A match that is a token of its own
gets that id. All other matches that a worker meets for the first time are grouped by length into matrices with one match
a row, padded on the right. In each round every row merges its leftmost pair of least rank: pair ranks come from an
open-addressing hash table over (left id, right id), only the two pairs beside a merge are looked up again, the rest of the
row moves one place to the left, and rows without any pair left leave the matrix. Ranks are ids, so the merged id is the
rank. A match of more than ``WIDE`` bytes is merged by the same rule with a heap of (rank, place) over a linked list,
which takes time in proportion to n log n where whole rows of a matrix would take n * n.

Words (text between single spaces) keep their ids for later texts of the same worker. The patterns of byte-level
tokenizers cut before a single space between two visible characters, so ids of words put together are the ids of the
text; ``cuts=False`` takes whole texts through the pattern instead, for patterns that do not.

Null and empty texts have no ids. Texts of any length are encoded whole, by one task each. Equal texts have equal ids;
repeated rows and rows without an id are kept as they are; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import release

#: Bytes of a match up to which it is a row of a matrix.
WIDE = 256
#: Words kept by each worker, about 200 bytes each; a full table is emptied.
CACHE_WORDS = 900_000
#: Characters of the texts whose new words are encoded together, and cells of a matrix.
BLOCK_CHARS, CELLS = 2_000_000, 1 << 20
NONE = np.int32(2**31 - 1)
_GAP = re.compile(r" (?=\S)(?<=\S )")


class PairTable:
    """Rank of each pair of ids, in an open-addressing table with linear probing."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        left, right = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
        keys, ranks = left << 32 | right, np.array(list(pairs.values()), np.int32)
        self._bits = max(4, int(len(pairs) * 3).bit_length())
        size = 1 << self._bits
        self._keys, self._ranks = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        at, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):  # the first key that asks for a free slot gets it, others go on to the next slot
            free = self._keys[at[rest]] < 0
            slots, first = np.unique(at[rest[free]], return_index=True)
            won = rest[free][first]
            self._keys[slots], self._ranks[slots] = keys[won], ranks[won]
            rest = np.setdiff1d(rest, won, assume_unique=True)
            at[rest] = at[rest] + 1 & size - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of many pairs; ``NONE`` for those that never merge and those with a pad (-1) on the right."""
        out = np.full(left.shape, NONE, np.int32)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        rest = np.flatnonzero((left >= 0) & (right >= 0))
        wanted = keys.ravel()[rest]
        at, flat = self._slot(wanted), out.ravel()
        while len(rest):
            held = self._keys[at]
            hit = held == wanted
            flat[rest[hit]] = self._ranks[at[hit]]
            going = ~hit & (held >= 0)
            rest, wanted, at = rest[going], wanted[going], at[going] + 1 & len(self._keys) - 1
        return flat.reshape(left.shape)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """``encode(texts)``: ids of each text as little-endian unsigned 32-bit integers; ``decode(ids)``: their bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, words: int = CACHE_WORDS, cuts: bool = True):
        self._ranks, self._most, self._cuts = ranks, words, cuts
        self._matches = regex.compile(pattern).findall
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable({
            (ranks[token[:k]], ranks[token[k:]]): rank for token, rank in ranks.items()
            for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks})
        # Ids of words with the space before them.
        self._words: dict[str, bytes] = {}
        self._decimal = {rank: str(rank) for rank in self._bytes}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def digests(self, ids: bytes) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids with one space between, SHA-256 of the decoded bytes."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        written, decoded = " ".join(map(self._decimal.__getitem__, numbers)), b"".join(map(self._bytes.__getitem__, numbers))
        return len(numbers), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        cut, new = [], {}
        if len(self._words) > self._most:
            self._words.clear()
        for text in texts:
            words = self._split(text or "")
            cut.append(words)
            if words:
                new[words[0]] = None
                new.update(dict.fromkeys(" " + w for w in set(words[1:]).difference(self._words)))
        heads = self._encode_words([w for w in new if w])
        self._words.update((word[1:], ids) for word, ids in heads.items() if word[0] == " ")
        for words in cut:
            yield heads.get(words[0], b"") + b"".join(map(self._words.__getitem__, words[1:])) if words else b""

    def _split(self, text: str) -> list[str]:
        """Words between single spaces; all but the first have lost the space before them."""
        if not text or not self._cuts:
            return [text] if text else []
        words = text.split()
        return words if " ".join(words) == text else _GAP.split(text)

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        known: dict[str, bytes] = {}
        parts = [self._matches(w) for w in words]
        wanted = []
        for part in dict.fromkeys(p for some in parts for p in some):
            token = part.encode()
            whole = self._ranks.get(token)
            if whole is None:
                wanted.append((part, token))
            else:
                known[part] = whole.to_bytes(4, "little")
        known.update(zip((p for p, _ in wanted), self.merge([token for _, token in wanted])))
        return {w: known[some[0]] if len(some) == 1 else b"".join(map(known.__getitem__, some)) for w, some in zip(words, parts)}

    def merge(self, matches: list[bytes]) -> list[bytes]:
        """Ids of each match, by merges alone."""
        out: list[bytes] = [b""] * len(matches)
        lengths = np.fromiter(map(len, matches), np.int64, len(matches))
        # Lengths of up to 16 have a matrix each, longer ones share one with those up to the next multiple of 16.
        bucket = np.where(lengths <= 16, lengths, -(-lengths // 16) * 16)
        for width in np.unique(bucket[lengths <= WIDE]).tolist():
            rows = np.flatnonzero(bucket == width)
            for at in range(0, len(rows), step := max(1, CELLS // max(1, width))):
                self._merge_rows(rows[at:at + step], matches, lengths, width, out)
        for k in np.flatnonzero(lengths > WIDE).tolist():
            out[k] = self._merge_long(matches[k])
        return out

    def _merge_rows(self, rows: np.ndarray, matches: list[bytes], lengths: np.ndarray, width: int, out: list[bytes]) -> None:
        joined = np.frombuffer(b"".join(matches[k].ljust(width, b"\0") for k in rows.tolist()), np.uint8).reshape(len(rows), width)
        places = np.arange(width)
        length = lengths[rows]
        ids = np.where(places < length[:, None], self._first[joined], np.int32(-1))
        rank = np.full((len(rows), width), NONE, np.int32)
        rank[:, :-1] = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            over = best == NONE
            if over.any():
                packed = ids[over].astype("<u4")
                for k, row, n in zip(rows[over].tolist(), packed, length[over].tolist()):
                    out[k] = row[:n].tobytes()
                rows, ids, rank, at, best, length = (x[~over] for x in (rows, ids, rank, at, best, length))
                if not len(rows):
                    return
            n, width = len(rows), ids.shape[1] - 1
            every = np.arange(n)
            # All places behind the merge move one to the left.
            behind = np.arange(width) > at[:, None]
            ids = np.where(behind, ids[:, 1:], ids[:, :-1])
            rank = np.where(np.arange(width) >= at[:, None], rank[:, 1:], rank[:, :-1])
            ids[every, at] = best
            length = length - 1
            before, after = at > 0, at + 1 < width
            right = np.full(n, -1, np.int32)
            right[after] = ids[every[after], at[after] + 1]
            rank[every, at] = self.pairs.ranks(best, right)
            rank[every[before], at[before] - 1] = self.pairs.ranks(ids[every[before], at[before] - 1], best[before])

    def _merge_long(self, match: bytes) -> bytes:
        ids = self._first[np.frombuffer(match, np.uint8)]
        ranks = self.pairs.ranks(ids[:-1], ids[1:])
        heap = [(r, k) for k, r in enumerate(ranks.tolist()) if r != NONE]
        heapq.heapify(heap)
        ids, ranks = ids.tolist(), ranks.tolist() + [int(NONE)]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        end, tokens, known = len(ids), self._bytes, self._ranks

        def renew(k: int) -> None:
            follows = after[k]
            found = known.get(tokens[ids[k]] + tokens[ids[follows]]) if follows < end else None
            ranks[k] = int(NONE) if found is None else found
            if found is not None:
                heapq.heappush(heap, (found, k))

        while heap:
            rank, k = heapq.heappop(heap)
            if ids[k] < 0 or ranks[k] != rank:
                continue
            gone = after[k]
            ids[k], ids[gone], after[k] = rank, -1, after[gone]
            if after[k] < end:
                before[after[k]] = k
            renew(k)
            if before[k] >= 0:
                renew(before[k])
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, cuts: bool = True) -> Codec:
    """One per worker process: its words serve all its tasks."""
    return Codec(load_ranks(path), pattern, cuts=cuts)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Keys and values of rows, up to ``BLOCK_CHARS`` characters (bytes) together, or one longer value."""
    keys, values, held = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            some = batch.slice(at, 64)
            for key, value in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                keys.append(key)
                values.append(value)
                held += len(value or "")
                if held >= BLOCK_CHARS:
                    yield keys, values
                    keys, values, held = [], [], 0
    if keys:
        yield keys, values


def _mapped(df: DataFrame, key: str, value: str, fields: list[tuple[str, pa.DataType, str]], rows) -> DataFrame:
    names = ["_key", *(name for name, _, _ in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, values in _blocks(batches):
            columns = list(zip(*rows(values)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), *(pa.array(c, kind) for c, (_, kind, _) in zip(columns, fields))], names=names)
        release()

    ddl = ", ".join(["_key long", *(f"{name} {kind}" for name, _, kind in fields)])
    return df.select(F.col(key).cast("long").alias("_key"), F.col(value).alias("_value")).mapInArrow(run, ddl).withColumnRenamed("_key", key)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", cuts: bool = True) -> DataFrame:
    """``key`` and ``ids``, the token ids of each text in little-endian unsigned 32-bit form."""
    return _mapped(df, key, text, [("ids", pa.binary(), "binary")],
                   lambda texts: [(ids,) for ids in codec(path, pattern, cuts).encode(texts)])


def decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``bytes``, what the ids of ``encode`` stand for. No ids: no bytes."""
    return _mapped(df, key, ids, [("bytes", pa.binary(), "binary")],
                   lambda values: [(codec(path, pattern).decode(v or b""),) for v in values])


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens, ids_sha256 (of the decimal ids, one space between), decoded_sha256 (of the decoded ids)."""
    def rows(texts: list[str | None]) -> Iterator[tuple]:
        codes = codec(path, pattern)
        return map(codes.digests, codes.encode(texts))

    return _mapped(df, key, text, [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"),
                                   ("decoded_sha256", pa.string(), "string")], rows)
