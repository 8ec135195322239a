"""Exact substring dedup by fixed-block anchors.

A window is 20 consecutive words ``[^\\x20\\x09-\\x0D]+`` of one document. A word is removed if a window over it has the same
words as a window that starts earlier: in a smaller doc_id, or earlier in the same document.

Anchors: every document is cut into reference blocks of 10 words. A window of 20 words holds a whole block, so whenever
two windows are equal, a block inside the earlier one equals a rolling 10-word window inside the later one. Blocks are
indexed and every rolling window probes the index by 24 bits of a hash within its bucket; a chance hit costs work, never a
wrong result. Extension: hits spread over the windows that hold them, those are compared by the hash of all 20 words (64
bits, besides a bucket chosen by an independent hash), and neighbouring equal windows join to maximal repeats.

Bytes: a task handles its documents in chunks and sends one packed row per chunk and bucket, about four bytes a window.
Skew: within a chunk equal windows are combined and one of them is sent with its hash, so a passage in a third of all
documents reaches its bucket once per chunk; the rest travel as places only. Buckets grow in number with the input. A
chunk's combined windows go to the same bucket as the one sent, so a repeated task cannot split them.

Null and empty texts have no words. Rows without an id come before all others. Rows of equal id, or without one, that
differ in their text are ordered by a hash of the text; rows equal in both start at the same places, so neither repeats the
other. A place is one number, the text's hash above the start, so that order is the order of numbers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlake.llm.common import map_rows, pack, release

WINDOW, BLOCK = 20, 10
assert 2 * BLOCK - 1 <= WINDOW
CHUNK = 1 << 19
BUCKET_BYTES = 8 << 20
NO_ID = -(1 << 63)
_WHITE = " \t\n\x0b\x0c\r"
_PARTS = re.compile(r"[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+")
# Multipliers of the words of a block, of a window and of a window's bucket, and of the finishing steps: random odd numbers
# of a fixed seed.
_ODD = np.random.default_rng(20).integers(0, 1 << 63, BLOCK + 2 * WINDOW + 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OF_BLOCK, _OF_WINDOW, _OF_BUCKET = _ODD[:BLOCK], _ODD[BLOCK:BLOCK + WINDOW], _ODD[BLOCK + WINDOW:BLOCK + 2 * WINDOW]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def tag_of(text: str | None) -> int:
    """What precedes the starts of a text's windows: 31 bits of its hash, shifted above any start."""
    return xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass"), 42) >> 33 << 32


def _tag(text: str) -> Column:
    """``tag_of`` as a column."""
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 33), 32)


def _finish(x: np.ndarray, multiplier: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * multiplier
    return x ^ (x >> np.uint64(29))


def _rolling(hashes: np.ndarray, width: int, multipliers: np.ndarray) -> np.ndarray:
    n = len(hashes) - width + 1
    out = hashes[:n] * multipliers[0]
    for j in range(1, width):
        out += hashes[j:n + j] * multipliers[j]
    return out


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _from_planes(raw: bytes, dtype: str, n: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width).reshape(width, n).T).view(dtype).reshape(n)


def pack_places(docs: np.ndarray, places: np.ndarray) -> bytes:
    """Places in the order of a chunk, as differences; neighbours mostly share the document."""
    doc = np.diff(docs, prepend=np.int64(0))
    step = np.where((doc == 0) & (np.arange(len(doc)) > 0), np.diff(places, prepend=np.int64(0)), places).astype("<i8")
    return zstandard.ZstdCompressor(level=1).compress(_planes(doc.astype("<i8")) + _planes(step))


def unpack_places(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, 16 * n))
    doc, step = _from_planes(raw, "<i8", n), _from_planes(raw[8 * n:], "<i8", n)
    new = doc != 0
    new[:1] = True
    sums = np.cumsum(step)
    base = (sums - step)[new]
    return np.cumsum(doc), sums - base[np.cumsum(new) - 1]


def send(keys: np.ndarray, bucket: np.ndarray, docs: np.ndarray, places: np.ndarray, flags: np.ndarray, width: int,
         group: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple]:
    """Packed rows (bucket, sent, combined, keys, flags, places, combined places) of a chunk. ``group(order, edges)`` gets the
    windows ordered by bucket and key with the edges of equal ones, and returns which window of each run is sent, and which
    of the others are to be reported with it."""
    order = np.lexsort((keys, bucket))
    edge = np.flatnonzero(np.concatenate(([True], (np.diff(keys[order]) != 0) | (np.diff(bucket[order]) != 0))))
    chosen, others = group(order, edge)
    chosen, others = np.sort(chosen), np.sort(others)
    by, by_other = np.argsort(bucket[chosen], kind="stable"), np.argsort(bucket[others], kind="stable")
    chosen, others = chosen[by], others[by_other]
    numbers = np.union1d(bucket[chosen], bucket[others])
    cut, cut_other = (np.searchsorted(bucket[x], np.append(numbers, numbers[-1:] + 1)) for x in (chosen, others))
    for k, number in enumerate(numbers.tolist()):
        a, b = chosen[cut[k]:cut[k + 1]], others[cut_other[k]:cut_other[k + 1]]
        raw = keys[a].astype("<u8").view(np.uint8).reshape(len(a), 8)[:, :width]
        yield (number, len(a), len(b), raw.tobytes(), np.packbits(flags[a]).tobytes(), pack_places(docs[a], places[a]), pack_places(docs[b], places[b]))


SENT = "bucket int, n int, m int, keys binary, flags binary, places binary, others binary"


def _chunks(rows: Iterator[dict], need: int, chunk_words: int) -> Iterator[list[tuple[dict, list[bytes]]]]:
    """Documents of at least ``need`` words, about ``chunk_words`` words at a time."""
    held, size = [], 0
    for r in rows:
        words = words_of(r["text"])
        if len(words) < need:
            continue
        held.append((r, words))
        size += len(words)
        if size >= chunk_words:
            yield held
            held, size = [], 0
    if held:
        yield held


def _id(r: dict) -> int:
    return NO_ID if r["doc_id"] is None else r["doc_id"]


def anchors(docs: DataFrame, buckets: int, chunk_words: int = CHUNK) -> DataFrame:
    """Packed rolling windows of ``BLOCK`` words; flagged ones are reference blocks. Windows equal within a chunk are hits
    already, and are reported with the one sent."""
    def rows(found: Iterator[dict]) -> Iterator[tuple]:
        for chunk in _chunks(found, WINDOW, chunk_words):
            counts = np.array([len(w) for _, w in chunk])
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            hashes = np.concatenate([_word_hashes(w) for _, w in chunk])
            rolled = _rolling(hashes, BLOCK, _OF_BLOCK)
            place = np.arange(len(hashes)) - np.repeat(starts, counts)
            inside = (place + BLOCK <= np.repeat(counts, counts))[:len(rolled)]
            tags = np.repeat(np.array([tag_of(r["text"]) for r, _ in chunk], np.int64), counts)
            blocks = (place % BLOCK == 0)[:len(rolled)][inside]
            places = (place + tags)[:len(rolled)][inside]
            mixed = _finish(rolled[inside], _ODD[-1])
            ids = np.repeat(np.array([_id(r) for r, _ in chunk], np.int64), counts)[:len(rolled)][inside]
            for at in range(0, len(mixed), 2 * CHUNK):
                part = slice(at, at + 2 * CHUNK)
                flags = blocks[part]

                def group(order: np.ndarray, edge: np.ndarray, flags=flags) -> tuple[np.ndarray, np.ndarray]:
                    size = np.diff(np.append(edge, len(order)))
                    run = np.repeat(np.arange(len(edge)), size)
                    # A flagged window of the run if there is one, else its first.
                    first = np.where(flags[order], np.arange(len(order)), len(order))
                    best = np.minimum.reduceat(first, edge) if len(edge) else edge
                    best = np.where(best == len(order), edge, best)
                    others = np.arange(len(order)) != best[run]
                    also = (size > 1)[run]
                    return order[best], order[others | also]

                key = mixed[part]
                yield from send(key & np.uint64(0xFFFFFF), ((key >> np.uint64(24)) % np.uint64(buckets)).astype(np.int32), ids[part],
                                places[part], flags, 3, group)

    return map_rows(docs, rows, SENT, flush=64)


def windows(rows: DataFrame, hits: DataFrame, buckets: int, chunk_words: int = CHUNK) -> DataFrame:
    """Packed windows of ``WINDOW`` words that hold a hit. Of windows equal within a chunk the earliest is sent; the others
    are repeats already."""
    def packed(found: Iterator[dict]) -> Iterator[tuple]:
        for chunk in _chunks(found, WINDOW, chunk_words):
            hashes, homes, ids, places = [], [], [], []
            for r, words in chunk:
                wanted = np.zeros(len(words) + 1, np.int64)
                hit = r["places"][r["places"] + BLOCK <= len(words)]
                np.add.at(wanted, np.maximum(0, hit - BLOCK + 1), 1)
                np.add.at(wanted, hit + 1, -1)
                starts = np.flatnonzero(np.cumsum(wanted)[:len(words) - WINDOW + 1] > 0)
                if not len(starts):
                    continue
                of_words = _word_hashes(words)
                hashes.append(_rolling(of_words, WINDOW, _OF_WINDOW)[starts])
                homes.append(_rolling(of_words, WINDOW, _OF_BUCKET)[starts])
                ids.append(np.full(len(starts), _id(r), np.int64))
                places.append(starts + tag_of(r["text"]))
            if not hashes:
                continue
            raw, home, docs_, at = map(np.concatenate, (hashes, homes, ids, places))

            def group(order: np.ndarray, edge: np.ndarray, docs_=docs_, at=at) -> tuple[np.ndarray, np.ndarray]:
                size = np.diff(np.append(edge, len(order)))
                run = np.repeat(np.arange(len(edge)), size)
                ranked = np.lexsort((at[order], docs_[order], run))
                order = order[ranked]  # runs stay where they are, the earliest of each comes first
                lead = order[edge][run]
                later = (docs_[order] > docs_[lead]) | (docs_[order] == docs_[lead]) & (at[order] > at[lead])
                return order[edge], order[later]

            keys = _finish(raw, _ODD[-2])
            bucket = (_finish(home, _ODD[-3]) >> np.uint64(20)) % np.uint64(buckets)
            yield from send(keys, bucket.astype(np.int32), docs_, at, np.zeros(len(raw), bool), 8, group)

    return with_places(rows, hits, lambda found: packed(r for r in found if len(r["places"])), SENT)


def with_places(rows: DataFrame, places: DataFrame, each: Callable, schema: str | T.StructType) -> DataFrame:
    """``each`` over the rows of a part, with the ``places`` picked in their document."""
    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def part(left: pa.Table, right: pa.Table) -> pa.Table:
        picked = [unpack_places(b, n) for b, n in zip(right["places"].to_pylist(), right["n"].to_pylist())]
        docs, at = map(np.concatenate, zip(*picked)) if picked else (np.zeros(0, np.int64),) * 2
        order = np.lexsort((at, docs))
        docs, at = docs[order], at[order]

        def dicts() -> Iterator[dict]:
            for start in range(0, left.num_rows, 256):
                for r in left.slice(start, 256).to_pylist():
                    low, high = np.searchsorted(docs, r["doc_id"], "left"), np.searchsorted(docs, r["doc_id"], "right")
                    tag = tag_of(r["text"]) if low < high else 0
                    low, high = low + np.searchsorted(at[low:high], [tag, tag + (1 << 32)])
                    yield r | {"places": at[low:high] - tag}

        done = list(each(dicts()))
        out = pa.Table.from_batches([pack(done[k:k + 1000], arrow) for k in range(0, len(done), 1000)], schema=arrow)
        done.clear()
        release()
        return out

    return rows.groupBy("part").cogroup(places.groupBy("part")).applyInArrow(part, schema)


def met(sent: DataFrame, width: int, parts: int, judge: Callable) -> DataFrame:
    """(part, n, places): what ``judge(keys, flags, docs, places)`` picks in each bucket, and the combined windows, packed for
    each part of the documents."""
    schema = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("places", pa.binary())])

    def bucket(rows: list[dict]) -> pa.RecordBatch:
        n = sum(r["n"] for r in rows)
        keys = np.zeros((n, 8), np.uint8)
        keys[:, :width] = np.frombuffer(b"".join(r["keys"] for r in rows), np.uint8).reshape(n, width)
        flags = np.concatenate([np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=r["n"]) for r in rows]).astype(bool)
        docs, places = map(np.concatenate, zip(*[unpack_places(r["places"], r["n"]) for r in rows]))
        picked = judge(keys.view("<u8").reshape(n), flags, docs, places)
        more_docs, more = map(np.concatenate, zip(*[unpack_places(r["others"], r["m"]) for r in rows]))
        docs, places = np.concatenate((docs[picked], more_docs)), np.concatenate((places[picked], more))
        part = part_of(docs, places >> np.int64(32) << np.int64(32), parts)
        order = np.lexsort((places, docs, part))
        part, docs, places = part[order], docs[order], places[order]
        edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else np.zeros(1, np.int64)
        return pack([(int(part[a]), int(b - a), pack_places(docs[a:b], places[a:b])) for a, b in zip(edges[:-1], edges[1:])], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and held[0]["bucket"] != r["bucket"]:
                    yield bucket(held)
                    held = []
                held.append(r)
        if held:
            yield bucket(held)
        release()

    return sent.repartition(F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(run, "part int, n int, places binary")


# The primes of XXH64.
_PRIMES = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _xxh64(numbers: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of single 64-bit numbers."""
    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return x << np.uint64(by) | x >> np.uint64(64 - by)

    first, second, third, fourth, fifth = _PRIMES
    out = seed + fifth + np.uint64(8) ^ turned(numbers * second, 31) * first
    out = turned(out, 27) * first + fourth
    out = (out ^ out >> np.uint64(33)) * second
    out = (out ^ out >> np.uint64(29)) * third
    return out ^ out >> np.uint64(32)


def part_of(docs: np.ndarray, tags: np.ndarray, parts: int) -> np.ndarray:
    """As ``pmod(xxhash64(doc_id, tag), parts)``: rows without an id, or of one id, are dealt by their texts."""
    own = _xxh64(docs.astype(np.int64).view(np.uint64), np.full(len(docs), 42, np.uint64))
    return (_xxh64(tags.astype(np.int64).view(np.uint64), own).view(np.int64) % parts).astype(np.int32)


def _anchored(keys: np.ndarray, flags: np.ndarray, docs: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Windows whose key occurs twice or more, at least once as a reference block."""
    ordered = np.sort(keys << np.uint64(32) | np.arange(len(keys), dtype=np.uint64))
    order = (ordered & np.uint64(0xFFFFFFFF)).astype(np.int64)
    key = ordered >> np.uint64(32)
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, len(key)))
    indexed = np.logical_or.reduceat(flags[order], edge) if len(edge) else np.zeros(0, bool)
    return order[np.repeat((size > 1) & indexed, size)]


def _later(keys: np.ndarray, flags: np.ndarray, docs: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Windows with an equal one that starts earlier."""
    order = np.lexsort((places, docs, keys))
    key, doc, place = keys[order], docs[order], places[order]
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    lead = np.repeat(edge, np.diff(np.append(edge, len(key))))
    return order[(doc != doc[lead]) | (place != place[lead])]


def with_repeats(docs: DataFrame, each: Callable, schema: str | T.StructType, id_col: str = "doc_id", text: str = "text",
                 chunk: int = CHUNK, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``each`` over rows with doc_id, text, ``row`` (the other columns) and ``places``, the starts of the windows that also
    start earlier. Documents are dealt into parts by id and text; the texts are shuffled once, for the windows and for the result."""
    others = [F.col(c) for c in docs.columns if c not in (id_col, text)]
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text).alias("text"),
                       *([F.struct(*others).alias("row")] if others else []))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    hits = met(anchors(rows.select("doc_id", "text"), buckets, chunk), 3, buckets, _anchored)
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.col("doc_id"), _tag("text")), F.lit(buckets)).cast("int"))
    later = met(windows(rows, hits, buckets, chunk), 8, buckets, _later)
    return with_places(rows, later, each, schema)


def free_places(n: int, repeats: np.ndarray) -> np.ndarray:
    """Places, of ``n`` words, outside repeated windows."""
    starts = np.unique(repeats[repeats + WINDOW <= n])
    cover = np.zeros(n + 1, np.int64)
    cover[starts] += 1
    np.subtract.at(cover, starts + WINDOW, 1)
    return np.flatnonzero(np.cumsum(cover)[:-1] == 0)


def cut_out(text: str, free: np.ndarray) -> str:
    """The text with the words at ``free`` places only. White space between words that stay neighbours stays as it is; where
    words went in between, it is that before them if it has a line break, else that behind them."""
    parts = _PARTS.findall(text)
    lead = 1 - (parts[0].strip(_WHITE) != "")  # the first word's position among the parts
    words = (lead + 2 * free).tolist()
    out = [parts[0]] if lead and words[0] == 1 else []
    for before, at in zip([None, *words], words):
        if before is not None:
            gap = parts[before + 1]
            out.append(gap if at == before + 2 or "\n" in gap else parts[at - 1])
        out.append(parts[at])
    return "".join(out) + (parts[-1] if words[-1] == len(parts) - 2 else "")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space) of every row."""
    def rows(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            words = words_of(r["text"])
            free = free_places(len(words), r["places"]).tolist()
            kept = words if len(free) == len(words) else [words[k] for k in free]
            yield None if r["doc_id"] == NO_ID else r["doc_id"], len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    return with_repeats(docs.select(id_col, text), rows, "doc_id long, n_words long, n_removed long, kept_sha256 string", id_col, text, **options)


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n_chars: str = "n_chars", **options: int) -> DataFrame:
    """The documents with all their columns, repeated words cut out of their texts, with the new length in ``n_chars`` if there
    is such a column; a document that loses all its words goes. Others stay as they are."""
    names = docs.columns

    def rows(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            n = len(words_of(r["text"]))
            free = free_places(n, r["places"])
            if n and not len(free):
                continue
            whole = len(free) == n
            new = r["text"] if whole else cut_out(r["text"], free)
            own = {**(r.get("row") or {}), id_col: None if r["doc_id"] == NO_ID else r["doc_id"], text: new}
            if n_chars in own and not whole:
                own[n_chars] = len(new)
            yield tuple(own[c] for c in names)

    return with_repeats(docs, rows, docs.schema, id_col, text, **options)
