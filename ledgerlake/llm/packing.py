"""Hierarchical packing of documents into context windows of several lengths.

Route: a document's ids (its end id included) are cut into full windows of ``WINDOW`` and a rest. A rest that nearly fills
a long window (``LONG_SHARE`` of it) stays whole and opens one. Any other rest is cut into one piece for each power of two
in its length, from the largest down to ``SHORTEST``, and a tail below that.

Pack: a piece of 2^k ids is a whole sequence of the tier 2^k, without padding. The gaps of long windows are filled from
the shorter tiers, largest piece first, then with the longest tails that fit; tails left over share long windows of
their own. So only long windows are padded, by less than the shortest tail at hand, and the last one of a group.

Balance: the sequences of a tier are dealt into step groups of ``STEP_IDS`` padded ids each, so all steps of a tier cost
the same.

Where a document is cut depends on its length alone, so ids are made, cut and checked in one pass over the texts and
never stored or shuffled; packing sees lengths only. Pieces are dealt into groups of about ``GROUP_PIECES`` by a hash of
their place in the stored table, and each group is packed by itself. Null and empty texts have the end id alone. Repeated rows are packed each; a row without
an id keeps the null.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlake.llm import tokens
from ledgerlake.llm.common import map_rows, pack, stored

WINDOW, SHORTEST, END_ID = 2048, 64, 1
LONG_SHARE = 0.75
GROUP_PIECES = 40_000
STEP_IDS = 1 << 18
PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long, tier int, step_group long"


def cuts(n: int, window: int = WINDOW) -> list[int]:
    """Lengths of the pieces of a document of n ids, in order."""
    out, rest = [window] * (n // window), n % window
    if rest >= LONG_SHARE * window:
        return [*out, rest]
    size = window // 2
    while size >= SHORTEST:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return [*out, rest] if rest else out


def pieces(docs: DataFrame, tokenizer: str, spaced: bool = True, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
           words: int = tokens.CACHE_WORDS) -> DataFrame:
    """One row per piece, in the order of the document."""
    end = np.array([END_ID], "<u4").tobytes()

    def rows(found: Iterator[dict]) -> Iterator[tuple]:
        encoder = tokens.encoder(tokenizer, spaced, words)
        for r in found:
            ids = memoryview(encoder.encode(r["text"]) + end)
            n, start = len(ids) // 4, 0
            for length in cuts(n, window):
                yield r["doc_id"], start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n
                start += length

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")), rows, PIECES)


def fill(lengths: list[int], window: int = WINDOW) -> list[tuple[int, list[int]]]:
    """(tier, members) of each sequence; members are positions in ``lengths``, whose pieces are at most a window long."""
    tiers: dict[int, list[int]] = {}
    tails: dict[int, list[int]] = {}
    opened: list[tuple[list[int], int]] = []
    out: list[tuple[int, list[int]]] = []
    for k, n in enumerate(lengths):
        if n == window:
            out.append((window, [k]))
        elif n >= LONG_SHARE * window:
            opened.append(([k], window - n))
        elif n >= SHORTEST:
            tiers.setdefault(n, []).append(k)
        else:
            tails.setdefault(n, []).append(k)
    sizes, short = sorted(tiers, reverse=True), sorted(tails)

    def with_tails(members: list[int], gap: int) -> None:
        while gap and short and short[0] <= gap:
            at = bisect_right(short, gap) - 1
            size = short[at]
            members.append(tails[size].pop())
            gap -= size
            if not tails[size]:
                del short[at]

    for members, gap in opened:
        for size in sizes:
            while tiers[size] and size <= gap:
                members.append(tiers[size].pop())
                gap -= size
        with_tails(members, gap)
        out.append((window, members))
    for size in sizes:
        out += [(size, [k]) for k in tiers[size]]
    while short:
        members: list[int] = []
        with_tails(members, window)
        out.append((window, members))
    return out


def pack_pieces(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """Sequences of pieces: adds sequence_id, offset in the sequence, tier and step_group."""
    spark = found.sparkSession
    found = stored(spark, found, "pieces")
    groups = max(1, -(-found.count() // GROUP_PIECES))
    arrow = to_arrow_schema(spark.createDataFrame([], PACKED).schema)
    # By the place in the stored table: equal pieces of repeated rows are dealt like any others.
    dealt = found.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long"))

    def packed(group: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows.sort(key=lambda r: (r[0] is not None, r))
        done, seen = [], {}
        for number, (tier, members) in enumerate(fill([r[2] for r in rows], window)):
            step = seen[tier] = seen.get(tier, -1) + 1
            at, sequence = 0, (group << 32) + number
            for k in members:
                done.append((*rows[k], sequence, at, tier, (group << 32) + step // max(1, STEP_IDS // tier)))
                at += rows[k][2]
        for at in range(0, len(done), 10_000):
            yield pack(done[at:at + 10_000], arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            for values in zip(*[c.to_pylist() for c in batch.columns]):
                if values[-1] != group and rows:
                    yield from packed(group, rows)
                    rows = []
                group = values[-1]
                rows.append(values[:-1])
        if rows:
            yield from packed(group, rows)

    return dealt.repartition(F.col("_group")).sortWithinPartitions("_group").mapInArrow(run, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Every piece of every document with its place."""
    return pack_pieces(pieces(docs, tokenizer, **options))
