"""Near copies: documents whose shingle sets have a Jaccard similarity of ``SIMILAR`` or more, beside SimHash links.

Shingles are five words joined by a space, A-Z lower-cased, without repeats (fewer words: the whole sequence), each hashed by
XXH64. Texts with equal sets are one node from the start. Two kinds of links join nodes into groups:

- SimHash fingerprints within three bits, as ``simhash_mih`` finds them. At a similarity of 0.8 two fingerprints differ in
  about ten of 64 bits; halves or quarters with balls that wide meet a fixed share of the whole corpus per document, so
  Hamming search does not find the others.
- Candidates from min-hashes: ``BANDS`` bands of ``ROWS`` minima, of which one must agree. A pair of similarity 0.8 is missed
  once in 1,500 times (0.85: once in 86,000), a pair of 0.3 met twice in a hundred. Candidates are put into groups by links
  to the smallest node of each band value, so no pairs are listed; then every group is checked on the whole shingle sets. A
  large group is dealt into cells, every two blocks of which meet once, and a cell emits a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import simhash_mih
from ledgerlake.llm.common import map_rows, stored, unused
from ledgerlake.llm.components import components

SHINGLE, SIMILAR, BANDS, ROWS = 5, 0.8, 24, 6
#: Shingles and nodes of one block on average; a cell holds two.
BLOCK_SHINGLES, BLOCK_NODES = 500_000, 2048

_SEEDS = [xxhash.xxh64_intdigest(str(k).encode()) for k in range(2 * BANDS * ROWS)]
_FACTORS = np.array(_SEEDS[::2], np.uint64)[:, None] | np.uint64(1)
_TERMS = np.array(_SEEDS[1::2], np.uint64)[:, None]


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "<u8")
    shingles = map(b" ".join, zip(*[words[k:] for k in range(SHINGLE)])) if len(words) > SHINGLE else [b" ".join(words)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), "<u8"))


def bands(hashes: np.ndarray) -> list[int]:
    """One value per band; none of an empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[at:at + 512] * _FACTORS + _TERMS).min(axis=1), out=least)
    return [simhash_mih._signed(xxhash.xxh64_intdigest(row.tobytes())) for row in least.reshape(BANDS, ROWS)]


def forest(nodes: list[int], sets: list[np.ndarray], least: float = SIMILAR) -> list[tuple[int, int]]:
    """Links that connect whatever is connected by pairs at or above the similarity: a spanning forest. No set is empty."""
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    own = np.split(flat, np.cumsum(sizes)[:-1])
    left, out, frontier = np.arange(len(nodes)), [], []
    while len(left):
        if not frontier:
            frontier.append(left[0])
            left, flat = left[1:], flat[sizes[left[0]]:]
            continue
        this = frontier.pop()
        marked = np.zeros(len(values), bool)
        marked[own[this]] = True
        shared = np.add.reduceat(marked[flat], np.cumsum(sizes[left]) - sizes[left], dtype=np.int64)
        near = shared >= least * (sizes[this] + sizes[left] - shared) - 1e-9
        if near.any():
            out += [(nodes[this], nodes[n]) for n in left[near]]
            frontier += left[near].tolist()
            flat = flat[np.repeat(~near, sizes[left])]
            left = left[~near]
    return out


def similar_links(texts: DataFrame, prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect all candidate nodes at or above the similarity, from (key, text) and (key, node, size, bands)."""
    spark = texts.sparkSession
    nodes = stored(spark, prints.where("size > 0").groupBy("node").agg(
        F.min("key").alias("key"), F.first("size").alias("size"), F.first("bands").alias("bands")), "near-nodes")
    values = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    met = values.groupBy("band", "value").agg(F.min("node").alias("other"), F.count(F.lit(1)).alias("n")).where("n > 1")
    candidates = values.join(met, ["band", "value"]).where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    members = stored(spark, components(candidates).join(nodes.select("node", "key", "size"), "node"), "near-members")
    blocks = members.groupBy("component").agg(
        F.ceil(F.greatest(F.sum("size") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_NODES)).cast("int").alias("blocks"))
    wanted = members.join(blocks, "component").select("key", "node", "component", "blocks")
    once = texts.join(wanted, "key").groupBy("key", "node", "component", "blocks").agg(F.first("text").alias("text"))

    def hashed(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            yield r["node"], r["component"], r["blocks"], shingle_set(r["text"]).tobytes()

    sets = stored(spark, map_rows(once.drop("key"), hashed, "node long, component long, blocks int, hashes binary"), "near-sets")
    dealt = sets.withColumn("_block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = dealt.select("component", F.least("_block", "_other").alias("lo"), F.greatest("_block", "_other").alias("hi"), "node", "hashes")

    def verify(found: Iterator[dict]) -> Iterator[tuple]:
        for _, cell in groupby(found, key=lambda r: (r["component"], r["lo"], r["hi"])):
            members = [(r["node"], np.frombuffer(r["hashes"], "<u8")) for r in cell]
            if len(members) > 1:
                yield from forest(*zip(*members))

    place = ["component", "lo", "hi"]
    return map_rows(cells.repartition(*place).sortWithinPartitions(*place), verify, "a long, b long").distinct()


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of each group, with all columns: the one with the smallest doc_id; rows without an id stay only where no
    other does."""
    spark = docs.sparkSession
    key, group, nth = (unused(docs, name) for name in ("_key", "_group", "_nth"))
    keyed = docs.withColumn(key, F.md5(F.coalesce("text", F.lit(""))))
    texts = keyed.select(F.col(key).alias("key"), "text")

    def rows(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            hashes = shingle_set(r["text"])
            node = simhash_mih._signed(xxhash.xxh3_64_intdigest(hashes.tobytes()))
            yield r["key"], node, simhash_mih._signed(simhash_mih.fingerprint(r["text"])), len(hashes), bands(hashes)

    prints = stored(spark, map_rows(texts, rows, "key string, node long, fp long, size long, bands array<long>"), "near-prints")
    by_print = stored(spark, prints.groupBy("fp").agg(F.min("node").alias("node")), "near-simhash")
    equal = prints.select("fp", F.col("node").alias("a")).distinct().join(by_print.withColumnRenamed("node", "b"), "fp").select("a", "b")
    found = components(simhash_mih.links(by_print).unionByName(equal).unionByName(similar_links(texts, prints)))
    groups = prints.select(F.col("key").alias(key), "node").distinct().join(found, "node", "left").select(
        key, F.coalesce("component", "node").alias(group))
    first = Window.partitionBy(group).orderBy(F.col("doc_id").cast("long").asc_nulls_last(), *[F.col(c) for c in docs.columns])
    chosen = keyed.join(groups, key).withColumn(nth, F.row_number().over(first))
    return chosen.where(F.col(nth) == 1).select(*docs.columns)
