"""Weighted SimHash fingerprints with permuted block tables.

Fingerprint: 128 bits. Terms are the text's words and pairs of neighbouring words; a term that occurs f times weighs
1 + ln f, a pair counts twice as much as a word. Every term hashes to 128 bits and votes its weight for each set bit and
against each clear one; the sign of the sum is the bit. Equal texts have equal fingerprints; a text without words, or a
null, has the zero fingerprint.

Likeness of two fingerprints that differ in d of 128 bits: max(0, cos(pi d / 128)), the cosine that random signed
projections estimate. A zero fingerprint is like another one only if both are zero.

Search within a radius: the bits are cut into blocks. With ``radius`` differing bits at least ``blocks - radius`` blocks
agree, so there is one table per choice of that many blocks, ordered with the chosen blocks in front, and every
fingerprint within the radius meets the query in one of them. Hits are verified in full and reported once. Leads that very many
fingerprints share are dealt into slots.

Null ids take part as rows but ask no question; repeated rows count each; further columns of the input are ignored, whatever
their names; a text of any length is read whole, its terms in slices.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows, stored

BITS, WORDS = 128, 2
# Odd multipliers that mix word hashes into pair hashes and spread a hash over the further bits.
_PAIR, _SPREAD, _FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(32)
_STEPS = [np.uint64((k + 1) * int(_SPREAD) % 2**64) for k in range(WORDS)]
SLICE = 8192
#: Fingerprints of one lead that a query meets in one task; a lead with more is dealt into slots.
CROWD = 4096
RADIUS, EVERY = 3, 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _FOLD)) * _PAIR
    x = (x ^ (x >> np.uint64(29))) * _SPREAD
    return x ^ (x >> _FOLD)


def fingerprint(text: str | None) -> bytes:
    """16 bytes."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return bytes(BITS // 8)
    single = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    votes = np.zeros(BITS, np.float32)
    for hashes, factor in ((single, 1.0), (_mixed(single[:-1] * _PAIR + (single[1:] ^ _SPREAD)), 2.0)):
        terms, counts = np.unique(hashes, return_counts=True)
        weights = (factor * (1 + np.log(counts))).astype(np.float32)
        for at in range(0, len(terms), SLICE):
            some, weight = terms[at:at + SLICE], weights[at:at + SLICE]
            bits = np.unpackbits(np.stack([_mixed(some + step) for step in _STEPS], axis=1).view(np.uint8), axis=1)
            votes += 2 * (weight @ bits.astype(np.float32)) - weight.sum()
    return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0
    if not any(a) or not any(b):
        return 0.0
    return max(0.0, math.cos(math.pi * (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) as 32 hex digits, one row per document."""
    def rows(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            yield r["doc_id"], fingerprint(r["text"]).hex()

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")), rows, "doc_id long, fingerprint string")


def _differing(a: Column, b: Column) -> Column:
    half = BITS // 8
    return sum((F.bit_count(F.conv(F.substring(a, at, 8), 16, 10).cast("long").bitwiseXOR(
        F.conv(F.substring(b, at, 8), 16, 10).cast("long"))) for at in range(1, 2 * half + 1, 8)), F.lit(0))


def _met(queries: DataFrame, index: DataFrame) -> DataFrame:
    """Join by table and lead. The index rows of a crowded lead are dealt into slots, and a query visits each of them."""
    lead = ["t", "lead"]
    crowded = index.groupBy(*lead).agg(F.ceil(F.count(F.lit(1)) / CROWD).alias("slots")).where("slots > 1")
    slots = F.coalesce("slots", F.lit(1).cast("long"))
    dealt = index.join(crowded, lead, "left").select(*lead, "found", F.pmod(F.xxhash64("found"), slots).alias("slot"))
    visits = queries.join(crowded, lead, "left").select(
        *lead, "query", F.explode(F.sequence(F.lit(0).cast("long"), slots - 1)).alias("slot"))
    return visits.join(dealt, [*lead, "slot"])


def search(index: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = 4) -> DataFrame:
    """(query, found, differing): every fingerprint of ``index`` within the radius of a query's, from frames with a
    ``fingerprint`` column. Fingerprints are searched once however many documents carry them; join the result with the
    documents for ids. A query finds itself if it is indexed."""
    if not 0 <= radius < blocks or BITS % (4 * blocks):
        raise ValueError("radius below the number of blocks, blocks of whole hex digits")
    width = BITS // 4 // blocks
    tables = list(itertools.combinations(range(blocks), blocks - radius))

    def permuted(prints: DataFrame, name: str) -> DataFrame:
        keys = [F.struct(F.lit(t).alias("t"), F.concat(*[F.substring(name, b * width + 1, width) for b in chosen]).alias("lead"))
                for t, chosen in enumerate(tables)]
        return prints.select(F.col("fingerprint").alias(name)).where(f"{name} IS NOT NULL").distinct().select(
            name, F.explode(F.array(*keys)).alias("k")).select(name, "k.t", "k.lead")

    met = _met(permuted(queries, "query"), permuted(index, "found"))
    return met.withColumn("differing", _differing(F.col("query"), F.col("found")).cast("int")).where(
        F.col("differing") <= radius).select("query", "found", "differing").distinct()


def count_near(prints: DataFrame, radius: int = RADIUS, every: int = EVERY) -> DataFrame:
    """``prints`` (doc_id, fingerprint and more) with ``n_near``: how many rows, itself included, have a fingerprint within the radius
    of the row's, for rows whose doc_id ``every`` divides; null for the others. Equal fingerprints are searched once and counted
    before they are joined."""
    carried = prints.groupBy(F.col("fingerprint").alias("found")).agg(F.count(F.lit(1)).alias("_n"))
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    found = search(prints, prints.where(asked), radius).join(carried, "found")
    totals = found.groupBy(F.col("query").alias("fingerprint")).agg(F.sum("_n").alias("n_near"))
    return prints.join(totals, "fingerprint", "left").withColumn("n_near", F.when(asked, F.col("n_near"))).select(*prints.columns, "n_near")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last floor(n / 2) code points replaced by the first as many
    (or all) of the next document, in ascending id, after the last the first. Rows without an id come first; rows of equal
    id are ordered by text. A single document is its own next.

    Texts are range-partitioned by id once and read in order. Only the first and the last text of every partition go
    through a second, small join that pairs a partition's last with the next one's first."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text")).withColumn("part", F.spark_partition_id())
    result = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def judged(doc_id, this: str, own: bytes, following: str, other: bytes) -> tuple:
        half = len(this) // 2
        edited = this[:len(this) - half] + following[:half]
        changed = fingerprint(edited)
        return (doc_id, len(this), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own.hex(), changed.hex(),
                likeness(own, changed), likeness(own, other))

    def inside(found: Iterator[dict]) -> Iterator[tuple]:
        held = None
        for r in found:
            mine = (r["doc_id"], r["text"], fingerprint(r["text"]), r["part"])
            if held is None:
                yield (*(None,) * 7, mine[3], "first", mine[0], mine[1])
            else:
                yield (*judged(*held[:3], mine[1], mine[2]), None, None, None, None)
            held = mine
        if held is not None:
            yield (*(None,) * 7, held[3], "last", held[0], held[1])

    done = stored(spark, map_rows(ordered, inside, f"{result}, part int, edge string, edge_id long, edge_text string", flush=256), "next")
    parts = sorted(r[0] for r in done.where("edge = 'first'").select("part").collect())  # one number per partition
    after = spark.createDataFrame([(p, parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)], "part int, following int")
    last = done.where("edge = 'last'").select("part", F.col("edge_id").alias("doc_id"), F.col("edge_text").alias("text"))
    first = done.where("edge = 'first'").select(F.col("part").alias("following"), F.col("edge_text").alias("next_text"))

    def across(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            yield judged(r["doc_id"], r["text"], fingerprint(r["text"]), r["next_text"], fingerprint(r["next_text"]))

    joined = last.join(after, "part").join(first, "following").select("doc_id", "text", "next_text")
    ends = stored(spark, map_rows(joined, across, result), "next-ends")
    return done.where("edge IS NULL").drop("part", "edge", "edge_id", "edge_text").unionByName(ends)
