"""SimHash near-duplicates by multi-index hashing.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of three words joined by a space with repeats (fewer
words: the whole sequence), each hashed by XXH64 with seed 42; a bit is set if it is set in over half of the hashes. A text
without words, or a null, has fingerprint zero and links like any other.

Search: of two fingerprints that differ in at most three of 64 bits, one 32-bit half differs in at most one bit. Every
fingerprint stands in two tables, one per half, and enumerates the Hamming ball of radius one around each half. If two
halves differ in one bit, clearing that bit in one gives the other, so it is enough to clear each set bit in turn.

Equal fingerprints are one node from the start, copies are never paired. Probes meet the table on half and value, and only
those that hit are kept. A value met by many fingerprints is dealt into cells of bounded size, every two blocks of which
meet once; a cell emits a spanning forest of the links it verified, not all pairs. So nothing grows with the square of a
group but bit counts inside cells, and no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows, release, stored
from ledgerlake.llm.components import components

SHINGLE, RADIUS, HALF = 3, 3, 32
#: Fingerprints of one block; a cell holds at most two.
BLOCK = 2048


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), "<u8")
    out = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        out += np.unpackbits(hashes[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * out > len(hashes), bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): one row per document, the fingerprint as a signed 64-bit integer."""
    def rows(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            yield r["doc_id"], _signed(fingerprint(r["text"]))

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")), rows, "doc_id long, fp long")


def fingerprint_column(text: Column) -> Column:
    """16 hex digits of each text's fingerprint."""
    @F.arrow_udf("string")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([f"{fingerprint(t):016x}" for t in batch.to_pylist()], pa.string())
        release()

    return prints(text)


def forest(nodes: list[int], fps: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected by pairs within the radius: a spanning forest."""
    left, values = np.array(nodes, np.int64), np.array(fps, np.int64).view(np.uint64)
    out, frontier = [], []
    while len(left):
        if not frontier:
            frontier.append((left[0], values[0]))
            left, values = left[1:], values[1:]
            continue
        node, value = frontier.pop()
        near = np.bitwise_count(values ^ value) <= radius
        if near.any():
            out += [(int(node), int(n)) for n in left[near]]
            frontier += list(zip(left[near], values[near]))
            left, values = left[~near], values[~near]
    return out


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between nodes (node, fp) of different fingerprints that connect all pairs within the radius."""
    if not 0 <= radius <= 3:
        raise ValueError("two halves with balls of radius one find up to three differing bits")
    halves = F.array(*[F.struct(F.lit(k).alias("half"), F.shiftrightunsigned("fp", HALF * k).bitwiseAND(F.lit((1 << HALF) - 1)).alias("value"))
                       for k in (0, 1)])
    table = nodes.select("node", "fp", F.explode(halves).alias("h")).select("node", "fp", "h.half", "h.value")
    cleared = F.expr(f"filter(transform(sequence(0, {HALF - 1}), k -> value ^ (value & shiftleft(1L, k))), v -> v <> value)")
    probes = table.select("node", "fp", "half", F.explode(cleared).alias("value"))
    # The table's values with the number of fingerprints on each.
    values = table.groupBy("half", "value").agg(F.count(F.lit(1)).alias("homes"))
    hits = probes.join(values.select("half", "value"), ["half", "value"], "left_semi")
    crowded = table.join(values.where("homes > 1").select("half", "value"), ["half", "value"], "left_semi")
    hit_values = hits.select("half", "value").distinct()
    homes = table.join(hit_values, ["half", "value"], "left_semi").unionByName(crowded).distinct()
    members = stored(nodes.sparkSession, hits.unionByName(homes), "mih-members")
    sizes = members.groupBy("half", "value").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, ["half", "value"]).withColumn("_block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "half", "value", F.least("_block", "_other").alias("lo"), F.greatest("_block", "_other").alias("hi"), "node", "fp")
    grouped = cells.groupBy("half", "value", "lo", "hi").agg(F.collect_list("node").alias("nodes"), F.collect_list("fp").alias("fps"))

    def verify(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            yield from forest(r["nodes"], r["fps"], radius)

    return map_rows(grouped.where("size(nodes) > 1").select("nodes", "fps"), verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable) of every row. Rows with equal fingerprints
    share a component; rows without an id take their component from the others, and null if there is none."""
    prints = stored(docs.sparkSession, fingerprints(docs, id_col, text), "simhash")
    nodes = stored(docs.sparkSession, prints.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node IS NOT NULL"), "simhash-nodes")
    found = components(links(nodes, radius))
    classes = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(classes, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
