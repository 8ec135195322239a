"""Token files compressed by Re-Pair grammars.

Documents are put in ascending id order by one range partitioning; each task writes its documents as shards of about
``SHARD_IDS`` ids. In a shard, pairs of neighbouring symbols that occur ``LEAST_COUNT`` times or more are replaced by new
symbols, round after round until there is none; a round takes all such pairs together, and where two occurrences overlap that
of the more frequent pair is replaced. Pairs never cross a document's end. The file holds the rules with their expansion lengths, the
remaining symbols, and per document its id, first id and first symbol. A document, or a range of ids that may begin and end
inside one, is decoded without expanding the rest: the lengths tell which half of a rule an offset falls in.

Positions in the whole corpus come from the numbers of ids per task, one number each; they are added when files are read.
Only files listed in the committed manifest are read. Null and empty texts have the end id alone; rows without an id come
first; equal ids are ordered by text.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import tokens
from ledgerlake.llm.common import filesystem, map_rows, stored, write_file
from ledgerlake.session import scratch_path

END_ID, SHARD_IDS = 2, 1 << 20
#: Occurrences that a pair needs for a rule of its own. A rule costs twelve bytes before compression.
LEAST_COUNT = 16
#: Passes in which a round settles overlapping pairs; what is open then is left to the next round.
PASSES = 8
SLOT_BITS = 18
#: Ids of a rule's expansion up to which it is kept whole while a shard is read.
FLAT = 1024
TASK_SHARDS = 4
MAGIC = b"RPR1"


def _frequent(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct pairs that occur often enough, and how often."""
    ordered = np.sort(pairs)
    edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True])))
    counts = np.diff(edges)
    often = counts >= LEAST_COUNT
    return ordered[edges[:-1]][often], counts[often]


def compress(ids: np.ndarray, end_id: int = END_ID, vocabulary: int | None = None) -> tuple[int, np.ndarray, np.ndarray]:
    """(first new symbol, rules, symbols): rule k replaces the pair ``rules[k]`` by symbol ``first + k``.

    Each round replaces all pairs frequent enough, and the rounds go on until there is none. Counts of old pairs only fall, so a
    round looks at pairs with a symbol of the round before; when these are used up it looks at all pairs once more."""
    symbols = ids.astype(np.uint32)
    base = top = int(symbols.max(initial=0)) + 1 if vocabulary is None else vocabulary
    rules: list[np.ndarray] = []
    new_from = 0  # symbols from here on are new; 0: look at all
    while len(symbols) > 1:
        # Pairs of small symbols are one 32-bit number, which sorts faster.
        wide, shift = (np.uint32, 16) if top < 1 << 16 else (np.uint64, 32)
        low = wide((1 << shift) - 1)
        if new_from:
            new = np.flatnonzero(symbols >= new_from)
            beside = np.zeros(len(symbols) + 1, bool)  # the pair that ends with a new symbol, and the one that begins with it
            beside[new], beside[new + 1] = True, True
            place = np.flatnonzero(beside[1:-1])
            place = place[(symbols[place] != end_id) & (symbols[place + 1] != end_id)]
        else:
            inner = symbols != end_id
            place = np.flatnonzero(inner[:-1] & inner[1:])
        pairs = (symbols[place].astype(wide) << wide(shift)) | symbols[place + 1].astype(wide)
        chosen, counts = _frequent(pairs) if len(pairs) >= LEAST_COUNT else (pairs[:0], place[:0])
        taken, rule = _disjoint(place, pairs, chosen, counts)
        if len(taken):  # overlaps may have left a pair too few places
            uses = np.bincount(rule, minlength=len(chosen))
            enough = uses >= LEAST_COUNT // 2
            chosen, number = chosen[enough], np.cumsum(enough) - 1
            taken, rule = taken[enough[rule]], number[rule[enough[rule]]]
        if not len(taken):
            if not new_from:
                break
            new_from = 0
            continue
        symbols[taken] = (top + rule).astype(np.uint32)
        keep = np.ones(len(symbols), bool)
        keep[taken + 1] = False
        symbols = symbols[keep]
        rules.append(np.stack([chosen >> wide(shift), chosen & low], axis=1).astype(np.uint32))
        new_from, top = top, top + len(chosen)
    return base, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), symbols


def _which(pairs: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``pairs`` of those among the sorted ``chosen`` ones, and the number of each. By a hash table; chosen pairs
    that share a slot are looked up by bisection."""
    kind = pairs.dtype.type
    factor, shift = (kind(0x9E3779B1), kind(32 - SLOT_BITS)) if kind is np.uint32 else (kind(0x9E3779B97F4A7C15), kind(64 - SLOT_BITS))
    table, shared = np.zeros(1 << SLOT_BITS, np.int32), np.zeros(1 << SLOT_BITS, bool)
    own = chosen * factor >> shift
    table[own] = np.arange(len(chosen), dtype=np.int32)
    shared[own[table[own] != np.arange(len(chosen))]] = True
    slots = pairs * factor >> shift
    at = table[slots]
    hit = chosen[at] == pairs
    if shared.any():
        rest = np.flatnonzero(~hit & shared[slots])
        at[rest] = np.minimum(np.searchsorted(chosen, pairs[rest]), len(chosen) - 1)
        hit[rest] = chosen[at[rest]] == pairs[rest]
    where = np.flatnonzero(hit)
    return where, at[where].astype(np.int64)


def _disjoint(place: np.ndarray, pairs: np.ndarray, chosen: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of chosen pairs that do not overlap, in order, and which pair each is. The more frequent pair goes first, so all
    copies of a passage are cut alike wherever they stand."""
    if not len(chosen):
        return place[:0], place[:0]
    found, rule = _which(pairs, chosen)
    where = place[found]
    # Ranks without ties; among equally frequent pairs an order without any run along the text.
    mixed = (np.arange(len(chosen), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    rank = np.empty(len(chosen), np.int64)
    rank[np.lexsort((mixed, counts))] = np.arange(len(chosen))
    places, rules = [], []
    for _ in range(PASSES):
        if not len(where):
            break
        beside = np.diff(where) == 1
        # Of a run of one pair, as in "aaaa", every second place counts, from its left end.
        nth = np.arange(len(where))
        begins = np.concatenate(([True], ~(beside & (rule[1:] == rule[:-1]))))
        height = np.where((nth - np.maximum.accumulate(np.where(begins, nth, 0))) % 2 == 0, rank[rule], -1)
        best = height >= 0
        best[1:] &= ~beside | (height[1:] > height[:-1])
        best[:-1] &= ~beside | (height[:-1] > height[1:])
        places.append(where[best])
        rules.append(rule[best])
        gone = best.copy()
        gone[1:] |= beside & best[:-1]
        gone[:-1] |= beside & best[1:]
        where, rule = where[~gone], rule[~gone]
    where, rule = np.concatenate(places), np.concatenate(rules)
    order = np.argsort(where)
    return where[order], rule[order]


def expansion_lengths(base: int, rules: np.ndarray) -> np.ndarray:
    lengths = []
    for a, b in rules.tolist():
        lengths.append((lengths[a - base] if a >= base else 1) + (lengths[b - base] if b >= base else 1))
    return np.array(lengths, np.uint32)


def expand(base: int, rules: np.ndarray, symbols: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """Ids of a run of symbols: new symbols are replaced by their pairs until none is left. With ``wanted``, a flag per
    symbol, one step that replaces the flagged ones."""
    while True:
        new = symbols >= base if wanted is None else wanted[symbols]
        if not new.any():
            return symbols
        at = np.arange(len(symbols)) + np.concatenate(([0], np.cumsum(new)[:-1]))
        out = np.empty(len(symbols) + int(new.sum()), np.uint32)
        out[at[~new]] = symbols[~new]
        pair = rules[symbols[new] - base]
        out[at[new]], out[at[new] + 1] = pair[:, 0], pair[:, 1]
        symbols = out
        if wanted is not None:
            return symbols


def encode_shard(doc_ids: list[int | None], ids: bytes, counts: list[int], end_id: int = END_ID) -> bytes:
    """File image of a shard: ``ids`` holds all documents' ids, ``counts`` their numbers."""
    base, rules, symbols = compress(np.frombuffer(ids, "<u4"), end_id)
    lengths = expansion_lengths(base, rules)
    width = np.concatenate((np.ones(base, np.uint32), lengths))[symbols]
    first_id = np.concatenate(([0], np.cumsum(counts)))[:-1].astype("<u8") if counts else np.zeros(0, "<u8")
    first_symbol = np.searchsorted(np.cumsum(width, dtype=np.uint64), first_id, side="right").astype("<u8")
    kind = "<u2" if base + len(rules) <= 1 << 16 else "<u4"
    parts = [np.array([i is not None for i in doc_ids], "u1"), np.array([i or 0 for i in doc_ids], "<i8"), np.array(counts, "<u8"), first_id,
             first_symbol, rules.astype("<u4"), lengths.astype("<u4"), symbols.astype(kind)]
    packer = zstandard.ZstdCompressor(level=1)
    bodies = [packer.compress(np.ascontiguousarray(p)) for p in parts]
    head = struct.pack("<4sIIIQB", MAGIC, len(doc_ids), base, len(rules), len(symbols), int(kind[2]))
    return head + struct.pack(f"<{len(bodies)}Q", *map(len, bodies)) + b"".join(bodies)


class Shard:
    """A shard file; documents and id ranges are decoded alone."""

    def __init__(self, image: bytes):
        magic, n, self.base, n_rules, n_symbols, width = struct.unpack_from("<4sIIIQB", image)
        if magic != MAGIC:
            raise ValueError("not a shard file")
        at = struct.calcsize("<4sIIIQB")
        sizes = struct.unpack_from("<8Q", image, at)
        starts = [at + 64, *accumulate(sizes, initial=at + 64)][1:]
        unpacker, view = zstandard.ZstdDecompressor(), memoryview(image)
        body = [unpacker.decompress(view[s:s + z]) for s, z in zip(starts, sizes)]
        known, ids = np.frombuffer(body[0], "u1"), np.frombuffer(body[1], "<i8")
        self.doc_ids = [int(i) if k else None for k, i in zip(known, ids)]
        self.counts, self.first_id, self.first_symbol = (np.frombuffer(b, "<u8").astype(np.int64) for b in body[2:5])
        self.rules = np.frombuffer(body[5], "<u4").reshape(n_rules, 2)
        self.lengths = np.frombuffer(body[6], "<u4")
        self.symbols = np.frombuffer(body[7], f"<u{width}").astype(np.uint32)
        assert len(self.doc_ids) == n and len(self.symbols) == n_symbols
        # Where each symbol's ids end.
        self._ends = np.cumsum(np.concatenate((np.ones(self.base, np.int64), self.lengths))[self.symbols])

    def document(self, k: int) -> np.ndarray:
        stop = self.first_symbol[k + 1] if k + 1 < len(self.doc_ids) else len(self.symbols)
        return expand(self.base, self.rules, self.symbols[self.first_symbol[k]:stop])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids of a range. The first and the last symbol are entered where the range begins and ends; what lies outside
        it is skipped by the lengths of the rules and never expanded."""
        start, stop = max(0, start), min(stop, int(self._ends[-1]) if len(self._ends) else 0)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = np.searchsorted(self._ends, [start, stop - 1], side="right").tolist()
        before = int(self._ends[first - 1]) if first else 0
        if first == last:
            return self._part(int(self.symbols[first]), start - before, stop - before)
        edge = int(self._ends[last - 1])
        return np.concatenate([
            self._part(int(self.symbols[first]), start - before, int(self._ends[first]) - before),
            expand(self.base, self.rules, self.symbols[first + 1:last]), self._part(int(self.symbols[last]), 0, stop - edge)])

    def _length(self, symbol: int) -> int:
        return int(self.lengths[symbol - self.base]) if symbol >= self.base else 1

    def _part(self, symbol: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of a symbol's expansion."""
        out, todo = [], [(symbol, start, stop)]
        while todo:
            symbol, start, stop = todo.pop()
            if start >= stop:
                continue
            if start == 0 and stop == self._length(symbol):
                out.append(expand(self.base, self.rules, np.array([symbol], np.uint32)))
                continue
            left, right = self.rules[symbol - self.base].tolist()
            n = self._length(left)
            todo += [(right, max(0, start - n), stop - n), (left, start, min(stop, n))]
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def all_ids(self) -> np.ndarray:
        """Ids of the whole shard. Rules of moderate length are expanded once, into one array that all symbols copy from."""
        symbols, rules = self.symbols, self.rules
        short = np.concatenate((np.ones(self.base, bool), self.lengths <= FLAT))
        while not short[symbols].all():
            symbols = expand(self.base, rules, symbols, ~short)
        # Itself for every id, then the expansions of the short rules one behind the other.
        every = np.arange(self.base + len(rules), dtype=np.uint32)
        flat = np.concatenate((every[:self.base], expand(self.base, rules, every[self.base:][short[self.base:]])))
        length = np.concatenate((np.ones(self.base, np.int64), np.where(short[self.base:], self.lengths, 0))).astype(np.int64)
        start, n = (np.cumsum(length) - length)[symbols], length[symbols]
        return flat[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def write_shards(docs: DataFrame, tokenizer: str, folder: str, spaced: bool = False, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents; returns the manifest: part, number, path, n_docs, n_ids, stored_bytes."""
    end = np.array([END_ID], "<u4").tobytes()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text")).withColumn("part", F.spark_partition_id())

    def write(found: Iterator[dict]) -> Iterator[tuple]:
        encoder, number = tokens.encoder(tokenizer, spaced), 0
        doc_ids, parts, counts, held, part = [], [], [], 0, 0

        def close() -> tuple:
            image = encode_shard(doc_ids, b"".join(parts), counts)
            row = (part, number, write_file(folder, f"shard-{part:06d}-{number:06d}", [image]), len(doc_ids), held, len(image))
            doc_ids.clear(), parts.clear(), counts.clear()
            return row

        for r in found:
            part = r["part"]
            ids = encoder.encode(r["text"]) + end
            doc_ids.append(r["doc_id"])
            parts.append(ids)
            counts.append(len(ids) // 4)
            held += counts[-1]
            if held >= SHARD_IDS:
                yield close()
                number, held = number + 1, 0
        if doc_ids:
            yield close()

    return stored(docs.sparkSession, map_rows(
        ordered, write, "part int, number int, path string, n_docs long, n_ids long, stored_bytes long", flush=1), "token-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start in the corpus, n_tokens, ids_crc32 of every document, decoded from the files."""
    from pyspark.sql import Window

    totals = sorted(tuple(r) for r in manifest.groupBy("part").agg(F.sum("n_ids")).collect())  # one number per writing task
    begins = list(zip((p for p, _ in totals), accumulate((n for _, n in totals), initial=0)))
    base = manifest.sparkSession.createDataFrame(begins, "part int, part_start long")
    before = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("_own", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).join(base, "part").select(
        "path", (F.col("part_start") + F.col("_own")).alias("shard_start"))

    def read(found: Iterator[dict]) -> Iterator[tuple]:
        for r in found:
            fs, path = filesystem(r["path"])
            with fs.open_input_file(path) as f:
                shard = Shard(f.read())
            ids = memoryview(np.ascontiguousarray(shard.all_ids(), "<u4")).cast("B")
            for doc_id, first, n in zip(shard.doc_ids, shard.first_id.tolist(), shard.counts.tolist()):
                yield doc_id, r["shard_start"] + first, n, zlib.crc32(ids[4 * first:4 * (first + n)])

    tasks = max(1, sum(n for _, n in totals) // (TASK_SHARDS * SHARD_IDS))
    return map_rows(shards.repartition(tasks, F.col("path")), read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    return read_shards(write_shards(docs, tokenizer, scratch_path(docs.sparkSession, "token-shards"), **options))
