"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased and reduced to letters and digits with one space between words. An item of m characters
may be found with up to floor(``rate`` x m) edits, k. It is cut into k + 1 pieces; wherever it occurs with at most k edits,
at least one piece occurs unchanged. One automaton finds all pieces of all items in a text. Hits of one item whose implied
starts are near each other share a window, and Myers' bit-parallel algorithm gives the least edit distance of the item to
any part of the window.

Items of fewer than ``MIN_CHARS`` characters after that are left out, or with ``short`` found where they stand unchanged as
whole words (next to a script that writes no spaces: anywhere). Items without letters and digits match nothing; equal items
are searched once. Items go to the tasks in blocks of at most
``BLOCK_CHARS`` characters, one pass over the documents per block, so a large benchmark costs more passes and not more
memory. Null and empty texts match nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows, stored, unused

RATE, BLOCK_CHARS, MIN_CHARS = 0.08, 4_000_000, 16
_WORDS = re.compile(r"[^\W_]+")
# Scripts without spaces between words: Thai to Myanmar, Khmer, Chinese and Japanese.
_UNSPACED = r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
_OPEN_START, _OPEN_END = re.compile(rf"^ (?={_UNSPACED})"), re.compile(rf"(?<={_UNSPACED}) $")


def normalise(text: str | None) -> str:
    return f" {' '.join(_WORDS.findall((text or '').lower()))} "


def myers(pattern: str, text: str, most: int) -> int | None:
    """Least edit distance of the pattern to any part of the text, or None if above ``most``."""
    m, masks = len(pattern), {}
    for k, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << k
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up, down = up << 1, down << 1
        plus, minus = (down | ~(diagonal | up)) & full, up & diagonal & full
        best = min(best, score)
    return best if best <= most else None


class Matcher:
    """All items of a block; ``find(text)`` yields (item position, least edits)."""

    def __init__(self, items: list[str], rate: float, short: bool = False):
        import ahocorasick

        self.items = [normalise(i) for i in items]
        self.budget = [int(rate * len(i)) for i in self.items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (item, k) in enumerate(zip(self.items, self.budget)):
            if len(item) - 2 < MIN_CHARS:
                if not short or not item.strip():
                    continue
                item = self.items[n] = _OPEN_END.sub("", _OPEN_START.sub("", item))
                k = self.budget[n] = 0
            at = [len(item) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(at, at[1:]):
                pieces.setdefault(item[a:b], []).append((n, b - 1))
        self._automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self._automaton.add_word(piece, owners)
        self._automaton.make_automaton()
        self._any = bool(pieces)

    def find(self, text: str | None) -> Iterator[tuple[int, int]]:
        plain = normalise(text)
        starts: dict[int, list[int]] = {}
        for end, owners in self._automaton.iter(plain) if self._any else ():
            for n, offset in owners:
                starts.setdefault(n, []).append(end - offset)
        for n, found in starts.items():
            item, k = self.items[n], self.budget[n]
            best = 0 if any(s >= 0 and plain.startswith(item, s) for s in found) else k + 1
            for low, high in _near(sorted(found), k) if best else ():
                edits = myers(item, plain[max(0, low - k):high + len(item) + k], best - 1)
                best = best if edits is None else edits
            if best <= k:
                yield n, best


def _near(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """First and last of each run of starts that lie within the gap of the one before."""
    first = last = starts[0]
    for s in starts[1:]:
        if s - last > gap:
            yield first, last
            first = s
        last = s
    yield first, last


def find_items(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS, short: bool = False) -> DataFrame:
    """doc_id, item_id, edits, budget: one row per document and benchmark item found in it; with ``short`` also items of
    fewer than ``MIN_CHARS`` characters. One pass over the documents per ``block_chars`` characters of items."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return _found(rows, "doc_id", benchmark, rate, block_chars, short)


def _found(rows: DataFrame, key: str, benchmark: DataFrame, rate: float, block_chars: int, short: bool) -> DataFrame:
    """``key``, item_id, edits, budget, from rows of (``key``, text)."""
    spark = rows.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where("text IS NOT NULL")
    by_text = items.groupBy("text").agg(F.min("item_id").alias("_key"))
    total = by_text.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // block_chars))  # half full on average, so that hashing keeps blocks near the bound
    found = []
    for block in range(blocks):
        some = [(r["_key"], r["text"]) for r in by_text.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("text").collect()]
        shared = spark.sparkContext.broadcast(some)

        def match(batch: Iterator[dict], shared=shared) -> Iterator[tuple]:
            matcher = Matcher([t for _, t in shared.value], rate, short)
            for r in batch:
                for n, edits in matcher.find(r["text"]):
                    yield r[key], shared.value[n][1], edits, matcher.budget[n]

        found.append(map_rows(rows, match, f"{key} {rows.schema[key].dataType.simpleString()}, _text string, edits int, budget int"))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    return hits.join(items.withColumnRenamed("text", "_text"), "_text").select(key, "item_id", "edits", "budget").distinct()


def without_items(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, short: bool = False) -> DataFrame:
    """The documents in which no item is found, with all their columns. A row goes by its own text, whether it has an id or shares
    one with others."""
    found = unused(docs, "_found")
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    rows = docs.select(digest.alias("digest"), "text")
    hits = _found(rows, "digest", benchmark, rate, BLOCK_CHARS, short).select(F.col("digest").alias(found)).distinct()
    return docs.join(stored(docs.sparkSession, hits, "leaks"), digest == F.col(found), "left_anti")
