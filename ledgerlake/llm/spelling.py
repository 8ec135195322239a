"""Spelling variants: frequent words one edit apart, found by blocked products of letter counts.

Words come from runs of letters, lower-cased in A-Z only, of whole texts. A run whose ``<doc_id>:<run>`` has a crc32 that 199
divides loses one letter, which plants slips of the pen. Words of at least ``MIN_LETTERS`` code points and
``MIN_COUNT`` occurrences are kept. Two words are near if one inserted, deleted or replaced code point turns one into the
other. The form of a word is its most frequent near word (ties: the smallest in code-point order) if that is at least
``RATIO`` times as frequent; the root is reached by following forms.

Method: a word has a vector of letter counts, in ``COLUMNS`` columns by code point. One edit changes the squared
distance of two vectors by at most two, so a matrix product of a block of words gives all candidates: the Gram matrix with
the squared lengths turns into squared distances, and pairs at two or less are verified letter by letter. Blocks are made so
that no near pair is lost and few others meet. Letters fall into ``GROUPS`` groups; a word's cell is its letters per group.
Taking one letter away from a word leads to the same cell as a near word of the same length does by its own letter, or to
the very cell of a near word shorter by one. So a word goes to its own cell (as the shorter one) and to each cell with one
letter less (as a longer one): at most ``GROUPS`` + 1 copies. Every near pair meets in one cell exactly, adjacent
lengths included. Words of a cell are dealt into blocks of at most about ``BLOCK`` words and ``BLOCK_LETTERS`` letters, and
each two blocks meet in one task, which holds these two only. Cells, blocks and pairs never reach the driver.

Null and empty texts have no words; a null id is written as nothing (``:<run>``). Repeated rows count again. Words of any
length are compared whole. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows, release, stored

MIN_LETTERS, MIN_COUNT, RATIO, SLIP = 6, 5, 5, 199
COLUMNS, GROUPS = 32, 8
#: Words, and letters, of a block; a task holds two blocks.
BLOCK, BLOCK_LETTERS = 2048, 1 << 20
#: Rows of one matrix product; rows of small meetings that share products.
ROWS, TOGETHER = 256, 4096
#: Different words of a map task counted together before they go to the shuffle.
HELD_WORDS = 200_000
_RUNS = re.compile("[A-Za-zÀ-ÿ]+").findall
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# Groups of about equal weight in western texts: letters in order of frequency, dealt back and forth.
_ORDER = "etaoinsrhldcumfpgwybvkxjqz"
_GROUP = np.arange(256) % GROUPS
for _k, _letter in enumerate(_ORDER):
    _GROUP[ord(_letter)] = _k % GROUPS if _k // GROUPS % 2 == 0 else GROUPS - 1 - _k % GROUPS


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """word and n of all words long and frequent enough."""
    def counted(rows: Iterator[dict]) -> Iterator[tuple]:
        held: Counter = Counter()
        for row in rows:
            start = zlib.crc32(b"%s:" % (b"" if row["_key"] is None else str(row["_key"]).encode()))
            for run, n in Counter(_RUNS(row["_text"] or "")).items():
                if len(run) < min_letters:
                    continue
                word = run.lower() if run.isascii() else run.translate(_LOWER)
                h = zlib.crc32(word.encode(), start)
                if h % slip == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
                    if len(word) < min_letters:
                        continue
                held[word] += n
            if len(held) >= HELD_WORDS:
                yield from held.items()
                held.clear()
        yield from held.items()

    found = map_rows(docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")), counted, "word string, n long", 20_000)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All letters of all words, and the word of each."""
    flat = np.frombuffer(b"".join(words), np.uint8)
    return flat, np.repeat(np.arange(len(words)), [len(w) for w in words])


def _cell_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, role, word, n): role g < GROUPS for a word less one letter of group g, GROUPS for the whole word."""
    for batch in batches:
        words, n = batch.column(0).to_pylist(), np.array(batch.column(1))
        coded = [w.encode("latin-1") for w in words]
        flat, of = _letters(coded)
        counts = np.bincount(of * GROUPS + _GROUP[flat], minlength=len(words) * GROUPS).reshape(-1, GROUPS).astype("<u4")
        cells, roles, which = [counts], [np.full(len(words), GROUPS)], [np.arange(len(words))]
        for g in range(GROUPS):
            has = np.flatnonzero(counts[:, g])
            less = counts[has]
            less[:, g] -= 1
            cells.append(less)
            roles.append(np.full(len(has), g))
            which.append(has)
        which = np.concatenate(which)
        # Letters per group, a byte each where all are small: equal cells, and only these, have equal keys.
        cells = np.concatenate(cells)
        small, wide = cells.astype(np.uint8), (cells > 255).any(axis=1).tolist()
        keys = [whole.tobytes() if big else byte.tobytes() for whole, byte, big in zip(cells, small, wide)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(np.concatenate(roles), pa.int32()), pa.array([words[k] for k in which], pa.string()),
             pa.array(n[which], pa.int64())], names=["cell", "role", "word", "n"])


def _one_edit(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Whether a[k] and b[k], equally long or a longer by one, are one edit apart."""
    out = np.zeros(len(a), bool)
    shapes = np.array([len(x) << 1 | (len(x) != len(y)) for x, y in zip(a, b)], np.int64)
    for shape in np.unique(shapes).tolist():
        width, shorter = shape >> 1, shape & 1
        rows = np.flatnonzero(shapes == shape)
        for at in range(0, len(rows), step := max(1, BLOCK_LETTERS * 4 // max(1, width))):
            some = rows[at:at + step]
            x = np.frombuffer(b"".join(a[k] for k in some), np.uint8).reshape(len(some), width)
            y = np.frombuffer(b"".join(b[k] for k in some), np.uint8).reshape(len(some), width - shorter)
            if not shorter:
                out[some] = (x != y).sum(axis=1) == 1
                continue
            # Equal up to a first difference, and from there on with one letter left out.
            head = np.logical_and.accumulate(x[:, :-1] == y, axis=1).sum(axis=1)
            tail = np.logical_and.accumulate((x[:, 1:] == y)[:, ::-1], axis=1).sum(axis=1)
            out[some] = head + tail >= width - 1
    return out


def _first_groups(words: list[bytes]) -> np.ndarray:
    """The lowest group that each word has letters of."""
    flat, of = _letters(words)
    out = np.full(len(words), GROUPS)
    np.minimum.at(out, of, _GROUP[flat])
    return out


def _near(words: list[bytes], roles: np.ndarray, meeting: np.ndarray, part: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of near pairs, each once, longer word first. ``meeting``: which rows are together, in ascending order;
    ``part``: 0 or 1 within a meeting of two blocks (``halves``), where only words of different blocks are compared."""
    flat, of = _letters(words)
    counts = np.bincount(of * COLUMNS + flat % COLUMNS, minlength=len(words) * COLUMNS).reshape(-1, COLUMNS).astype(np.float32)
    square, first = np.einsum("ij,ij->i", counts, counts), _first_groups(words)
    ends = np.searchsorted(meeting, meeting, side="right")
    left, right = [], []
    for at in range(0, len(words), ROWS):
        until = min(at + ROWS, len(words))
        end = int(ends[until - 1])
        # Squared distances. Counts are whole numbers, exact in single precision for words of up to about 2,000 letters;
        # longer ones may differ by rounding, so the bound grows with them.
        apart = square[at:until, None] + square[at:end] - 2 * (counts[at:until] @ counts[at:end].T)
        i, j = np.nonzero(apart <= 2 + 1e-6 * square[at:end].max())
        i, j = i + at, j + at
        # Words of one cell meet in as many cells as they have groups; they count where they lost a letter of the first.
        good = (i < j) & (meeting[i] == meeting[j]) & (~halves[i] | (part[i] != part[j])) & np.where(
            roles[i] == roles[j], (roles[i] < GROUPS) & (first[i] == roles[i]), True)
        left.append(i[good])
        right.append(j[good])
    left, right = np.concatenate(left), np.concatenate(right)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    turned = lengths[left] < lengths[right]
    left, right = np.where(turned, right, left), np.where(turned, left, right)
    good = _one_edit([words[k] for k in left.tolist()], [words[k] for k in right.tolist()])
    return left[good], right[good]


def _partial(rows: list[tuple], meeting: list[int], halves: list[bool]) -> Iterator[tuple]:
    """(word, n_near, near_n, near): partial results of some meetings, each whole."""
    texts, roles, counts, parts = zip(*rows)
    words, n = [t.encode("latin-1") for t in texts], counts
    left, right = _near(words, np.array(roles), np.array(meeting), np.array(parts), np.array(halves))
    near: dict[str, list] = {}
    for a, b in ((left, right), (right, left)):
        for k, other in zip(a.tolist(), b.tolist()):
            known, offer = near.get(texts[k]), (-n[other], texts[other])
            if known is None:
                near[texts[k]] = [1, offer]
            else:
                known[0] += 1
                known[1] = min(known[1], offer)
    for word, (many, (less, other)) in near.items():
        yield word, many, -less, other


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, near_n, near (the most frequent near word, ties to the smallest) of every word that has near words.
    ``words``: word (letters up to U+00FF) and n, each word once."""
    spark = words.sparkSession
    copies = words.select("word", "n").mapInArrow(_cell_copies, "cell binary, role int, word string, n long")
    # Blocks of crowded cells only; the others are one block, and need no second look.
    sizes = copies.groupBy("cell").agg(F.count("*").alias("size"), F.sum(F.length("word")).alias("letters")).select(
        "cell", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("letters") / BLOCK_LETTERS)).cast("int").alias("blocks"))
    crowded = stored(spark, sizes.where("blocks > 1"), "spelling-cells")
    # A word's block is the same in all its cells of one size, so it is found from the word alone.
    dealt = copies.join(crowded, "cell", "left").select(
        "cell", "role", "word", "n", F.coalesce("blocks", F.lit(1)).alias("blocks"),
        F.pmod(F.xxhash64("word"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"))
    # Block x meets block y >= x in the pair (x, y); there x is part 0 and y part 1.
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cell", "role", "word", "n", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        (F.col("block") > F.col("other")).cast("int").alias("part"))
    met = paired.repartition("cell", "x", "y").sortWithinPartitions("cell", "x", "y")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flat() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        held, meeting, halves, found = [], [], [], []
        for k, ((_, x, y), group) in enumerate(groupby(flat(), key=lambda r: (r[0], r[4], r[5]))):
            members = [(r[2], r[1], r[3], r[6]) for r in group]
            if len(members) == 1:
                continue
            held += members
            meeting += [k] * len(members)
            halves += [x != y] * len(members)
            if len(held) >= TOGETHER:
                found += _partial(held, meeting, halves)
                held, meeting, halves = [], [], []
            if len(found) >= 20_000:
                yield _result(found)
                found = []
        if held:
            found += _partial(held, meeting, halves)
        if found:
            yield _result(found)
        release()

    partial = met.mapInArrow(rows, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def _result(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
        names=["word", "n_near", "near_n", "near"])


def with_roots(forms: DataFrame) -> DataFrame:
    """word and root of every word with a form. Forms are followed in steps of doubling length until none moves: counts
    grow by ``RATIO`` at each form, so a handful of rounds do."""
    spark = forms.sparkSession
    known = stored(spark, forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(spark, known.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        known = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return known


def spelling_forms(docs: DataFrame, key: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    spark = docs.sparkSession
    words = stored(spark, word_counts(docs, key, text), "spelling-words")
    near = near_words(words)
    judged = words.join(near, "word", "left").withColumn("taken", F.col("near_n") >= ratio * F.col("n")).select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("taken"), F.col("near")).alias("form"),
        F.when(F.col("taken"), F.col("near_n")).alias("form_n"))
    judged = stored(spark, judged, "spelling-forms")
    roots = with_roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
