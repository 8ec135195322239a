"""Hard negatives of embeddings by Fagin's threshold algorithm.

Anchors are the rows whose id ``EVERY`` divides. An anchor's positives are its ``POSITIVES`` best other rows of the same
label; the negatives of a positive are the ``NEGATIVES`` best rows of other labels whose score lies in a window, from ``LOW``
to ``HIGH`` hundredths of the positive's score. A score is the inner product with the anchor, on components rounded down
to 1/256, so it is a whole number and exact; better scores come first, ties by smaller id.

Method: all rows are dealt evenly into blocks of at most about ``BLOCK`` rows, packed and stored once. In each block every
dimension has its rows sorted by component. For an anchor a row's score is at most the sum, over the dimensions, of the
anchor's component times the best component not yet read in that dimension: the largest one where the anchor's component is
positive, the smallest one where it is negative. So the lists are read from the ends that the anchors' signs ask for, in
steps of doubling depth; rows met for the first time are scored by random access to all their components; and an
anchor stops as soon as that sum, its threshold, falls strictly below the score of the last wanted row of each of its
windows, or below a window that cannot be filled. Anchors of a block share the rows that their lists meet. The stated
anchors meet all rows in blocks: each block is held by one task, which reads the anchors piece by piece, and gives at
most the wanted number of rows per anchor and window. The best of all blocks are then ranked by Spark. One pass finds the
positives, one the negatives.

Rows with a null label or vector, or with a null or non-finite component, take no part, nor do rows without an id, which
nothing could name. Vectors of different lengths are compared as if the shorter one ended in zeros; empty ones score 0. Rows
that share an anchor's id are that anchor, never its positives or negatives; a repeated anchor is mined again. Other repeated
rows each take a place. Scores beyond 64 bits count as the end of that range. Equal vectors tie by id. An empty
table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlake.llm.common import pack, release, stored

EVERY, POSITIVES, NEGATIVES, LOW, HIGH = 100, 5, 10, 30, 90
#: Rows of a block, anchors of a piece, anchors that read the lists together, and the least number of blocks.
BLOCK, PIECE, TOGETHER, LEAST_BLOCKS = 65_536, 1024, 128, 8
_LONG = np.iinfo(np.int64)
#: Anchor, window, row and score of what was found.
Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
_MARKS = "array<struct<i:int,nth:int,positive_id:bigint,score:bigint>>"
_PACKED = "packed int, n int, kind string, ids binary, labels binary, vectors binary"


def relabelled(vec_id: Column, label: Column) -> Column:
    """Ids that 7 divides get the next of ten labels."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, vector (whole numbers as double) of the rows that take part."""
    found = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                      F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = found.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)
    # Not floor(): it gives a long, which large components leave.
    return found.select("vec_id", relabelled(F.col("vec_id"), F.col("label")).alias("label"), F.transform(
        "vector", lambda x: x * 256).alias("vector"))


def packed(spark, rows: DataFrame, size: int, least: int, tag: str) -> DataFrame:
    """Rows in blocks of about ``size``, dealt evenly without a key: a row per block. ``packed`` counts from 0."""
    blocks = max(least, -(-rows.count() // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        ids, labels = (np.concatenate([b.column(k).to_numpy() for b in got]) for k in (0, 1))
        vectors = _matrix([b.column(2) for b in got])
        kind = "<i2" if not vectors.size or np.abs(vectors).max() < 32_000 else "<f8"
        yield pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([kind]),
            pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([labels.astype("<i8").tobytes()], pa.binary()),
            pa.array([vectors.astype(kind).tobytes()], pa.binary())], names=["packed", "n", "kind", "ids", "labels", "vectors"])
        release()

    return stored(spark, rows.repartition(blocks).mapInArrow(run, _PACKED), tag)


def _matrix(lists: list[pa.Array]) -> np.ndarray:
    """Components rounded down, with zeros behind the end of shorter vectors."""
    lengths = np.concatenate([np.diff(np.asarray(x.offsets)) for x in lists])
    flat = np.concatenate([np.asarray(x.flatten()) for x in lists])
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    # Finite components stay finite: 256 times the largest one is cut back.
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.nan_to_num(np.floor(flat))
    return out


class Packed:
    """A packed row, opened."""

    def __init__(self, row: dict):
        self.ids, self.labels = (np.frombuffer(row[k], "<i8") for k in ("ids", "labels"))
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(row["n"], -1).astype(np.float64)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point where all sums are exact there, else in whole numbers of any size."""
    wide = min(anchors.shape[1], rows.shape[1])
    anchors, rows = anchors[:, :wide], rows[:, :wide]
    bound = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * wide
    if bound < 2.0**24:
        return anchors.astype(np.float32) @ rows.astype(np.float32).T
    if bound < 2.0**53:
        return anchors @ rows.T
    whole = np.array([[int(v) for v in r] for r in anchors.tolist()], object) @ np.array([[int(v) for v in r] for r in rows.tolist()], object).T
    return np.clip(whole, _LONG.min, _LONG.max).astype(np.int64)


class SortedLists:
    """Rows sorted by each component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self._order = np.argsort(vectors.T, axis=1, kind="stable").astype(np.int32)
        self._values = np.take_along_axis(vectors.T, self._order, axis=1)

    def search(self, anchors: np.ndarray, ids: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int,
               apart: np.ndarray | None = None) -> Found:
        """The ``k`` best rows of each anchor in each of its windows, best first, ties by id. ``lows`` and ``highs``: whole
        numbers, a row per anchor and a column per window; a window whose low exceeds its high has no rows. Rows with the
        anchor's id, or with its label in ``apart``, stay out."""
        n, wide = len(self.ids), min(anchors.shape[1], self.vectors.shape[1])
        order, values, anchors = self._order[:wide], self._values[:wide], anchors[:, :wide]
        found: Found = (np.zeros(0, np.int64),) * 4
        open_ = lows <= highs
        last = np.where(open_, lows, _LONG.max)  # what a further row has to reach in each window
        seen, depth, step = np.zeros(n, bool), 0, 1
        active = np.flatnonzero(open_.any(axis=1)) if n else found[0]
        while len(active):
            some, until = anchors[active], min(n, depth + step)
            up, down = (some > 0).any(axis=0), (some < 0).any(axis=0)
            if until < n and (up.any() or down.any()):
                met = np.unique(np.concatenate([order[up, n - until:n - depth].ravel(), order[down, depth:until].ravel()]))
                new = met[~seen[met]]
            else:  # the end of all lists, or no component that could tell rows apart
                until, new = n, np.flatnonzero(~seen)
            seen[new] = True
            if len(new):
                found = self._with(found, new, some, active, ids, highs, open_, last, k, apart)
            if until == n:
                break
            threshold = np.where(some > 0, some * values[:, n - until], some * values[:, until - 1]).sum(axis=1)
            threshold += np.abs(threshold) * 1e-9  # rounding beyond 2^53 must not stop an anchor early
            active = active[(open_[active] & (threshold[:, None] >= last[active])).any(axis=1)]
            depth, step = until, step * 2
        return found

    def _with(self, found: Found, new: np.ndarray, some: np.ndarray, active: np.ndarray, ids: np.ndarray, highs: np.ndarray,
              open_: np.ndarray, last: np.ndarray, k: int, apart: np.ndarray | None) -> Found:
        """What was found, with the rows ``new`` scored; ``last`` rises where a window is full."""
        score = scores(some, self.vectors[new])
        most = np.where(open_[active], highs[active], _LONG.min).max(axis=1)
        i, j = np.nonzero((score >= last[active].min(axis=1)[:, None]) & (score <= most[:, None]))
        who, row, what = active[i], new[j], score[i, j].astype(np.int64)
        keep = self.ids[row] != ids[who]
        if apart is not None:
            keep &= self.labels[row] != apart[who]
        who, row, what = who[keep], row[keep], what[keep]
        parts = [found]
        for w in range(last.shape[1]):
            inside = open_[who, w] & (what >= last[who, w]) & (what <= highs[who, w])
            parts.append((who[inside], np.full(int(inside.sum()), w), row[inside], what[inside]))
        who, window, row, what = (np.concatenate(x) for x in zip(*parts))
        # ~ turns the order of whole numbers round without overflow.
        order = np.lexsort((row, self.ids[row], ~what, window, who))
        who, window, row, what = who[order], window[order], row[order], what[order]
        group = who * last.shape[1] + window
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        kth = rank == k - 1
        last[who[kth], window[kth]] = what[kth]
        keep = rank < k
        return who[keep], window[keep], row[keep], what[keep]


def _meet(blocks: DataFrame, pieces: DataFrame, schema: str, opened: Callable[[dict], Callable[[dict], Iterator[tuple]]]) -> DataFrame:
    """Every block with every piece of anchors: ``opened(block)`` gives what answers a piece. A task has one block and one
    piece at a time."""
    count = (blocks.agg(F.max("packed")).head()[0] or 0) + 1
    columns = ["packed", "piece", "n", "kind", "ids", "labels", "vectors", "marks"]
    held = blocks.withColumns({"piece": F.lit(-1), "marks": F.lit(None).cast(_MARKS)}).select(columns)
    sent = pieces.withColumnRenamed("packed", "piece").withColumn("packed", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).select(columns)
    met = held.unionByName(sent).repartition(count, "packed").sortWithinPartitions("packed", "piece")
    arrow = to_arrow_schema(blocks.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = answer = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["piece"] < 0:
                    number, answer = row["packed"], opened(row)
                elif row["packed"] == number:
                    rows = list(answer(row))
                    if rows:
                        yield pack(rows, arrow)
        release()

    return met.mapInArrow(run, schema)


def _positives(block: dict, k: int) -> Callable[[dict], Iterator[tuple]]:
    rows, lists = Packed(block), {}

    def answer(piece: dict) -> Iterator[tuple]:
        anchors = Packed(piece)
        for label in np.unique(anchors.labels).tolist():
            if label not in lists:
                same = rows.labels == label
                lists[label] = SortedLists(rows.ids[same], rows.labels[same], rows.vectors[same])
            mine = np.flatnonzero(anchors.labels == label)
            for at in range(0, len(mine), TOGETHER):
                some = mine[at:at + TOGETHER]
                low, high = np.full((len(some), 1), _LONG.min), np.full((len(some), 1), _LONG.max)
                who, _, row, score = lists[label].search(anchors.vectors[some], anchors.ids[some], low, high, k)
                for i, r, s in zip(some[who].tolist(), lists[label].ids[row].tolist(), score.tolist()):
                    yield piece["piece"], i, int(anchors.ids[i]), r, s

    return answer


def _negatives(block: dict, k: int, low: int, high: int) -> Callable[[dict], Iterator[tuple]]:
    rows = Packed(block)
    lists = SortedLists(rows.ids, rows.labels, rows.vectors)

    def answer(piece: dict) -> Iterator[tuple]:
        anchors = Packed(piece)
        marks = {(m["i"], m["nth"]): m for m in piece["marks"]}
        windows = max((nth for _, nth in marks), default=0)
        lows, highs = np.ones((len(anchors.ids), windows), np.int64), np.zeros((len(anchors.ids), windows), np.int64)
        for (i, nth), m in marks.items():  # the whole numbers between low and high hundredths
            lows[i, nth - 1], highs[i, nth - 1] = -(-low * m["score"] // 100), high * m["score"] // 100
        for at in range(0, len(anchors.ids) if windows else 0, TOGETHER):
            some = slice(at, at + TOGETHER)
            who, window, row, score = lists.search(anchors.vectors[some], anchors.ids[some], lows[some], highs[some], k, anchors.labels[some])
            for i, w, r, s in zip((who + at).tolist(), (window + 1).tolist(), lists.ids[row].tolist(), score.tolist()):
                m = marks[i, w]
                yield piece["piece"], i, w, int(anchors.ids[i]), m["positive_id"], m["score"], r, s

    return answer


def _best(rows: DataFrame, group: list[str], score: str, tie: str, name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc(score), tie)
    return rows.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def mine(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = EVERY,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = df.sparkSession
    rows = usable(df, vec_id, vector, label)
    blocks = packed(spark, rows, BLOCK, LEAST_BLOCKS, "negatives-blocks")
    pieces = packed(spark, rows.where(F.col("vec_id") % every == 0), PIECE, 1, "negatives-anchors").withColumn("marks", F.lit(None).cast(_MARKS))
    near = _meet(blocks, pieces, "piece int, i int, anchor_id long, positive_id long, score long", lambda block: _positives(block, positives))
    near = _best(near, ["piece", "i"], "score", "positive_id", "nth", positives)
    marks = near.groupBy("piece").agg(F.collect_list(F.struct("i", "nth", "positive_id", "score")).cast(_MARKS).alias("marks"))
    marked = stored(spark, pieces.drop("marks").join(marks.withColumnRenamed("piece", "packed"), "packed"), "negatives-windows")
    far = _meet(blocks, marked, "piece int, i int, nth int, anchor_id long, positive_id long, positive_score long, negative_id long, "
                "negative_score long", lambda block: _negatives(block, negatives, low, high))
    return _best(far, ["piece", "i", "nth"], "negative_score", "negative_id", "rank", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
