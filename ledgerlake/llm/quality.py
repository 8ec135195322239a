"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

Terms describe how a text is written, not what it says: shapes of words (runs of upper, lower, digit and mark
characters), character pairs around marks, words said again at once, and binned shares of the whole text. They are hashed
into a fixed number of columns, weighted by tf-idf and reduced by a truncated singular value decomposition. Both are
fitted on a bounded sample of labelled texts: the ``max_labelled`` with the smallest hash of their id and text, half of
them of each label. The labelled vectors (``max_labelled`` x ``DIMENSIONS`` floats) go to every task;
each block of documents is multiplied with all of them, and the ``NEIGHBOURS`` most similar vote with the label and the
similarity. Classes are balanced in the vote: a label's votes are divided by the label's share in the sample.

Equal texts get equal scores whatever their other columns. Null and empty texts have the zero vector and get the share of
label 1 among empty labelled texts, or 0.5 if there are none or no votes. With no labelled rows every score is 0.5.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows, release

COLUMNS, DIMENSIONS, NEIGHBOURS, MAX_LABELLED, THRESHOLD = 4096, 48, 25, 4000, 0.3
#: Documents of one product with the labelled vectors.
BLOCK = 1024
_RUN = re.compile(r"(\S)\1*")
_CLASSES = str.maketrans({c: "x" for c in "abcdefghijklmnopqrstuvwxyz"} | {c: "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: "9" for c in "0123456789"})


def _shape(word: str) -> str:
    out = word.translate(_CLASSES)
    if not out.isascii():
        out = "".join(c if c.isascii() else "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isnumeric() else "?" for c in out)
    return "".join(a for a, b in zip(out, out[1:] + "\0") if a != b)


def _bin(name: str, share: float) -> str:
    return f"{name}{min(20, int(20 * share))}"


def terms(text: str | None, known: dict[str, str]) -> Counter:
    """Term counts of a whole text; ``known`` keeps the shapes of words between calls."""
    words = (text or "").split()
    if not words:
        return Counter()
    shapes = []
    for word, n in Counter(words).items():
        shape = known.get(word)
        if shape is None:
            if len(known) > 100_000:
                known.clear()
            shape = known[word] = _shape(word)[:24]
        shapes.append((shape, n))
    out: Counter = Counter()
    for shape, n in shapes:
        out["s:" + shape] += n
    total = len(words)
    again = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in (text or "").split("\n") if x.strip()]
    letters = sum(n * len(w) for w, n in Counter(words).items())
    plain = sum(n for shape, n in shapes if shape.rstrip(".,") in ("x", "Xx", "X"))
    upper = sum(n for shape, n in shapes if shape.startswith("X") and "x" not in shape)
    weight = max(1, total // 20)
    for term in (_bin("again", again / total), _bin("distinct", len(shapes) / total), _bin("plain", plain / total), _bin("upper", upper / total),
                 _bin("lines", len(set(lines)) / max(1, len(lines))), _bin("length", min(1.0, letters / total / 20)), f"size{total.bit_length()}"):
        out["d:" + term] += weight
    return out


def vectors(texts: list[str | None], known: dict[str, str]) -> np.ndarray:
    """Hashed counts, damped by a logarithm."""
    out = np.zeros((len(texts), COLUMNS), np.float32)
    for k, text in enumerate(texts):
        for term, n in terms(text, known).items():
            out[k, xxhash.xxh3_64_intdigest(term) % COLUMNS] += n
    return np.log1p(out)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


@dataclass(frozen=True)
class Model:
    """``idf`` and ``axes`` make vectors, ``examples`` are the labelled ones; ``empty``: the score of texts without words."""

    idf: np.ndarray
    axes: np.ndarray
    examples: np.ndarray
    labels: np.ndarray
    empty: float

    def embed(self, texts: list[str | None], known: dict[str, str]) -> np.ndarray:
        return _unit(_unit(vectors(texts, known) * self.idf) @ self.axes)

    def score(self, texts: list[str | None], known: dict[str, str]) -> np.ndarray:
        out = np.full(len(texts), self.empty)
        if not len(self.labels):
            return out
        for at in range(0, len(texts), BLOCK):
            some = self.embed(texts[at:at + BLOCK], known)
            similar = some @ self.examples.T
            k = min(NEIGHBOURS, len(self.labels))
            nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(similar, nearest, axis=1), 0.0).astype(np.float64) ** 4
            share = np.array([(self.labels == 0).mean(), (self.labels == 1).mean()])
            weight /= np.maximum(share[self.labels[nearest]], 1e-9)
            total, good = weight.sum(axis=1), (weight * (self.labels[nearest] == 1)).sum(axis=1)
            seen = np.any(some != 0, axis=1) & (total > 0)
            out[at:at + BLOCK][seen] = good[seen] / total[seen]
        return np.clip(out, 0.0, 1.0)


def fit(counts: np.ndarray, labels: list[int]) -> Model:
    """From the hashed counts of the labelled texts, which are used up; rows of zeros are texts without words."""
    known, blank = np.array(labels, np.int64), ~counts.any(axis=1)
    empty = float(known[blank].mean()) if blank.any() else 0.5
    if blank.any():
        counts, known = counts[~blank], known[~blank]
    if not len(known):
        return Model(np.zeros(COLUMNS, np.float32), np.zeros((COLUMNS, 1), np.float32), np.zeros((0, 1), np.float32), known, empty)
    idf = np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))).astype(np.float32) + 1
    # In place and in single precision: the driver holds one matrix of the sample, no copies.
    weighted = counts
    weighted *= idf
    for at in range(0, len(weighted), BLOCK):
        weighted[at:at + BLOCK] = _unit(weighted[at:at + BLOCK])
    # The leading right singular vectors, by subspace iteration from a fixed start.
    axes = np.random.default_rng(7).standard_normal((COLUMNS, min(DIMENSIONS, COLUMNS))).astype(np.float32)
    for _ in range(8):
        axes = np.linalg.qr((weighted.T @ (weighted @ axes)).astype(np.float64))[0].astype(np.float32)
    return Model(idf, axes, _unit(weighted @ axes), known, empty)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, list[int]]:
    """Hashed counts and labels to learn from: rows whose crc32(doc_id as text) mod 5 is not 0, at most ``max_labelled``. The
    choice is made on ids; the driver gathers the nonzero counts of the chosen texts, not the texts."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    ranked = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled // 2) for q in (0, 1)]
    chosen = ranked[0].unionByName(ranked[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").groupBy(
        "doc_id", "quality").agg(F.min("text").alias("text"))

    def counted(rows: Iterator[dict]) -> Iterator[tuple]:
        for r in rows:
            row = vectors([r["text"]], {})[0]
            at = np.flatnonzero(row)
            yield r["doc_id"], r["quality"], at.astype("<u2").tobytes(), row[at].astype("<f4").tobytes()

    found = map_rows(texts, counted, "doc_id long, quality int, at binary, n binary").orderBy("doc_id").collect()
    counts, labels = np.zeros((len(found), COLUMNS), np.float32), [r["quality"] for r in found]
    for k, r in enumerate(found):
        counts[k, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<f4")
    found.clear()
    release()
    return counts, labels


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, str] = {}
        for batch in batches:
            parts = [shared.value.score(batch.slice(at, 128).to_pylist(), known) for at in range(0, len(batch), 128)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
        known.clear()
        release()

    return docs.withColumn(name, scored(F.col(text)))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = fit(*labelled_sample(docs, labels))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
