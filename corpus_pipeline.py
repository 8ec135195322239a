"""From a raw corpus to packed training sequences: quality, near duplicates, repeated passages, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and its result is written as Parquet and
read again for the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontamination, near_copies, packing, quality, substrings
from ledgerlake.llm.common import prepare, stored, table, unused
from ledgerlake.llm.queries import tokenizer_path


#: Words that a worker remembers the ids of: fewer than alone, beside what earlier stages left in memory.
WORDS_PER_WORKER = 250_000
#: Documents that hold a benchmark item of fewer than ``decontamination.MIN_CHARS`` characters go as well. An item of one
#: common word takes every document with that word along.
SHORT_ITEMS = True


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the threshold."""
    prepare(spark)
    model = quality.fit(*quality.labelled_sample(docs, table(spark, sf_dir, "labels")))
    score = unused(docs, "_score")
    return quality.score(docs, model, name=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (3 bits of SimHash, or 0.8 of the five-word shingles), also among rows
    without an id: the one with the smallest doc_id."""
    prepare(spark)
    return near_copies.without_copies(docs)


def strip_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go from the texts; documents without any other words go."""
    prepare(spark)
    return substrings.strip_repeats(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return decontamination.without_items(docs, table(spark, sf_dir, "benchmark"), short=SHORT_ITEMS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    prepare(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), words=WORDS_PER_WORKER)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", strip_repeated_passages),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: SQL cannot express the classifier, the edit distance or the tokenizer; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
