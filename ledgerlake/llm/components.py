"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round replaces links by links to smaller ids until each component is a star around its smallest id. Rounds join on
aggregated minima, so a node with very many links is combined before the shuffle and its links are split by adaptive
skew handling. Each round is written to the shared folder; the driver sees a count and a checksum only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored

MAX_ROUNDS = 60
#: Links of one file of a round: late rounds are small, and every file is a task of each join that follows.
FILE_LINKS = 500_000


def _to_smallest(links: DataFrame, keep_node: bool) -> DataFrame:
    """Join every (node, other) with the smallest id among the node and its others."""
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    moved = links.join(least, "node")
    moved = moved.where("other > node") if keep_node else moved
    pairs = moved.select(F.col("other").alias("node"), F.col("least").alias("other"))
    if not keep_node:
        pairs = pairs.unionByName(least.select("node", F.col("least").alias("other")))
    return pairs.where("node <> other").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node, from links (a, b) in any order, repeats and self links allowed;
    ``component`` is the smallest id reachable. Without links: no rows."""
    spark = links.sparkSession
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct()
    pairs, before = stored(spark, pairs, "links"), None
    for _ in range(MAX_ROUNDS):
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return pairs.select("node", F.col("other").alias("component")).unionByName(
                pairs.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct())
        before = state
        both = pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _to_smallest(both, keep_node=True)
        oriented = large.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
        # Rounds never add links, so the last count bounds this one.
        pairs = stored(spark, _to_smallest(oriented, keep_node=False).coalesce(max(1, -(-2 * state[0] // FILE_LINKS))), "links")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
