"""Connected components over an edge table, in the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import cut

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst): root is the smallest node reachable.

    Alternating large-star and small-star rounds: every node's larger (then smaller) neighbours are
    linked to its smallest one until nothing changes. The neighbour minimum is an aggregate joined
    back, so a hub's neighbours are never gathered in one row. Each round is checkpointed.
    """
    e = cut(edges.select("src", "dst").where("src != dst").distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        # Large star: neighbours above the node go to its minimum.
        e = both.join(low, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src != dst").distinct()
        # Small star: edges point downwards; the node and its smaller neighbours go to the minimum.
        low = e.groupBy("src").agg(F.min("dst").alias("m"))
        small = e.join(low, "src")
        e = cut(small.select(F.col("dst").alias("src"), F.col("m").alias("dst")).unionByName(
            small.select("src", F.col("m").alias("dst"))).where("src != dst").distinct())
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            return e.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
                e.select(F.col("dst").alias("node"), F.col("dst").alias("root"))).distinct()
        before = now
    raise RuntimeError("components did not settle")
