"""Connected components of stored edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import stored


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node of `edges` (a, b).

    Every round joins neighbours to the smallest node they know. The smallest neighbour is found by
    an aggregation that combines on the map side, so a node with many neighbours is no hot spot.
    Rounds are written to `folder`; they end when the edges no longer change.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    now, turn = stored(now, f"{folder}/0"), 0
    before = None
    while True:
        both = now.unionByName(now.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        large = both.join(least, "node").filter("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        large = stored(large.filter("node <> root").distinct(), f"{folder}/{turn}-large")
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        small = small.unionByName(least.select("node", F.col("least").alias("root"))).filter("node <> root")
        turn += 1
        now = stored(small.distinct(), f"{folder}/{turn}")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if state == before:
            return now
        before = state
