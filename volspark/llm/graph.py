"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoint import checkpointed

#: Large-star and small-star rounds come to rest in about log² of the longest chain.
MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node it reaches.

    Alternating large-star and small-star rounds: an edge set only ever shrinks towards stars, no
    node gathers its neighbours in a list, and a node of many edges is a partial minimum and a
    join that adaptive execution can split. One row per round reaches the driver.
    """
    rows = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    rows = checkpointed(rows.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(MOST_ROUNDS):
        both = rows.unionByName(rows.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select(
            "a", F.least("a", "_m").alias("m")
        )
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.distinct()
        root = small.groupBy("a").agg(F.min("b").alias("m"))
        linked = small.join(root, "a")
        rows = checkpointed(
            linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(root.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        state = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not come to rest")
    tops = rows.select(F.col("b").alias("node")).distinct()
    return rows.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        tops.select("node", F.col("node").alias("root"))
    )
