"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import written


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node of an edge list; the root is the smallest node reachable.

    Edges may repeat, point either way or be loops.  Every round hangs the
    neighbours of a node below the smallest of them, and is written to the
    shared folder; the number of rounds grows with the logarithm of the size.
    """
    pairs = edges.select(
        F.greatest(left, right).alias("v"), F.least(left, right).alias("m")
    ).where("v <> m")
    pairs = written(pairs.distinct(), "edges")
    state = None
    while True:
        both = pairs.select(F.col("v").alias("u"), F.col("m").alias("w")).union(
            pairs.select("m", "v")
        )
        least = both.groupBy("u").agg(F.min("w").alias("low"))
        large = (
            both.where("w > u")
            .join(least, "u")
            .select(F.col("w").alias("v"), F.least("u", "low").alias("m"))
            .distinct()
        )
        lower = large.groupBy("v").agg(F.min("m").alias("low"))
        small = (
            large.join(lower, "v")
            .select(F.when(F.col("m") == F.col("low"), F.col("v")).otherwise(F.col("m")).alias("v"), F.col("low").alias("m"))
            .where("v <> m")
            .distinct()
        )
        pairs = written(small, "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "m") % (1 << 40))).first()
        if now == state:
            break
        state = now
    roots = pairs.select("m").distinct()
    return pairs.select(F.col("v").alias("node"), F.col("m").alias("root")).union(
        roots.select("m", "m")
    )
