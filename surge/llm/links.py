"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surge.llm.staging import release, staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest id reachable from each node of ``edges`` (pairs of long ids).

    Each round hangs every node under the smallest id in its neighbourhood, so the
    number of rounds grows with the logarithm of the longest path.  Repeated pairs
    and pairs of a node with itself are allowed; an empty table gives an empty result.
    """
    pair = F.col(a) != F.col(b)
    now = staged(edges.where(pair).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while True:
        # A forest of stars has no node that is both above and below another one, and one parent for each.
        parents = now.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        loose = parents.where("n > 1").select(F.col("u").alias("x")).unionAll(
            now.join(parents.select(F.col("u").alias("v")), "v", "left_semi").select(F.col("v").alias("x")))
        if loose.isEmpty():
            break
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        before, now = now, staged(large, "links-large")
        release(before)
        large = now
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        now = staged(small, "links-small")
        release(large)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
