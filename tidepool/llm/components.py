"""Connected components of a link table, by alternating large-star and small-star rounds.

The rounds are those of Kiveris et al., "Connected Components in MapReduce
and Beyond" (2014). Every step is a join or a group-by on node ids; links
never leave the executors. Each round is checkpointed, so a lost executor
costs one round, and the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.scratch import shared_dir


def _checkpoint(df: DataFrame) -> DataFrame:
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def _signature(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"),
                     F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: long).

    ``component`` is the smallest node id reachable. Loops and repeated links
    do no harm; nodes without a link to another node are absent.
    """
    edges = _checkpoint(links.where("a <> b")
                        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _signature(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = _checkpoint(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
