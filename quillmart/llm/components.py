"""Connected components of a large graph, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import dealt_anew, stage

MOST_STEPS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Join the larger neighbours of each node to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")).select(dealt_anew("a"), "m")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Join each node and its smaller neighbours (a > b in ``edges``) to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(dealt_anew("a"), "m")
    joined = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for every node of ``edges`` (a, b: long).

    Each step is two joins on aggregated minima, written to the shared folder;
    no neighbourhood is ever gathered in one place.
    """
    now = stage(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "edges")
    mark = None
    for _ in range(MOST_STEPS):
        now = stage(spark, _small_star(_large_star(now)), "stars")
        sums = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).head()
        if sums == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = sums
    raise RuntimeError(f"components: no end after {MOST_STEPS} steps")
