"""Connected components of a link table, by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm._stage import store


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` to ``(node, root)``: for every linked node but the
    component's smallest, that smallest node. Nodes are longs, nulls are ignored.

    Each round hangs neighbours on the smallest node nearby (a grouped
    minimum, combined per task before its shuffle, joined back), first larger
    ones, then smaller ones, and stores the links; rounds grow with the
    logarithm of the longest path. It ends when a round changes nothing.
    """
    edges = store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .filter("u > v").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        facts = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if facts == seen or facts[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = facts
        edges = store(_small_star(_large_star(edges)), "links")
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
