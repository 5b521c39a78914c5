"""Connected components of a graph too large for one machine, by alternating star contraction.

Each round hangs neighbours below the smallest vertex in sight; rounds are written to the shared folder, and their number
grows with the logarithm of the graph's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.scratch import write_and_read


def components(edges: DataFrame) -> DataFrame:
    """For edges (a, b) between numbers: `node` and `root`, the smallest node it is connected to, for all but the roots."""
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = write_and_read(edges.filter("a <> b").select(larger, smaller).distinct(), "edges")
    while True:
        stars = write_and_read(_small_star(_large_star(stars)), "stars")
        inner = stars.select(F.col("b").alias("a")).distinct()
        if stars.join(inner, "a", "left_semi").isEmpty():
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.union(stars.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("_least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("a").agg(F.min("b").alias("_least"))
    moved = stars.join(least, "a").filter("b <> _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return moved.union(least.toDF("a", "b")).distinct()
