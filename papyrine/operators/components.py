"""Groups of rows that links connect, directly or through others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.sources.tables import materialize


def connected(links: DataFrame) -> DataFrame:
    """For links (a, b): `node` and `root`, the smallest node it is connected to, for every node of a link.

    Labels spread along links and then jump to the label of their label, so the number of rounds grows with the logarithm of
    the longest path. Each round is written to the shared folder. A node with very many links is no single task's: minima are
    taken of parts first, and adaptive execution splits the join where a node's rows are many.
    """
    one_way = links.filter("a <> b").select("a", "b")
    both = materialize(one_way.union(one_way.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        seen = both.join(labels.toDF("b", "_seen"), "b").groupBy("a").agg(F.min("_seen").alias("_seen"))
        spread = labels.join(seen, labels["node"] == seen["a"]).select("node", F.col("root").alias("_old"), F.least("root", "_seen").alias("root"))
        spread = materialize(spread, "spread")
        jumped = spread.join(spread.select(F.col("node").alias("root"), F.col("root").alias("_next")), "root")
        moved = materialize(jumped.select("node", F.least("root", "_next").alias("root"), (F.least("root", "_next") < F.col("_old")).alias("_moved")), "labels")
        labels = moved.select("node", "root")
        if moved.filter("_moved").isEmpty():
            return labels
