"""Connected components by alternating stars; every round is aggregations and joins, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, tables: Scratch) -> DataFrame:
    """(node, label) for every node of `edges` (a, b); label is the smallest node that can be reached.

    Large stars hang every larger neighbour of a node on its smallest one, small stars do so with the smaller neighbours;
    after a number of rounds that grows with the logarithm of the longest path, only stars are left. A node with very many
    neighbours is a skewed join key, whose partition adaptive execution splits. No edges give no rows.
    """
    now = tables.write(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges0"
    )
    mark, step = None, 0
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        hung = large.join(least, F.col("u") == F.col("k")).select("u", "v", "m")
        small = hung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(hung.select("u", F.col("m").alias("v"))).distinct()
        step += 1
        now = tables.write(small, f"edges{step}")
        tables.drop(f"edges{step - 1}")
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(now.select("v", "v").distinct())
