"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """Every node of ``edges`` (columns a, b) but the smallest of its component, with that smallest node.

    Returns (node, root). Alternates two star contractions until the edge list no longer changes; each is a
    minimum per node, combined before the shuffle, joined back to the edges. A hub's edges meet only its one
    minimum, so adaptive execution can split a hub. Loops and null ends are ignored; an empty list gives no rows.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, before = materialize(pairs.distinct()), None
    while True:
        n, mark = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if (n, mark) == before or n == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = (n, mark)
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = materialize(small.unionByName(lowest.withColumnRenamed("m", "b")).distinct())
