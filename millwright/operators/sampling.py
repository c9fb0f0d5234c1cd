"""Seeded row samples that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PREFIX = 4  # hex digits used to narrow the candidates: 65,536 groups


def hash_order(id_col: str, seed: int) -> Column:
    """Hash of (id, seed); a NULL id counts as an empty one."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: those with the smallest hash of (id, seed). Rows with NULL ids take part.

    One counting pass over a hash prefix finds how far the sample can reach, so only rows up to there are
    sorted and the top-n merge stays small on any number of partitions.
    """
    hashed = df.withColumn("_hash", hash_order(id_col, seed))
    prefix = F.substring("_hash", 1, _PREFIX)
    counts = hashed.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    taken, reach = 0, None
    for row in counts:  # at most 65,536 rows
        taken, reach = taken + row["n"], row["p"]
        if taken >= n:
            break
    if taken >= n:
        hashed = hashed.filter(prefix <= F.lit(reach)).orderBy("_hash", id_col).limit(n)
    return hashed.drop("_hash")
