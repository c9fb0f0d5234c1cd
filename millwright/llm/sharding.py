"""Balanced label propagation: linked documents move towards their neighbours' shards under quotas.

All steps are DataFrame operations. Documents are linked through keys, never as pairs: a key's vote is one row with
a count per shard, joined to the documents that hold the key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwright.operators.ordering import row_index
from millwright.session import materialize

BINS = 64
CLASSES = 16
#: A group larger than a shard is split into units of about this share of one, which leaves room for uneven hashes.
SPLIT_SHARE = 0.75


def _case(values: list[int], on: Column) -> Column:
    """Look up a number by shard; there are as many as shards."""
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), on + 1)


def _counts(df: DataFrame, column: str, shards: int) -> list[int]:
    found = dict(df.groupBy(column).agg(F.count(F.lit(1))).collect())
    return [found.get(s, 0) for s in range(shards)]


def _units(links: DataFrame, quota: int) -> DataFrame:
    """(row, unit) for keys with two rows or more; only a key too large for a shard is split by hash into units."""
    sizes = links.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.when(F.col("n") <= max(2, quota), F.lit(1)).otherwise(F.ceil(F.col("n") / max(2.0, SPLIT_SHARE * quota)))
    return links.join(sizes, "key").select("row", F.xxhash64("key", F.pmod(F.xxhash64("row"), parts)).alias("unit"))


def propagate(links: DataFrame, rows: int, shards: int, rounds: int = 8) -> DataFrame:
    """(row, unit, shard, settled) of all linked rows. ``links`` has (row, key); one row may hold several keys.

    Each round a row wants the shard with most of its neighbours among those with room for all of them beside the
    settled rows; ties are broken by a hash that its neighbours share. A row is settled once all its neighbours are in
    its shard. Arrivals in a shard are admitted by bins, larger groups first and whole bins only, as long as they fit
    its quota beside the rows that stay. Stops early when all rows are settled or none can move.
    """
    quota = rows // shards
    units = materialize(_units(links, quota))
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    labels = materialize(units.groupBy("row").agg(F.min("unit").alias("unit")).select("row", "unit", start, F.lit(False).alias("settled")))
    settled = [0] * shards
    for number in range(rounds):
        placed = units.join(labels.select("row", "shard"), "row")
        votes = placed.groupBy("unit").agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("shard") == s).alias(f"v{s}") for s in range(shards)])
        # Far below one, so it only orders equal counts, and alike for all rows of the unit.
        tie = lambda s: F.pmod(F.xxhash64("unit", F.lit(s)), F.lit(1 << 20)) / (1 << 32)
        votes = votes.select("unit", "all", *[(F.col(f"v{s}") + tie(s)).alias(f"v{s}") for s in range(shards)])
        wishes = placed.join(votes, "unit").groupBy("row").agg(F.sum("all").alias("all"), *[F.sum(f"v{s}").alias(f"v{s}") for s in range(shards)])
        near = wishes.join(labels, "row")
        own = F.element_at(F.array(*[f"v{s}" for s in range(shards)]), F.col("shard") + 1)
        near = near.withColumn("whole", F.floor(own) >= F.col("all"))
        every = F.array(*[F.when(F.col("all") <= quota - settled[s], F.col(f"v{s}")).otherwise(-1.0) for s in range(shards)])
        best = F.when(F.array_max(every) >= 0, (F.array_position(every, F.array_max(every)) - 1).cast("int"))
        want = F.when(F.col("whole"), F.col("shard")).otherwise(best)
        size = F.least(F.lit(CLASSES - 1), F.floor(F.col("all") * CLASSES / (quota + 1))).cast("int")
        bins = (CLASSES - 1 - size) * BINS + F.pmod(F.xxhash64("unit", F.lit(number)), F.lit(BINS)).cast("int")
        wanted = materialize(near.select("row", "unit", "shard", "whole", want.alias("want"), bins.alias("bin")))
        stays = _counts(wanted.where("whole"), "shard", shards)
        arrivals = wanted.where("not whole and want is not null").groupBy("want", "bin").agg(F.count(F.lit(1)).alias("n"))
        # At most shards x CLASSES x BINS rows.
        running = F.sum("n").over(Window.partitionBy("want").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        admitted = arrivals.withColumn("upto", running).where(F.col("upto") <= quota - _case(stays, F.col("want")))
        admitted = admitted.select("want", "bin", F.lit(True).alias("go"))
        moved = wanted.join(F.broadcast(admitted), ["want", "bin"], "left")
        goes = F.coalesce("go", F.lit(False)) & ~F.col("whole")
        shard = F.when(goes, F.col("want")).otherwise(F.col("shard")).alias("shard")
        labels = materialize(moved.select("row", "unit", shard, (goes | F.col("whole")).alias("settled")))
        settled = _counts(labels.where("settled"), "shard", shards)
        if arrivals.limit(1).count() == 0 or labels.where("not settled").limit(1).count() == 0:
            break
    return labels


def balanced_shards(docs: DataFrame, shards: int = 24, rounds: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot per row of ``docs``; shard counts differ by one row at most.

    Rows with equal texts are linked. A null text counts as an empty one, so nulls and empty texts form one group.
    Groups larger than a shard are split by hash first. After the propagation, rows are numbered per shard, settled
    ones first and those without links last, by a distributed row index; what exceeds a shard's exact quota fills the others' gaps,
    which is arithmetic on the row number and the counts per shard. Repeated rows and null doc_ids are rows like any
    other; an empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    data = F.coalesce("text", F.lit("")).cast("binary")
    base = materialize(docs.select(
        "doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.xxhash64(F.xxhash64(data), F.crc32(data), F.octet_length(data)).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    ))
    n = base.count()
    labels = propagate(base.select("row", "key"), n, shards, rounds)
    own = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    placed = base.drop("key").join(labels, "row", "left").withColumn("at", F.coalesce("shard", own)).drop("shard")
    order = [F.col("at"), F.col("unit").isNull(), F.coalesce("settled", F.lit(False)).desc(), F.col("unit"), F.col("row")]
    ranked = row_index(placed, order, "index")
    have = _counts(ranked, "at", shards)
    target = [n // shards + (s < n % shards) for s in range(shards)]
    sums = lambda xs: [sum(xs[:s]) for s in range(shards)]
    over, gaps = [max(0, h - t) for h, t in zip(have, target)], [max(0, t - h) for h, t in zip(have, target)]
    place = F.col("index") - _case(sums(have), F.col("at"))
    spare = _case(sums(over), F.col("at")) + place - _case(target, F.col("at"))
    to = reduce(
        lambda rest, s: F.when((spare >= sums(gaps)[s]) & (spare < sums(gaps)[s] + gaps[s]), F.lit(s)).otherwise(rest),
        [s for s in range(shards) if gaps[s]], F.lit(None).cast("int"),
    )
    fits = place < _case(target, F.col("at"))
    out = ranked.withColumn("shard", F.when(fits, F.col("at")).otherwise(to))
    slot = F.when(fits, place).otherwise(_case(have, F.col("shard")) + spare - _case(sums(gaps), F.col("shard")))
    return out.select("doc_id", "size", "text_crc32", "shard", slot.cast("long").alias("slot"))
