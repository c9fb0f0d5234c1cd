"""SimHash near-duplicates through covering locality-sensitive hashing.

Every fingerprint bit i has a label m(i), a non-zero vector of radius + 1 bits. Table v (v non-zero) keeps the
bits whose label has an odd overlap with v. Two fingerprints that differ in at most ``radius`` bits agree in the
table of some v orthogonal to the labels of those bits, and such a v exists: ``radius`` equations leave at least one
dimension free. So no pair within the radius is missed.

Inside a bucket no pairs are made. A member emits the points within radius / 2 of it (flipping only bits that the
table leaves free); two members share such a point exactly if they are within the radius. A point links all its
members to its smallest one, so a bucket costs as much per member however many it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.components import components
from millwright.llm.words import chunks, fields, spans_of, whole_row
from millwright.session import materialize

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, size: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included; 0 without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < size:
        words, size = [b" ".join(words)], 1
    joined, starts, ends = spans_of(words)
    n = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo, hi in chunks(n, SHINGLES_AT_ONCE):
        first, last = starts[lo:hi].tolist(), ends[lo + size - 1 : hi + size - 1].tolist()
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last)), "<u8", hi - lo)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def simhash(text: Column, size: int = 3) -> Column:
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, size) for t in batch], dtype="int64")

    return fingerprints(text)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def covering_masks(radius: int) -> list[int]:
    """2^(radius + 1) - 1 masks; any ``radius`` bits lie outside at least one of them."""
    top = (1 << (radius + 1)) - 1
    labels = [i % top + 1 for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(labels) if (m & v).bit_count() % 2) for v in range(1, top + 1)]


def _nearby(mask: int, radius: int) -> list[int]:
    """Differences to all points within radius / 2, over the bits that the mask leaves free."""
    free = [1 << i for i in range(BITS) if not mask >> i & 1]
    return [_signed(sum(c)) for k in range(radius // 2 + 1) for c in combinations(free, k)]


def linked_fingerprints(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all pairs within the radius.

    Each edge is itself within the radius. ``radius`` is even.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = covering_masks(radius)
    table = F.explode(F.array(*[
        F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket"))
        for v, m in enumerate(masks)
    ])).alias("t")
    members = materialize(prints.select("fp", table).select("fp", "t.*"))
    shared = members.groupBy("v", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    crowded = members.join(shared, ["v", "bucket"], "left_semi")
    steps = [F.array(*[F.lit(d) for d in _nearby(m, radius)]) for m in masks]
    around = F.transform(F.element_at(F.array(*steps), F.col("v") + 1), lambda d: F.col("fp").bitwiseXOR(d))
    points = crowded.select("fp", F.explode(around).alias("point"))
    spread = points.groupBy("point").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi")
    return points.join(spread.select("point", "lo"), "point").select(F.col("fp").alias("a"), F.col("lo").alias("b"))


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, text_hash, fp (signed SimHash) and component_id (smallest doc_id reachable) per row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. A null, empty or blank text has fingerprint 0 and is
    linked like any other. Repeated rows are all returned. A null doc_id never names a component unless all its
    members are null. Fingerprints are stored once; copies fold into one row per fingerprint before any bucket.
    """
    base = materialize(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), simhash(F.col("text"), size).alias("fp")))
    prints = materialize(base.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(linked_fingerprints(prints.select("fp"), radius))
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    linked = prints.join(roots.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    of_linked = linked.join(smallest, "root").select("fp", "component_id")
    classes = prints.join(of_linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return base.join(classes, "fp").select("doc_id", "text_hash", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` without all but one of each component; all columns stay.

    The row with the smallest doc_id stays (nulls last, then the smallest hash of the text; of rows equal in both
    only one).
    """
    rows = near_duplicates(docs, size, radius)
    ids = (F.col("doc_id").isNull().alias("null_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash"))
    # A component without any id is named by null: its fingerprint class then stands for it.
    group = F.when(F.col("component_id").isNull(), F.col("fp"))
    best = rows.groupBy("component_id", group.alias("unnamed")).agg(F.min(F.struct(*ids)).alias("best")).select("best.*")
    keyed = docs.select(whole_row(docs), *ids[:2], F.xxhash64("text").alias("text_hash"))
    keys = ["null_id", "id", "text_hash"]
    return keyed.join(best, keys, "left_semi").dropDuplicates(keys).select(*fields(docs))
