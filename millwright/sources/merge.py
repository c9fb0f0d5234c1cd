"""Changes to a stored table that write only the buckets they touch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.sources.load import write_back
from millwright.sources.versions import BUCKET, Stored, Version, bucket_of, read_stored, stage


class RepeatedKeys(ValueError):
    """Two updates for one key: which one holds is not defined."""


def _typed_keys(keys: DataFrame, table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys in the table's types, so that they hash alike; NULL keys match nothing and go."""
    typed = keys.withColumns({c: F.col(c).cast(table.schema[c].dataType) for c in key})
    return typed.na.drop(subset=list(key))


def _buckets(rows: DataFrame, table: Stored) -> list[int]:
    """Buckets with rows; at most as many as the table has."""
    found = rows.select(bucket_of(table.key, table.buckets).alias(BUCKET)).distinct().collect()
    return sorted(r[BUCKET] for r in found)


def _with_buckets(table: Stored, touched: Sequence[int], new: Stored) -> Stored:
    others = {b: p for b, p in table.parts.items() if int(b) not in set(touched)}
    return replace(table, parts={**others, **new.parts})


def stage_merge(
    spark: SparkSession, root: str, base: Version, name: str, updates: DataFrame, columns: Sequence[str]
) -> Stored:
    """The table with ``columns`` replaced where ``updates`` has the key, equal to ``write_back`` row for row.

    Only buckets in which a row really changes are written again. NULL keys change nothing, an unknown key adds nothing, and
    all rows of a key that the table holds repeatedly change. Two updates of one key are an error.
    """
    table = base.tables[name]
    key = list(table.key)
    whole = read_stored(spark, root, base, name)
    new = _typed_keys(updates.select(*key, *columns), whole, key)
    if not new.groupBy(*key).count().filter("count > 1").isEmpty():
        raise RepeatedKeys(f"{name}: repeated keys among the updates")
    values = {f"_new_{c}": F.col(c).cast(whole.schema[c].dataType) for c in columns}
    met = whole.select(*key, *columns).join(new.withColumns(values).select(*key, *values), key)
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    touched = _buckets(met.filter(differs), table)
    if not touched:
        return table
    rows = read_stored(spark, root, base, name, touched)
    here = new.filter(bucket_of(key, table.buckets).isin(touched))
    return _with_buckets(table, touched, stage(write_back(rows, here, key, list(columns)), root, name, key, table.buckets))


def stage_replace(
    spark: SparkSession, root: str, base: Version, name: str, keys: DataFrame, rows: DataFrame
) -> Stored:
    """The table with all rows of the given keys taken out and ``rows`` put in; ``rows`` may hold only these keys.

    Keys that are given without rows are deleted, new ones inserted. Only the keys' buckets are written again.
    """
    table = base.tables[name]
    key = list(table.key)
    whole = read_stored(spark, root, base, name)
    gone = _typed_keys(keys.select(*key), whole, key).distinct()
    added = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in whole.schema.fields])
    if not added.join(gone, key, "left_anti").isEmpty():
        raise ValueError(f"{name}: rows outside the keys to replace")
    touched = _buckets(gone, table)
    if not touched:
        return table
    left = read_stored(spark, root, base, name, touched).join(gone, key, "left_anti")
    return _with_buckets(table, touched, stage(left.unionByName(added), root, name, key, table.buckets))
