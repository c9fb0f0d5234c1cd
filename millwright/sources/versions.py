"""Tables that change together: parquet folders of their own for every change, and one manifest that names the current ones.

A writer stages new folders, which no reader knows, and then publishes the next manifest by creating a file that must
not exist yet. Nothing is renamed or overwritten, so readers see all of a change or nothing of it, whatever step fails.
A table is cut into buckets by a hash of its key; a change stages only the buckets it touches, and the manifest goes on
naming the old folders of all others.

A manifest that its writer did not finish is passed over by readers and stops the next writer until ``recover`` takes it
away. The file system must create files exclusively, as HDFS does and object stores with conditional writes do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.sources import files

BUCKET = "_bucket"
_FOLDER = "_manifests"


class CommitConflict(RuntimeError):
    """Another writer changed the same table, or left a manifest unfinished."""


@dataclass(frozen=True)
class Stored:
    """One table of a version: bucket number -> folder below the root. Empty buckets have no folder."""

    schema: str
    key: tuple[str, ...]
    buckets: int
    parts: dict[str, str]


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: Mapping[str, Stored] = field(default_factory=dict)


def _manifest(root: str, number: int) -> str:
    return f"{root}/{_FOLDER}/{number:012d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in files.names(spark, f"{root}/{_FOLDER}") if n.endswith(".json")]


def _load(spark: SparkSession, root: str, number: int) -> Version | None:
    """The version, or None if its writer did not finish the manifest."""
    try:
        record = json.loads(files.read_text(spark, _manifest(root, number)))
    except json.JSONDecodeError:
        return None
    tables = {name: Stored(**{**t, "key": tuple(t["key"])}) for name, t in record["tables"].items()}
    return Version(record["number"], tables)


def latest(spark: SparkSession, root: str) -> Version:
    """The last finished version; number 0 without tables if nothing was published."""
    for number in reversed(_numbers(spark, root)):
        if (version := _load(spark, root, number)) is not None:
            return version
    return Version()


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """Bucket of a key; rows whose key is NULL share one."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def stage(rows: DataFrame, root: str, name: str, key: Sequence[str], buckets: int) -> Stored:
    """Write rows to folders that no manifest names yet.

    Adaptive execution splits a bucket that is far larger than others over several tasks.
    """
    spark, folder = rows.sparkSession, f"{name}/{uuid.uuid4().hex}"
    cut = rows.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
    cut.write.partitionBy(BUCKET).parquet(f"{root}/{folder}")
    prefix = f"{BUCKET}="
    found = [n for n in files.names(spark, f"{root}/{folder}") if n.startswith(prefix)]
    return Stored(rows.schema.json(), tuple(key), buckets, {n.removeprefix(prefix): f"{folder}/{n}" for n in found})


def publish(spark: SparkSession, root: str, base: Version, changes: Mapping[str, Stored]) -> Version:
    """Make staged tables current, all at once; ``base`` is the version they were worked out from.

    A writer that published other tables in the meantime is no conflict: its tables stay.
    """
    while True:
        now = latest(spark, root)
        taken = max(_numbers(spark, root), default=0)
        if taken > now.number:
            raise CommitConflict(f"manifest {taken} is unfinished: wait for its writer, or call recover")
        changed = [name for name in changes if now.tables.get(name) != base.tables.get(name)]
        if changed:
            raise CommitConflict(f"changed since version {base.number}: {', '.join(sorted(changed))}")
        after = Version(now.number + 1, {**now.tables, **changes})
        text = json.dumps({"number": after.number, "tables": {n: asdict(t) for n, t in after.tables.items()}})
        if files.create_text(spark, _manifest(root, after.number), text):
            return after


def recover(spark: SparkSession, root: str) -> list[int]:
    """Take away unfinished manifests of writers that are known to be gone; returns their numbers."""
    broken = [n for n in _numbers(spark, root) if _load(spark, root, n) is None]
    for number in broken:
        files.delete(spark, _manifest(root, number))
    return broken


def read_stored(
    spark: SparkSession, root: str, version: Version, name: str, buckets: Sequence[int] | None = None
) -> DataFrame | None:
    """Rows of a table, or of some of its buckets; None if the version has no such table."""
    table = version.tables.get(name)
    if table is None:
        return None
    schema = T.StructType.fromJson(json.loads(table.schema))
    wanted = table.parts if buckets is None else {b: p for b, p in table.parts.items() if int(b) in set(buckets)}
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{p}" for p in wanted.values()])


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` manifests, and the folders that only deleted ones name; returns folders deleted.

    Manifests go first, so no manifest ever names a folder that is gone. Folders being staged are not touched. Readers
    that still use a dropped version fail, so keep as many as the longest reader needs.
    """
    versions = [v for n in _numbers(spark, root) if (v := _load(spark, root, n)) is not None]
    old, kept = versions[:-keep] if keep else versions, versions[-keep:] if keep else []
    if not kept:
        raise ValueError("at least one version has to stay")

    def folders(of: list[Version]) -> set[str]:
        return {path for v in of for t in v.tables.values() for path in t.parts.values()}

    for version in old:
        files.delete(spark, _manifest(root, version.number))
    gone = folders(old) - folders(kept)
    for path in sorted(gone):
        files.delete(spark, f"{root}/{path}")
    return len(gone)
