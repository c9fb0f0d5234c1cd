"""Session defaults and tables in the checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_written: list[str] = []


def build_session(app: str = "millwright", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All day and hour keys are UTC, whatever session the caller hands in."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's own setting, or a temporary one in local runs."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="millwright-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to a table in the checkpoint folder and read them back.

    Cuts the lineage like a checkpoint and survives the loss of any executor, but the rows are computed only
    once, and later steps read just the columns they use. The table lives in this run's checkpoint folder.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialize`` wrote inside the block when it ends; results must be stored by then."""
    before = len(_written)
    try:
        yield
    finally:
        for text in _written[before:]:
            path = spark._jvm.org.apache.hadoop.fs.Path(text)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        del _written[before:]
