"""Sinks: feature matrix, scores, KPI snapshots, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.schemas import STORED_DECIMALS


def as_stored(df: DataFrame, table: str) -> DataFrame:
    """Cast doubles to the decimal types of the stored table."""
    kinds = STORED_DECIMALS.get(table, {})
    casts = {c: F.col(c).cast(f"decimal({p},{s})") for c, (p, s) in kinds.items() if c in df.columns}
    return df.withColumns(casts) if casts else df


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_snapshots(kpis: DataFrame, path: str, replace_days_only: bool = False) -> None:
    """Store KPI snapshots: truncate and reload, or replace only the days present in ``kpis``."""
    stored = as_stored(kpis, "kpi_snapshots")
    if replace_days_only:
        (
            stored.repartition("snapshot_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("snapshot_date")
            .parquet(path)
        )
    else:
        write_parquet(stored, path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One-row metrics record as JSON."""
    metrics.write.mode("overwrite").json(path)
