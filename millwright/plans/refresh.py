"""Refresh of the stored views by difference: only snapshots that changed since the last refresh are read.

The views stand in the same root as the tables and are published together, so a reader sees all of them from one refresh.
``view_basis`` names the snapshot buckets they were worked out from. Buckets that were replaced since are retracted from
the sums with their old rows and added with their new ones. Sums are whole numbers, so this equals a full recomputation.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.plans import views
from millwright.schemas import KPI_SNAPSHOTS, PLANTS
from millwright.session import materialize
from millwright.sources.readers import conform, read_published
from millwright.sources.versions import Stored, Version, latest, publish, read_stored, stage

KPIS, BASIS, SUMS, NAMES = "kpi_snapshots", "view_basis", "view_sums", "view_plants"
DAILY, SUMMARY, RISK = "mv_daily_oee", "mv_plant_summary", "mv_top_risk_work_orders"
# Averages of the summary with the decimals of their columns, and its totals.
_AVERAGES = {
    "avg_oee": ("oee_score", 4), "avg_mttr_hours": ("mttr_hours", 2), "avg_sla_breach_rate": ("sla_breach_rate", 4),
    "avg_defect_rate": ("defect_rate", 4),
}
_TOTALS = {
    "total_high_risk_wos": "high_risk_wo_count", "total_anomalies": "anomaly_count", "total_throughput": "throughput_units",
}


def _measures(sign: int) -> dict[str, Column]:
    """Sum and count of each column as whole numbers; a plant without rows is one whose ``rows`` come to 0."""
    out = {"rows": F.lit(sign)}
    for name, (column, scale) in _AVERAGES.items():
        out[f"{name}_sum"] = sign * F.rint(F.col(column) * float(10**scale)).cast("long")
        out[f"{name}_n"] = F.when(F.col(column).isNotNull(), sign).otherwise(0)
    for name, column in _TOTALS.items():
        out[f"{name}_sum"] = sign * F.col(column)
        out[f"{name}_n"] = F.when(F.col(column).isNotNull(), sign).otherwise(0)
    return out


def _sums(kpis: DataFrame, sign: int) -> DataFrame:
    totals = [F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(name) for name, value in _measures(sign).items()]
    return kpis.groupBy("plant_id").agg(*totals)


def _added_up(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    names = [c for c in rows.columns if c != "plant_id"]
    return rows.groupBy("plant_id").agg(*[F.sum(c).alias(c) for c in names]).filter(F.col("rows") > 0)


def summary_of_sums(sums: DataFrame, plants: DataFrame) -> DataFrame:
    """The plant summary from stored sums; equal to ``views.mv_plant_summary`` over the same snapshots."""
    averages = [
        (F.try_divide(F.col(f"{name}_sum").cast("double"), F.col(f"{name}_n")) / F.lit(float(10**scale))).alias(name)
        for name, (_, scale) in _AVERAGES.items()
    ]
    totals = [F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum")).alias(name) for name in _TOTALS]
    named = sums.join(plants.select("plant_id", "plant_code", "plant_name"), "plant_id")
    return named.select("plant_id", "plant_code", "plant_name", *averages, *totals)


def _changed(old: Stored, new: Stored) -> list[int]:
    """Buckets whose folder is another one, is new or is gone."""
    return sorted(int(b) for b in old.parts.keys() | new.parts.keys() if old.parts.get(b) != new.parts.get(b))


def refresh_views(
    spark: SparkSession, root: str, work_orders: DataFrame, plants: DataFrame, machines: DataFrame
) -> list[int]:
    """Bring the three views up to the published snapshots; returns the snapshot buckets that were read.

    Everything is worked out anew at the first refresh and after a change of the plants' names.
    """
    base = latest(spark, root)
    kpis = base.tables[KPIS]
    names = conform(plants, PLANTS).select("plant_id", "plant_code", "plant_name")
    known = read_stored(spark, root, base, NAMES)
    basis = base.tables.get(BASIS)
    fresh = (
        basis is None or known is None or basis.buckets != kpis.buckets
        or not known.exceptAll(names).isEmpty() or not names.exceptAll(known).isEmpty()
    )
    before = replace(kpis, parts={}) if fresh else basis
    touched = _changed(before, kpis)
    old = _rows(spark, root, base, before, touched)
    new = _rows(spark, root, base, kpis, touched)
    parts = [] if fresh else [read_stored(spark, root, base, SUMS)]
    sums = materialize(_added_up([*parts, _sums(new, 1), _sums(old, -1)]))
    daily = stage(views.mv_daily_oee(new, plants), root, DAILY, ["day"], kpis.buckets)
    if not fresh:
        kept = {b: p for b, p in base.tables[DAILY].parts.items() if int(b) not in set(touched)}
        daily = replace(daily, parts={**kept, **daily.parts})
    risky = views.mv_top_risk_work_orders(work_orders, plants, machines)
    publish(spark, root, base, {
        BASIS: kpis, SUMS: stage(sums, root, SUMS, ["plant_id"], 1), NAMES: stage(names, root, NAMES, ["plant_id"], 1),
        DAILY: daily, SUMMARY: stage(summary_of_sums(sums, plants), root, SUMMARY, ["plant_id"], 1),
        RISK: stage(risky, root, RISK, ["work_order_id"], kpis.buckets),
    })
    return touched


def _rows(spark: SparkSession, root: str, base: Version, table: Stored, buckets: list[int]) -> DataFrame:
    """Snapshots in some buckets of a table entry, whether it is the current one or the basis."""
    at = replace(base, tables={KPIS: table})
    return conform(read_stored(spark, root, at, KPIS, buckets), KPI_SNAPSHOTS)


def changed_days(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """Days on which computed snapshots differ from the published ones, deleted and new days included."""
    stored = read_published(spark, root, KPIS, KPI_SNAPSHOTS)
    now = rows.select(*KPI_SNAPSHOTS.names)
    return stored.exceptAll(now).unionByName(now.exceptAll(stored)).select("snapshot_date").distinct()
