"""Daily plant KPIs: OEE and its parts, MTTR, MTBF, SLA breaches, defects, throughput, anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.config import DEFAULT, KpiConfig
from millwright.functions import clip, day_of, half_even, parse_timestamps, to_double
from millwright.functions.temporal import MICROS_PER_HOUR, micros
from millwright.operators.sizing import dimension
from millwright.schemas import KPI_SNAPSHOTS


def daily_anomalies(telemetry: DataFrame, machines: DataFrame) -> DataFrame:
    """Flagged readings per plant and day.

    Readings are reduced to one row per machine and day before the machine table is joined.
    """
    readings = parse_timestamps(telemetry, "recorded_at")
    per_machine = (
        readings.select("machine_id", day_of("recorded_at").alias("day"), F.col("anomaly_flag").cast("int").alias("f"))
        .filter(F.col("machine_id").isNotNull() & F.col("day").isNotNull())
        .groupBy("machine_id", "day")
        .agg(F.coalesce(F.sum("f"), F.lit(0)).alias("f"))
    )
    located = per_machine.join(dimension(machines, "machine_id", "plant_id"), "machine_id")
    return located.groupBy("plant_id", "day").agg(F.sum("f").alias("anomaly_count"))


def _ratio(num: Column, den: Column, low: float | None = None, high: float | None = None) -> Column:
    """``num / den`` clipped; 0 where the denominator is not positive."""
    return F.when(den > 0, clip(num / den, low, high)).otherwise(F.lit(0.0))


def daily_snapshots(
    work_orders: DataFrame, machines: DataFrame, telemetry: DataFrame | None = None, cfg: KpiConfig = DEFAULT.kpis
) -> DataFrame:
    """One row per plant and UTC day of ``scheduled_start``.

    Orders of unknown machines and rows without plant or day are left out.
    """
    orders = parse_timestamps(work_orders, "scheduled_start", "scheduled_end")
    orders = orders.join(dimension(machines, "machine_id"), "machine_id", "left_semi")
    downtime = to_double("downtime_minutes", 0).alias("downtime")
    duration = micros("scheduled_end") - micros("scheduled_start")
    rows = orders.select(
        "plant_id",
        day_of("scheduled_start").alias("snapshot_date"),
        "machine_id",
        F.coalesce(F.col("status") == "failed", F.lit(False)).alias("failed"),
        F.coalesce(F.col("status").isin("failed", "delayed"), F.lit(False)).alias("late"),
        to_double("actual_units", 0).alias("actual"),
        to_double("planned_units").alias("planned"),
        to_double("defect_count", 0).alias("defects"),
        downtime,
        F.when(F.col("status") == "completed", F.when(duration < 0, F.lit(0)).otherwise(duration)).alias("done_us"),
        (to_double("risk_label", 0) == 1).alias("high_risk"),
    ).filter(F.col("plant_id").isNotNull() & F.col("snapshot_date").isNotNull())

    limit = F.lit(cfg.sla_breach_threshold_hours * 60)
    sums = rows.groupBy("plant_id", "snapshot_date").agg(
        F.greatest(F.count_distinct("machine_id"), F.lit(1)).alias("machines"),
        F.count(F.lit(1)).alias("orders"),
        F.count_if("failed").alias("failures"),
        F.count_if(F.col("late") & (F.col("downtime") > limit)).alias("breaches"),
        F.sum("actual").alias("actual"),
        F.coalesce(F.sum("planned"), F.lit(0.0)).alias("planned"),
        F.sum("defects").alias("defects"),
        F.sum("downtime").alias("downtime"),
        F.sum("done_us").alias("done_us"),
        F.count_if("high_risk").alias("high_risk_wo_count"),
    )

    capacity = F.col("machines") * F.lit(cfg.minutes_per_machine)
    availability = clip((capacity - F.col("downtime")) / capacity, low=0.0)
    performance = _ratio(F.col("actual"), F.col("planned"), 0.0, 1.0)
    quality = _ratio(F.col("actual") - F.col("defects"), F.col("actual"), 0.0, 1.0)
    uptime = F.coalesce(F.col("done_us") / F.lit(float(MICROS_PER_HOUR)), F.lit(cfg.mtbf_default_uptime_hours))
    failures = F.col("failures")
    mtbf = F.when(failures > 0, uptime / failures).otherwise(uptime)
    kpis = sums.select(
        "snapshot_date",
        "plant_id",
        half_even(availability * performance * quality, 4).alias("oee_score"),
        half_even(availability, 4).alias("availability_rate"),
        half_even(performance, 4).alias("performance_rate"),
        half_even(quality, 4).alias("quality_rate"),
        half_even(_ratio(F.col("downtime") / F.lit(60.0), failures), 2).alias("mttr_hours"),
        half_even(clip(mtbf, high=cfg.mtbf_cap_hours), 2).alias("mtbf_hours"),
        half_even(F.col("breaches") / F.col("orders"), 4).alias("sla_breach_rate"),
        half_even(_ratio(F.col("defects"), F.col("actual"), high=1.0), 4).alias("defect_rate"),
        "high_risk_wo_count",
        F.floor("actual").cast("long").alias("throughput_units"),
    )
    if telemetry is None:
        kpis = kpis.withColumn("anomaly_count", F.lit(0).cast("long"))
    else:
        flagged = daily_anomalies(telemetry, machines).withColumnRenamed("day", "snapshot_date")
        kpis = kpis.join(flagged, ["plant_id", "snapshot_date"], "left")
        kpis = kpis.withColumn("anomaly_count", F.coalesce("anomaly_count", F.lit(0)))
    return kpis.select(*KPI_SNAPSHOTS.names)
