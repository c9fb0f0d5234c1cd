"""The stored views behind the reports, and their refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions import fixed_avg
from millwright.operators.sizing import dimension
from millwright.schemas import KPI_SNAPSHOTS
from millwright.sources.writers import write_parquet


def with_plant_name(kpis: DataFrame, plants: DataFrame) -> DataFrame:
    return kpis.join(dimension(plants, "plant_id", "plant_name"), "plant_id")


def orders_located(work_orders: DataFrame, plants: DataFrame, machines: DataFrame) -> DataFrame:
    """Orders with plant name, machine code and machine type; orders of unknown plants or machines drop out."""
    located = with_plant_name(work_orders, plants)
    return located.join(dimension(machines, "machine_id", "machine_code", "machine_type"), "machine_id")


def readings_located(telemetry: DataFrame, plants: DataFrame, machines: DataFrame) -> DataFrame:
    """Sensor readings with plant name and machine code."""
    by_machine = telemetry.join(dimension(machines, "machine_id", "machine_code", "plant_id"), "machine_id")
    return with_plant_name(by_machine, plants)


def mv_daily_oee(kpis: DataFrame, plants: DataFrame) -> DataFrame:
    joined = kpis.join(dimension(plants, "plant_id", "plant_code", "plant_name"), "plant_id")
    measures = [c for c in KPI_SNAPSHOTS.names if c not in ("snapshot_date", "plant_id")]
    return joined.select(F.col("snapshot_date").alias("day"), "plant_code", "plant_name", *measures)


def mv_top_risk_work_orders(work_orders: DataFrame, plants: DataFrame, machines: DataFrame) -> DataFrame:
    """High-risk orders, highest score first."""
    risky = work_orders.filter(F.col("risk_label") == 1)
    return (
        orders_located(risky, plants, machines)
        .select(
            "work_order_id", "risk_score", "risk_label", "priority", "product_type", "status", "scheduled_start",
            "scheduled_end", "planned_units", "defect_count", "downtime_minutes", "plant_name", "machine_code",
            "machine_type",
        )
        .orderBy(F.col("risk_score").desc(), "work_order_id")
    )


def mv_plant_summary(kpis: DataFrame, plants: DataFrame) -> DataFrame:
    per_plant = kpis.groupBy("plant_id").agg(
        fixed_avg("oee_score", 4).alias("avg_oee"),
        fixed_avg("mttr_hours", 2).alias("avg_mttr_hours"),
        fixed_avg("sla_breach_rate", 4).alias("avg_sla_breach_rate"),
        fixed_avg("defect_rate", 4).alias("avg_defect_rate"),
        F.sum("high_risk_wo_count").alias("total_high_risk_wos"),
        F.sum("anomaly_count").alias("total_anomalies"),
        F.sum("throughput_units").alias("total_throughput"),
    )
    names = dimension(plants, "plant_id", "plant_code", "plant_name")
    return per_plant.join(names, "plant_id").select(
        "plant_id", "plant_code", "plant_name", *[c for c in per_plant.columns if c != "plant_id"]
    )


def refresh_all_views(
    kpis: DataFrame, work_orders: DataFrame, plants: DataFrame, machines: DataFrame, path: str
) -> None:
    """Recompute and overwrite the three stored views under ``path``."""
    write_parquet(mv_daily_oee(kpis, plants), f"{path}/mv_daily_oee")
    write_parquet(mv_top_risk_work_orders(work_orders, plants, machines), f"{path}/mv_top_risk_work_orders")
    write_parquet(mv_plant_summary(kpis, plants), f"{path}/mv_plant_summary")
