"""Executive page: month-over-month cards, high-risk totals, OEE trend, plant comparison.

Inputs are KPI snapshots joined with ``plant_name``: one row per plant and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwright.config import DEFAULT
from millwright.functions import fixed_avg, half_even
from millwright.plans.reports.common import only

# Decimals of the stored KPI columns.
KPI_DIGITS = {
    "oee_score": 4, "availability_rate": 4, "performance_rate": 4, "quality_rate": 4, "mttr_hours": 2,
    "mtbf_hours": 2, "sla_breach_rate": 4, "defect_rate": 4,
}
CARD_KPIS = ("oee_score", "mttr_hours", "sla_breach_rate", "defect_rate")


def month_over_month(kpis: DataFrame, columns: Sequence[str] = CARD_KPIS) -> DataFrame:
    """Mean of the latest calendar month, of the month before it, and their difference, per KPI."""
    monthly = kpis.groupBy(F.trunc("snapshot_date", "month").alias("month")).agg(
        *[fixed_avg(c, KPI_DIGITS[c]).alias(c) for c in columns]
    )
    long = monthly.unpivot(["month"], list(columns), "kpi", "mean")
    w = Window.partitionBy("kpi").orderBy("month")  # one row per month
    follows = F.lag("month").over(w) == F.add_months("month", -1)
    paired = long.withColumn("prior_mean", F.when(follows, F.lag("mean").over(w)))
    latest = paired.groupBy("kpi").agg(F.max_by(F.struct("month", "mean", "prior_mean"), "month").alias("m"))
    delta = F.col("m.mean") - F.col("m.prior_mean")
    return latest.select(
        "kpi",
        F.date_format("m.month", "yyyy-MM").alias("month"),
        F.col("m.mean").alias("latest_mean"),
        F.col("m.prior_mean").alias("prior_mean"),
        delta.alias("delta"),
        F.when(delta > 0, "up").otherwise("down").alias("direction"),
    )


def high_risk_summary(kpis: DataFrame, work_orders: DataFrame | None = None) -> DataFrame:
    """High-risk orders in total, per produced unit, and the leading plant with its share.

    ``high_risk_ratio`` divides by produced units, as the card does; pass the orders for the share of orders.
    """
    per_plant = kpis.groupBy("plant_name").agg(
        F.sum("high_risk_wo_count").alias("n"), F.sum("throughput_units").alias("units")
    )
    totals = per_plant.agg(
        F.sum("n").alias("high_risk_total"),
        F.greatest(F.sum("units"), F.lit(1)).alias("units_total"),
        F.min(F.struct((-F.col("n")).alias("neg"), "plant_name")).alias("top"),
    )
    out = totals.select(
        "high_risk_total",
        (F.col("high_risk_total") / F.col("units_total")).alias("high_risk_ratio"),
        F.col("top.plant_name").alias("top_plant"),
        F.try_divide(-F.col("top.neg").cast("double"), F.col("high_risk_total")).alias("top_share"),
    )
    if work_orders is not None:
        labelled = F.count_if(F.coalesce(F.col("risk_label") == 1, F.lit(False)))
        share = work_orders.agg(F.try_divide(labelled, F.count(F.lit(1))).alias("s")).first()["s"]
        out = out.withColumn("high_risk_share_of_orders", F.lit(share).cast("double"))
    return out


def oee_trend(kpis: DataFrame, plants: Sequence[str] | None = None, window: int | None = 7) -> DataFrame:
    """OEE smoothed over the last ``window`` snapshot rows of the plant (1 = raw)."""
    rows = window or 7
    w = Window.partitionBy("plant_name").orderBy("snapshot_date").rowsBetween(1 - rows, 0)
    total = F.sum(F.rint(F.col("oee_score") * F.lit(1e4)).cast("long")).over(w).cast("double")
    smooth = F.try_divide(total, F.count("oee_score").over(w)) / F.lit(1e4)
    return only(kpis, "plant_name", plants).select(
        "plant_name", "snapshot_date", "oee_score", smooth.alias("oee_smooth")
    )


def oee_gap(trend: DataFrame, target: float = DEFAULT.kpis.oee_target) -> DataFrame:
    """Last smoothed OEE of each plant and its distance from the target."""
    last = trend.groupBy("plant_name").agg(F.max_by("oee_smooth", "snapshot_date").alias("last_oee"))
    gap = F.col("last_oee") - F.lit(target)
    return last.select(
        "plant_name", "last_oee", gap.alias("gap"), F.when(gap >= 0, "above").otherwise("below").alias("direction")
    )


def plant_averages(
    kpis: DataFrame, columns: Sequence[str], digits: int | None = None, percent: Sequence[str] = ()
) -> DataFrame:
    """Mean KPI columns per plant, optionally rounded, some as percent."""
    means = []
    for column in columns:
        mean = fixed_avg(column, KPI_DIGITS[column])
        mean = mean * F.lit(100.0) if column in percent else mean
        means.append((half_even(mean, digits) if digits is not None else mean).alias(column))
    return kpis.groupBy("plant_name").agg(*means)


def kpi_series(kpis: DataFrame, column: str) -> DataFrame:
    """One KPI as plotted over time per plant."""
    return kpis.select("plant_name", "snapshot_date", column).orderBy("plant_name", "snapshot_date")
