"""Risk page: scatter sample, trend by order size, insight figures, top orders, score histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.config import DEFAULT, Config
from millwright.functions import fixed_avg, half_even, pearson, share, to_double
from millwright.operators.sampling import hash_sample
from millwright.operators.stats import histogram, step_bucket
from millwright.plans.reports.common import only

# Columns of the top-risk table.
TOP_COLUMNS = ("work_order_id", "plant_name", "machine_code", "priority", "status", "risk_score", "product_type")


def scored_orders(
    orders: DataFrame, plants: Sequence[str] | None = None, priorities: Sequence[str] | None = None
) -> DataFrame:
    """Located orders with a score and a planned quantity, filtered by plant and priority."""
    typed = orders.withColumns({"risk_score": to_double("risk_score"), "planned_units": to_double("planned_units")})
    complete = typed.na.drop(subset=["risk_score", "planned_units"])
    return only(only(complete, "plant_name", plants), "priority", priorities)


def scatter_sample(scored: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Seeded sample with its risk band: ``high`` above the threshold, otherwise ``normal``."""
    sample = hash_sample(scored, "work_order_id", cfg.reports.risk_sample_rows, cfg.reports.sample_seed)
    high = F.col("risk_score") > cfg.kpis.high_risk_score_threshold
    return sample.select(
        "work_order_id", "plant_name", "priority", "status", "planned_units", "risk_score",
        F.when(high, "high").otherwise("normal").alias("risk_band"),
    )


def risk_by_size(sample: DataFrame, step: int = 100) -> DataFrame:
    """Mean score per planned-units bucket."""
    return (
        sample.groupBy(step_bucket("planned_units", step).alias("bucket"))
        .agg(fixed_avg("risk_score", 4).alias("avg_risk"))
        .orderBy("bucket")
    )


def highest_risk_plant(scored: DataFrame) -> DataFrame:
    per_plant = scored.groupBy("plant_name").agg(fixed_avg("risk_score", 4).alias("avg_risk"))
    return per_plant.orderBy(F.col("avg_risk").desc(), "plant_name").limit(1)


def insight(scored: DataFrame, threshold: float = DEFAULT.kpis.high_risk_score_threshold) -> DataFrame:
    """Share above the threshold, correlation of size and risk with its class, and the riskiest plant."""
    overall = scored.agg(
        share(F.col("risk_score") > threshold).alias("share_above"), pearson("planned_units", "risk_score").alias("r")
    )
    top = highest_risk_plant(scored).select("plant_name").first()
    r = F.col("r")
    kind = F.when(F.abs(r) < 0.05, "independent").when(r > 0, "increases").otherwise("decreases")
    return overall.select(
        "share_above", r.alias("correlation"), kind.alias("relation"),
        F.lit(top["plant_name"] if top else None).cast("string").alias("top_plant"),
    )


def top_orders(scored: DataFrame, rows: int = DEFAULT.reports.top_risk_rows) -> DataFrame:
    """Highest scores first; ties by order id."""
    shown = scored.select(*[c for c in TOP_COLUMNS if c in scored.columns])
    return shown.orderBy(F.col("risk_score").desc(), "work_order_id").limit(rows).withColumn(
        "risk_score", half_even("risk_score", 4)
    )


def top_labelled_orders(orders: DataFrame, rows: int = DEFAULT.reports.top_risk_rows) -> DataFrame:
    """Top orders among those labelled high risk."""
    return top_orders(orders.filter(F.col("risk_label") == 1), rows)


def score_histogram(orders: DataFrame, bins: int = DEFAULT.reports.histogram_bins) -> DataFrame:
    return histogram(orders.withColumn("risk_score", to_double("risk_score")), "risk_score", bins, "status")
