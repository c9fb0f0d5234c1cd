"""Quality page: defect Pareto with and without rate, top-3 share, SLA heatmap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions import fixed_avg, month_of, to_double
from millwright.operators.stats import pareto
from millwright.plans.reports.common import only
from millwright.session import materialize


def drill_inputs(
    orders: DataFrame, kpis: DataFrame, plants: Sequence[str] | None, products: Sequence[str] | None
) -> tuple[DataFrame, DataFrame]:
    """Orders filtered by plant and product, KPIs by plant only."""
    return only(only(orders, "plant_name", plants), "product_type", products), only(kpis, "plant_name", plants)


def defect_pareto(orders: DataFrame) -> DataFrame:
    counted = orders.withColumn("_defects", to_double("defect_count", 0).cast("long"))
    return pareto(counted, "product_type", "_defects").withColumnRenamed("total", "defect_count")


def defect_pareto_with_rate(orders: DataFrame) -> DataFrame:
    """Defects, units and defect rate per product, most defects first; an unknown quantity counts as one unit."""
    totals = orders.filter(F.col("product_type").isNotNull()).groupBy("product_type").agg(
        F.sum(to_double("defect_count", 0).cast("long")).alias("total_defects"),
        F.sum(to_double("actual_units", 1).cast("long")).alias("total_units"),
    )
    rate = F.try_divide(F.col("total_defects").cast("double"), F.col("total_units"))
    return totals.withColumn("defect_rate", rate).orderBy(F.col("total_defects").desc(), "product_type")


def top_products(pareto_rows: DataFrame, rows: int = 3) -> DataFrame:
    """Combined share of the leading products, and the leader with its own share."""
    lead = F.col("pareto_rank")
    return pareto_rows.filter(lead <= rows).agg(
        F.count(F.lit(1)).alias("products"),
        F.max("cum_pct").alias("top_pct"),
        F.min_by("product_type", lead).alias("leader"),
        F.min_by("pct", lead).alias("leader_pct"),
    )


def sla_by_month(kpis: DataFrame) -> DataFrame:
    return kpis.groupBy(month_of("snapshot_date").alias("month"), "plant_name").agg(
        fixed_avg("sla_breach_rate", 4).alias("sla_breach_rate")
    )


def sla_heatmap(kpis: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Plants as rows, months as columns. Without given months, the monthly rows are stored once to find them."""
    monthly = sla_by_month(kpis) if months else materialize(sla_by_month(kpis))
    pivoted = monthly.groupBy("plant_name").pivot("month", list(months) if months else None)
    return pivoted.agg(F.max("sla_breach_rate"))  # one row per cell
