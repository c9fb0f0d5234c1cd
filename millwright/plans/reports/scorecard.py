"""Scorecard and plant-performance datasets of the printed report, and the model metrics table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.config import DEFAULT
from millwright.functions import half_even
from millwright.plans.reports.executive import plant_averages

# Column headings of the printed tables.
SCORECARD_COLUMNS = ("Plant", "OEE", "MTTR", "SLA Breach Rate", "Defect Rate")


def scorecard(kpis: DataFrame, target: float = DEFAULT.kpis.oee_target) -> DataFrame:
    """Rounded plant averages with the below-target flag."""
    means = plant_averages(kpis, ("oee_score", "mttr_hours", "sla_breach_rate", "defect_rate"), digits=4)
    return means.withColumn("below_target", F.col("oee_score") < target)


def scorecard_text(card: DataFrame) -> DataFrame:
    """The scorecard as printed."""

    def percent(column: str, digits: int) -> Column:
        return F.concat(half_even(F.col(column) * 100, digits).cast("string"), F.lit("%"))

    cells = (
        F.col("plant_name"), percent("oee_score", 1),
        F.concat(half_even("mttr_hours", 2).cast("string"), F.lit("h")),
        percent("sla_breach_rate", 2), percent("defect_rate", 2),
    )
    return card.select(*[cell.alias(name) for cell, name in zip(cells, SCORECARD_COLUMNS)])


def plant_performance(kpis: DataFrame) -> DataFrame:
    """MTTR in hours, defect and SLA breach rates in percent."""
    columns = ("mttr_hours", "defect_rate", "sla_breach_rate")
    return plant_averages(kpis, columns, percent=("defect_rate", "sla_breach_rate"))


def metrics_table(metrics: DataFrame) -> DataFrame:
    """The metrics record as (metric, value) text rows."""
    four = lambda c: F.format_string("%.4f", F.coalesce(F.col(c), F.lit(0.0)))
    # Names of the metrics.
    rows = {
        "CV AUC-ROC": F.concat(four("cv_auc_mean"), F.lit(" ± "), four("cv_auc_std")),
        "Test AUC-ROC": four("test_auc_roc"),
        "Test AUC-PR": four("test_auc_pr"),
        "Test F1": four("test_f1"),
        "High-Risk Threshold": F.col("threshold").cast("string"),
        "Test Set Positive Rate": F.format_string("%.2f%%", F.col("test_positive_rate") * 100),
    }
    pairs = [F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in rows.items()]
    return metrics.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def title_case(column: str) -> str:
    """Heading of a column: underscores as spaces, words capitalised."""
    return column.replace("_", " ").title()
