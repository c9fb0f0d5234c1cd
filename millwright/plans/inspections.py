"""Predicates over orders and inspections: which orders are inspected, how severe a result is, which finish is late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import hours_between

# Shares of failed units above which a result is critical or major.
CRITICAL_SHARE = 0.15
MAJOR_SHARE = 0.05


def eligible_orders(orders: DataFrame) -> DataFrame:
    """Finished orders that produced units."""
    return orders.filter(
        F.col("status").isin("completed", "delayed", "failed")
        & F.col("actual_end").isNotNull()
        & (F.col("actual_units") > 0)
    )


def severity(failed: Column, inspected: Column) -> Column:
    failed_share = F.try_divide(failed.cast("double"), inspected.cast("double"))
    return (
        F.when(failed <= 0, "minor")
        .when(failed_share > CRITICAL_SHARE, "critical")
        .when(failed_share > MAJOR_SHARE, "major")
        .otherwise("minor")
    )


def late_finish(threshold_hours: float) -> Column:
    """SLA breach of an inspection: the order ended more than the threshold after its scheduled end."""
    return hours_between("scheduled_end", "actual_end") > threshold_hours
