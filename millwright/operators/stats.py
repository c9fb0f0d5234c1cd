"""Exact quantile, Pareto, histogram, bucket trend and contiguous spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwright.operators.ordering import running_sums
from millwright.operators.sizing import SINGLE_TASK_ROWS
from millwright.session import materialize


def exact_quantile(
    df: DataFrame, column: str, q: float, name: str = "quantile", max_rows: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """One row with the linearly interpolated quantile.

    Works on value counts: equal readings collapse before the shuffle, and the running count over the
    distinct values is distributed when there are many of them.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("_v"))
    values = materialize(values.agg(F.count(F.lit(1)).alias("_n")))
    total = values.agg(F.sum("_n")).first()[0] or 0
    place = q * max(total - 1, 0)
    low = int(place)
    high = min(low + 1, max(total - 1, 0))
    ranked = running_sums(values, [F.col("_v").asc()], {"_upto": "_n"}, max_rows)
    at = lambda k: F.min(F.when(F.col("_upto") > k, F.col("_v")))
    return ranked.agg(at(low).alias("_a"), at(high).alias("_b")).select(
        (F.col("_a") + (F.col("_b") - F.col("_a")) * F.lit(place - low)).alias(name)
    )


def pareto(df: DataFrame, key: str, measure: str, max_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Totals per key, largest first, with share and cumulative share in percent.

    Sums are taken on the integer measure, so shares do not depend on merge order.
    """
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(measure).cast("long").alias("total"))
    grouped = materialize(grouped)  # read three times below, computed once
    grand = grouped.agg(F.sum("total")).first()[0] or 1
    ranked = running_sums(
        grouped.withColumn("_one", F.lit(1).cast("long")),
        [F.col("total").desc(), F.col(key).asc()],
        {"_cum": "total", "pareto_rank": "_one"},
        max_rows,
    )
    percent = lambda c: F.col(c).cast("double") / F.lit(float(grand)) * F.lit(100.0)
    return ranked.select(key, "total", percent("total").alias("pct"), percent("_cum").alias("cum_pct"), "pareto_rank")


def histogram(df: DataFrame, column: str, bins: int, *by: str) -> DataFrame:
    """Counts in ``bins`` equal bins on [0, 1]; 1.0 falls in the last bin."""
    bin_no = F.least(F.lit(bins - 1), F.floor(F.col(column) * F.lit(float(bins))).cast("int"))
    return df.filter(F.col(column).isNotNull()).groupBy(bin_no.alias("bin"), *by).agg(F.count(F.lit(1)).alias("n"))


def step_bucket(column: str, step: int) -> Column:
    return (F.floor(F.col(column) / F.lit(float(step))) * step).cast("int")


def contiguous_spans(df: DataFrame, key: str, date: str, max_gap_days: int) -> DataFrame:
    """Merge dates of a key into spans; a gap above ``max_gap_days`` starts a new one.

    The input has one row per (key, date), so a key's group is bounded by the number of days.
    """
    w = Window.partitionBy(key).orderBy(date)
    opens = F.datediff(F.col(date), F.lag(date).over(w)) > max_gap_days
    marked = df.withColumn("_opens", F.coalesce(opens, F.lit(False)).cast("int"))
    numbered = marked.withColumn("span", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "span").agg(
        F.min(date).alias("span_start"), F.max(date).alias("span_end"), F.count(F.lit(1)).alias("days")
    )
