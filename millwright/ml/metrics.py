"""Exact ranking and classification metrics over a score and a 0/1 label.

Rows collapse to one per distinct score before anything is ordered; ties are therefore averaged exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwright.operators.ordering import running_sums, with_next_row
from millwright.operators.sizing import SINGLE_TASK_ROWS
from millwright.session import materialize


def score_curve(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), max_rows: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """Per distinct score, highest first: positives, negatives, and both accumulated (``tp``, ``fp``).

    With ``by``, one curve per group; use that for groups of bounded size, such as samples.
    """
    positive = F.col(label) == 1
    groups = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    if by:
        w = Window.partitionBy(*by).orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
        return groups.withColumns({"tp": F.sum("pos").over(w), "fp": F.sum("neg").over(w)})
    return running_sums(materialize(groups), [F.col("score").desc()], {"tp": "pos", "fp": "neg"}, max_rows)


def _auc() -> Column:
    """Share of (positive, negative) pairs ranked correctly, ties counting half."""
    won = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0)))
    return F.try_divide(won, F.max("tp").cast("double") * F.max("fp"))


def _average_precision() -> Column:
    steps = F.sum(F.col("pos").cast("double") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return F.try_divide(steps, F.max("tp"))


def auc_roc(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*by).agg(_auc().alias("auc_roc"))


def average_precision(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*by).agg(_average_precision().alias("auc_pr"))


def confusion_counts(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    actual, hit = F.col(label) == 1, F.coalesce(predicted, F.lit(False))
    return df.agg(
        F.count_if(~actual & ~hit).alias("tn"), F.count_if(~actual & hit).alias("fp"),
        F.count_if(actual & ~hit).alias("fn"), F.count_if(actual & hit).alias("tp"),
    )


def confusion_matrix(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    """All four cells as rows (actual, predicted, n)."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n")) for a, p, c in cells
    ]
    return confusion_counts(df, label, predicted).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def f1_score(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    """F1, 0 where undefined."""
    c = confusion_counts(df, label, predicted)
    wrong = F.col("fp") + F.col("fn")
    return c.select(F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + wrong), F.lit(0.0)).alias("f1"))


def roc_corners(curve: DataFrame, grid: int | None = None, max_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Points at which the ROC curve bends, with the origin and the end: the curve through them is the whole one.

    A point goes if the steps before and after it have one direction, compared in whole numbers. With ``grid``, only the last
    corner in each cell of a grid of that many steps a side is kept, and the end: at most ``2 * grid`` points for any
    number of rows, every lost corner within one step of a kept one.
    """
    ordered = with_next_row(curve, [F.col("score").desc()], ["pos", "neg", "tp", "fp"], "_next", max_rows)
    wide = "decimal(19,0)"
    rise, run = F.col("pos").cast(wide), F.col("neg").cast(wide)
    straight = rise * F.col("_next.neg").cast(wide) == run * F.col("_next.pos").cast(wide)
    corners = ordered.filter(F.col("_next").isNull() | ~straight)
    if grid is not None:
        totals = curve.agg(F.max("tp").alias("p"), F.max("fp").alias("n")).first()

        def cell(value: Column, total: int | None) -> Column:
            return F.floor(value * F.lit(grid) / F.lit(max(total or 0, 1))).cast("long")

        kept = corners.drop("_next").withColumns({"_x": cell(F.col("fp"), totals["n"]), "_y": cell(F.col("tp"), totals["p"])})
        last = kept.groupBy("_x", "_y").agg(F.max_by(F.struct(*curve.columns), F.struct("tp", "fp")).alias("_row"))
        corners = last.select("_row.*")
    return roc_points(corners.select(*curve.columns), curve)


def roc_points(curve: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Every point of the ROC curve, starting at the origin; the totals are those of ``whole`` if ``curve`` is a part of it."""
    totals = (curve if whole is None else whole).agg(F.max("tp").alias("p"), F.max("fp").alias("n")).first()
    p, n = float(totals["p"] or 0), float(totals["n"] or 0)
    points = curve.select(
        "score", F.try_divide(F.col("fp"), F.lit(n)).alias("fpr"), F.try_divide(F.col("tp"), F.lit(p)).alias("tpr")
    )
    origin = curve.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)


def evaluate(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """One row: AUC-ROC, average precision, F1 at the threshold, row count, positive rate."""
    curve = score_curve(df, score, label)
    at = F.col("score") >= threshold
    tp = F.sum(F.when(at, F.col("pos")).otherwise(0))
    called = F.sum(F.when(at, F.col("pos") + F.col("neg")).otherwise(0))
    positives, rows = F.sum("pos"), F.sum(F.col("pos") + F.col("neg"))
    return curve.agg(
        _auc().alias("test_auc_roc"),
        _average_precision().alias("test_auc_pr"),
        F.coalesce(F.try_divide(2.0 * tp, called + positives), F.lit(0.0)).alias("test_f1"),
        rows.alias("test_n"),
        F.try_divide(positives.cast("double"), rows).alias("test_positive_rate"),
    )
