from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.config import DEFAULT, AnomalyConfig, BoostConfig, ModelConfig
from millwright.ml import anomaly, importance, metrics, risk, split
from millwright.plans.features import FEATURES, TARGET
from millwright.plans.reports.scorecard import metrics_table
from tests.builders import T0, readings

CFG = replace(
    DEFAULT,
    models=ModelConfig(
        anomaly=AnomalyConfig(n_estimators=10, contamination=0.05),
        boost_a=BoostConfig(4, 3, 0.1, 0.8, 0.8, 4.0), boost_b=BoostConfig(4, 3, 0.1, min_rows_per_leaf=2), cv_splits=2,
    ),
    kpis=replace(DEFAULT.kpis, high_risk_score_threshold=0.5),
    reports=replace(DEFAULT.reports, importance_sample_rows=100),
)


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(2)
    scores = np.round(rng.random(400), 2)
    labels = (rng.random(400) < scores).astype(int)
    rows = [(int(i), float(s), int(y)) for i, (s, y) in enumerate(zip(scores, labels))]
    return scores, labels, spark.createDataFrame(rows, "id long, s double, y int")


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_auc_with_ties(scored, max_rows):
    scores, labels, df = scored
    curve = metrics.score_curve(df, "s", "y", max_rows=max_rows)
    assert metrics.auc_roc(curve).first()["auc_roc"] == pytest.approx(brute_auc(scores, labels))
    steps, tp, seen = 0.0, 0, 0
    for s in sorted(set(scores), reverse=True):
        hit = [y for v, y in zip(scores, labels) if v == s]
        tp, seen = tp + sum(hit), seen + len(hit)
        steps += sum(hit) / labels.sum() * tp / seen
    assert metrics.average_precision(curve).first()["auc_pr"] == pytest.approx(steps)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert metrics.auc_roc(metrics.score_curve(df, "s", "y")).first()["auc_roc"] is None


def test_confusion_has_all_cells_and_f1_is_zero_when_undefined(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "s double, y int")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df, "y", F.col("s") >= 0.5).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 0}
    assert metrics.f1_score(df, "y", F.col("s") >= 0.5).first()["f1"] == 0.0


def test_roc_runs_from_origin_to_one(scored):
    _, _, df = scored
    points = metrics.roc_points(metrics.score_curve(df, "s", "y")).orderBy("fpr", "tpr").collect()
    assert (points[0]["fpr"], points[0]["tpr"], points[-1]["fpr"], points[-1]["tpr"]) == (0.0, 0.0, 1.0, 1.0)
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(metrics.auc_roc(metrics.score_curve(df, "s", "y")).first()["auc_roc"])


def test_folds_expand():
    folds = split.expanding_folds(103, 5)
    assert [(f.start, f.end) for f in folds] == [(18, 35), (35, 52), (52, 69), (69, 86), (86, 103)]
    with pytest.raises(ValueError):
        split.expanding_folds(3, 5)


def test_holdout_order_decides_who_is_held_out(spark):
    rows = [(i, i % 2, T0 + timedelta(hours=i)) for i in range(10)]
    df = spark.createDataFrame(rows, "work_order_id long, plant_id int, scheduled_start timestamp")
    by_time = {r["work_order_id"] for r in split.holdout(df, 0.8).filter("NOT in_train").collect()}
    by_plant = {r["work_order_id"] for r in split.holdout(df, 0.8, split.PLANT_ORDER).filter("NOT in_train").collect()}
    assert by_time == {8, 9} and by_plant == {7, 9}


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(240):
        x = [float(v) for v in rng.normal(0, 1, len(FEATURES))]
        rows.append((i + 1, 1, T0 + timedelta(hours=i), *x, int(x[0] + 0.3 * rng.normal() > 0.7)))
    columns = ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame(rows, f"work_order_id long, plant_id int, scheduled_start timestamp, {columns}, {TARGET} int")


@pytest.fixture(scope="module")
def trained(matrix):
    return risk.train(matrix, CFG)


def test_training_metrics(trained):
    row = trained.metrics.first()
    for name in ("cv_auc_mean", "test_auc_roc", "test_auc_pr", "test_f1"):
        assert 0.0 <= row[name] <= 1.0
    assert row["test_auc_roc"] > 0.8  # the label follows the first feature
    assert row["test_n"] == 48
    assert {r["metric"] for r in metrics_table(trained.metrics).collect()} >= {"CV AUC-ROC", "Test F1"}
    assert risk.roc_by_model(trained.held_out).select("model").distinct().count() == 3


def test_scores_and_reload(trained, matrix, tmp_path):
    out = risk.score(matrix, trained.models, CFG).collect()
    assert len(out) == 240
    assert all(0 <= r["risk_score"] <= 1 and r["risk_label"] in (0, 1) for r in out)
    trained.models.save(str(tmp_path / "m"))
    assert risk.score(matrix, risk.RiskModels.load(str(tmp_path / "m")), CFG).collect() == out


def test_importance_finds_the_informative_feature(trained, matrix):
    top = importance.permutation_importance(matrix, trained.models, CFG).collect()
    assert len(top) == 15 and top[0]["feature"] == FEATURES[0] and top[0]["auc_drop"] > 0.1
    by_tree = importance.tree_importance(trained.models, matrix).orderBy(F.col("importance_a").desc()).first()
    assert by_tree["feature"] == FEATURES[0]


def sensor_rows(n, seed=42):
    rng = np.random.default_rng(seed)
    return [{
        "machine_id": int(rng.integers(1, 6)), "temperature_c": float(rng.normal(65, 5)),
        "vibration_hz": float(rng.normal(12, 2)), "pressure_bar": float(rng.normal(8, 1)),
        "power_kw": float(rng.normal(45, 5)), "rpm": float(rng.normal(3000, 100)),
    } for _ in range(n)]


@pytest.mark.parametrize("trees, samples", [(10, 256), (5, 16)])  # shared samples, disjoint samples
def test_forest_scores(spark, trees, samples):
    rows = sensor_rows(100) + [{"temperature_c": 119.0, "vibration_hz": 49.0, "pressure_bar": 19.0}, {"rpm": None}]
    tel = readings(spark, rows)
    cfg = replace(CFG, models=replace(CFG.models, anomaly=AnomalyConfig(trees, samples)))
    out = anomaly.score(tel, anomaly.fit(tel, cfg), cfg).orderBy("telemetry_id").collect()
    assert len(out) == len(rows)
    assert all(-1 <= r["anomaly_score"] <= 0 for r in out)
    assert (out[-1]["anomaly_score"], out[-1]["anomaly_flag"]) == (0.0, False)
    assert all(r["anomaly_flag"] for r in out[:-1])  # every complete reading is below -0.1
    assert out[100]["anomaly_score"] < np.mean([r["anomaly_score"] for r in out[:100]])


def test_forest_does_not_depend_on_partitioning(spark):
    tel = readings(spark, sensor_rows(300))
    scores = []
    for parts in (1, 7):
        moved = tel.repartition(parts)
        out = anomaly.score(moved, anomaly.fit(moved, CFG), CFG)
        scores.append([r[0] for r in out.orderBy("telemetry_id").select("anomaly_score").collect()])
    assert scores[0] == scores[1]


def test_contamination_mode_and_reload(spark, tmp_path):
    tel = readings(spark, sensor_rows(200))
    forest = anomaly.fit(tel, CFG)
    flagged = anomaly.score(tel, forest, CFG, mode="contamination").filter("anomaly_flag").count()
    assert flagged == 10  # the lowest 5 %
    forest.save(str(tmp_path / "f"))
    again = anomaly.Forest.load(spark, str(tmp_path / "f"))
    one = anomaly.score(tel, forest, CFG).orderBy("telemetry_id").collect()
    assert anomaly.score(tel, again, CFG).orderBy("telemetry_id").collect() == one


def test_constant_sensor_keeps_scale_one(spark):
    scaler = anomaly.fit_scaler(readings(spark, [{}, {}]))
    assert scaler["rpm"] == (3000.0, 1.0)


def test_no_complete_reading(spark):
    with pytest.raises(ValueError):
        anomaly.fit(readings(spark, [{"rpm": None}]), CFG)
