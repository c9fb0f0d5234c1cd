"""Scan predicates, ROC corners, neighbours in a total order, parameters from text."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millwright.config import DEFAULT, UnknownParameter, parse_config
from millwright.ml import metrics
from millwright.operators.ordering import with_next_row
from millwright.sources.readers import scan_predicates


def parts_of(df, predicates):
    """Rows of each part, and the number of rows that do not lie in exactly one."""
    hits = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    total = sum(hits[1:], hits[0])
    counts = df.agg(*[F.sum(h).alias(f"p{i}") for i, h in enumerate(hits)], F.count_if(total != 1).alias("bad")).first()
    return [counts[f"p{i}"] for i in range(len(hits))], counts["bad"]


KEYS = {
    "long": [i * i for i in range(400)],
    "int": [7] * 200 + list(range(200)),
    "decimal(12,2)": [Decimal(i) / 4 for i in range(-200, 200)],
    "date": [date(1960, 1, 1) + timedelta(days=50 * i) for i in range(400)],
    "timestamp_ntz": [datetime(1969, 12, 31, 23, 59, 59, 999_999) + timedelta(seconds=i, microseconds=i) for i in range(400)],
}


@pytest.mark.parametrize("kind", KEYS)
def test_predicates_cover_without_overlap(spark, kind):
    keys = spark.createDataFrame([(v,) for v in [*KEYS[kind], None, None]], f"k {kind}")
    sizes, bad = parts_of(keys, scan_predicates(keys, "k", 5))
    assert bad == 0 and sum(sizes) == 402
    if kind == "int":
        assert max(sizes) <= 201 + 1  # the hot key stands alone
    else:
        assert max(sizes) <= 85
    small = keys.filter("k IS NOT NULL").limit(20)  # cuts of a sample hold for keys beyond it
    assert parts_of(keys, scan_predicates(small, "k", 5))[1] == 0


def test_predicates_of_few_keys(spark):
    empty = spark.createDataFrame([], "k long")
    assert scan_predicates(empty, "k", 4) == ["1 = 1"] == scan_predicates(empty, "k", 1)
    one = spark.createDataFrame([(3,), (None,)], "k long")
    assert parts_of(one, scan_predicates(one, "k", 4))[1] == 0
    for kind in ("double", "string", "timestamp"):
        with pytest.raises(ValueError):
            scan_predicates(spark.createDataFrame([], f"k {kind}"), "k", 4)
    with pytest.raises(ValueError):
        scan_predicates(empty, "k", 0)


@pytest.mark.parametrize("max_rows", [0, 10**6])
def test_next_row(spark, max_rows):
    rows = [(i, i % 5, None if i % 7 == 0 else i) for i in random.Random(1).sample(range(300), 120)]
    df = spark.createDataFrame(rows, "k int, a int, b int").repartition(6)
    got = {r["k"]: r["next"] for r in with_next_row(df, [F.col("k").desc()], ["k", "b"], max_rows=max_rows).collect()}
    ordered = sorted(rows, reverse=True)
    assert got.pop(ordered[-1][0]) is None
    assert {k: (n["k"], n["b"]) for k, n in got.items()} == {
        here[0]: (after[0], after[2]) for here, after in zip(ordered, ordered[1:])}


def area(points):
    points = sorted(points)
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))


@pytest.mark.parametrize("max_rows", [0, 10**6])
def test_corners_keep_the_curve(spark, max_rows):
    rng = random.Random(3)
    # Long runs of one direction: only their ends are corners.
    rows = [(float(s), int(rng.random() < (0.9 if s > 60 else 0.2))) for s in range(100) for _ in range(1 if s % 9 else 6)]
    curve = metrics.score_curve(spark.createDataFrame(rows, "s double, y int"), "s", "y")
    whole = [(r["fpr"], r["tpr"]) for r in metrics.roc_points(curve).collect()]
    corners = [(r["fpr"], r["tpr"]) for r in metrics.roc_corners(curve, max_rows=max_rows).collect()]
    ends = {(0.0, 0.0), (1.0, 1.0)}
    assert set(corners) <= set(whole) and ends <= set(corners) and len(corners) < len(whole)
    assert area(corners) == pytest.approx(area(whole), abs=1e-12)
    thin = [(r["fpr"], r["tpr"]) for r in metrics.roc_corners(curve, grid=5, max_rows=max_rows).collect()]
    assert set(thin) <= set(corners) and ends <= set(thin) and len(thin) <= 2 * 5 + 2
    for x, y in corners:
        assert min(max(abs(x - a), abs(y - b)) for a, b in thin) <= 1 / 5 + 1e-12


def test_corners_of_one_class_and_of_nothing(spark):
    kinds = "s double, y int"
    only = metrics.score_curve(spark.createDataFrame([(0.1, 1), (0.2, 1)], kinds), "s", "y")
    assert [r["tpr"] for r in metrics.roc_corners(only, 10).orderBy("tpr").collect()] == [0.0, 1.0]
    none = metrics.score_curve(spark.createDataFrame([], kinds), "s", "y")
    assert metrics.roc_corners(none, 10).count() == 1


def test_parameters_from_text():
    cfg = parse_config('{"models": {"boost_a": {"n_estimators": 7}}, "validation": {"rpm_range": [1, 2.5]}}')
    assert cfg.models.boost_a.n_estimators == 7 and cfg.models.boost_a.positive_weight == 4.0
    assert cfg.validation.rpm_range == (1.0, 2.5) and cfg.models.boost_b == DEFAULT.models.boost_b
    assert parse_config("[kpis]\noee_target = 1\n[features]\nexclude_current = true", "toml").kpis.oee_target == 1.0
    assert parse_config("{}") == DEFAULT


@pytest.mark.parametrize("text, named", [
    ('{"kpi": {}}', "kpi"), ('{"models": {"boost_a": {"depth": 3}}}', "models.boost_a.depth"),
    ('{"kpis": {"oee_target": "high"}}', "kpis.oee_target"), ('{"kpis": 3}', "kpis"),
    ('{"features": {"machine_rows": true}}', "features.machine_rows"), ('{"features": {"machine_rows": 2.5}}', "features.machine_rows"),
    ('{"validation": {"rpm_range": [1]}}', "validation.rpm_range"), ('{"load": {"buckets": null}}', "load.buckets"), ("[]", "parameters"),
])
def test_unknown_parameters_are_named(text, named):
    with pytest.raises(UnknownParameter, match=named):
        parse_config(text)
