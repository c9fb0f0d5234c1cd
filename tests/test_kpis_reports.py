from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwright.functions import half_even, pearson
from millwright.plans import inspections as insp
from millwright.plans import kpis, views
from millwright.plans.reports import common, equipment, executive, quality, risk, scorecard
from millwright.schemas import KPI_SNAPSHOTS
from tests.builders import T0, column, machines, orders, plants, readings


def snapshot(spark, rows, **kw):
    return kpis.daily_snapshots(orders(spark, rows), machines(spark, (1, 2)), **kw).first()


def same_day(rows):
    return [{"scheduled_start": T0} | r for r in rows]


def test_snapshot_by_hand(spark):
    row = snapshot(spark, same_day([
        {"status": "failed", "downtime_minutes": 121, "actual_units": 50, "defect_count": 10, "risk_label": 1},
        {"status": "delayed", "downtime_minutes": 120, "machine_id": 2, "actual_units": None, "defect_count": 0},
        {"scheduled_end": T0 + timedelta(hours=3), "downtime_minutes": None},
    ]))
    assert row["availability_rate"] == 0.9163  # (2880 - 241) / 2880
    assert row["performance_rate"] == 0.4933  # 148 / 300
    assert row["quality_rate"] == 0.9189  # 136 / 148
    assert row["oee_score"] == 0.4154
    assert row["mttr_hours"] == 4.02  # all downtime of the day over one failure
    assert row["mtbf_hours"] == 3.0  # planned hours of completed orders
    assert row["sla_breach_rate"] == 0.3333  # 120 minutes are not yet a breach
    assert row["defect_rate"] == 0.0811
    assert (row["high_risk_wo_count"], row["anomaly_count"], row["throughput_units"]) == (1, 0, 148)


def test_snapshot_without_failures_or_units(spark):
    row = snapshot(spark, same_day([{"status": "cancelled", "actual_units": 0, "planned_units": 0, "defect_count": 3}]))
    assert (row["performance_rate"], row["quality_rate"], row["oee_score"], row["defect_rate"]) == (0, 0, 0, 0)
    assert (row["mttr_hours"], row["mtbf_hours"]) == (0.0, 24.0)


def test_snapshot_caps(spark):
    long = {"scheduled_end": T0 + timedelta(hours=99999), "actual_units": 500, "defect_count": 900, "downtime_minutes": 9999}
    row = snapshot(spark, same_day([long]))
    assert (row["mtbf_hours"], row["performance_rate"], row["availability_rate"]) == (9999.0, 1.0, 0.0)
    assert (row["quality_rate"], row["defect_rate"]) == (0.0, 1.0)


def test_snapshot_keys(spark):
    rows = [{"plant_id": None}, {"scheduled_start": None}, {"machine_id": 77}, {}]
    assert kpis.daily_snapshots(orders(spark, rows), machines(spark)).count() == 1


def test_anomalies_join_by_plant_and_utc_day(spark):
    tel = readings(spark, [{"anomaly_flag": True}, {"anomaly_flag": None}, {"anomaly_flag": True, "machine_id": 99},
                           {"anomaly_flag": True, "recorded_at": T0 + timedelta(days=1)}])
    assert snapshot(spark, [{}], telemetry=tel)["anomaly_count"] == 1


def kpi_frame(spark, rows):
    out = []
    for day, plant, change in rows:
        base = {c: 0.0 for c in KPI_SNAPSHOTS.names} | {
            "snapshot_date": day, "plant_id": 1, "high_risk_wo_count": 0, "anomaly_count": 0, "throughput_units": 0,
        } | change
        out.append(tuple(base[c] for c in KPI_SNAPSHOTS.names) + (plant,))
    schema = KPI_SNAPSHOTS.simpleString()[7:-1] + ",plant_name:string"
    return spark.createDataFrame(out, schema)


def test_month_over_month_uses_the_calendar_month_before(spark):
    df = kpi_frame(spark, [
        (date(2022, 1, 5), "A", {"oee_score": 0.1}), (date(2022, 3, 5), "A", {"oee_score": 0.5}),
        (date(2022, 3, 9), "B", {"oee_score": 0.7}),
    ])
    row = executive.month_over_month(df, ["oee_score"]).first()
    assert (row["month"], row["latest_mean"], row["prior_mean"], row["direction"]) == ("2022-03", 0.6, None, "down")
    more = df.unionByName(kpi_frame(spark, [(date(2022, 2, 1), "A", {"oee_score": 0.4})]))
    row = executive.month_over_month(more, ["oee_score"]).first()
    assert (row["prior_mean"], row["direction"]) == (0.4, "up")


def test_high_risk_summary(spark):
    df = kpi_frame(spark, [
        (date(2022, 1, 1), "B", {"high_risk_wo_count": 3}), (date(2022, 1, 1), "A", {"high_risk_wo_count": 3}),
        (date(2022, 1, 2), "C", {"high_risk_wo_count": 2}),
    ])
    row = executive.high_risk_summary(df, orders(spark, [{"risk_label": 1}, {"risk_label": 0}, {}, {}])).first()
    assert (row["high_risk_total"], row["high_risk_ratio"], row["top_plant"]) == (8, 8.0, "A")
    assert (row["top_share"], row["high_risk_share_of_orders"]) == (0.375, 0.25)


def test_oee_trend_and_gap(spark):
    df = kpi_frame(spark, [(date(2022, 1, d), "A", {"oee_score": d / 10}) for d in (1, 2, 3)] + [
        (date(2022, 1, 1), "B", {"oee_score": 0.9})])
    trend = executive.oee_trend(df, window=2)
    a = [r["oee_smooth"] for r in trend.filter("plant_name = 'A'").orderBy("snapshot_date").collect()]
    assert a == pytest.approx([0.1, 0.15, 0.25])
    gaps = {r["plant_name"]: r["direction"] for r in executive.oee_gap(trend).collect()}
    assert gaps == {"A": "below", "B": "above"}
    assert executive.oee_trend(df, plants=["B"]).count() == 1
    assert executive.oee_trend(df, plants=[]).count() == 4


def test_scorecard_text(spark):
    df = kpi_frame(spark, [(date(2022, 1, 1), "A", {"oee_score": 0.7654, "mttr_hours": 1.5, "defect_rate": 0.0123})])
    card = scorecard.scorecard(df)
    assert card.first()["below_target"] is True
    assert tuple(scorecard.scorecard_text(card).first()) == ("A", "76.5%", "1.5h", "0.0%", "1.23%")
    assert scorecard.title_case("risk_score") == "Risk Score"


def test_sla_heatmap(spark):
    df = kpi_frame(spark, [(date(2022, 1, 1), "A", {"sla_breach_rate": 0.2}), (date(2022, 1, 2), "A", {"sla_breach_rate": 0.4}),
                           (date(2022, 2, 1), "B", {"sla_breach_rate": 0.5})])
    got = {r["plant_name"]: (r["2022-01"], r["2022-02"]) for r in quality.sla_heatmap(df).collect()}
    assert got == {"A": (0.3, None), "B": (None, 0.5)}
    assert quality.sla_by_month(df).count() == 2


def located(spark, rows):
    return views.orders_located(orders(spark, rows), plants(spark), machines(spark))


def test_risk_bands_label_and_filters(spark):
    df = located(spark, [{"risk_score": s, "priority": p} for s, p in
                         ((0.65, "high"), (0.6501, "low"), (None, "low"), (0.1, "critical"))])
    scored = risk.scored_orders(df)
    bands = {r["risk_score"]: r["risk_band"] for r in risk.scatter_sample(scored).collect()}
    assert bands == {0.65: "normal", 0.6501: "high", 0.1: "normal"}
    assert risk.scored_orders(df, priorities=["low"]).count() == 1
    assert risk.scored_orders(df, plants=["Nowhere"]).count() == 0
    top = risk.top_orders(scored, 2).collect()
    assert [r["risk_score"] for r in top] == [0.6501, 0.65]


@pytest.mark.parametrize("scores, relation", [
    ((0.1, 0.2, 0.3), "increases"), ((0.3, 0.2, 0.1), "decreases"), ((0.2, 0.2, 0.2), "decreases")])
def test_risk_insight_relation(spark, scores, relation):
    df = located(spark, [{"risk_score": s, "planned_units": 100 * i} for i, s in enumerate(scores)])
    row = risk.insight(risk.scored_orders(df), 0.15).first()
    assert row["relation"] == relation and row["top_plant"] == "Alpha"
    assert (row["correlation"] is None) == (len(set(scores)) == 1)


def test_risk_by_size(spark):
    df = located(spark, [{"risk_score": 0.2, "planned_units": 199}, {"risk_score": 0.4, "planned_units": 100},
                         {"risk_score": 0.5, "planned_units": 200}])
    got = [(r["bucket"], r["avg_risk"]) for r in risk.risk_by_size(risk.scored_orders(df)).collect()]
    assert got == [(100, pytest.approx(0.3)), (200, 0.5)]


def test_equipment_shares_keep_null_in_the_denominator(spark):
    tel = readings(spark, [
        {"temperature_c": 96.0, "vibration_hz": 36.0, "anomaly_flag": True}, {"temperature_c": None},
        {"temperature_c": 95.0, "vibration_hz": 10.0, "anomaly_flag": True}, {"anomaly_flag": True, "vibration_hz": None},
    ])
    df = equipment.typed_readings(views.readings_located(tel, plants(spark), machines(spark)))
    row = equipment.insight(df).first()
    assert (row["overheat_share"], row["high_vibration_share"]) == (0.25, 0.5)
    assert (row["strongest_plant"], row["strongest_r"]) == ("Alpha", pytest.approx(1.0))
    quiet = equipment.insight(df.withColumn("anomaly_flag", F.lit(False))).first()
    assert (quiet["high_vibration_share"], quiet["strongest_plant"], quiet["strongest_r"]) == (0.0, "N/A", 0.0)


def test_correlation_without_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "a double, b double")
    assert df.agg(pearson("a", "b").alias("r")).first()["r"] is None


def test_overheat_spans(spark):
    days = (1, 2, 4, 8)
    rows = [(("A"), date(2022, 1, d), 99.0) for d in days] + [("A", date(2022, 1, 6), 90.0)]
    daily = spark.createDataFrame(rows, "plant_name string, date date, temp_7d double")
    got = [(r["span_start"].day, r["span_end"].day) for r in equipment.overheat_spans(daily).orderBy("span").collect()]
    assert got == [(1, 4), (8, 8)]


def test_vibration_events_split_at_p99(spark):
    rows = [{"anomaly_flag": True, "vibration_hz": float(i)} for i in range(200)] + [{"vibration_hz": 9999.0}]
    df = equipment.typed_readings(views.readings_located(readings(spark, rows), plants(spark), machines(spark)))
    bands = {r["band"]: r["n"] for r in equipment.vibration_events(df).groupBy("band").agg(F.count("*").alias("n")).collect()}
    assert bands == {"normal": 198, "extreme": 2}


def test_defect_rate_counts_unknown_units_as_one(spark):
    df = orders(spark, [{"actual_units": None, "defect_count": 1}, {"actual_units": 3, "defect_count": 1}])
    row = quality.defect_pareto_with_rate(df).first()
    assert (row["total_units"], row["defect_rate"]) == (4, 0.5)


def test_top_products(spark):
    df = orders(spark, [{"product_type": p, "defect_count": n} for p, n in (("a", 5), ("b", 3), ("c", 1), ("d", 1))])
    row = quality.top_products(quality.defect_pareto(df)).first()
    assert (row["products"], row["top_pct"], row["leader"], row["leader_pct"]) == (3, 90.0, "a", 50.0)


def test_distinct_values_skip_null(spark):
    df = orders(spark, [{"product_type": p} for p in ("b", None, "a", "b")])
    assert [r[0] for r in common.distinct_values(df, "product_type").collect()] == ["a", "b"]


def test_half_even_matches_numpy(spark):
    import numpy as np

    values = [0.125, 0.375, 2.675, 1.005, -0.125, 0.00005, 0.12345]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (1, 2, 4):
        got = [r[0] for r in df.select(half_even("x", digits)).collect()]
        assert got == [float(np.round(np.float64(v), digits)) for v in values]


def test_inspections_by_hand(spark):
    df = orders(spark, [
        {"actual_units": 100, "actual_end": T0 + timedelta(hours=10), "scheduled_start": T0},
        {"actual_units": 100, "actual_end": T0 + timedelta(hours=10, seconds=1), "scheduled_start": T0},
        {"status": "cancelled"}, {"actual_end": None}, {"actual_units": 0},
    ])
    rows = insp.eligible_orders(df).select("work_order_id", insp.late_finish(2).alias("late")).orderBy("work_order_id")
    assert [tuple(r) for r in rows.collect()] == [(1, False), (2, True)]
    units = spark.createDataFrame([(16, 100), (15, 100), (5, 100), (0, 100), (0, 0)], "f int, n int")
    levels = [r["s"] for r in units.select(insp.severity(F.col("f"), F.col("n")).alias("s")).collect()]
    assert levels == ["critical", "major", "minor", "minor", "minor"]
