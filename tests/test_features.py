from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwright.config import FeatureConfig
from millwright.operators.lookback import lookback_mean
from millwright.plans import features
from tests.builders import T0, column, machines, orders, readings

HOUR = 3_600_000_000


def test_priority_codes(spark):
    df = orders(spark, [{"priority": p} for p in ("critical", "high", "medium", "low", "odd", None)])
    assert column(features.static_features(df), "priority_encoded") == [4, 3, 2, 1, 2, 2]


def test_product_codes_are_alphabetical_and_null_is_minus_one(spark):
    df = orders(spark, [{"product_type": p} for p in ("b", "a", None, "c", "a")])
    assert column(features.static_features(df), "product_type_encoded") == [1, 0, -1, 2, 0]


def test_calendar(spark):
    starts = [datetime(2022, 3, 24, 5), datetime(2022, 3, 25, 23), datetime(2022, 4, 25), datetime(2022, 1, 3, 7)]
    out = features.static_features(orders(spark, [{"scheduled_start": s} for s in starts]))
    assert column(out, "is_end_of_quarter") == [0, 1, 0, 0]
    assert column(out, "day_of_week") == [3, 4, 0, 0]
    assert column(out, "is_monday") == [0, 0, 1, 1]
    assert column(out, "hour_of_day") == [5, 23, 0, 7]


def test_durations_have_a_floor_and_keep_null(spark):
    out = features.schedule_features(orders(spark, [
        {"scheduled_end": T0 - timedelta(hours=1), "scheduled_start": T0},
        {"created_at": T0 + timedelta(hours=9), "scheduled_start": T0 + timedelta(hours=1)},
        {"created_at": None, "scheduled_start": T0 + timedelta(hours=2)},
    ]))
    assert column(out, "planned_duration_hours")[0] == 0.0
    assert column(out, "lead_time_hours") == [1.0, 0.0, None]
    assert column(out, "overdue_flag") == [1, 1, 0]  # unknown lead time is not rushed


def test_text_timestamps_parse_leniently(spark):
    df = orders(spark, [{}, {}]).withColumn(
        "scheduled_start",
        F.when(F.col("work_order_id") == 1, "2022-01-03T05:00:00+00:00").otherwise("not a time"),
    )
    out = features.static_features(df)
    assert column(out, "hour_of_day") == [5, None]
    assert column(out, "is_monday") == [1, 0]


def test_queue_depth_wraps_at_20_and_breaks_ties_by_id(spark):
    df = orders(spark, [{"scheduled_start": T0} for _ in range(22)])
    assert column(features.schedule_features(df), "queue_depth") == [*range(1, 20), 0, 1, 2]


def test_rolling_windows_count_rows_not_days(spark):
    rows = [{"status": "failed", "downtime_minutes": 10, "scheduled_start": T0 + timedelta(days=100 * i)} for i in range(32)]
    out = features.machine_history_features(orders(spark, rows))
    counts = column(out, "failure_count_30d")
    assert counts[:3] == [1, 2, 3] and counts[29:] == [30, 30, 30]
    assert column(out, "avg_downtime_30d") == [10.0] * 32


def test_exclude_current_leaves_the_own_outcome_out(spark):
    rows = [{"status": "failed", "downtime_minutes": 60}, {}, {}]
    cfg = FeatureConfig(exclude_current=True)
    out = features.machine_history_features(orders(spark, rows), cfg)
    assert column(out, "failure_count_30d") == [0, 1, 1]
    assert column(out, "avg_downtime_30d") == [0.0, 60.0, 32.5]
    plant = features.plant_context_features(orders(spark, rows), cfg)
    assert column(plant, "plant_utilization_rate") == [0.8, 0.0, 0.5]


@pytest.mark.parametrize("max_group, block", [(10**6, 100), (0, 40)])
def test_days_since_last_failure(spark, max_group, block):
    statuses = ["completed", "failed", "completed", "failed", "completed"]
    starts = [T0, T0 + timedelta(days=1), T0 + timedelta(days=1), T0 + timedelta(days=3), T0 + timedelta(days=3, hours=12)]
    df = orders(spark, [{"status": s, "scheduled_start": t} for s, t in zip(statuses, starts)])
    out = features.machine_history_features(df, max_group_rows=max_group, block_rows=block)
    # No failure yet is 365, not 0; an order at the very time of the failure is 0 days away.
    assert column(out, "days_since_last_failure") == [365.0, 365.0, 0.0, 2.0, 0.5]


def test_machine_age(spark):
    df = orders(spark, [{"scheduled_start": datetime(2022, 1, 1)}, {"scheduled_start": datetime(2019, 1, 1)}])
    aged = features.machine_history_features(df.join(machines(spark).select("machine_id", "install_date"), "machine_id"))
    assert column(aged, "machine_age_days") == [731, 0]
    assert column(aged, "machine_age_years") == [2.0, 0.0]
    assert column(features.machine_history_features(df), "machine_age_years") == [5.0, 5.0]


def test_order_defect_rate(spark):
    df = orders(spark, [
        {"defect_count": 5, "actual_units": 0}, {"defect_count": 5, "actual_units": None},
        {"defect_count": 5, "actual_units": 4}, {"defect_count": 1, "actual_units": 4},
    ])
    assert column(features.plant_context_features(df), "defect_rate_wo") == [0.0, 0.0, 1.0, 0.25]


def test_hourly_statistics_of_one_reading(spark):
    out = features.aggregate_telemetry(readings(spark, [{}, {"temperature_c": None, "anomaly_flag": True}])).orderBy("hour")
    one, two = out.collect()
    assert (one["temp_mean"], one["temp_std"], one["rpm_cv"], one["pwr_spike_count"]) == (65.0, 0.0, 0.0, 0)
    assert (two["temp_mean"], two["anomaly_count"], one["anomaly_count"]) == (0.0, 1, 0)


def test_power_spikes_need_their_group(spark):
    power = [10.0] * 9 + [100.0]
    rows = [{"power_kw": p, "recorded_at": T0 + timedelta(minutes=i)} for i, p in enumerate(power)]
    out = features.aggregate_telemetry(readings(spark, rows)).collect()
    assert [r["pwr_spike_count"] for r in out] == [1]


def test_null_keys_drop_out(spark):
    out = features.aggregate_telemetry(readings(spark, [{"machine_id": None}, {"recorded_at": None}, {}]))
    assert out.count() == 1


def test_lookback_bounds(spark):
    start = datetime(2022, 1, 10, 0, 0)
    hours = [start - timedelta(hours=25), start - timedelta(hours=24), start - timedelta(hours=1), start]
    buckets = spark.createDataFrame([(1, h, float(10**i)) for i, h in enumerate(hours)], "m int, h timestamp, v double")
    left = spark.createDataFrame([(1, 1, start), (2, 2, start), (3, 1, None)], "id int, m int, s timestamp")
    out = lookback_mean(left, buckets, "m", "s", "h", ["v"], 24 * HOUR, HOUR)
    # start-24h is inside, start is outside; other machines and unknown starts get 0.
    assert column(out, "v", "id") == [(10.0 + 100.0) / 2, 0.0, 0.0]


@pytest.mark.parametrize("lookback_min, block", [(24 * 60, 720), (24 * 60, 24), (90, 2), (30, 1)])
def test_lookback_equals_brute_force(spark, lookback_min, block):
    rng = random.Random(lookback_min + block)
    origin = datetime(1969, 12, 20)
    buckets = sorted({(rng.choice([1, 1, 1, 2]), origin + timedelta(hours=rng.randint(0, 700))) for _ in range(400)})
    buckets = [(m, h, rng.random()) for m, h in buckets]
    left = [
        (i, rng.choice([1, 1, 2, 3]), origin + timedelta(minutes=rng.choice([60 * rng.randint(0, 720), rng.randint(0, 43000)])))
        for i in range(300)
    ]
    out = lookback_mean(
        spark.createDataFrame(left, "id int, m int, s timestamp"),
        spark.createDataFrame(buckets, "m int, h timestamp, v double"),
        "m", "s", "h", ["v"], lookback_min * 60_000_000, HOUR, block_slots=block,
    )
    want = []
    for _, m, s in left:
        found = [v for bm, h, v in buckets if bm == m and s - timedelta(minutes=lookback_min) <= h < s]
        want.append(sum(found) / len(found) if found else 0.0)
    assert column(out, "v", "id") == pytest.approx(want)


def test_matrix_has_all_columns_and_no_nulls(spark):
    df = orders(spark, [{"status": s, "priority": None, "product_type": None} for s in ("failed", "delayed", "completed")])
    out = features.feature_matrix(df, machines(spark), readings(spark, [{}]))
    assert out.columns == ["work_order_id", "plant_id", "scheduled_start", *features.FEATURES, features.TARGET]
    assert len(features.FEATURES) == 26
    assert column(out, features.TARGET) == [1, 1, 0]
    assert out.na.drop().count() == 3


def test_block_path_gives_the_same_matrix(spark):
    rng = random.Random(1)
    rows = [{"status": rng.choice(["failed", "completed"]), "downtime_minutes": rng.randint(0, 99),
             "machine_id": rng.randint(1, 3)} for _ in range(80)]
    args = (orders(spark, rows), machines(spark, (1, 2, 3)), readings(spark, [{} for _ in range(50)]))
    plain = features.feature_matrix(*args).orderBy("work_order_id").collect()
    blocks = features.feature_matrix(*args, max_group_rows=0).orderBy("work_order_id").collect()
    assert plain == blocks


def test_absent_features_are_zero(spark):
    df = features.static_features(orders(spark, [{}]))
    assert "tel_temp_mean" in features.missing_features(df)
    assert features.select_matrix(df).first()["tel_temp_mean"] == 0.0
