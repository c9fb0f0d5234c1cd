"""The 26-column feature matrix: order attributes, schedule pressure, machine history, plant context, sensors."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.config import DEFAULT, FeatureConfig
from millwright.functions import at_or_before_zero, clip, half_even, hours_between, parse_timestamps
from millwright.functions.temporal import MICROS_PER_DAY, MICROS_PER_HOUR, micros
from millwright.operators.lookback import lookback_mean
from millwright.operators.ordering import LastBefore, RollingRows, RowNumber, over_key_order, running_sums
from millwright.operators.sizing import GROUP_ROWS, dimension, row_count
from millwright.session import materialize

log = logging.getLogger(__name__)

# Feature names and order, target name, priority codes.
FEATURES = (
    "priority_encoded", "product_type_encoded", "planned_units", "day_of_week", "hour_of_day", "is_monday",
    "is_end_of_quarter",
    "planned_duration_hours", "lead_time_hours", "queue_depth", "overdue_flag",
    "machine_age_years", "failure_count_30d", "avg_downtime_30d", "days_since_last_failure",
    "plant_defect_rate_7d", "plant_failure_rate_7d", "plant_utilization_rate",
    "tel_temp_mean", "tel_temp_std", "tel_temp_max", "tel_vib_mean", "tel_vib_max", "tel_pres_deviation",
    "tel_pwr_spike_count", "tel_anomaly_count",
)
TARGET = "risk_label_raw"
PRIORITY_CODES = {"critical": 4, "high": 3, "medium": 2, "low": 1}
OTHER_PRIORITY = 2
NO_FAILURE_DAYS = 365.0
UTILIZATION_DEFAULT = 0.8
RUSHED_HOURS = 2

# Names of the sensor statistics.
SENSOR_STATS = (
    "temp_mean", "temp_std", "temp_max", "vib_mean", "vib_std", "vib_max", "pres_mean", "pres_deviation", "pwr_mean",
    "pwr_spike_count", "rpm_mean", "rpm_cv", "anomaly_count",
)
_BUCKET_MICROS = {"hour": MICROS_PER_HOUR, "day": MICROS_PER_DAY}


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _start_order() -> list[Column]:
    return [F.col("scheduled_start").asc_nulls_last(), F.col("work_order_id").asc()]


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Alphabetical code from 0 for each distinct non-null value."""
    values = materialize(df.filter(F.col(column).isNotNull()).select(column).distinct())  # read more than once below
    ranked = running_sums(values.withColumn("_one", F.lit(1)), [F.col(column).asc()], {"_rank": "_one"})
    return ranked.select(column, (F.col("_rank") - 1).cast("int").alias(f"{column}_encoded"))


def static_features(orders: DataFrame) -> DataFrame:
    """Priority and product codes, calendar keys and planned duration."""
    df = parse_timestamps(orders, "created_at", "scheduled_start", "scheduled_end")
    df = df.join(dimension(category_codes(df, "product_type")), "product_type", "left").select(
        *df.columns, "product_type_encoded"
    )
    start = F.col("scheduled_start")
    priority = F.lit(None).cast("int")
    for name, code in PRIORITY_CODES.items():
        priority = F.when(F.col("priority") == name, F.lit(code)).otherwise(priority)
    quarter_end = F.month(start).isin(3, 6, 9, 12) & (F.dayofmonth(start) >= 25)
    return df.withColumns({
        "priority_encoded": F.coalesce(priority, F.lit(OTHER_PRIORITY)),
        "product_type_encoded": F.coalesce("product_type_encoded", F.lit(-1)),
        "day_of_week": F.weekday(start),
        "hour_of_day": F.hour(start),
        "is_monday": _flag(F.weekday(start) == 0),
        "is_end_of_quarter": _flag(quarter_end),
        "planned_duration_hours": at_or_before_zero(hours_between("scheduled_start", "scheduled_end")),
    })


def _schedule_columns(orders: DataFrame) -> DataFrame:
    df = parse_timestamps(orders, "created_at", "scheduled_start", "scheduled_end")
    lead = at_or_before_zero(hours_between("created_at", "scheduled_start"))
    return df.withColumns({
        "planned_duration_hours": at_or_before_zero(hours_between("scheduled_start", "scheduled_end")),
        "lead_time_hours": lead,
        "overdue_flag": _flag(lead < RUSHED_HOURS),
    })


def _queue_spec() -> RowNumber:
    return RowNumber("queue_depth")


def _queue_depth(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    return df.withColumn("queue_depth", (F.col("queue_depth") % cfg.queue_modulus).cast("int"))


def schedule_features(
    orders: DataFrame, cfg: FeatureConfig = DEFAULT.features, max_group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Lead time, rushed flag, and the queue proxy: order number within the plant, modulo 20."""
    df = _schedule_columns(orders)
    return _queue_depth(over_key_order(df, "plant_id", _start_order(), [_queue_spec()], max_group_rows), cfg)


def machine_history_features(
    orders: DataFrame, cfg: FeatureConfig = DEFAULT.features, max_group_rows: int = GROUP_ROWS,
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Machine age and history over the last 30 orders of the machine.

    ``exclude_current`` keeps the order's own outcome out of its features.
    """
    df = parse_timestamps(orders, "scheduled_start")
    failed = _flag(F.col("status") == "failed")
    df = df.withColumns({
        "is_failure": failed,
        "_failed_at": F.when(failed == 1, micros("scheduled_start")),
        "_downtime": F.col("downtime_minutes").cast("double"),
    })
    rows, skip = cfg.machine_rows, cfg.exclude_current
    out = over_key_order(df, "machine_id", _start_order(), [
        RollingRows("failure_count_30d", lambda: F.sum("is_failure"), rows, skip),
        RollingRows("avg_downtime_30d", lambda: F.avg("_downtime"), rows, skip),
        LastBefore("_last_failed_at", "_failed_at"),
    ], max_group_rows, block_rows)
    days = (micros("scheduled_start") - F.col("_last_failed_at")) / F.lit(float(MICROS_PER_DAY))
    if "install_date" in df.columns:
        age_us = micros("scheduled_start") - F.unix_micros(F.col("install_date").cast("timestamp"))
        age_days = clip(F.floor(age_us / F.lit(float(MICROS_PER_DAY))).cast("long"), low=0)
        age = {"machine_age_days": age_days, "machine_age_years": half_even(age_days / F.lit(365.25), 2)}
    else:
        age = {"machine_age_years": F.lit(5.0)}
    return out.withColumns({
        "failure_count_30d": F.coalesce("failure_count_30d", F.lit(0)),
        "avg_downtime_30d": F.coalesce("avg_downtime_30d", F.lit(0.0)),
        # NULL is tested first: greatest() would skip it and turn "no failure yet" into 0 days.
        "days_since_last_failure": F.when(F.col("_last_failed_at").isNull(), F.lit(NO_FAILURE_DAYS)).otherwise(
            F.greatest(F.lit(0.0), days)
        ),
        **age,
    }).drop("_failed_at", "_downtime", "_last_failed_at")


def _plant_columns(orders: DataFrame) -> DataFrame:
    df = parse_timestamps(orders, "scheduled_start")
    rate = F.try_divide(F.col("defect_count").cast("double"), F.col("actual_units").cast("double"))
    return df.withColumns({
        "defect_rate_wo": clip(F.coalesce(rate, F.lit(0.0)), 0.0, 1.0),
        "is_failure": _flag(F.col("status") == "failed"),
        "completed_flag": _flag(F.col("status") == "completed"),
    })


def _plant_specs(cfg: FeatureConfig) -> list[RollingRows]:
    skip = cfg.exclude_current
    return [
        RollingRows("plant_defect_rate_7d", lambda: F.avg("defect_rate_wo"), cfg.plant_rate_rows, skip),
        RollingRows("plant_failure_rate_7d", lambda: F.avg("is_failure"), cfg.plant_rate_rows, skip),
        RollingRows("plant_utilization_rate", lambda: F.avg("completed_flag"), cfg.plant_utilization_rows, skip),
    ]


def _plant_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "plant_defect_rate_7d": F.coalesce("plant_defect_rate_7d", F.lit(0.0)),
        "plant_failure_rate_7d": F.coalesce("plant_failure_rate_7d", F.lit(0.0)),
        "plant_utilization_rate": F.coalesce("plant_utilization_rate", F.lit(UTILIZATION_DEFAULT)),
    })


def plant_context_features(
    orders: DataFrame, cfg: FeatureConfig = DEFAULT.features, max_group_rows: int = GROUP_ROWS,
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Defect, failure and completion rates over the last orders of the plant."""
    df = _plant_columns(orders)
    out = over_key_order(df, "plant_id", _start_order(), _plant_specs(cfg), max_group_rows, block_rows)
    return _plant_defaults(out)


def aggregate_telemetry(
    telemetry: DataFrame, keys: tuple[str, ...] = ("machine_id",), bucket: str = "hour", bucket_col: str = "hour"
) -> DataFrame:
    """Sensor statistics per key and time bucket; a statistic without values is 0.

    A spike is a power reading above mean + 2 standard deviations of its own group. That needs the finished
    group statistics, which are stored once; readings are read again only for groups whose maximum shows there is one.
    """
    df = parse_timestamps(telemetry, "recorded_at").withColumn(bucket_col, F.date_trunc(bucket, "recorded_at"))
    group = [*keys, bucket_col]
    for column in group:
        df = df.filter(F.col(column).isNotNull())
    anomalous = F.coalesce(F.col("anomaly_flag").cast("int"), F.lit(0))
    rpm_mean = F.avg("rpm")
    base = materialize(df.groupBy(*group).agg(
        F.avg("temperature_c").alias("temp_mean"),
        F.stddev_samp("temperature_c").alias("temp_std"),
        F.max("temperature_c").alias("temp_max"),
        F.avg("vibration_hz").alias("vib_mean"),
        F.stddev_samp("vibration_hz").alias("vib_std"),
        F.max("vibration_hz").alias("vib_max"),
        F.avg("pressure_bar").alias("pres_mean"),
        F.stddev_samp("pressure_bar").alias("pres_deviation"),
        F.avg("power_kw").alias("pwr_mean"),
        rpm_mean.alias("rpm_mean"),
        F.when(rpm_mean > 0, F.stddev_samp("rpm") / rpm_mean).otherwise(F.lit(0.0)).alias("rpm_cv"),
        F.sum(anomalous).cast("long").alias("anomaly_count"),
        F.max("power_kw").alias("_top"),
        (F.avg("power_kw") + 2 * F.stddev_samp("power_kw")).alias("_limit"),
    ))
    spiky = base.filter("_top > _limit").select(*group, "_limit")
    if row_count(spiky) == 0:
        out = base.withColumn("pwr_spike_count", F.lit(0).cast("long"))
    else:
        readings = df.select(*group, "power_kw").join(dimension(spiky, *group, "_limit"), group)
        spikes = readings.filter("power_kw > _limit").groupBy(*group).agg(F.count(F.lit(1)).alias("pwr_spike_count"))
        out = base.join(spikes, group, "left")
    return out.select(*group, *SENSOR_STATS).na.fill(0, subset=list(SENSOR_STATS))


def sensor_lookback(
    orders: DataFrame, telemetry: DataFrame, stats: tuple[str, ...] = SENSOR_STATS,
    cfg: FeatureConfig = DEFAULT.features,
) -> DataFrame:
    """Add ``tel_*``: mean of the machine's bucket statistics in the hours before the scheduled start."""
    df = parse_timestamps(orders, "scheduled_start")
    buckets = aggregate_telemetry(telemetry, bucket=cfg.telemetry_bucket)
    return lookback_mean(
        df, buckets, "machine_id", "scheduled_start", "hour", stats,
        cfg.telemetry_lookback_hours * MICROS_PER_HOUR, _BUCKET_MICROS[cfg.telemetry_bucket], prefix="tel_",
    )


def with_target(orders: DataFrame) -> DataFrame:
    return orders.withColumn(TARGET, _flag(F.col("status").isin("failed", "delayed")))


def select_matrix(df: DataFrame) -> DataFrame:
    """Id, features and target; an absent feature is 0, with a warning, and so is a NULL."""
    absent = missing_features(df)
    if absent:
        log.warning("features filled with 0: %s", ", ".join(absent))
    columns = [
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in df.columns else F.lit(0.0).alias(c)
        for c in FEATURES
    ]
    target = [TARGET] if TARGET in df.columns else []
    keep = [c for c in ("plant_id", "scheduled_start") if c in df.columns]
    return df.select("work_order_id", *keep, *columns, *target)


def missing_features(df: DataFrame) -> list[str]:
    return [c for c in FEATURES if c not in df.columns]


_ORDER_COLUMNS = (
    "work_order_id", "machine_id", "plant_id", "created_at", "scheduled_start", "scheduled_end", "status", "priority",
    "product_type", "planned_units", "actual_units", "defect_count", "downtime_minutes",
)


def feature_matrix(
    orders: DataFrame, machines: DataFrame, telemetry: DataFrame, cfg: FeatureConfig = DEFAULT.features,
    max_group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Order id, plant and start (the split's order keys), 26 features and the target.

    Two ordered passes in all, one by machine and one by plant, then one equi-join for the sensor means.
    """
    df = orders.select(*[c for c in _ORDER_COLUMNS if c in orders.columns])
    df = df.join(dimension(machines, "machine_id", "install_date", "machine_type"), "machine_id", "left")
    df = _schedule_columns(static_features(df))
    df = machine_history_features(df, cfg, max_group_rows)
    df = over_key_order(
        _plant_columns(df), "plant_id", _start_order(), [*_plant_specs(cfg), _queue_spec()], max_group_rows
    )
    df = _queue_depth(_plant_defaults(df), cfg)
    used = tuple(s for s in SENSOR_STATS if f"tel_{s}" in FEATURES)
    df = sensor_lookback(df, telemetry, used, cfg)
    return select_matrix(with_target(df))
