"""Equipment page: temperature trend, overheating spans, vibration at flagged readings, correlations.

Inputs are readings joined with ``plant_name``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwright.config import DEFAULT, ReportConfig
from millwright.functions import day_of, parse_timestamps, pearson, share, to_double
from millwright.operators.sampling import hash_sample
from millwright.operators.stats import contiguous_spans, exact_quantile
from millwright.plans.reports.common import only
from millwright.session import materialize


def typed_readings(readings: DataFrame, plants: list[str] | None = None) -> DataFrame:
    typed = parse_timestamps(readings, "recorded_at").withColumns({
        "anomaly_flag": F.coalesce(F.col("anomaly_flag").cast("boolean"), F.lit(False)),
        "temperature_c": to_double("temperature_c"),
        "vibration_hz": to_double("vibration_hz"),
    })
    return only(typed, "plant_name", plants)


def daily_temperature(readings: DataFrame, rows: int = 7) -> DataFrame:
    """Daily means per plant, with the temperature mean over the last ``rows`` days present."""
    daily = readings.groupBy("plant_name", day_of("recorded_at").alias("date")).agg(
        F.avg("temperature_c").alias("temperature_c"), F.avg("vibration_hz").alias("vibration_hz")
    )
    w = Window.partitionBy("plant_name").orderBy("date").rowsBetween(1 - rows, 0)
    return daily.withColumn("temp_7d", F.avg("temperature_c").over(w))


def overheat_spans(
    daily: DataFrame, limit: float = DEFAULT.reports.temperature_limit, gap: int = DEFAULT.reports.overheat_gap_days
) -> DataFrame:
    """Contiguous spans of days whose rolling temperature is above the limit."""
    return contiguous_spans(daily.filter(F.col("temp_7d") > limit), "plant_name", "date", gap)


def raw_sample(readings: DataFrame, cfg: ReportConfig = DEFAULT.reports) -> DataFrame:
    present = readings.na.drop(subset=["temperature_c"])
    sample = hash_sample(present, "telemetry_id", cfg.raw_sample_rows, cfg.sample_seed)
    return sample.select("telemetry_id", "plant_name", "recorded_at", "temperature_c").orderBy("recorded_at")


def flagged(readings: DataFrame) -> DataFrame:
    """Flagged readings with a vibration value."""
    return readings.filter(F.col("anomaly_flag")).na.drop(subset=["vibration_hz"])


def vibration_p99(readings: DataFrame) -> DataFrame:
    return exact_quantile(flagged(readings), "vibration_hz", 0.99, "p99_vibration")


def vibration_events(readings: DataFrame, cfg: ReportConfig = DEFAULT.reports) -> DataFrame:
    """Every flagged reading above the 99th percentile, and a seeded sample of the others."""
    events = materialize(flagged(readings).select("telemetry_id", "plant_name", "recorded_at", "vibration_hz"))
    p99 = exact_quantile(events, "vibration_hz", 0.99, "p99_vibration").first()["p99_vibration"]
    extreme = F.col("vibration_hz") > F.lit(p99)
    usual = hash_sample(events.filter(~extreme), "telemetry_id", cfg.anomaly_sample_rows, cfg.sample_seed)
    return usual.withColumn("band", F.lit("normal")).unionByName(
        events.filter(extreme).withColumn("band", F.lit("extreme"))
    )


def temp_vibration_correlation(readings: DataFrame) -> DataFrame:
    """Correlation per plant over flagged readings, strongest first; plants without variance are left out."""
    per_plant = flagged(readings).groupBy("plant_name").agg(pearson("temperature_c", "vibration_hz").alias("r"))
    return per_plant.filter(F.col("r").isNotNull()).orderBy(F.col("r").desc(), "plant_name")


def insight(readings: DataFrame, cfg: ReportConfig = DEFAULT.reports) -> DataFrame:
    """Overheating share, share of strong vibration among flagged readings, strongest correlation."""
    events = F.col("anomaly_flag") & F.col("vibration_hz").isNotNull()
    figures = readings.agg(
        share(F.col("temperature_c") > cfg.temperature_limit).alias("overheat_share"),
        F.coalesce(
            F.avg(F.when(events, (F.col("vibration_hz") > cfg.vibration_limit).cast("double"))), F.lit(0.0)
        ).alias("high_vibration_share"),
    )
    best = temp_vibration_correlation(readings).limit(1).first()
    return figures.withColumns({
        "strongest_plant": F.lit(best["plant_name"] if best else "N/A"),
        "strongest_r": F.lit(float(best["r"]) if best else 0.0),
    })


def anomaly_rate(readings: DataFrame) -> DataFrame:
    """Share of flagged readings and scored counts."""
    is_flagged = F.coalesce(F.col("anomaly_flag").cast("boolean"), F.lit(False))
    return readings.agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(is_flagged).alias("flagged"),
        share(is_flagged).alias("anomaly_rate"),
    )
