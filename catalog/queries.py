"""One entry per operator: (spark, sf_dir) -> DataFrame over the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.testbed import Testbed
from millwright.config import DEFAULT, FeatureConfig, parse_config
from millwright.functions import half_even, parse_timestamps
from millwright.ml import anomaly, attribution, importance, metrics, risk, split
from millwright.operators.ordering import running_sums
from millwright.operators.sampling import hash_sample
from millwright.operators.sizing import dimension
from millwright.plans import features, inspections, kpis, refresh, validation, views
from millwright.plans.reports import common, equipment, executive, quality, risk as risk_page, scorecard
from millwright.schemas import KPI_SNAPSHOTS, MACHINE_TELEMETRY, WORK_ORDERS
from millwright.session import ensure_checkpoint_dir, materialize
from millwright.sources import (
    read_csv, read_metrics, read_parquet, read_tables, write_csv, write_metrics, write_parquet, write_snapshots,
)
from millwright.sources.load import load_csvs, write_back
from millwright.sources.merge import stage_merge, stage_replace
from millwright.sources.readers import check_csv, read_published, scan_predicates
from millwright.sources.versions import Version, latest, publish, read_stored, stage
from millwright.sources.writers import as_stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Testbed(spark, sf_dir))
    return fn


def long_query(fn: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    """Over orders spread across 80 months."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Testbed(spark, sf_dir, long=True))
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Drop the last digits that depend on the order in which doubles are summed."""
    return df.withColumns({c: half_even(c, digits) for c in columns})


def snapshots(t: Testbed) -> DataFrame:
    return kpis.daily_snapshots(t.work_orders, t.machines, t.machine_telemetry)


def named_snapshots(t: Testbed) -> DataFrame:
    return views.with_plant_name(snapshots(t), t.plants)


def located_orders(t: Testbed) -> DataFrame:
    return views.orders_located(t.work_orders, t.plants, t.machines)


def located_readings(t: Testbed) -> DataFrame:
    return equipment.typed_readings(views.readings_located(t.machine_telemetry, t.plants, t.machines))


def scored(t: Testbed) -> DataFrame:
    return risk_page.scored_orders(located_orders(t))


# KPIs and views


@query
def kpi_daily_snapshot(t: Testbed) -> DataFrame:
    return snapshots(t)


@long_query
def kpi_daily_snapshot_long(t: Testbed) -> DataFrame:
    return snapshots(t)


@query
def kpi_daily_anomalies(t: Testbed) -> DataFrame:
    return kpis.daily_anomalies(t.machine_telemetry, t.machines)


@query
def mv_daily_oee(t: Testbed) -> DataFrame:
    return views.mv_daily_oee(snapshots(t), t.plants)


@query
def mv_plant_summary(t: Testbed) -> DataFrame:
    return views.mv_plant_summary(snapshots(t), t.plants)


@query
def mv_top_risk(t: Testbed) -> DataFrame:
    return views.mv_top_risk_work_orders(t.work_orders, t.plants, t.machines)


# Validation


@query
def validate_work_orders(t: Testbed) -> DataFrame:
    return validation.validate_work_orders(t.work_orders)


@query
def validate_telemetry(t: Testbed) -> DataFrame:
    return validation.validate_telemetry(t.machine_telemetry)


@query
def validate_inspections(t: Testbed) -> DataFrame:
    return validation.validate_inspections(t.quality_inspections)


@query
def validate_business(t: Testbed) -> DataFrame:
    return validation.check_business_rules(t.work_orders)


@query
def validate_references(t: Testbed) -> DataFrame:
    return validation.check_references(t.work_orders, t.quality_inspections)


@query
def validate_orphans(t: Testbed) -> DataFrame:
    missing = validation.orphans(t.quality_inspections, t.work_orders, "work_order_id", "work_order_id")
    return missing.withColumnRenamed("_k", "work_order_id")


@query
def validate_report(t: Testbed) -> DataFrame:
    return validation.by_level(validation.validate_all(t.tables()))


@query
def validate_level_counts(t: Testbed) -> DataFrame:
    return validation.level_counts(validation.validate_all(t.tables()))


@query
def validate_constraints(t: Testbed) -> DataFrame:
    return validation.constraint_checks({
        "plants": t.plants, "machines": t.machines, "work_orders": t.work_orders,
        "machine_telemetry": t.machine_telemetry, "quality_inspections": t.quality_inspections,
    })


# Features


@query
def features_static(t: Testbed) -> DataFrame:
    return features.static_features(t.work_orders).select(
        "work_order_id", "priority_encoded", "product_type_encoded", "planned_units", "day_of_week", "hour_of_day",
        "is_monday", "is_end_of_quarter", "planned_duration_hours",
    )


@long_query
def features_calendar_long(t: Testbed) -> DataFrame:
    return features.static_features(t.work_orders).select(
        "work_order_id", "day_of_week", "hour_of_day", "is_monday", "is_end_of_quarter"
    )


@query
def features_category_codes(t: Testbed) -> DataFrame:
    return features.category_codes(t.work_orders, "product_type")


@query
def features_schedule(t: Testbed) -> DataFrame:
    return features.schedule_features(t.work_orders).select(
        "work_order_id", "planned_duration_hours", "lead_time_hours", "queue_depth", "overdue_flag"
    )


_HISTORY = (
    "work_order_id", "is_failure", "machine_age_years", "failure_count_30d", "avg_downtime_30d",
    "days_since_last_failure",
)


def _with_machine(t: Testbed) -> DataFrame:
    return t.work_orders.join(dimension(t.machines, "machine_id", "install_date"), "machine_id", "left")


@query
def features_machine_history(t: Testbed) -> DataFrame:
    out = features.machine_history_features(_with_machine(t)).select(*_HISTORY)
    return rounded(out, 6, "avg_downtime_30d", "days_since_last_failure")


@query
def features_machine_history_lagged(t: Testbed) -> DataFrame:
    out = features.machine_history_features(_with_machine(t), FeatureConfig(exclude_current=True)).select(*_HISTORY)
    return rounded(out, 6, "avg_downtime_30d", "days_since_last_failure")


_CONTEXT = ("plant_defect_rate_7d", "plant_failure_rate_7d", "plant_utilization_rate")


@query
def features_plant_context(t: Testbed) -> DataFrame:
    out = features.plant_context_features(t.work_orders).select("work_order_id", "defect_rate_wo", *_CONTEXT)
    return rounded(out, 9, *_CONTEXT)


@query
def features_plant_context_blocks(t: Testbed) -> DataFrame:
    """The skew-proof path: the same windows over blocks of 2,000 sorted rows."""
    out = features.plant_context_features(t.work_orders, max_group_rows=0, block_rows=2000)
    return rounded(out.select("work_order_id", "defect_rate_wo", *_CONTEXT), 9, *_CONTEXT)


@query
def telemetry_hourly(t: Testbed) -> DataFrame:
    return rounded(features.aggregate_telemetry(t.machine_telemetry), 6, *_DOUBLE_STATS)


_DOUBLE_STATS = tuple(s for s in features.SENSOR_STATS if s not in ("pwr_spike_count", "anomaly_count"))


@query
def telemetry_daily_plant(t: Testbed) -> DataFrame:
    """The same statistics over plant-day groups, which are large enough to have spikes."""
    readings = views.readings_located(t.machine_telemetry, t.plants, t.machines)
    out = features.aggregate_telemetry(readings, ("plant_id",), "day", "day")
    return rounded(out, 9, *_DOUBLE_STATS)


_TEL = tuple(f"tel_{s}" for s in features.SENSOR_STATS)


@query
def telemetry_lookback(t: Testbed) -> DataFrame:
    out = features.sensor_lookback(t.work_orders.select("work_order_id", "machine_id", "scheduled_start"),
                                   t.machine_telemetry)
    return rounded(out.select("work_order_id", *_TEL), 6, *_TEL)


@query
def feature_matrix(t: Testbed) -> DataFrame:
    out = features.feature_matrix(t.work_orders, t.machines, t.machine_telemetry)
    return rounded(out.drop("plant_id", "scheduled_start"), 6, *features.FEATURES)


# Executive page


@long_query
def exec_month_over_month(t: Testbed) -> DataFrame:
    return executive.month_over_month(named_snapshots(t))


@query
def exec_high_risk(t: Testbed) -> DataFrame:
    return executive.high_risk_summary(named_snapshots(t), t.work_orders)


@query
def oee_smoothed(t: Testbed) -> DataFrame:
    return executive.oee_trend(named_snapshots(t))


@long_query
def oee_smoothed_30_filtered(t: Testbed) -> DataFrame:
    first = common.distinct_values(t.plants, "plant_name").limit(2).collect()
    return executive.oee_trend(named_snapshots(t), [r["plant_name"] for r in first], 30)


@query
def oee_gap(t: Testbed) -> DataFrame:
    return executive.oee_gap(executive.oee_trend(named_snapshots(t)))


@query
def plant_averages(t: Testbed) -> DataFrame:
    return executive.plant_averages(named_snapshots(t), ("oee_score", "sla_breach_rate", "defect_rate", "mttr_hours"))


@query
def plant_performance(t: Testbed) -> DataFrame:
    return scorecard.plant_performance(named_snapshots(t))


@query
def scorecard_values(t: Testbed) -> DataFrame:
    return scorecard.scorecard(named_snapshots(t))


@query
def scorecard_printed(t: Testbed) -> DataFrame:
    return scorecard.scorecard_text(scorecard.scorecard(named_snapshots(t)))


@long_query
def mttr_trend(t: Testbed) -> DataFrame:
    return executive.kpi_series(named_snapshots(t), "mttr_hours")


# Risk page


@query
def risk_scatter_sample(t: Testbed) -> DataFrame:
    return risk_page.scatter_sample(scored(t))


@query
def risk_by_size(t: Testbed) -> DataFrame:
    return risk_page.risk_by_size(risk_page.scatter_sample(scored(t)))


@query
def risk_insight(t: Testbed) -> DataFrame:
    return rounded(risk_page.insight(scored(t)), 9, "correlation")


@query
def risk_insight_filtered(t: Testbed) -> DataFrame:
    rows = risk_page.scored_orders(located_orders(t), priorities=["critical", "high"])
    return rounded(risk_page.insight(rows), 9, "correlation")


@query
def risk_highest_plant(t: Testbed) -> DataFrame:
    return risk_page.highest_risk_plant(scored(t))


@query
def risk_top20(t: Testbed) -> DataFrame:
    return risk_page.top_orders(scored(t))


@query
def risk_top20_labelled(t: Testbed) -> DataFrame:
    return risk_page.top_labelled_orders(located_orders(t))


@query
def risk_histogram(t: Testbed) -> DataFrame:
    return risk_page.score_histogram(t.work_orders.join(dimension(t.plants, "plant_id"), "plant_id"))


@query
def product_list(t: Testbed) -> DataFrame:
    return common.distinct_values(located_orders(t), "product_type")


# Equipment page

_TEST_OVERHEAT = 65.5  # the benchmark readings are cooler than the default limit


@query
def temp_daily_rolling(t: Testbed) -> DataFrame:
    out = equipment.daily_temperature(located_readings(t))
    return rounded(out, 9, "temperature_c", "vibration_hz", "temp_7d")


@query
def overheat_islands(t: Testbed) -> DataFrame:
    return equipment.overheat_spans(equipment.daily_temperature(located_readings(t)), _TEST_OVERHEAT)


@query
def temp_raw_sample(t: Testbed) -> DataFrame:
    return equipment.raw_sample(located_readings(t))


@query
def vibration_p99(t: Testbed) -> DataFrame:
    return rounded(equipment.vibration_p99(located_readings(t)), 9, "p99_vibration")


@query
def vibration_events(t: Testbed) -> DataFrame:
    return equipment.vibration_events(located_readings(t))


@query
def temp_vibration_correlation(t: Testbed) -> DataFrame:
    return rounded(equipment.temp_vibration_correlation(located_readings(t)), 9, "r")


@query
def equipment_insight(t: Testbed) -> DataFrame:
    return rounded(equipment.insight(located_readings(t)), 9, "strongest_r")


@query
def anomaly_rate(t: Testbed) -> DataFrame:
    return equipment.anomaly_rate(t.machine_telemetry)


# Quality page


@query
def defect_pareto(t: Testbed) -> DataFrame:
    return quality.defect_pareto(located_orders(t))


@query
def defect_pareto_filtered(t: Testbed) -> DataFrame:
    plants = [r["plant_name"] for r in common.distinct_values(t.plants, "plant_name").limit(3).collect()]
    orders, _ = quality.drill_inputs(located_orders(t), t.plants, plants, ["ECONOMY", "SMALL", "LARGE"])
    return quality.defect_pareto(orders)


@query
def defect_pareto_rate(t: Testbed) -> DataFrame:
    return quality.defect_pareto_with_rate(t.work_orders.filter(F.col("risk_score").isNotNull()))


@query
def defect_top3(t: Testbed) -> DataFrame:
    return quality.top_products(quality.defect_pareto(located_orders(t)))


@long_query
def sla_by_month(t: Testbed) -> DataFrame:
    return quality.sla_by_month(named_snapshots(t))


@long_query
def sla_heatmap(t: Testbed) -> DataFrame:
    return quality.sla_heatmap(named_snapshots(t))


# Inspections, sensors


@query
def inspection_severity(t: Testbed) -> DataFrame:
    """Severity of every inspection by its own units."""
    level = inspections.severity(F.col("units_failed"), F.col("units_inspected"))
    return t.quality_inspections.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("inspections"), F.sum("units_failed").alias("units_failed"))


@query
def late_finishes(t: Testbed) -> DataFrame:
    """Finished orders that can be inspected, and how many of them ended late, by plant."""
    late = F.coalesce(inspections.late_finish(DEFAULT.kpis.sla_breach_threshold_hours), F.lit(False))
    return inspections.eligible_orders(t.work_orders).groupBy("plant_id").agg(
        F.count(F.lit(1)).alias("eligible"), F.count_if(late).alias("late"))


@query
def sensor_standardise(t: Testbed) -> DataFrame:
    readings = t.machine_telemetry.na.drop(subset=["temperature_c", "vibration_hz", "pressure_bar", "power_kw", "rpm"])
    out = anomaly.scaled(readings, anomaly.fit_scaler(readings))
    out = out.select("telemetry_id", "temperature_c", "vibration_hz", "pressure_bar", "power_kw", "rpm")
    return rounded(out, 6, "temperature_c", "vibration_hz", "pressure_bar", "power_kw", "rpm")


# Splits and metrics


@query
def split_temporal(t: Testbed) -> DataFrame:
    keys = t.work_orders.select("work_order_id", "scheduled_start")
    return split.holdout(keys, 0.8).select("work_order_id", "position", "in_train")


@query
def split_by_plant_order(t: Testbed) -> DataFrame:
    keys = t.work_orders.select("work_order_id", "plant_id", "scheduled_start")
    return split.holdout(keys, 0.8, split.PLANT_ORDER).select("work_order_id", "position", "in_train")


@query
def cv_folds(t: Testbed) -> DataFrame:
    rows = split.with_position(t.work_orders.select("work_order_id", "scheduled_start"))
    n = rows.count()
    roles = [
        F.struct(F.lit(f.number).alias("fold"), split.fold_role(f).alias("role")) for f in split.expanding_folds(n, 5)
    ]
    out = rows.select("work_order_id", "position", F.explode(F.array(*roles)).alias("r"))
    return out.filter("r.role IS NOT NULL").groupBy("r.fold", "r.role").agg(
        F.count(F.lit(1)).alias("orders"), F.min("position").alias("first_position"),
        F.max("position").alias("last_position"), F.sum("work_order_id").alias("id_sum"),
    )


def _labelled(t: Testbed) -> DataFrame:
    rows = features.with_target(t.work_orders).filter(F.col("risk_score").isNotNull())
    return rows.select("work_order_id", "risk_score", features.TARGET)


@query
def auc_roc(t: Testbed) -> DataFrame:
    curve = metrics.score_curve(_labelled(t), "risk_score", features.TARGET)
    return rounded(metrics.auc_roc(curve), 9, "auc_roc")


@query
def avg_precision(t: Testbed) -> DataFrame:
    curve = metrics.score_curve(_labelled(t), "risk_score", features.TARGET)
    return rounded(metrics.average_precision(curve), 9, "auc_pr")


@query
def f1(t: Testbed) -> DataFrame:
    return metrics.f1_score(_labelled(t), features.TARGET, F.col("risk_score") >= 0.65)


@query
def confusion(t: Testbed) -> DataFrame:
    return metrics.confusion_matrix(_labelled(t), features.TARGET, F.col("risk_score") >= 0.65)


@query
def roc_points(t: Testbed) -> DataFrame:
    """Document length as a score for the toxicity label."""
    rows = t.raw("labels").join(t.raw("documents").select("doc_id", "n_chars"), "doc_id")
    return metrics.roc_points(metrics.score_curve(rows.withColumn("s", F.col("n_chars").cast("double")), "s", "toxic"))


@query
def score_evaluation(t: Testbed) -> DataFrame:
    return rounded(metrics.evaluate(_labelled(t), "risk_score", features.TARGET, 0.65), 9,
                   "test_auc_roc", "test_auc_pr", "test_f1", "test_positive_rate")


@query
def class_balance(t: Testbed) -> DataFrame:
    return risk.class_balance(features.with_target(t.work_orders))


@query
def hash_sample_orders(t: Testbed) -> DataFrame:
    return hash_sample(t.work_orders.select("work_order_id", "status"), "work_order_id", 5000, 42)


@query
def write_back_scores(t: Testbed) -> DataFrame:
    """Scores of finished orders replaced by new ones, all other orders unchanged."""
    out = write_back(t.work_orders, _new_scores(t), "work_order_id", ["risk_score", "risk_label"])
    return out.select("work_order_id", half_even("risk_score", 4).alias("risk_score"), "risk_label")


@query
def hash_sample_null_ids(t: Testbed) -> DataFrame:
    """A sample half of whose rows have no id: none is lost."""
    some = t.work_orders.select(F.when(F.col("work_order_id") % 2 == 0, F.col("work_order_id")).alias("id"))
    return hash_sample(some, "id", 6000, 42).agg(F.count(F.lit(1)).alias("rows"), F.count("id").alias("with_id"))


@query
def running_sums_blocks(t: Testbed) -> DataFrame:
    """Running defects over sorted partitions; orders that are not finished add nothing."""
    df = t.work_orders.select("work_order_id", F.when(F.col("status") == "completed", F.col("defect_count")).alias("defects"))
    return running_sums(df, [F.col("work_order_id")], {"total": "defects"}, max_rows=0).select("work_order_id", "total")


@query
def features_schedule_blocks(t: Testbed) -> DataFrame:
    """Order numbers by plant over blocks; orders without a plant have none."""
    some = t.work_orders.withColumn("plant_id", F.when(F.col("work_order_id") % 7 != 0, F.col("plant_id")))
    return features.schedule_features(some, max_group_rows=0).select("work_order_id", "queue_depth")


# Models: whole tables and the parameters of the library.


def _matrix(t: Testbed) -> DataFrame:
    return features.feature_matrix(t.work_orders, t.machines, t.machine_telemetry)


@query
def iforest_score(t: Testbed) -> DataFrame:
    forest = anomaly.fit(t.machine_telemetry, DEFAULT)
    return anomaly.score(t.machine_telemetry, forest, DEFAULT).select("telemetry_id", "anomaly_score", "anomaly_flag")


@query
def iforest_contamination(t: Testbed) -> DataFrame:
    forest = anomaly.fit(t.machine_telemetry, DEFAULT)
    out = anomaly.score(t.machine_telemetry, forest, DEFAULT, mode="contamination")
    return out.select("telemetry_id", "anomaly_score", "anomaly_flag")


@query
def risk_score(t: Testbed) -> DataFrame:
    matrix = materialize(_matrix(t))
    train = materialize(split.holdout(matrix, 0.8).filter("in_train"))
    return risk.score(matrix, risk.fit(risk.vectorize(train), DEFAULT), DEFAULT)


@query
def risk_model_metrics(t: Testbed) -> DataFrame:
    return scorecard.metrics_table(risk.train(materialize(_matrix(t)), DEFAULT).metrics)


@query
def feature_importance(t: Testbed) -> DataFrame:
    matrix = materialize(_matrix(t))
    models = risk.fit(risk.vectorize(matrix), DEFAULT)
    return importance.permutation_importance(matrix, models, DEFAULT)


@query
def feature_attribution(t: Testbed) -> DataFrame:
    """Features of greatest mean absolute attribution in the first model."""
    matrix = materialize(_matrix(t))
    return attribution.attribution_summary(matrix, risk.fit(risk.vectorize(matrix)).a)


@query
def attribution_invariants(t: Testbed) -> DataFrame:
    """What must hold of any fit: all rounds grown, leaves within the bound, and attributions that add up to each margin."""
    matrix = materialize(_matrix(t))
    models = risk.fit(risk.vectorize(matrix))
    found = attribution.attributions(matrix, models.a)
    total = F.aggregate(F.array(*features.FEATURES), F.col("expected"), lambda a, x: a + x)
    leaves = [sum(1 for _ in attribution.leaf_paths(tree)) for tree in models.b.trees]
    return found.agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.abs(total - F.col("margin")) <= 1e-9).alias("explained"),
        F.lit(len(models.a.trees)).alias("rounds_a"), F.lit(len(models.b.trees)).alias("rounds_b"),
        F.lit(sum(n > 63 for n in leaves)).alias("over_the_bound"),
    )


@query
def iforest_invariants(t: Testbed) -> DataFrame:
    """What must hold of any forest's scores: all readings scored, in [-1, 0], incomplete ones 0 and not flagged."""
    readings = t.machine_telemetry
    scored = anomaly.score(readings, anomaly.fit(readings, DEFAULT), DEFAULT)
    complete = F.lit(True)
    for sensor in anomaly.SENSORS:
        complete = complete & F.col(sensor).isNotNull()
    whole = (F.col("anomaly_score") == 0) & ~F.col("anomaly_flag")
    return scored.agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(~complete).alias("incomplete"),
        F.count_if(~F.col("anomaly_score").between(-1, 0)).alias("out_of_range"),
        F.count_if(~complete & ~whole).alias("incomplete_scored"),
    )


@query
def risk_invariants(t: Testbed) -> DataFrame:
    """What must hold of any model's scores: all orders scored, in [0, 1], the label by the threshold."""
    scored = risk_score(t)
    return scored.agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(~F.col("risk_score").between(0, 1)).alias("out_of_range"),
        F.count_if(F.col("risk_score").isNull() | F.col("risk_label").isNull()).alias("unscored"),
    )


@query
def risk_training_invariants(t: Testbed) -> DataFrame:
    """What must hold of any training: the whole hold-out is judged, curves rise from 0 to 1, saved models score alike."""
    matrix = materialize(_matrix(t))
    trained = risk.train(matrix, DEFAULT)
    roc = materialize(risk.roc_by_model(trained.held_out))
    drops = importance.permutation_importance(matrix, trained.models, DEFAULT)
    folder = _folder(t)
    trained.models.save(folder)
    again = risk.score(matrix, risk.RiskModels.load(folder), DEFAULT).withColumnRenamed("risk_score", "again")
    both = risk.score(matrix, trained.models, DEFAULT).join(again.select("work_order_id", "again"), "work_order_id")
    figures = trained.metrics.select(F.col("test_n").alias("held_out"), F.size("feature_names").alias("features"))
    ends = roc.groupBy("model").agg(F.min("fpr").alias("lo"), F.max("fpr").alias("hi"), F.max("tpr").alias("top"))
    return figures.withColumns({
        "models": F.lit(ends.filter("lo = 0 AND hi = 1 AND top = 1").count()).cast("long"),
        "outside": F.lit(roc.filter("NOT (fpr BETWEEN 0 AND 1 AND tpr BETWEEN 0 AND 1 AND auc BETWEEN 0 AND 1)").count()),
        "important": F.lit(drops.select("feature").distinct().count()).cast("long"),
        "scored_alike": F.lit(both.filter("risk_score = again").count()).cast("long"),
    })


# Sources and sinks: what is written and read again equals its source.


def _folder(t: Testbed) -> str:
    return f"{ensure_checkpoint_dir(t.spark)}/io-{uuid.uuid4().hex}"


_STORED_ORDER = (
    "work_order_id", "machine_id", "created_at", "actual_end", "status", "product_type", "actual_units", "risk_score",
    "risk_label",
)


@query
def csv_round_trip(t: Testbed) -> DataFrame:
    """Orders through CSV text, with ids beyond the integers that a double holds."""
    path = _folder(t)
    shifted = t.work_orders.withColumn("work_order_id", F.col("work_order_id") + F.lit((1 << 53) + 1))
    write_csv(shifted, path)
    return read_csv(t.spark, path, WORK_ORDERS).select(*_STORED_ORDER)


@query
def bulk_load_orders(t: Testbed) -> DataFrame:
    """Orders and machines loaded from CSV files twice; the second load replaces the first, stored decimals hold."""
    path = _folder(t)
    write_csv(t.machines, f"{path}/csv/machines.csv")
    write_csv(t.work_orders.drop("downtime_minutes"), f"{path}/csv/work_orders.csv")
    for _ in range(2):
        load_csvs(t.spark, f"{path}/csv", f"{path}/tables")
    return read_tables(t.spark, f"{path}/tables").work_orders.select(*_STORED_ORDER, "downtime_minutes")


@query
def parquet_round_trip(t: Testbed) -> DataFrame:
    path = _folder(t)
    write_parquet(t.machine_telemetry, path)
    return read_parquet(t.spark, path, MACHINE_TELEMETRY)


@query
def matrix_round_trip(t: Testbed) -> DataFrame:
    path = _folder(t)
    write_parquet(_matrix(t), path)
    stored = read_parquet(t.spark, path).drop("plant_id", "scheduled_start")
    return rounded(stored, 6, *features.FEATURES)


@query
def snapshot_sink(t: Testbed) -> DataFrame:
    """Snapshots by day: all days stored, then the later half replaced by itself."""
    path = _folder(t)
    rows = materialize(snapshots(t))
    write_snapshots(rows, path, replace_days_only=True)
    middle = rows.agg(F.percentile_approx(F.unix_date("snapshot_date"), 0.5)).first()[0]
    write_snapshots(rows.filter(F.unix_date("snapshot_date") > F.lit(middle)), path, replace_days_only=True)
    return read_parquet(t.spark, path, KPI_SNAPSHOTS)


@query
def views_refreshed(t: Testbed) -> DataFrame:
    """The stored plant summary after two refreshes."""
    path = _folder(t)
    rows = materialize(snapshots(t))
    for _ in range(2):
        views.refresh_all_views(rows, t.work_orders, t.plants, t.machines, path)
    return read_parquet(t.spark, f"{path}/mv_plant_summary")


@query
def metrics_round_trip(t: Testbed) -> DataFrame:
    path = _folder(t)
    record = metrics.evaluate(_labelled(t), "risk_score", features.TARGET, 0.65)
    write_metrics(record, path)
    return rounded(read_metrics(t.spark, path, record.schema), 9, "test_auc_roc", "test_auc_pr", "test_f1", "test_positive_rate")


@query
def invalid_status_values(t: Testbed) -> DataFrame:
    """Orders every 11th of which has its priority in place of its status: the unknown values by name."""
    mixed = F.when(F.col("work_order_id") % 11 == 0, F.col("priority")).otherwise(F.col("status"))
    return validation.invalid_statuses(t.work_orders.withColumn("status", mixed))


@query
def validate_kpi_constraints(t: Testbed) -> DataFrame:
    return validation.constraint_checks({"kpi_snapshots": materialize(snapshots(t)), "plants": t.plants})


# Published tables: merges, replaced days, views by difference, rejected lines.


def _new_scores(t: Testbed) -> DataFrame:
    done = t.work_orders.filter(F.col("status") == "completed")
    return done.select("work_order_id", (F.lit(1.0) - F.col("risk_score")).alias("risk_score"), F.lit(0).alias("risk_label"))


@query
def merge_scores(t: Testbed) -> DataFrame:
    """The update of ``write_back_scores`` as a merge into a published table."""
    root, buckets = _folder(t), DEFAULT.load.buckets
    base = publish(t.spark, root, Version(), {"work_orders": stage(t.work_orders, root, "work_orders", ["work_order_id"], buckets)})
    merged = stage_merge(t.spark, root, base, "work_orders", materialize(_new_scores(t)), ["risk_score", "risk_label"])
    publish(t.spark, root, base, {"work_orders": merged})
    out = read_published(t.spark, root, "work_orders", WORK_ORDERS)
    return out.select("work_order_id", half_even("risk_score", 4).alias("risk_score"), "risk_label")


def _published_snapshots(t: Testbed) -> tuple[str, DataFrame]:
    """Snapshots with wrong defect rates on later days, and earlier days repeated ten years before, where there are none."""
    root = _folder(t)
    rows = materialize(as_stored(snapshots(t), refresh.KPIS).select(*KPI_SNAPSHOTS.names))
    late = F.col("snapshot_date") > F.lit("2024-01-15").cast("date")
    wrong = rows.withColumn("defect_rate", F.when(late, F.col("oee_score")).otherwise(F.col("defect_rate")))
    extra = rows.filter(~late).withColumn("snapshot_date", F.date_add("snapshot_date", -3650))
    table = stage(wrong.unionByName(extra), root, refresh.KPIS, ["snapshot_date"], DEFAULT.load.buckets)
    publish(t.spark, root, Version(), {refresh.KPIS: table})
    return root, rows


def _put_right(t: Testbed, root: str, rows: DataFrame) -> None:
    """Replace the days that differ: later ones change, those that do not exist go."""
    base = latest(t.spark, root)
    days = materialize(refresh.changed_days(t.spark, root, rows.withColumns({
        f.name: F.col(f.name).cast(f.dataType) for f in KPI_SNAPSHOTS.fields})))
    new = rows.join(days, "snapshot_date", "left_semi")
    publish(t.spark, root, base, {refresh.KPIS: stage_replace(t.spark, root, base, refresh.KPIS, days, new)})


@query
def snapshot_days_replaced(t: Testbed) -> DataFrame:
    root, rows = _published_snapshots(t)
    _put_right(t, root, rows)
    return read_published(t.spark, root, refresh.KPIS, KPI_SNAPSHOTS)


def _refreshed_twice(t: Testbed, view: str) -> DataFrame:
    root, rows = _published_snapshots(t)
    refresh.refresh_views(t.spark, root, t.work_orders, t.plants, t.machines)
    _put_right(t, root, rows)
    refresh.refresh_views(t.spark, root, t.work_orders, t.plants, t.machines)
    return read_stored(t.spark, root, latest(t.spark, root), view)


@query
def summary_by_difference(t: Testbed) -> DataFrame:
    """The plant summary after a refresh that retracts wrong days, takes out others and adds the right ones."""
    return _refreshed_twice(t, refresh.SUMMARY)


@query
def daily_oee_by_difference(t: Testbed) -> DataFrame:
    out = _refreshed_twice(t, refresh.DAILY)
    return out.withColumns({c: F.col(c).cast("double") for c, kind in out.dtypes if kind.startswith("decimal")})


@query
def csv_rejects(t: Testbed) -> DataFrame:
    """Orders through CSV with unreadable cells: every order is either loaded or rejected with the columns at fault."""
    path, n = _folder(t), F.col("work_order_id")
    texts = t.work_orders.withColumns({
        "planned_units": F.concat(F.col("planned_units"), F.when(n % 17 == 0, F.lit("?")).otherwise(F.lit(""))),
        "created_at": F.when(n % 23 == 0, F.lit("soon")).otherwise(F.col("created_at").cast("string")),
    })
    write_csv(texts, path)
    checked = check_csv(t.spark, path, WORK_ORDERS)
    loaded = checked.accepted().select("work_order_id", "planned_units", F.lit(None).cast("string").alias("rejected_for"))
    names = F.concat_ws(",", F.transform("reasons", lambda r: r["column"]))
    number = F.split_part("line", F.lit(","), F.lit(1)).cast("long")
    bad = checked.rejected().select(number.alias("work_order_id"), F.lit(None).cast("int").alias("planned_units"), names.alias("rejected_for"))
    return loaded.unionByName(bad)


@query
def scan_partitions(t: Testbed) -> DataFrame:
    """Rows in each part of a scan planned from key quantiles; a third of the keys is one machine, some are NULL."""
    n = F.col("work_order_id")
    keys = t.work_orders.select(
        F.when(n % 3 == 0, F.lit(5)).when(n % 41 != 0, F.col("machine_id")).alias("machine_id"))
    met = [F.expr(p).cast("int") for p in scan_predicates(keys, "machine_id", 8)]
    times = F.lit(0)
    for hit in met:
        times = times + F.coalesce(hit, F.lit(0))
    return keys.groupBy(times.alias("parts_of_row")).agg(F.count(F.lit(1)).alias("rows"), F.count("machine_id").alias("keyed"))


# ROC corners, parameters from text, lenient times, absent columns, the gate, and the drill inputs' KPIs.


@query
def roc_corners(t: Testbed) -> DataFrame:
    rows = t.raw("labels").join(t.raw("documents").select("doc_id", "n_chars"), "doc_id")
    return metrics.roc_corners(metrics.score_curve(rows.withColumn("s", F.col("n_chars").cast("double")), "s", "toxic"))


@query
def roc_corners_blocks(t: Testbed) -> DataFrame:
    """Corners over sorted partitions whose neighbours are carried across."""
    curve = metrics.score_curve(_labelled(t), "risk_score", features.TARGET)
    return rounded(metrics.roc_corners(curve, max_rows=0), 9, "fpr", "tpr")


@query
def kpi_with_parameters(t: Testbed) -> DataFrame:
    """Snapshots with parameters from a text: breaches from one hour on, MTBF of at most two days."""
    cfg = parse_config('{"kpis": {"sla_breach_threshold_hours": 1, "mtbf_cap_hours": 48.0}}')
    return kpis.daily_snapshots(t.work_orders, t.machines, t.machine_telemetry, cfg.kpis)


@query
def lenient_timestamps(t: Testbed) -> DataFrame:
    """Times as text, every 13th of them unreadable."""
    text = F.when(F.col("work_order_id") % 13 == 0, F.lit("31 of never")).otherwise(F.col("created_at").cast("string"))
    return parse_timestamps(t.work_orders.select("work_order_id", text.alias("created_at")), "created_at")


@query
def validate_absent_columns(t: Testbed) -> DataFrame:
    """Orders without planned units, defects and status: their null rates are 1, checks on them are left out."""
    return validation.validate_work_orders(t.work_orders.drop("planned_units", "defect_count", "status"))


@query
def matrix_absent_features(t: Testbed) -> DataFrame:
    """Features that no column gives, by name, and that the matrix has them as 0 in every row."""
    some = features.static_features(t.work_orders)
    absent = features.missing_features(some)
    matrix = features.select_matrix(some)
    zero = [F.struct(F.lit(c).alias("feature"), F.count_if(F.col(c) == 0).alias("zeros")) for c in absent]
    return matrix.agg(F.array(*zero).alias("found")).select(F.inline("found"))


@query
def validation_gate(t: Testbed) -> DataFrame:
    """Whether the gate stops the checks of each table, beside the number of critical ones."""
    out = None
    for name, results in {
        "work_orders": validation.validate_work_orders(t.work_orders),
        "references": validation.check_references(t.work_orders, t.quality_inspections),
    }.items():
        results = materialize(results)
        try:
            validation.gate(results)
            stopped = False
        except validation.ValidationError:
            stopped = True
        row = results.agg(F.lit(name).alias("checks"), F.count_if(F.col("level") == "CRITICAL").alias("critical"),
                          F.lit(stopped).alias("stopped"))
        out = row if out is None else out.unionByName(row)
    return out


@query
def drill_kpis(t: Testbed) -> DataFrame:
    """KPI half of the drill inputs: snapshots of the chosen plants, whatever products are chosen."""
    plants = [r["plant_name"] for r in common.distinct_values(t.plants, "plant_name").limit(3).collect()]
    _, chosen = quality.drill_inputs(located_orders(t), named_snapshots(t), plants, ["ECONOMY"])
    return chosen
