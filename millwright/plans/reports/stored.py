"""All report datasets of a run, from the stored snapshots, orders and readings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millwright.config import DEFAULT, Config
from millwright.plans import views
from millwright.plans.reports import equipment, executive, quality, risk, scorecard
from millwright.session import materialize
from millwright.sources.readers import Tables

AVERAGED = ("oee_score", "sla_breach_rate", "defect_rate", "mttr_hours")


def report_datasets(tables: Tables, snapshots: DataFrame, cfg: Config = DEFAULT) -> dict[str, DataFrame]:
    """Name -> dataset for every page of the reports, without plant or product filters.

    ``tables`` holds scored orders and readings. Located orders and readings feed several datasets each; only the
    columns the pages use are stored, once.
    """
    conf = cfg.reports
    kpis = views.with_plant_name(snapshots, tables.plants)
    orders = materialize(views.orders_located(tables.work_orders, tables.plants, tables.machines).select(
        "work_order_id", "plant_name", "machine_code", "machine_type", "priority", "status", "product_type",
        "planned_units", "actual_units", "defect_count", "risk_score", "risk_label",
    ))
    readings = materialize(equipment.typed_readings(
        views.readings_located(tables.machine_telemetry, tables.plants, tables.machines)
    ).select("telemetry_id", "plant_name", "recorded_at", "temperature_c", "vibration_hz", "anomaly_flag"))

    trend = executive.oee_trend(kpis)
    scored = risk.scored_orders(orders)
    sample = materialize(risk.scatter_sample(scored, cfg))
    daily = equipment.daily_temperature(readings)
    pareto = quality.defect_pareto(orders)
    card = scorecard.scorecard(kpis, cfg.kpis.oee_target)
    return {
        "executive_month_over_month": executive.month_over_month(kpis),
        "executive_high_risk": executive.high_risk_summary(kpis, tables.work_orders),
        "executive_oee_trend": trend,
        "executive_oee_gap": executive.oee_gap(trend, cfg.kpis.oee_target),
        "executive_plant_averages": executive.plant_averages(kpis, AVERAGED),
        "executive_mttr_trend": executive.kpi_series(kpis, "mttr_hours"),
        "risk_scatter": sample,
        "risk_by_size": risk.risk_by_size(sample),
        "risk_insight": risk.insight(scored, cfg.kpis.high_risk_score_threshold),
        "risk_top_orders": risk.top_orders(scored, conf.top_risk_rows),
        "risk_top_labelled": risk.top_labelled_orders(orders, conf.top_risk_rows),
        "risk_histogram": risk.score_histogram(orders, conf.histogram_bins),
        "equipment_daily_temperature": daily,
        "equipment_overheat_spans": equipment.overheat_spans(daily, conf.temperature_limit, conf.overheat_gap_days),
        "equipment_raw_sample": equipment.raw_sample(readings, conf),
        "equipment_vibration": equipment.vibration_events(readings, conf),
        "equipment_correlation": equipment.temp_vibration_correlation(readings),
        "equipment_insight": equipment.insight(readings, conf),
        "equipment_anomaly_rate": equipment.anomaly_rate(readings),
        "quality_pareto": pareto,
        "quality_top_products": quality.top_products(pareto),
        "quality_pareto_with_rate": quality.defect_pareto_with_rate(orders),
        "quality_sla_by_month": quality.sla_by_month(kpis),
        "scorecard": card,
        "scorecard_printed": scorecard.scorecard_text(card),
        "plant_performance": scorecard.plant_performance(kpis),
    }
