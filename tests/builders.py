"""Small typed frames for hand-computed cases."""

from __future__ import annotations

from datetime import datetime, timedelta

from millwright.schemas import MACHINE_TELEMETRY, QUALITY_INSPECTIONS, WORK_ORDERS

T0 = datetime(2022, 1, 1, 1, 0)


def orders(spark, rows: list[dict]):
    """Good orders, six hours apart, with the given columns replaced."""
    out = []
    for i, change in enumerate(rows):
        start = change.get("scheduled_start", T0 + timedelta(hours=6 * i))
        base = {
            "work_order_id": i + 1, "machine_id": 1, "plant_id": 1,
            "created_at": start - timedelta(hours=1) if start else T0, "scheduled_start": start,
            "scheduled_end": start + timedelta(hours=8) if start else T0, "actual_start": start,
            "actual_end": start + timedelta(hours=8) if start else T0, "status": "completed", "priority": "medium",
            "product_type": "Widget-A", "planned_units": 100, "actual_units": 98, "defect_count": 2,
            "downtime_minutes": 5, "operator_id": None, "failure_mode": None, "risk_score": None, "risk_label": None,
        } | change
        out.append(tuple(base[c] for c in WORK_ORDERS.names))
    return spark.createDataFrame(out, WORK_ORDERS)


def readings(spark, rows: list[dict]):
    out = []
    for i, change in enumerate(rows):
        base = {
            "telemetry_id": i + 1, "machine_id": 1, "recorded_at": T0 + timedelta(hours=i), "temperature_c": 65.0,
            "vibration_hz": 12.0, "pressure_bar": 8.0, "power_kw": 45.0, "rpm": 3000.0, "anomaly_flag": None,
            "anomaly_score": None,
        } | change
        out.append(tuple(base[c] for c in MACHINE_TELEMETRY.names))
    return spark.createDataFrame(out, MACHINE_TELEMETRY)


def inspections(spark, rows: list[dict]):
    out = []
    for i, change in enumerate(rows):
        base = {
            "inspection_id": i + 1, "work_order_id": i + 1, "inspected_at": T0, "inspector_id": None,
            "units_inspected": 10, "units_passed": 9, "units_failed": 1, "defect_type": None, "severity": "minor",
            "sla_breach": False,
        } | change
        out.append(tuple(base[c] for c in QUALITY_INSPECTIONS.names))
    return spark.createDataFrame(out, QUALITY_INSPECTIONS)


def machines(spark, ids=(1,), plant=1):
    rows = [(m, f"M{m}", plant, "CNC", datetime(2020, 1, 1).date(), 15) for m in ids]
    from millwright.schemas import MACHINES
    return spark.createDataFrame(rows, MACHINES)


def plants(spark, names=("Alpha",)):
    from millwright.schemas import PLANTS
    rows = [(i + 1, f"PLT-{i + 1}", n, n, 1000) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, PLANTS)


def column(df, name, by="work_order_id"):
    return [r[name] for r in df.orderBy(by).select(by, name).collect()]
