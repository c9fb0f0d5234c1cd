"""Table schemas, keys, domains and column defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_INT, _LONG, _STR, _DBL = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()
_TS, _DATE, _BOOL, _SHORT = T.TimestampType(), T.DateType(), T.BooleanType(), T.ShortType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in cols])


# Columns and types of the stored tables.
PLANTS = _struct(
    ("plant_id", _INT), ("plant_code", _STR), ("plant_name", _STR), ("region", _STR), ("capacity_units", _INT),
)
MACHINES = _struct(
    ("machine_id", _INT), ("machine_code", _STR), ("plant_id", _INT), ("machine_type", _STR),
    ("install_date", _DATE), ("expected_life_years", _INT),
)
WORK_ORDERS = _struct(
    ("work_order_id", _LONG), ("machine_id", _INT), ("plant_id", _INT), ("created_at", _TS),
    ("scheduled_start", _TS), ("actual_start", _TS), ("scheduled_end", _TS), ("actual_end", _TS),
    ("status", _STR), ("priority", _STR), ("product_type", _STR), ("planned_units", _INT), ("actual_units", _INT),
    ("defect_count", _INT), ("downtime_minutes", _INT), ("operator_id", _INT), ("failure_mode", _STR),
    ("risk_score", _DBL), ("risk_label", _SHORT),
)
MACHINE_TELEMETRY = _struct(
    ("telemetry_id", _LONG), ("machine_id", _INT), ("recorded_at", _TS), ("temperature_c", _DBL),
    ("vibration_hz", _DBL), ("pressure_bar", _DBL), ("power_kw", _DBL), ("rpm", _DBL),
    ("anomaly_flag", _BOOL), ("anomaly_score", _DBL),
)
QUALITY_INSPECTIONS = _struct(
    ("inspection_id", _LONG), ("work_order_id", _LONG), ("inspected_at", _TS), ("inspector_id", _INT),
    ("units_inspected", _INT), ("units_passed", _INT), ("units_failed", _INT), ("defect_type", _STR),
    ("severity", _STR), ("sla_breach", _BOOL),
)
KPI_SNAPSHOTS = _struct(
    ("snapshot_date", _DATE), ("plant_id", _INT), ("oee_score", _DBL), ("availability_rate", _DBL),
    ("performance_rate", _DBL), ("quality_rate", _DBL), ("mttr_hours", _DBL), ("mtbf_hours", _DBL),
    ("sla_breach_rate", _DBL), ("defect_rate", _DBL), ("high_risk_wo_count", _LONG), ("anomaly_count", _LONG),
    ("throughput_units", _LONG),
)

# Decimal types the stored tables declare, applied when a table is written.
STORED_DECIMALS = {
    "work_orders": {"risk_score": (6, 4)},
    "machine_telemetry": {
        "temperature_c": (6, 2), "vibration_hz": (8, 4), "pressure_bar": (6, 3), "power_kw": (7, 3), "rpm": (7, 1),
        "anomaly_score": (7, 4),
    },
    "kpi_snapshots": {
        "oee_score": (6, 4), "availability_rate": (6, 4), "performance_rate": (6, 4), "quality_rate": (6, 4),
        "mttr_hours": (8, 2), "mtbf_hours": (8, 2), "sla_breach_rate": (6, 4), "defect_rate": (6, 4),
    },
}

# Category domains.
STATUSES = ("completed", "failed", "delayed", "in_progress", "cancelled")
PRIORITIES = ("critical", "high", "medium", "low")
SEVERITIES = ("minor", "major", "critical")
SENSORS = ("temperature_c", "vibration_hz", "pressure_bar", "power_kw", "rpm")


@dataclass(frozen=True)
class TableRules:
    """Constraints of one table, checked by ``plans.validation.constraint_checks``."""

    schema: T.StructType
    not_null: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: dict[str, str] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)


# Constraints and defaults. Load order: a table comes after the tables it refers to.
TABLES: dict[str, TableRules] = {
    "plants": TableRules(
        PLANTS, ("plant_id", "plant_code", "plant_name", "capacity_units"), (("plant_id",), ("plant_code",)),
    ),
    "machines": TableRules(
        MACHINES,
        ("machine_id", "machine_code", "plant_id", "machine_type", "install_date", "expected_life_years"),
        (("machine_id",), ("machine_code",)),
        {"plant_id": "plants"},
        defaults={"expected_life_years": 15},
    ),
    "work_orders": TableRules(
        WORK_ORDERS,
        ("work_order_id", "machine_id", "plant_id", "created_at", "scheduled_start", "scheduled_end", "status",
         "priority", "product_type", "planned_units", "defect_count", "downtime_minutes"),
        (("work_order_id",),),
        {"machine_id": "machines", "plant_id": "plants"},
        {"status": STATUSES, "priority": PRIORITIES},
        {"defect_count": 0, "downtime_minutes": 0},
    ),
    "machine_telemetry": TableRules(
        MACHINE_TELEMETRY,
        ("telemetry_id", "machine_id", "recorded_at"),
        (("telemetry_id",),),
        {"machine_id": "machines"},
        defaults={"anomaly_flag": False},
    ),
    "quality_inspections": TableRules(
        QUALITY_INSPECTIONS,
        ("inspection_id", "work_order_id", "inspected_at", "units_inspected", "units_passed", "units_failed",
         "sla_breach"),
        (("inspection_id",),),
        {"work_order_id": "work_orders"},
        {"severity": SEVERITIES},
        {"sla_breach": False},
    ),
    "kpi_snapshots": TableRules(
        KPI_SNAPSHOTS, ("snapshot_date", "plant_id"), (("snapshot_date", "plant_id"),), {"plant_id": "plants"},
    ),
}
