"""Parameters of all stages, as frozen dataclasses."""

from __future__ import annotations

import json
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any, get_type_hints

Range = tuple[float, float]


# Thresholds, ranges and model parameters that results depend on.
@dataclass(frozen=True)
class ValidationConfig:
    max_null_rate: float = 0.02
    range_warning_share: float = 0.001
    range_critical_share: float = 0.01
    temperature_range: Range = (15.0, 120.0)
    vibration_range: Range = (0.0, 50.0)
    pressure_range: Range = (0.5, 20.0)
    power_range: Range = (0.0, 500.0)
    rpm_range: Range = (0.0, 5000.0)

    @property
    def sensor_ranges(self) -> dict[str, Range]:
        return {
            "temperature_c": self.temperature_range,
            "vibration_hz": self.vibration_range,
            "pressure_bar": self.pressure_range,
            "power_kw": self.power_range,
            "rpm": self.rpm_range,
        }


@dataclass(frozen=True)
class FeatureConfig:
    telemetry_lookback_hours: int = 24
    telemetry_bucket: str = "hour"
    machine_rows: int = 30
    plant_rate_rows: int = 7
    plant_utilization_rows: int = 14
    queue_modulus: int = 20
    exclude_current: bool = False


@dataclass(frozen=True)
class AnomalyConfig:
    n_estimators: int = 200
    max_samples: int = 256
    contamination: float = 0.03
    random_state: int = 42


@dataclass(frozen=True)
class BoostConfig:
    n_estimators: int = 400
    max_depth: int = 6
    learning_rate: float = 0.05
    subsample: float = 1.0
    colsample: float = 1.0
    positive_weight: float = 1.0
    min_rows_per_leaf: int = 1
    random_state: int = 42
    l2: float = 1.0
    min_hessian: float = 1.0
    max_leaves: int = 0  # no bound beside the depth


@dataclass(frozen=True)
class ModelConfig:
    anomaly: AnomalyConfig = field(default_factory=AnomalyConfig)
    boost_a: BoostConfig = field(
        default_factory=lambda: BoostConfig(subsample=0.8, colsample=0.8, positive_weight=4.0)
    )
    boost_b: BoostConfig = field(default_factory=lambda: BoostConfig(min_rows_per_leaf=20, l2=0.0, min_hessian=1e-3, max_leaves=63))
    cv_splits: int = 5
    train_share: float = 0.80
    ensemble_weights: tuple[float, float] = (0.5, 0.5)


@dataclass(frozen=True)
class KpiConfig:
    oee_target: float = 0.85
    sla_breach_threshold_hours: float = 2.0
    high_risk_score_threshold: float = 0.65
    anomaly_score_threshold: float = -0.1
    minutes_per_machine: float = 1440.0
    mtbf_cap_hours: float = 9999.0
    mtbf_default_uptime_hours: float = 24.0


@dataclass(frozen=True)
class ReportConfig:
    temperature_limit: float = 95.0
    vibration_limit: float = 35.0
    overheat_gap_days: int = 2
    top_risk_rows: int = 20
    risk_sample_rows: int = 6000
    raw_sample_rows: int = 15000
    anomaly_sample_rows: int = 8000
    importance_sample_rows: int = 5000
    importance_shown: int = 15
    histogram_bins: int = 50
    sample_seed: int = 42


@dataclass(frozen=True)
class LoadConfig:
    """``buckets``: parts of a stored table, of some GB each at full size. A file with a larger share of lines that cannot be
    read than ``max_reject_share`` fails the load; 0 allows none."""

    buckets: int = 16
    max_reject_share: float = 0.0


@dataclass(frozen=True)
class Config:
    validation: ValidationConfig = field(default_factory=ValidationConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    models: ModelConfig = field(default_factory=ModelConfig)
    kpis: KpiConfig = field(default_factory=KpiConfig)
    reports: ReportConfig = field(default_factory=ReportConfig)
    load: LoadConfig = field(default_factory=LoadConfig)


DEFAULT = Config()


class UnknownParameter(ValueError):
    """A parameter that does not exist, or a value of another type than its default."""


def parse_config(text: str, fmt: str = "json") -> Config:
    """Parameters from JSON or TOML text, sections nested as in ``Config``; what is not named keeps its default.

    Unknown names and values of the wrong type are errors, named by their whole path.
    """
    if fmt not in ("json", "toml"):
        raise ValueError(f"parameters are read from json or toml, not {fmt}")
    return _build(DEFAULT, json.loads(text) if fmt == "json" else tomllib.loads(text), "")


def _build(default: Any, given: Any, path: str) -> Any:
    if not isinstance(given, Mapping):
        raise UnknownParameter(f"{path or 'parameters'}: a section is expected")
    known = {f.name: getattr(default, f.name) for f in fields(default)}
    if unknown := [f"{path}{name}" for name in given if name not in known]:
        raise UnknownParameter(", ".join(sorted(unknown)))
    hints = get_type_hints(type(default))
    changed = {}
    for name, value in given.items():
        old, at = known[name], f"{path}{name}"
        changed[name] = _build(old, value, f"{at}.") if is_dataclass(old) else _value(hints[name], old, value, at)
    return type(default)(**{**known, **changed})


def _value(kind: Any, old: Any, value: Any, at: str) -> Any:
    if isinstance(old, tuple):
        if not isinstance(value, (list, tuple)) or len(value) != len(old):
            raise UnknownParameter(f"{at}: {len(old)} values are expected")
        return tuple(_value(type(o), o, v, at) for o, v in zip(old, value))
    if kind is float and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if not isinstance(value, kind) or isinstance(value, bool) != (kind is bool):
        raise UnknownParameter(f"{at}: {kind.__name__} is expected, not {value!r}")
    return value
