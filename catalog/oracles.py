"""DuckDB SQL for the registered queries, written against the same benchmark tables."""

from __future__ import annotations

from catalog import testbed as tb

_D = tb.DUCKDB
_N_MACHINES = "(SELECT count(*) FROM supplier)"
_N_PARTS = "(SELECT count(*) FROM part)"


def _round(expr: str, digits: int) -> str:
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits})"


def _mean(column: str, scale: int, over: str = "") -> str:
    """Average of values with ``scale`` decimals, summed as integers."""
    total = f"CAST(sum(CAST(round_even({column} * 1e{scale}, 0) AS BIGINT)) {over} AS DOUBLE)"
    return f"({total} / count({column}) {over} / 1e{scale})"


_KPI_COLUMNS = (
    "oee_score, availability_rate, performance_rate, quality_rate, mttr_hours, mtbf_hours, sla_breach_rate, "
    "defect_rate, high_risk_wo_count, anomaly_count, throughput_units"
)


def _kpis(orders: str) -> str:
    return f"""
SELECT snapshot_date, k.plant_id, {_round('av * pf * ql', 4)} AS oee_score, {_round('av', 4)} AS availability_rate,
       {_round('pf', 4)} AS performance_rate, {_round('ql', 4)} AS quality_rate,
       {_round('CASE WHEN f > 0 THEN t / 60e0 / f ELSE 0e0 END', 2)} AS mttr_hours,
       {_round('least(CASE WHEN f > 0 THEN up / f ELSE up END, 9999e0)', 2)} AS mtbf_hours,
       {_round('CAST(b AS DOUBLE) / n', 4)} AS sla_breach_rate,
       {_round('CASE WHEN a > 0 THEN least(d / a, 1e0) ELSE 0e0 END', 4)} AS defect_rate,
       hr AS high_risk_wo_count, CAST(coalesce(an.anomaly_count, 0) AS BIGINT) AS anomaly_count,
       CAST(a AS BIGINT) AS throughput_units
FROM (
  SELECT *, greatest((m * 1440e0 - t) / (m * 1440e0), 0e0) AS av,
         CASE WHEN p > 0 THEN least(greatest(a / p, 0e0), 1e0) ELSE 0e0 END AS pf,
         CASE WHEN a > 0 THEN least(greatest((a - d) / a, 0e0), 1e0) ELSE 0e0 END AS ql,
         coalesce(us / 36e8, 24e0) AS up
  FROM (
    SELECT plant_id, CAST(scheduled_start AS DATE) AS snapshot_date, greatest(count(DISTINCT machine_id), 1) AS m,
           count(*) AS n, count(*) FILTER (WHERE status = 'failed') AS f,
           count(*) FILTER (WHERE status IN ('failed', 'delayed') AND coalesce(downtime_minutes, 0) > 120) AS b,
           CAST(sum(coalesce(actual_units, 0)) AS DOUBLE) AS a, CAST(sum(planned_units) AS DOUBLE) AS p,
           CAST(sum(coalesce(defect_count, 0)) AS DOUBLE) AS d, CAST(sum(coalesce(downtime_minutes, 0)) AS DOUBLE) AS t,
           CAST(sum(greatest(epoch_us(scheduled_end) - epoch_us(scheduled_start), 0))
                FILTER (WHERE status = 'completed') AS DOUBLE) AS us,
           count(*) FILTER (WHERE risk_label = 1) AS hr
    FROM {orders} WHERE machine_id IN (SELECT machine_id FROM machines)
    GROUP BY ALL
  ) s
) k
LEFT JOIN anomalies an ON an.plant_id = k.plant_id AND an.day = k.snapshot_date"""


# Named sub-queries: (SQL, the sub-queries it reads).
_PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "plants": (tb.plants_sql("region"), ()),
    "machines": (tb.machines_sql("supplier", "nation", _D), ()),
    "wo": (tb.work_orders_sql("orders", "machines", "part", _N_MACHINES, _N_PARTS, _D), ("machines",)),
    "wol": (tb.work_orders_sql("orders", "machines", "part", _N_MACHINES, _N_PARTS, _D, True), ("machines",)),
    "tel": (tb.telemetry_sql("events", _N_MACHINES, _D), ()),
    "woc": (
        tb.work_orders_sql("orders", "machines", "part", _N_MACHINES, _N_PARTS, _D, with_cents=True), ("machines",)),
    "insp": (tb.inspections_sql("woc", _D), ("woc",)),
    "anomalies": (
        "SELECT plant_id, CAST(recorded_at AS DATE) AS day, CAST(sum(CAST(anomaly_flag AS INT)) AS BIGINT) "
        "AS anomaly_count FROM tel JOIN machines USING (machine_id) GROUP BY ALL", ("tel", "machines")),
    "kpi": (_kpis("wo"), ("wo", "machines", "anomalies")),
    "kpil": (_kpis("wol"), ("wol", "machines", "anomalies")),
    "kpin": ("SELECT kpi.*, plant_name FROM kpi JOIN plants USING (plant_id)", ("kpi", "plants")),
    "kpiln": ("SELECT kpil.*, plant_name FROM kpil JOIN plants USING (plant_id)", ("kpil", "plants")),
    "wop": (
        "SELECT wo.*, plant_name, machine_code, machine_type FROM wo JOIN plants USING (plant_id) "
        "JOIN (SELECT machine_id, machine_code, machine_type FROM machines) USING (machine_id)",
        ("wo", "plants", "machines")),
    "telp": (
        "SELECT tel.*, plant_id, plant_name, machine_code FROM tel "
        "JOIN (SELECT machine_id, machine_code, plant_id FROM machines) USING (machine_id) "
        "JOIN (SELECT plant_id, plant_name FROM plants) USING (plant_id)", ("tel", "machines", "plants")),
    "scored": ("SELECT * FROM wop WHERE risk_score IS NOT NULL AND planned_units IS NOT NULL", ("wop",)),
    "sampled": (
        "SELECT * FROM scored ORDER BY md5(concat(CAST(work_order_id AS VARCHAR), ':42')), work_order_id LIMIT 6000",
        ("scored",)),
    "flagged": ("SELECT * FROM telp WHERE anomaly_flag AND vibration_hz IS NOT NULL", ("telp",)),
    "daily": (
        "SELECT *, avg(temperature_c) OVER (PARTITION BY plant_name ORDER BY date ROWS 6 PRECEDING) AS temp_7d FROM ("
        "SELECT plant_name, CAST(recorded_at AS DATE) AS date, avg(temperature_c) AS temperature_c, "
        "avg(vibration_hz) AS vibration_hz FROM telp GROUP BY ALL)", ("telp",)),
    "hourly": ("", ("tel",)),
    "labelled": (
        "SELECT work_order_id, risk_score, CASE WHEN status IN ('failed', 'delayed') THEN 1 ELSE 0 END AS y "
        "FROM wo WHERE risk_score IS NOT NULL", ("wo",)),
    "curve": (
        "SELECT *, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM (SELECT "
        "risk_score AS s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM labelled "
        "GROUP BY ALL)", ("labelled",)),
}


def _sensor_stats(source: str, keys: str, bucket: str, name: str) -> str:
    group = f"{keys}, {name}"
    return f"""
SELECT {group}, coalesce(avg(temperature_c), 0) AS temp_mean, coalesce(stddev_samp(temperature_c), 0) AS temp_std,
       coalesce(max(temperature_c), 0) AS temp_max, coalesce(avg(vibration_hz), 0) AS vib_mean,
       coalesce(stddev_samp(vibration_hz), 0) AS vib_std, coalesce(max(vibration_hz), 0) AS vib_max,
       coalesce(avg(pressure_bar), 0) AS pres_mean, coalesce(stddev_samp(pressure_bar), 0) AS pres_deviation,
       coalesce(avg(power_kw), 0) AS pwr_mean, count(*) FILTER (WHERE power_kw > pm + 2 * ps) AS pwr_spike_count,
       coalesce(avg(rpm), 0) AS rpm_mean,
       coalesce(CASE WHEN avg(rpm) > 0 THEN stddev_samp(rpm) / avg(rpm) ELSE 0 END, 0) AS rpm_cv,
       count(*) FILTER (WHERE anomaly_flag) AS anomaly_count
FROM (
  SELECT *, avg(power_kw) OVER g AS pm, stddev_samp(power_kw) OVER g AS ps
  FROM (SELECT *, date_trunc('{bucket}', recorded_at) AS {name} FROM {source})
  WINDOW g AS (PARTITION BY {group})
) GROUP BY {group}"""


_PARTS["hourly"] = (_sensor_stats("tel", "machine_id", "hour", "hour"), ("tel",))

_STATS = (
    "temp_mean", "temp_std", "temp_max", "vib_mean", "vib_std", "vib_max", "pres_mean", "pres_deviation", "pwr_mean",
    "pwr_spike_count", "rpm_mean", "rpm_cv", "anomaly_count",
)
_COUNTS = ("pwr_spike_count", "anomaly_count")
_PARTS["lookback"] = (
    "SELECT work_order_id, " + ", ".join(f"coalesce(avg({s}), 0) AS tel_{s}" for s in _STATS) + """
FROM wo LEFT JOIN hourly ON hourly.machine_id = wo.machine_id
 AND hour >= scheduled_start - INTERVAL 24 HOUR AND hour < scheduled_start
GROUP BY work_order_id""", ("wo", "hourly"))

_PARTS["codes"] = (
    "SELECT product_type, CAST(row_number() OVER (ORDER BY product_type) - 1 AS INT) AS product_type_encoded "
    "FROM (SELECT DISTINCT product_type FROM wo WHERE product_type IS NOT NULL)", ("wo",))


def _calendar(start: str) -> str:
    return f"""CAST(isodow({start}) - 1 AS INT) AS day_of_week, CAST(hour({start}) AS INT) AS hour_of_day,
       CAST(isodow({start}) = 1 AS INT) AS is_monday,
       CAST(month({start}) IN (3, 6, 9, 12) AND day({start}) >= 25 AS INT) AS is_end_of_quarter"""


_HOURS = "greatest((epoch_us({b}) - epoch_us({a})) / 36e8, 0)"
_PARTS["fstatic"] = (
    f"""SELECT work_order_id,
       CAST(CASE priority WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'low' THEN 1 ELSE 2 END AS INT)
         AS priority_encoded,
       CAST(coalesce(product_type_encoded, -1) AS INT) AS product_type_encoded, planned_units,
       {_calendar('scheduled_start')}, {_HOURS.format(a='scheduled_start', b='scheduled_end')} AS planned_duration_hours
FROM wo LEFT JOIN codes USING (product_type)""", ("wo", "codes"))
_PARTS["fschedule"] = (
    f"""SELECT work_order_id, {_HOURS.format(a='scheduled_start', b='scheduled_end')} AS planned_duration_hours,
       {_HOURS.format(a='created_at', b='scheduled_start')} AS lead_time_hours,
       CAST(row_number() OVER (PARTITION BY plant_id ORDER BY scheduled_start, work_order_id) % 20 AS INT)
         AS queue_depth,
       CAST({_HOURS.format(a='created_at', b='scheduled_start')} < 2 AS INT) AS overdue_flag FROM wo""", ("wo",))


def _history(frame: str) -> str:
    by = "PARTITION BY machine_id ORDER BY scheduled_start, work_order_id"
    return f"""
SELECT work_order_id, is_failure, {_round('age / 365.25e0', 2)} AS machine_age_years,
       CAST(coalesce(fc, 0) AS BIGINT) AS failure_count_30d, coalesce(dt, 0) AS avg_downtime_30d,
       CASE WHEN lf IS NULL THEN 365e0 ELSE greatest((epoch_us(scheduled_start) - lf) / 864e8, 0) END
         AS days_since_last_failure
FROM (
  SELECT *, sum(is_failure) OVER ({by} {frame}) AS fc, avg(downtime_minutes) OVER ({by} {frame}) AS dt,
         max(CASE WHEN is_failure = 1 THEN epoch_us(scheduled_start) END)
           OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lf,
         greatest(floor((epoch_us(scheduled_start) - epoch_us(CAST(install_date AS TIMESTAMP))) / 864e8), 0) AS age
  FROM (SELECT wo.*, install_date, CAST(status = 'failed' AS INT) AS is_failure
        FROM wo LEFT JOIN (SELECT machine_id, install_date FROM machines) USING (machine_id))
)"""


_PARTS["fhistory"] = (_history("ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"), ("wo", "machines"))
_PARTS["fhistlag"] = (_history("ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING"), ("wo", "machines"))
_PLANT_BY = "PARTITION BY plant_id ORDER BY scheduled_start, work_order_id ROWS"
_PARTS["fplant"] = (
    f"""SELECT work_order_id, defect_rate_wo,
       avg(defect_rate_wo) OVER ({_PLANT_BY} 6 PRECEDING) AS plant_defect_rate_7d,
       avg(CAST(status = 'failed' AS INT)) OVER ({_PLANT_BY} 6 PRECEDING) AS plant_failure_rate_7d,
       avg(CAST(status = 'completed' AS INT)) OVER ({_PLANT_BY} 13 PRECEDING) AS plant_utilization_rate
FROM (SELECT *, CASE WHEN actual_units <> 0
                THEN least(greatest(CAST(defect_count AS DOUBLE) / actual_units, 0), 1) ELSE 0e0 END AS defect_rate_wo
      FROM wo)""", ("wo",))

ORACLES: dict[str, str] = {}


def _needs(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needs(_PARTS[name][1], seen)
            seen.append(name)
    return seen


def _add(key: str, body: str, *uses: str) -> None:
    parts = [f"{name} AS ({_PARTS[name][0].strip()})" for name in _needs(uses, [])]
    ORACLES[key] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


# KPIs and views

_add("kpi_daily_snapshot", "SELECT * FROM kpi", "kpi")
_add("kpi_daily_snapshot_long", "SELECT * FROM kpil", "kpil")
_add("kpi_daily_anomalies", "SELECT * FROM anomalies", "anomalies")
_add("mv_daily_oee", f"""
SELECT snapshot_date AS day, plant_code, plant_name, {_KPI_COLUMNS} FROM kpi JOIN plants USING (plant_id)
""", "kpi", "plants")
_add("mv_plant_summary", f"""
SELECT plant_id, plant_code, plant_name, {_mean('oee_score', 4)} AS avg_oee, {_mean('mttr_hours', 2)} AS avg_mttr_hours,
       {_mean('sla_breach_rate', 4)} AS avg_sla_breach_rate, {_mean('defect_rate', 4)} AS avg_defect_rate,
       CAST(sum(high_risk_wo_count) AS BIGINT) AS total_high_risk_wos,
       CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies, CAST(sum(throughput_units) AS BIGINT) AS total_throughput
FROM kpi JOIN plants USING (plant_id) GROUP BY ALL""", "kpi", "plants")
_add("mv_top_risk", """
SELECT work_order_id, risk_score, risk_label, priority, product_type, status, scheduled_start, scheduled_end,
       planned_units, defect_count, downtime_minutes, plant_name, machine_code, machine_type
FROM wop WHERE risk_label = 1 ORDER BY risk_score DESC, work_order_id""", "wop")

# Validation


def _row(table: str, check: str, value: str, level: str, detail: str, threshold: str = "NULL") -> str:
    return (
        f"SELECT {level} AS level, '{table}' AS \"table\", '{check}' AS \"check\", {detail} AS detail, "
        f"CAST(v AS DOUBLE) AS value, CAST({threshold} AS VARCHAR) AS threshold FROM ({value})"
    )


def _bad(table: str, source: str, check: str, where: str, level: str, text: str) -> str:
    return _row(
        table, check, f"SELECT count(*) FILTER (WHERE {where}) AS v FROM {source}",
        f"CASE WHEN v > 0 THEN '{level}' ELSE 'INFO' END", f"concat(v, ' {text}')")


def _null(table: str, source: str, column: str, level: str) -> str:
    return _row(
        table, f"null_rate:{column}", f"SELECT avg(CAST({column} IS NULL AS INT)) AS v FROM {source}",
        f"CASE WHEN v > 0.02 THEN '{level}' ELSE 'INFO' END", "printf('%.2f%% of the values are missing', v * 100)", "'0.02'")


_ORDER_ROWS = [
    _null("work_orders", "wo", c, "CRITICAL")
    for c in ("work_order_id", "machine_id", "plant_id", "created_at", "scheduled_start", "scheduled_end", "status",
              "priority", "product_type", "planned_units")
] + [
    _bad("work_orders", "wo", "planned_units_positive", "planned_units <= 0", "CRITICAL",
         "orders plan no units"),
    _bad("work_orders", "wo", "defect_count_lte_actual_units", "defect_count > actual_units", "WARNING",
         "orders count more defects than units made"),
    _row("work_orders", "status_domain",
         "SELECT count(*) AS v FROM (SELECT DISTINCT status FROM wo WHERE coalesce(status NOT IN ('completed', 'failed', "
         "'delayed', 'in_progress', 'cancelled'), true))",
         "CASE WHEN v > 0 THEN 'WARNING' ELSE 'INFO' END", "concat(v, ' unknown status values')"),
]
_RANGES = {
    "temperature_c": (15.0, 120.0), "vibration_hz": (0.0, 50.0), "pressure_bar": (0.5, 20.0), "power_kw": (0.0, 500.0),
    "rpm": (0.0, 5000.0),
}
_TEL_ROWS = [
    f"SELECT * FROM ({_null('machine_telemetry', 'tel', c, 'WARNING')}) WHERE level <> 'INFO'" for c in _RANGES
] + [
    _row("machine_telemetry", f"range:{c}",
         f"SELECT count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS v, count(*) AS n FROM tel",
         "CASE WHEN v / n > 0.01 THEN 'CRITICAL' WHEN v / n > 0.001 THEN 'WARNING' ELSE 'INFO' END",
         f"concat(v, ' readings lie out of [{lo}, {hi}]')", f"'[{lo}, {hi}]'")
    for c, (lo, hi) in _RANGES.items()
]
_INSP_ROWS = [
    _bad("quality_inspections", "insp", "unit_count_consistency", "units_passed + units_failed <> units_inspected",
         "WARNING", "inspections whose parts do not add up"),
    _bad("quality_inspections", "insp", "severity_domain",
         "coalesce(severity NOT IN ('minor', 'major', 'critical'), true)", "WARNING", "inspections of unknown severity"),
]
_RULE_ROWS = [
    _bad("work_orders", "wo", "scheduled_end_after_start", "scheduled_end <= scheduled_start", "CRITICAL",
         "orders planned to end before they begin"),
    _bad("work_orders", "wo", "created_before_scheduled_start", "created_at > scheduled_start", "WARNING",
         "orders created after their planned start"),
    _bad("work_orders", "wo", "actual_end_after_start", "actual_end < actual_start", "CRITICAL",
         "orders that ended before they began"),
    _bad("work_orders", "wo", "downtime_non_negative", "downtime_minutes < 0", "CRITICAL",
         "orders with a downtime below zero"),
    _bad("work_orders", "wo", "actual_units_non_negative", "actual_units < 0", "CRITICAL",
         "orders with fewer than zero units"),
]
_ORPHANS = "(SELECT DISTINCT work_order_id FROM insp WHERE work_order_id NOT IN (SELECT work_order_id FROM wo))"
_REF_ROWS = [_bad("quality_inspections", _ORPHANS, "referential_integrity", "true", "CRITICAL",
                  "inspected orders are not in the table")]
_UNION = "\nUNION ALL\n"
_add("validate_work_orders", _UNION.join(_ORDER_ROWS), "wo")
_add("validate_telemetry", _UNION.join(_TEL_ROWS), "tel")
_add("validate_inspections", _UNION.join(_INSP_ROWS), "insp")
_add("validate_business", _UNION.join(_RULE_ROWS), "wo")
_add("validate_references", _UNION.join(_REF_ROWS), "insp", "wo")
_add("validate_orphans", f"SELECT * FROM {_ORPHANS}", "insp", "wo")
_ALL_ROWS = _UNION.join(_ORDER_ROWS + _RULE_ROWS + _TEL_ROWS + _INSP_ROWS + _REF_ROWS)
_add("validate_report", _ALL_ROWS, "wo", "tel", "insp")
_add("validate_level_counts", f"""
SELECT count(*) AS total, count(*) FILTER (WHERE level = 'CRITICAL') AS critical,
       count(*) FILTER (WHERE level = 'WARNING') AS warning, count(*) FILTER (WHERE level = 'INFO') AS info
FROM ({_ALL_ROWS})""", "wo", "tel", "insp")

_NOT_NULL = {
    ("plants", "plants"): "plant_id plant_code plant_name capacity_units",
    ("machines", "machines"): "machine_id machine_code plant_id machine_type install_date expected_life_years",
    ("work_orders", "wo"): "work_order_id machine_id plant_id created_at scheduled_start scheduled_end status priority "
                           "product_type planned_units defect_count downtime_minutes",
    ("machine_telemetry", "tel"): "telemetry_id machine_id recorded_at",
    ("quality_inspections", "insp"): "inspection_id work_order_id inspected_at units_inspected units_passed "
                                     "units_failed sla_breach",
}
_CONSTRAINT_ROWS = [
    _bad(t, s, f"not_null:{c}", f"{c} IS NULL", "CRITICAL", "NULL values")
    for (t, s), columns in _NOT_NULL.items() for c in columns.split()
] + [
    _bad(t, s, f"domain:{c}", f"{c} NOT IN ({values})", "CRITICAL", "values outside the domain")
    for t, s, c, values in (
        ("work_orders", "wo", "status", "'completed', 'failed', 'delayed', 'in_progress', 'cancelled'"),
        ("work_orders", "wo", "priority", "'critical', 'high', 'medium', 'low'"),
        ("quality_inspections", "insp", "severity", "'minor', 'major', 'critical'"),
    )
] + [
    _bad(t, f"(SELECT {k} FROM {s} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)", f"unique:{k}", "true",
         "CRITICAL", "repeated keys")
    for t, s, k in (
        ("plants", "plants", "plant_id"), ("plants", "plants", "plant_code"), ("machines", "machines", "machine_id"),
        ("machines", "machines", "machine_code"), ("work_orders", "wo", "work_order_id"),
        ("machine_telemetry", "tel", "telemetry_id"), ("quality_inspections", "insp", "inspection_id"),
    )
] + [
    _bad(t, f"(SELECT DISTINCT {k} FROM {s} WHERE {k} NOT IN (SELECT {k} FROM {p}))", f"foreign_key:{k}", "true",
         "CRITICAL", f"keys missing in {name}")
    for t, s, k, p, name in (
        ("machines", "machines", "plant_id", "plants", "plants"),
        ("work_orders", "wo", "machine_id", "machines", "machines"),
        ("work_orders", "wo", "plant_id", "plants", "plants"),
        ("machine_telemetry", "tel", "machine_id", "machines", "machines"),
        ("quality_inspections", "insp", "work_order_id", "wo", "work_orders"),
    )
]
_add("validate_constraints", _UNION.join(_CONSTRAINT_ROWS), "plants", "machines", "wo", "tel", "insp")

# Features

_add("features_static", "SELECT * FROM fstatic", "fstatic")
_add("features_calendar_long", f"SELECT work_order_id, {_calendar('scheduled_start')} FROM wol", "wol")
_add("features_category_codes", "SELECT * FROM codes", "codes")
_add("features_schedule", "SELECT * FROM fschedule", "fschedule")


def _replaced(columns: tuple[str, ...], digits: int) -> str:
    return "* REPLACE (" + ", ".join(f"{_round(c, digits)} AS {c}" for c in columns) + ")"


_CONTEXT = ("plant_defect_rate_7d", "plant_failure_rate_7d", "plant_utilization_rate")
_ROUNDED_HISTORY = _replaced(("avg_downtime_30d", "days_since_last_failure"), 6)
_add("features_machine_history", f"SELECT {_ROUNDED_HISTORY} FROM fhistory", "fhistory")
_add("features_machine_history_lagged", f"SELECT {_ROUNDED_HISTORY} FROM fhistlag", "fhistlag")
_add("features_plant_context", f"SELECT {_replaced(_CONTEXT, 9)} FROM fplant", "fplant")
_add("features_plant_context_blocks", f"SELECT {_replaced(_CONTEXT, 9)} FROM fplant", "fplant")
_DOUBLES = tuple(s for s in _STATS if s not in _COUNTS)
_add("telemetry_hourly", f"SELECT {_replaced(_DOUBLES, 6)} FROM hourly", "hourly")
_add("telemetry_daily_plant",
     f"SELECT {_replaced(_DOUBLES, 9)} FROM ({_sensor_stats('telp', 'plant_id', 'day', 'day')})", "telp")
_add("telemetry_lookback", f"SELECT {_replaced(tuple(f'tel_{s}' for s in _STATS), 6)} FROM lookback", "lookback")

_MATRIX = {
    "fstatic": ("priority_encoded", "product_type_encoded", "planned_units", "day_of_week", "hour_of_day", "is_monday",
                "is_end_of_quarter", "planned_duration_hours"),
    "fschedule": ("lead_time_hours", "queue_depth", "overdue_flag"),
    "fhistory": ("machine_age_years", "failure_count_30d", "avg_downtime_30d", "days_since_last_failure"),
    "fplant": _CONTEXT,
    "lookback": ("tel_temp_mean", "tel_temp_std", "tel_temp_max", "tel_vib_mean", "tel_vib_max", "tel_pres_deviation",
                 "tel_pwr_spike_count", "tel_anomaly_count"),
}
_add("feature_matrix", "SELECT work_order_id, " + ", ".join(
    f"{_round(f'CAST({part}.{c} AS DOUBLE)', 6)} AS {c}" for part, columns in _MATRIX.items() for c in columns
) + ", CAST(status IN ('failed', 'delayed') AS INT) AS risk_label_raw FROM wo "
    + " ".join(f"JOIN {part} USING (work_order_id)" for part in _MATRIX), "wo", *_MATRIX)

# Executive page

_CARDS = {"oee_score": 4, "mttr_hours": 2, "sla_breach_rate": 4, "defect_rate": 4}
_add("exec_month_over_month", _UNION.join(f"""
SELECT '{c}' AS kpi, strftime(lm, '%Y-%m') AS month, cur AS latest_mean, prv AS prior_mean, cur - prv AS delta,
       CASE WHEN cur - prv > 0 THEN 'up' ELSE 'down' END AS direction
FROM (SELECT any_value(lm) AS lm, {_mean(f"CASE WHEN m = lm THEN {c} END", s)} AS cur,
             {_mean(f"CASE WHEN m = lm - INTERVAL 1 MONTH THEN {c} END", s)} AS prv
      FROM (SELECT *, date_trunc('month', snapshot_date) AS m, max(date_trunc('month', snapshot_date)) OVER () AS lm
            FROM kpiln))""" for c, s in _CARDS.items()), "kpiln")
_add("exec_high_risk", """
SELECT CAST(sum(n) AS BIGINT) AS high_risk_total, CAST(sum(n) AS DOUBLE) / greatest(sum(u), 1) AS high_risk_ratio,
       first(plant_name ORDER BY n DESC, plant_name) AS top_plant, CAST(max(n) AS DOUBLE) / sum(n) AS top_share,
       (SELECT CAST(count(*) FILTER (WHERE risk_label = 1) AS DOUBLE) / count(*) FROM wo) AS high_risk_share_of_orders
FROM (SELECT plant_name, sum(high_risk_wo_count) AS n, sum(throughput_units) AS u FROM kpin GROUP BY ALL)
""", "kpin", "wo")


def _smooth(source: str, rows: int) -> str:
    over = f"OVER (PARTITION BY plant_name ORDER BY snapshot_date ROWS {rows - 1} PRECEDING)"
    return f"SELECT plant_name, snapshot_date, oee_score, {_mean('oee_score', 4, over)} AS oee_smooth FROM {source}"


_add("oee_smoothed", _smooth("kpin", 7), "kpin")
_add("oee_smoothed_30_filtered", f"""
SELECT * FROM ({_smooth('kpiln', 30)})
WHERE plant_name IN (SELECT plant_name FROM plants ORDER BY plant_name LIMIT 2)""", "kpiln", "plants")
_add("oee_gap", f"""
SELECT plant_name, last_oee, last_oee - 85e-2 AS gap, CASE WHEN last_oee - 85e-2 >= 0 THEN 'above' ELSE 'below' END
  AS direction
FROM (SELECT plant_name, last(oee_smooth ORDER BY snapshot_date) AS last_oee FROM ({_smooth('kpin', 7)}) GROUP BY ALL)
""", "kpin")
_FOUR = ", ".join(f"{_mean(c, s)} AS {c}" for c, s in _CARDS.items())
_add("plant_averages", f"SELECT plant_name, {_FOUR} FROM kpin GROUP BY ALL", "kpin")
_add("plant_performance", f"""
SELECT plant_name, {_mean('mttr_hours', 2)} AS mttr_hours, {_mean('defect_rate', 4)} * 100 AS defect_rate,
       {_mean('sla_breach_rate', 4)} * 100 AS sla_breach_rate FROM kpin GROUP BY ALL""", "kpin")
_CARD = f"""SELECT *, oee_score < 85e-2 AS below_target FROM (
SELECT plant_name, {', '.join(f'{_round(_mean(c, s), 4)} AS {c}' for c, s in _CARDS.items())} FROM kpin GROUP BY ALL)"""
_add("scorecard_values", _CARD, "kpin")
_add("scorecard_printed", f"""
SELECT plant_name AS "Plant", concat({_round('oee_score * 100', 1)}, '%') AS "OEE",
       concat({_round('mttr_hours', 2)}, 'h') AS "MTTR",
       concat({_round('sla_breach_rate * 100', 2)}, '%') AS "SLA Breach Rate",
       concat({_round('defect_rate * 100', 2)}, '%') AS "Defect Rate" FROM ({_CARD})""", "kpin")
_add("mttr_trend", "SELECT plant_name, snapshot_date, mttr_hours FROM kpiln", "kpiln")

# Risk page

_add("risk_scatter_sample", """
SELECT work_order_id, plant_name, priority, status, CAST(planned_units AS DOUBLE) AS planned_units, risk_score,
       CASE WHEN risk_score > 65e-2 THEN 'high' ELSE 'normal' END AS risk_band FROM sampled""", "sampled")
_add("risk_by_size", f"""
SELECT CAST(planned_units // 100 * 100 AS INT) AS bucket, {_mean('risk_score', 4)} AS avg_risk FROM sampled GROUP BY ALL
""", "sampled")
_TOP_PLANT = (
    f"SELECT plant_name, {_mean('risk_score', 4)} AS avg_risk FROM {{source}} GROUP BY ALL "
    "ORDER BY avg_risk DESC, plant_name LIMIT 1"
)


def _insight(source: str) -> str:
    return f"""
SELECT share_above, {_round('r', 9)} AS correlation,
       CASE WHEN abs(r) < 0.05 THEN 'independent' WHEN r > 0 THEN 'increases' ELSE 'decreases' END AS relation,
       (SELECT plant_name FROM ({_TOP_PLANT.format(source=source)})) AS top_plant
FROM (SELECT avg(CAST(risk_score > 65e-2 AS INT)) AS share_above, corr(planned_units, risk_score) AS r FROM {source})"""


_add("risk_insight", _insight("scored"), "scored")
_add("risk_insight_filtered", _insight("(SELECT * FROM scored WHERE priority IN ('critical', 'high'))"), "scored")
_add("risk_highest_plant", _TOP_PLANT.format(source="scored"), "scored")
_TOP = "SELECT work_order_id, plant_name, machine_code, priority, status, risk_score, product_type"
_add("risk_top20", f"{_TOP} FROM scored ORDER BY risk_score DESC, work_order_id LIMIT 20", "scored")
_add("risk_top20_labelled",
     f"{_TOP} FROM wop WHERE risk_label = 1 ORDER BY risk_score DESC, work_order_id LIMIT 20", "wop")
_add("risk_histogram", """
SELECT CAST(least(49, floor(risk_score * 50e0)) AS INT) AS bin, status, count(*) AS n FROM wo
WHERE risk_score IS NOT NULL GROUP BY ALL""", "wo")
_add("product_list", "SELECT DISTINCT product_type FROM wop WHERE product_type IS NOT NULL", "wop")

# Equipment page

_add("temp_daily_rolling", f"SELECT {_replaced(('temperature_c', 'vibration_hz', 'temp_7d'), 9)} FROM daily", "daily")
_add("overheat_islands", """
SELECT plant_name, span, min(date) AS span_start, max(date) AS span_end, count(*) AS days
FROM (SELECT *, CAST(sum(opens) OVER (PARTITION BY plant_name ORDER BY date) AS BIGINT) AS span
      FROM (SELECT *, CASE WHEN date - lag(date) OVER (PARTITION BY plant_name ORDER BY date) > 2 THEN 1 ELSE 0 END
              AS opens FROM daily WHERE temp_7d > 65.5))
GROUP BY ALL""", "daily")
_add("temp_raw_sample", """
SELECT telemetry_id, plant_name, recorded_at, temperature_c FROM telp WHERE temperature_c IS NOT NULL
ORDER BY md5(concat(CAST(telemetry_id AS VARCHAR), ':42')), telemetry_id LIMIT 15000""", "telp")
_P99 = "SELECT quantile_cont(vibration_hz, 0.99) FROM flagged"
_add("vibration_p99", f"SELECT {_round('q', 9)} AS p99_vibration FROM ({_P99}) t(q)", "flagged")
_add("vibration_events", f"""
SELECT * FROM (SELECT telemetry_id, plant_name, recorded_at, vibration_hz, 'normal' AS band FROM flagged
               WHERE vibration_hz <= ({_P99})
               ORDER BY md5(concat(CAST(telemetry_id AS VARCHAR), ':42')), telemetry_id LIMIT 8000)
UNION ALL
SELECT telemetry_id, plant_name, recorded_at, vibration_hz, 'extreme' FROM flagged WHERE vibration_hz > ({_P99})
""", "flagged")
_CORR = "SELECT plant_name, corr(temperature_c, vibration_hz) AS r FROM flagged GROUP BY ALL"
_add("temp_vibration_correlation",
     f"SELECT plant_name, {_round('r', 9)} AS r FROM ({_CORR}) WHERE r IS NOT NULL AND NOT isnan(r)", "flagged")
_add("equipment_insight", f"""
SELECT (SELECT avg(CASE WHEN temperature_c > 95 THEN 1 ELSE 0 END) FROM telp) AS overheat_share,
       (SELECT avg(CASE WHEN vibration_hz > 35 THEN 1 ELSE 0 END) FROM flagged) AS high_vibration_share,
       plant_name AS strongest_plant, {_round('r', 9)} AS strongest_r
FROM ({_CORR}) WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY r DESC, plant_name LIMIT 1""", "telp", "flagged")
_add("anomaly_rate", """
SELECT count(*) AS readings, count(*) FILTER (WHERE anomaly_flag) AS flagged,
       avg(CASE WHEN anomaly_flag THEN 1 ELSE 0 END) AS anomaly_rate FROM tel""", "tel")

# Quality page


def _pareto(where: str = "true") -> str:
    by = "OVER (ORDER BY defect_count DESC, product_type)"
    whole = "OVER ()"
    return f"""
SELECT product_type, CAST(defect_count AS BIGINT) AS defect_count,
       CAST(defect_count AS DOUBLE) / sum(defect_count) {whole} * 100 AS pct,
       CAST(sum(defect_count) {by} AS DOUBLE) / sum(defect_count) {whole} * 100 AS cum_pct,
       row_number() {by} AS pareto_rank
FROM (SELECT product_type, sum(defect_count) AS defect_count FROM wop WHERE product_type IS NOT NULL AND {where}
      GROUP BY ALL)"""


_add("defect_pareto", _pareto(), "wop")
_add("defect_pareto_filtered", _pareto(
    "product_type IN ('ECONOMY', 'SMALL', 'LARGE') AND plant_name IN (SELECT plant_name FROM plants ORDER BY plant_name "
    "LIMIT 3)"), "wop", "plants")
_add("defect_pareto_rate", """
SELECT product_type, CAST(sum(defect_count) AS BIGINT) AS total_defects,
       CAST(sum(coalesce(actual_units, 1)) AS BIGINT) AS total_units,
       CAST(sum(defect_count) AS DOUBLE) / sum(coalesce(actual_units, 1)) AS defect_rate
FROM wo WHERE risk_score IS NOT NULL AND product_type IS NOT NULL GROUP BY ALL""", "wo")
_add("defect_top3", f"""
SELECT count(*) AS products, max(cum_pct) AS top_pct, first(product_type ORDER BY pareto_rank) AS leader,
       first(pct ORDER BY pareto_rank) AS leader_pct FROM ({_pareto()}) WHERE pareto_rank <= 3""", "wop")
_add("sla_by_month", f"""
SELECT strftime(snapshot_date, '%Y-%m') AS month, plant_name, {_mean('sla_breach_rate', 4)} AS sla_breach_rate
FROM kpiln GROUP BY ALL""", "kpiln")
# The orders span January 1995 to August 2001 at every scale.
_MONTHS = [f"{n // 12}-{n % 12 + 1:02d}" for n in range(1995 * 12, 2001 * 12 + 8)]
_add("sla_heatmap", "SELECT plant_name, " + ", ".join(
    f"max(CASE WHEN month = '{m}' THEN rate END) AS \"{m}\"" for m in _MONTHS
) + f"""
FROM (SELECT strftime(snapshot_date, '%Y-%m') AS month, plant_name, {_mean('sla_breach_rate', 4)} AS rate
      FROM kpiln GROUP BY ALL) GROUP BY plant_name""", "kpiln")

# Inspections, sensors

_add("inspection_severity", """
SELECT CASE WHEN units_failed <= 0 THEN 'minor' WHEN CAST(units_failed AS DOUBLE) / units_inspected > 15e-2 THEN 'critical'
            WHEN CAST(units_failed AS DOUBLE) / units_inspected > 5e-2 THEN 'major' ELSE 'minor' END AS level,
       count(*) AS inspections, CAST(sum(units_failed) AS BIGINT) AS units_failed
FROM insp GROUP BY ALL""", "insp")
_add("late_finishes", """
SELECT plant_id, count(*) AS eligible,
       count(*) FILTER (WHERE epoch_us(actual_end) - epoch_us(scheduled_end) > 7200000000) AS late
FROM wo WHERE status IN ('completed', 'delayed', 'failed') AND actual_end IS NOT NULL AND actual_units > 0
GROUP BY ALL""", "wo")
_SENSORS = {"temperature_c": 2, "vibration_hz": 4, "pressure_bar": 3, "power_kw": 3, "rpm": 1}
_add("sensor_standardise", "SELECT telemetry_id, " + ", ".join(
    _round(f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)", 6) + f" AS {c}"
    for c in _SENSORS
) + " FROM tel WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _SENSORS), "tel")

# Splits and metrics


def _split(order: str) -> str:
    return f"""
SELECT work_order_id, p AS position, p < CAST(floor((SELECT count(*) FROM wo) * 8e-1) AS BIGINT) AS in_train
FROM (SELECT work_order_id, row_number() OVER (ORDER BY {order}) - 1 AS p FROM wo)"""


_add("split_temporal", _split("scheduled_start, work_order_id"), "wo")
_add("split_by_plant_order", _split("plant_id, scheduled_start, work_order_id"), "wo")
_add("cv_folds", """
SELECT CAST(i AS INT) AS fold, CASE WHEN p < n - (6 - i) * t THEN 'train' ELSE 'test' END AS role, count(*) AS orders,
       min(p) AS first_position, max(p) AS last_position, CAST(sum(work_order_id) AS BIGINT) AS id_sum
FROM (SELECT work_order_id, row_number() OVER (ORDER BY scheduled_start, work_order_id) - 1 AS p, count(*) OVER () AS n,
             count(*) OVER () // 6 AS t FROM wo), range(1, 6) r(i)
WHERE p < n - (5 - i) * t GROUP BY ALL""", "wo")
_AUC = "sum(neg * (tp - pos / 2e0)) / (max(tp) * max(fp))"
_AP = "sum(pos / tot * tp / (tp + fp))"
_WITH_TOTAL = "(SELECT *, CAST(max(tp) OVER () AS DOUBLE) AS tot FROM curve)"
_add("auc_roc", f"SELECT {_round(_AUC, 9)} AS auc_roc FROM curve", "curve")
_add("avg_precision", f"SELECT {_round(_AP, 9)} AS auc_pr FROM {_WITH_TOTAL}", "curve")
_CELLS = """SELECT count(*) FILTER (WHERE y = 0 AND risk_score < 65e-2) AS tn,
  count(*) FILTER (WHERE y = 0 AND risk_score >= 65e-2) AS fp, count(*) FILTER (WHERE y = 1 AND risk_score < 65e-2) AS fn,
  count(*) FILTER (WHERE y = 1 AND risk_score >= 65e-2) AS tp FROM labelled"""
_add("f1", f"SELECT coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM ({_CELLS})", "labelled")
_add("confusion", _UNION.join(
    f"SELECT CAST({a} AS INT) AS actual, CAST({p} AS INT) AS predicted, {c} AS n FROM ({_CELLS})"
    for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))), "labelled")
_add("roc_points", """
SELECT NULL::DOUBLE AS score, 0e0 AS fpr, 0e0 AS tpr
UNION ALL
SELECT s, CAST(sum(neg) OVER w AS DOUBLE) / sum(neg) OVER (), CAST(sum(pos) OVER w AS DOUBLE) / sum(pos) OVER ()
FROM (SELECT CAST(n_chars AS DOUBLE) AS s, count(*) FILTER (WHERE toxic = 1) AS pos,
             count(*) FILTER (WHERE toxic <> 1) AS neg
      FROM labels JOIN documents USING (doc_id) GROUP BY ALL)
WINDOW w AS (ORDER BY s DESC)""")
_add("score_evaluation", f"""
SELECT {_round(_AUC, 9)} AS test_auc_roc, {_round(_AP, 9)} AS test_auc_pr,
       {_round('any_value(f1)', 9)} AS test_f1, CAST(sum(pos + neg) AS BIGINT) AS test_n,
       {_round('CAST(sum(pos) AS DOUBLE) / sum(pos + neg)', 9)} AS test_positive_rate
FROM {_WITH_TOTAL}, (SELECT 2e0 * tp / (2 * tp + fp + fn) AS f1 FROM ({_CELLS}))""", "curve", "labelled")
_add("class_balance", """
SELECT count(*) AS orders, avg(CASE WHEN status IN ('failed', 'delayed') THEN 1 ELSE 0 END) AS positive_rate FROM wo
""", "wo")
_add("hash_sample_orders", """
SELECT work_order_id, status FROM wo
ORDER BY md5(concat(CAST(work_order_id AS VARCHAR), ':42')), work_order_id LIMIT 5000""", "wo")
_add("write_back_scores", f"""
SELECT work_order_id, {_round("CASE WHEN status = 'completed' THEN 1e0 - risk_score ELSE risk_score END", 4)} AS risk_score,
       CAST(CASE WHEN status = 'completed' THEN 0 ELSE risk_label END AS SMALLINT) AS risk_label FROM wo""", "wo")
_add("hash_sample_null_ids", """
SELECT count(*) AS rows, count(id) AS with_id FROM (
  SELECT CASE WHEN work_order_id % 2 = 0 THEN work_order_id END AS id FROM wo
  ORDER BY md5(concat(coalesce(CAST(CASE WHEN work_order_id % 2 = 0 THEN work_order_id END AS VARCHAR), ''), ':42'))
  LIMIT 6000)""", "wo")
_add("running_sums_blocks", """
SELECT work_order_id, CAST(coalesce(sum(CASE WHEN status = 'completed' THEN defect_count END)
       OVER (ORDER BY work_order_id ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS total FROM wo""", "wo")
_add("features_schedule_blocks", """
SELECT work_order_id, CASE WHEN p IS NOT NULL THEN
         CAST(row_number() OVER (PARTITION BY p ORDER BY scheduled_start, work_order_id) % 20 AS INT) END AS queue_depth
FROM (SELECT *, CASE WHEN work_order_id % 7 <> 0 THEN plant_id END AS p FROM wo)""", "wo")
_add("iforest_invariants", "SELECT count(*) AS readings, count(*) FILTER (WHERE " + " OR ".join(
    f"{c} IS NULL" for c in _SENSORS) + ") AS incomplete, 0::BIGINT AS out_of_range, 0::BIGINT AS incomplete_scored FROM tel", "tel")
_add("risk_invariants", "SELECT count(*) AS orders, 0::BIGINT AS out_of_range, 0::BIGINT AS unscored FROM wo", "wo")
_add("attribution_invariants", """
SELECT count(*) AS orders, count(*) AS explained, 400::INT AS rounds_a, 400::INT AS rounds_b, 0::INT AS over_the_bound FROM wo""", "wo")
_add("risk_training_invariants", """
SELECT count(*) - CAST(floor(count(*) * 0.8) AS BIGINT) AS held_out, 26::INT AS features, 3::BIGINT AS models,
       0::INT AS outside, 15::BIGINT AS important, count(*) AS scored_alike FROM wo""", "wo")

# Sources and sinks

_STORED_ORDER = "machine_id, created_at, actual_end, status, product_type, actual_units, risk_score, risk_label"
_add("csv_round_trip", f"SELECT work_order_id + 9007199254740993 AS work_order_id, {_STORED_ORDER} FROM wo", "wo")
_add("bulk_load_orders", f"SELECT work_order_id, {_STORED_ORDER}, 0::INT AS downtime_minutes FROM wo", "wo")
_add("parquet_round_trip", "SELECT * FROM tel", "tel")
for _copy, _source in (
    ("matrix_round_trip", "feature_matrix"), ("snapshot_sink", "kpi_daily_snapshot"),
    ("views_refreshed", "mv_plant_summary"), ("metrics_round_trip", "score_evaluation"),
):
    ORACLES[_copy] = ORACLES[_source]
_add("invalid_status_values", """
SELECT status, count(*) AS rows FROM (SELECT CASE WHEN work_order_id % 11 = 0 THEN priority ELSE status END AS status FROM wo)
WHERE coalesce(status NOT IN ('completed', 'failed', 'delayed', 'in_progress', 'cancelled'), true)
GROUP BY status ORDER BY rows DESC, status""", "wo")
_add("validate_kpi_constraints", _UNION.join([
    *(_bad("plants", "plants", f"not_null:{c}", f"{c} IS NULL", "CRITICAL", "NULL values")
      for c in "plant_id plant_code plant_name capacity_units".split()),
    *(_bad("kpi_snapshots", "kpi", f"not_null:{c}", f"{c} IS NULL", "CRITICAL", "NULL values")
      for c in ("snapshot_date", "plant_id")),
    *(_bad(table, f"(SELECT 1 FROM {source} GROUP BY {key.replace('+', ', ')} HAVING count(*) > 1)", f"unique:{key}", "true",
           "CRITICAL", "repeated keys")
      for table, source, key in (
          ("plants", "plants", "plant_id"), ("plants", "plants", "plant_code"), ("kpi_snapshots", "kpi", "snapshot_date+plant_id"))),
    _bad("kpi_snapshots", "(SELECT DISTINCT plant_id FROM kpi WHERE plant_id NOT IN (SELECT plant_id FROM plants))",
         "foreign_key:plant_id", "true", "CRITICAL", "keys missing in plants"),
]), "kpi", "plants")

# Published tables

for _copy, _source in (
    ("merge_scores", "write_back_scores"), ("snapshot_days_replaced", "kpi_daily_snapshot"),
    ("summary_by_difference", "mv_plant_summary"), ("daily_oee_by_difference", "mv_daily_oee"),
):
    ORACLES[_copy] = ORACLES[_source]
_add("csv_rejects", """
SELECT work_order_id, CASE WHEN r IS NULL THEN planned_units END AS planned_units, r AS rejected_for FROM (
  SELECT *, nullif(concat_ws(',', CASE WHEN work_order_id % 23 = 0 THEN 'created_at' END,
                             CASE WHEN work_order_id % 17 = 0 THEN 'planned_units' END), '') AS r FROM wo)""", "wo")
_add("scan_partitions", """
SELECT 1::INT AS parts_of_row, count(*) AS rows,
       count(*) FILTER (WHERE work_order_id % 3 = 0 OR work_order_id % 41 <> 0) AS keyed FROM wo""", "wo")

# ROC corners, parameters, lenient times, absent columns, gate, drill inputs


def _corners(curve: str) -> str:
    return f"""
SELECT NULL::DOUBLE AS score, 0e0 AS fpr, 0e0 AS tpr
UNION ALL
SELECT s, fpr, tpr FROM (
  SELECT s, CAST(sum(neg) OVER w AS DOUBLE) / sum(neg) OVER () AS fpr, CAST(sum(pos) OVER w AS DOUBLE) / sum(pos) OVER () AS tpr,
         coalesce(pos * lead(neg) OVER w <> neg * lead(pos) OVER w, true) AS bends
  FROM {curve} WINDOW w AS (ORDER BY s DESC))
WHERE bends"""


_add("roc_corners", _corners("""(SELECT CAST(n_chars AS DOUBLE) AS s, count(*) FILTER (WHERE toxic = 1) AS pos,
    count(*) FILTER (WHERE toxic <> 1) AS neg FROM labels JOIN documents USING (doc_id) GROUP BY ALL)"""))
_add("roc_corners_blocks",
     f"SELECT score, {_round('fpr', 9)} AS fpr, {_round('tpr', 9)} AS tpr FROM ({_corners('curve')})", "curve")
_add("kpi_with_parameters", _kpis("wo").replace("> 120)", "> 60)").replace("9999e0", "48e0"), "wo", "machines", "anomalies")
_add("lenient_timestamps",
     "SELECT work_order_id, CASE WHEN work_order_id % 13 <> 0 THEN created_at END AS created_at FROM wo", "wo")
_add("validate_absent_columns", _UNION.join([
    _null("work_orders", "(SELECT * REPLACE (NULL AS planned_units, NULL AS status) FROM wo)", c, "CRITICAL")
    for c in ("work_order_id", "machine_id", "plant_id", "created_at", "scheduled_start", "scheduled_end", "status",
              "priority", "product_type", "planned_units")
]), "wo")
_add("matrix_absent_features", "SELECT unnest(['lead_time_hours', 'queue_depth', 'overdue_flag', " + ", ".join(
    f"'{c}'" for c in (
        "machine_age_years", "failure_count_30d", "avg_downtime_30d", "days_since_last_failure", "plant_defect_rate_7d",
        "plant_failure_rate_7d", "plant_utilization_rate", "tel_temp_mean", "tel_temp_std", "tel_temp_max", "tel_vib_mean",
        "tel_vib_max", "tel_pres_deviation", "tel_pwr_spike_count", "tel_anomaly_count")
) + "]) AS feature, (SELECT count(*) FROM wo) AS zeros", "wo")
_add("validation_gate", f"""
SELECT checks, critical, critical > 0 AS stopped FROM (
  SELECT 'work_orders' AS checks, count(*) FILTER (WHERE level = 'CRITICAL') AS critical FROM ({_UNION.join(_ORDER_ROWS)})
  UNION ALL
  SELECT 'references', count(*) FILTER (WHERE level = 'CRITICAL') FROM ({_UNION.join(_REF_ROWS)}))""", "wo", "insp")
_add("drill_kpis", "SELECT * FROM kpin WHERE plant_name IN (SELECT plant_name FROM plants ORDER BY plant_name LIMIT 3)",
     "kpin", "plants")
