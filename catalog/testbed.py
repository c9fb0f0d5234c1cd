"""Plant tables derived from the TPC-H-like benchmark tables, by integer arithmetic only.

The SQL is written once and rendered for Spark or DuckDB, so that both engines see the same input rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.operators.sizing import DIMENSION_ROWS
from millwright.session import use_utc
from millwright.sources.readers import Tables


@dataclass(frozen=True)
class Dialect:
    div: Callable[[str, str | int], str]
    add_minutes: Callable[[str, str], str]
    days_between: Callable[[str, str], str]
    add_days: Callable[[str, str], str]
    text: str


SPARK = Dialect(
    div=lambda a, b: f"(({a}) div ({b}))",
    add_minutes=lambda ts, k: f"timestampadd(MINUTE, CAST({k} AS INT), {ts})",
    days_between=lambda a, b: f"datediff({b}, {a})",
    add_days=lambda d, k: f"date_add({d}, CAST({k} AS INT))",
    text="STRING",
)
DUCKDB = Dialect(
    div=lambda a, b: f"(({a}) // ({b}))",
    add_minutes=lambda ts, k: f"({ts} + to_minutes(CAST({k} AS BIGINT)))",
    days_between=lambda a, b: f"date_diff('day', {a}, CAST({b} AS DATE))",
    add_days=lambda d, k: f"({d} + CAST({k} AS INT))",
    text="VARCHAR",
)


def plants_sql(region: str) -> str:
    return f"""
SELECT CAST(r_regionkey AS INT) AS plant_id, concat('PLT-00', CAST(r_regionkey + 1 AS INT)) AS plant_code,
       r_name AS plant_name, r_name AS region, CAST(8000 + 1000 * r_regionkey AS INT) AS capacity_units
FROM {region}"""


def machines_sql(supplier: str, nation: str, d: Dialect) -> str:
    install = d.add_days("DATE '1985-01-01'", "(s_suppkey * 37) % 3000")
    return f"""
SELECT CAST(s_suppkey AS INT) AS machine_id, s_name AS machine_code, CAST(n_regionkey AS INT) AS plant_id,
       CASE s_suppkey % 5 WHEN 0 THEN 'CNC' WHEN 1 THEN 'Press' WHEN 2 THEN 'Assembly' WHEN 3 THEN 'Conveyor'
            ELSE 'Packaging' END AS machine_type,
       CAST({install} AS DATE) AS install_date, CAST(15 AS INT) AS expected_life_years
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


def work_orders_sql(
    orders: str, machines: str, part: str, n_machines: str | int, n_parts: str | int, d: Dialect, long: bool = False,
    with_cents: bool = False,
) -> str:
    """``long=False``: orders in January 2024, over the sensor readings; ``long=True``: 80 months from 1995.

    ``with_cents`` also returns the order's price in cents, from which inspections are derived.
    """

    def pick(q: int, m: int | str) -> str:
        return f"({d.div('x', q)} % {m})"

    day = d.days_between("DATE '1995-01-01'", "odate")
    created = (
        d.add_minutes("odate", pick(23, 1440))
        if long
        else d.add_minutes("TIMESTAMP '2024-01-01 00:00:00'", f"{day} * 18 + o_orderkey % 18")
    )

    def by_status(failed: str, delayed: str, completed: str, cancelled: str) -> str:
        return (
            f"CASE status WHEN 'failed' THEN {failed} WHEN 'delayed' THEN {delayed} "
            f"WHEN 'completed' THEN {completed} ELSE {cancelled} END"
        )

    wait = by_status(pick(37, 120), f"30 + {pick(37, 330)}", pick(37, 15), "NULL")
    run_pct = by_status(f"10 + {pick(41, 81)}", f"100 + {pick(41, 51)}", f"90 + {pick(41, 16)}", "NULL")
    unit_pct = by_status(f"10 + {pick(11, 81)}", f"85 + {pick(13, 16)}", f"95 + {pick(13, 6)}", "0")
    defects = by_status(
        d.div(f"actual * (12 + {pick(17, 26)})", 100), d.div(f"actual * (1 + {pick(17, 6)})", 100),
        d.div(f"actual * {pick(17, 3)}", 100), "0",
    )
    downtime = by_status(f"30 + {pick(19, 450)}", pick(19, 60), pick(19, 20), "0")
    return f"""
SELECT CAST(o_orderkey AS BIGINT) AS work_order_id, CAST(mkey AS INT) AS machine_id,
       CAST(plant_id AS INT) AS plant_id, created_at, scheduled_start, actual_start, scheduled_end,
       {d.add_minutes('actual_start', d.div(f'dur * ({run_pct})', 100))} AS actual_end,
       status, priority, product_type, CAST(planned AS INT) AS planned_units, CAST(actual AS INT) AS actual_units,
       CAST({defects} AS INT) AS defect_count, CAST({downtime} AS INT) AS downtime_minutes,
       CAST(NULL AS INT) AS operator_id, CAST(NULL AS {d.text}) AS failure_mode,
       risk_score, CAST(CASE WHEN risk_score >= 65e-2 THEN 1 WHEN risk_score IS NULL THEN NULL ELSE 0 END
                        AS SMALLINT) AS risk_label{', x' if with_cents else ''}
FROM (
  SELECT *, {d.add_minutes('scheduled_start', 'dur')} AS scheduled_end,
         {d.add_minutes('scheduled_start', wait)} AS actual_start,
         {d.div(f'planned * ({unit_pct})', 100)} AS actual
  FROM (
    SELECT *, {d.add_minutes('created_at', f'30 + {pick(29, 210)}')} AS scheduled_start
    FROM (
      SELECT *,
             CASE WHEN x % 100 < 18 THEN 'failed' WHEN x % 100 < 33 THEN 'delayed' WHEN x % 100 < 35 THEN 'cancelled'
                  ELSE 'completed' END AS status,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high'
                  WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' END AS priority,
             {created} AS created_at, 60 + {pick(31, 1380)} AS dur, 50 + {pick(7, 951)} AS planned,
             CASE WHEN x % 97 <> 0 THEN CAST({pick(43, 10001)} AS DOUBLE) / 1e4 END AS risk_score
      FROM (
        SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS TIMESTAMP) AS odate,
               CAST(floor(o_totalprice * 100 + 5e-1) AS BIGINT) AS x, o_orderkey % {n_machines} AS mkey
        FROM {orders}
      ) a
    ) b
  ) c
) d
JOIN (SELECT machine_id AS m_id, plant_id FROM {machines}) m ON mkey = m_id
LEFT JOIN (SELECT p_partkey, p_type AS product_type FROM {part}) p
       ON p_partkey = CASE WHEN x % 53 <> 0 THEN x % {n_parts} END"""


def telemetry_sql(events: str, n_machines: str | int, d: Dialect) -> str:
    """Sensor values carry the decimals of the stored types, as integer / power of ten."""
    return f"""
SELECT CAST(event_id AS BIGINT) AS telemetry_id, CAST(user_id % {n_machines} AS INT) AS machine_id,
       recorded_at,
       CASE WHEN event_id % 101 <> 0 THEN CAST(4000 + {d.div('cents', 2)} AS DOUBLE) / 1e2 END AS temperature_c,
       CAST(5 * k AS DOUBLE) / 1e1 AS vibration_hz, CAST(500 + 190 * k AS DOUBLE) / 1e3 AS pressure_bar,
       CAST(cents AS DOUBLE) / 1e2 AS power_kw, CAST(400 + 25 * k AS DOUBLE) AS rpm,
       event_type = 'error' AS anomaly_flag, CAST(NULL AS DOUBLE) AS anomaly_score
FROM (
  SELECT event_id, user_id, event_type, CAST(ts AS TIMESTAMP) AS recorded_at,
         CAST(floor(value * 100 + 5e-1) AS BIGINT) AS cents,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
  FROM {events}
) e"""


def inspections_sql(orders_with_cents: str, d: Dialect) -> str:
    """Orders that ended and made units: here these are exactly the ones not cancelled, known from ``x`` alone."""
    return f"""
SELECT work_order_id AS inspection_id,
       CASE WHEN x % 211 = 0 THEN work_order_id + 1000000000 ELSE work_order_id END AS work_order_id,
       {d.add_minutes('actual_end', '30')} AS inspected_at, CAST(NULL AS INT) AS inspector_id,
       CAST(ui AS INT) AS units_inspected,
       CAST(CASE WHEN x % 199 = 0 THEN ui - uf + 1 ELSE ui - uf END AS INT) AS units_passed,
       CAST(uf AS INT) AS units_failed, CAST(NULL AS {d.text}) AS defect_type,
       CASE WHEN uf * 100 > 15 * ui THEN 'critical' WHEN uf * 100 > 5 * ui THEN 'major' ELSE 'minor' END AS severity,
       actual_end > {d.add_minutes('scheduled_end', '120')} AS sla_breach
FROM (
  SELECT *, least({d.div('ui * defect_count', 'actual_units')}, ui) AS uf
  FROM (
    SELECT w.*, actual_units - ({d.div('x', 47)} % ({d.div('actual_units', 4)} + 1)) AS ui
    FROM {orders_with_cents} w
    WHERE x % 100 NOT BETWEEN 33 AND 34
  ) a
) b"""


class Testbed:
    """The five plant tables over the benchmark tables in ``sf_dir``; only what is asked for is planned."""

    def __init__(self, spark: SparkSession, sf_dir: str, long: bool = False):
        self.spark, self.sf_dir, self.long = use_utc(spark), sf_dir, long
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def _n_machines(self) -> int:
        return self.raw("supplier").count()

    @cached_property
    def _orders(self) -> DataFrame:
        # Zone-less microsecond timestamps are UTC instants.
        return self.raw("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))

    @cached_property
    def plants(self) -> DataFrame:
        return self.spark.sql(plants_sql("{region}"), region=self.raw("region"))

    @cached_property
    def machines(self) -> DataFrame:
        sql = machines_sql("{supplier}", "{nation}", SPARK)
        return self.spark.sql(sql, supplier=self.raw("supplier"), nation=self.raw("nation"))

    def _derived_orders(self, with_cents: bool = False) -> DataFrame:
        part = self.raw("part")
        n_parts = part.count()
        sql = work_orders_sql(
            "{orders}", "{machines}", "{part}", self._n_machines, n_parts, SPARK, self.long, with_cents
        )
        small_machines = F.broadcast(self.machines) if self._n_machines <= DIMENSION_ROWS else self.machines
        small_part = F.broadcast(part) if n_parts <= DIMENSION_ROWS else part
        return self.spark.sql(sql, orders=self._orders, machines=small_machines, part=small_part)

    @cached_property
    def work_orders(self) -> DataFrame:
        return self._derived_orders()

    @cached_property
    def machine_telemetry(self) -> DataFrame:
        events = self.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))
        return self.spark.sql(telemetry_sql("{events}", self._n_machines, SPARK), events=events)

    @cached_property
    def quality_inspections(self) -> DataFrame:
        return self.spark.sql(inspections_sql("{orders}", SPARK), orders=self._derived_orders(with_cents=True))

    def tables(self) -> Tables:
        return Tables(
            self.plants, self.machines, self.work_orders, self.machine_telemetry, self.quality_inspections
        )
