"""How often plans read the facts."""

from __future__ import annotations

import pytest

from catalog import testbed
from catalog.queries import QUERIES
from millwright.plans import features, validation

SF_DIR = "/root/testdata/sf0.001"


def scans(df, table: str) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count(f"/{table}.parquet")


@pytest.mark.parametrize("name", ["exec_month_over_month", "mv_plant_summary", "sla_by_month"])
def test_kpi_reports_compute_the_snapshots_once(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert scans(df, "orders") == 1 and scans(df, "events") <= 1


def test_heatmap_reads_stored_months(spark):
    df = QUERIES["sla_heatmap"](spark, SF_DIR)
    assert (scans(df, "orders"), scans(df, "events")) == (0, 0)


def test_sensor_statistics_are_aggregated_once(spark):
    t = testbed.Testbed(spark, SF_DIR)
    assert scans(features.aggregate_telemetry(t.machine_telemetry), "events") == 0


def test_foreign_keys_share_a_scan(spark):
    t = testbed.Testbed(spark, SF_DIR)
    tables = {"plants": t.plants, "machines": t.machines, "work_orders": t.work_orders}
    assert scans(validation.constraint_checks(tables), "orders") == 2  # row rules, uniqueness
