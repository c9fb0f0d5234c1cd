from __future__ import annotations

import csv
from dataclasses import replace
from datetime import timedelta
from pathlib import Path
from urllib.parse import urlparse

import pytest

from millwright.config import DEFAULT, AnomalyConfig, BoostConfig, ModelConfig
from millwright.pipeline import Pipeline
from millwright.plans.validation import ValidationError
from millwright.plans import kpis
from millwright.schemas import KPI_SNAPSHOTS, MACHINES, MACHINE_TELEMETRY, PLANTS, QUALITY_INSPECTIONS, WORK_ORDERS
from millwright.session import ensure_checkpoint_dir
from millwright.sources import read_csv, read_parquet, read_tables, write_csv, write_snapshots
from millwright.sources.load import load_csvs, write_back
from millwright.sources.readers import jdbc_options, read_published
from millwright.sources.versions import latest, read_stored
from tests.builders import T0, column, machines, orders


def write_file(path, schema, rows):
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, schema.names)
        out.writeheader()
        out.writerows({k: "" if v is None else v for k, v in r.items()} for r in rows)


@pytest.fixture()
def csv_dir(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    write_file(folder / "plants.csv", PLANTS, [
        {"plant_id": p, "plant_code": f"P{p}", "plant_name": f"Plant {p}", "region": None, "capacity_units": 100} for p in (1, 2)])
    write_file(folder / "machines.csv", MACHINES, [
        {"machine_id": m, "machine_code": f"M{m}", "plant_id": 1 + m % 2, "machine_type": "CNC", "install_date": "2020-01-01",
         "expected_life_years": None} for m in (1, 2, 3, 4)])
    rows, seen = [], []
    for i in range(120):
        start = T0 + timedelta(hours=5 * i)
        status = ("failed", "completed", "delayed", "completed")[i % 4]
        rows.append({
            "work_order_id": i + 1, "machine_id": 1 + i % 4, "plant_id": 1 + (1 + i % 4) % 2,
            "created_at": (start - timedelta(hours=3)).isoformat() + "+00:00", "scheduled_start": start.isoformat() + "+00:00",
            "scheduled_end": (start + timedelta(hours=4)).isoformat() + "+00:00", "actual_start": start.isoformat() + "+00:00",
            "actual_end": (start + timedelta(hours=5)).isoformat() + "+00:00", "status": status, "priority": "high",
            "product_type": f"W{i % 3}", "planned_units": 100, "actual_units": 90 + i % 9, "defect_count": i % 5,
            "downtime_minutes": 150 if status == "failed" else 5, "operator_id": None, "failure_mode": None,
            "risk_score": None, "risk_label": None,
        })
        seen.append({
            "inspection_id": i + 1, "work_order_id": i + 1, "inspected_at": start.isoformat() + "+00:00", "inspector_id": 1,
            "units_inspected": 10, "units_passed": 9, "units_failed": 1, "defect_type": None, "severity": "minor",
            "sla_breach": "False",
        })
    write_file(folder / "work_orders.csv", WORK_ORDERS, rows)
    write_file(folder / "machine_telemetry.csv", MACHINE_TELEMETRY, [
        {"telemetry_id": i + 1, "machine_id": 1 + i % 4, "recorded_at": (T0 + timedelta(hours=i)).isoformat() + "+00:00",
         "temperature_c": 60 + i % 7, "vibration_hz": 10 + i % 5, "pressure_bar": 8, "power_kw": 40 + i % 3, "rpm": 3000 + i,
         "anomaly_flag": None, "anomaly_score": None} for i in range(300)])
    write_file(folder / "quality_inspections.csv", QUALITY_INSPECTIONS, seen)
    return folder


def test_csv_is_lenient(spark, tmp_path):
    path = tmp_path / "plants.csv"
    path.write_text("plant_name,plant_id,capacity_units\nA,1,5.0\n,x,\n")
    rows = read_csv(spark, str(path), PLANTS).collect()
    assert [(r["plant_id"], r["plant_name"], r["capacity_units"], r["region"]) for r in rows] == [
        (1, "A", 5, None), (None, None, None, None)]


def test_missing_source_is_empty_but_other_errors_stay(spark, tmp_path):
    assert read_csv(spark, str(tmp_path / "none.csv"), PLANTS, missing_ok=True).count() == 0
    assert read_tables(spark, str(tmp_path)).work_orders.columns == WORK_ORDERS.names
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "none.csv"), PLANTS)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_parquet(spark, str(tmp_path / "bad"), PLANTS, missing_ok=True).count()


def test_jdbc_options():
    split = jdbc_options("jdbc:x", "t", "id", (1, 9), 4)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("1", "9", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id", (9, 1), 4)


def test_load_counts_defaults_and_skips(spark, csv_dir, tmp_path):
    (csv_dir / "quality_inspections.csv").rename(csv_dir / "other.csv")
    target = str(tmp_path / "tables")
    assert load_csvs(spark, str(csv_dir), target) == {
        "plants": 2, "machines": 4, "work_orders": 120, "machine_telemetry": 300}
    tables = read_tables(spark, target)
    assert tables.machines.first()["expected_life_years"] == 15
    assert tables.machine_telemetry.first()["anomaly_flag"] is False
    assert tables.quality_inspections.count() == 0
    assert load_csvs(spark, str(csv_dir), target)["work_orders"] == 120  # a second load replaces
    assert latest(spark, target).number == 2


def test_failed_load_keeps_the_old_tables(spark, csv_dir, tmp_path):
    target = str(tmp_path / "tables")
    load_csvs(spark, str(csv_dir), target)
    (csv_dir / "plants.csv").write_text("plant_id,plant_code,plant_name,region,capacity_units\n9,P9,Nine,,1\n")
    (csv_dir / "machine_telemetry.csv").rename(csv_dir / "m.csv")
    (csv_dir / "machine_telemetry.csv").mkdir()
    (csv_dir / "machine_telemetry.csv" / "part.csv").write_bytes(b"\x1f\x8b broken")
    (csv_dir / "machine_telemetry.csv" / "part.csv.gz").write_bytes(b"\x1f\x8b broken")
    with pytest.raises(Exception):
        load_csvs(spark, str(csv_dir), target)
    assert read_tables(spark, target).plants.count() == 2


def test_invalid_statuses_are_named(spark, csv_dir, tmp_path):
    text = (csv_dir / "work_orders.csv").read_text().replace("completed", "compleet", 3)
    (csv_dir / "work_orders.csv").write_text(text)
    run = Pipeline(spark, str(tmp_path / "root"), SMALL)
    run.ingest(str(csv_dir))
    run.validate()
    named = read_parquet(spark, str(tmp_path / "root" / "reports" / "invalid_statuses"))
    assert [tuple(r) for r in named.collect()] == [("compleet", 3)]


def test_write_back_updates_only_matches(spark):
    table = orders(spark, [{"risk_score": 0.1, "risk_label": 0}, {"risk_score": 0.2, "risk_label": 0}])
    new = spark.createDataFrame([(2, 0.9, 1)], "work_order_id long, risk_score double, risk_label int")
    out = write_back(table, new, "work_order_id", ["risk_score", "risk_label"])
    assert out.schema["risk_label"].dataType == table.schema["risk_label"].dataType
    assert column(out, "risk_score") == [0.1, 0.9]
    assert column(out, "risk_label") == [0, 1]


def test_snapshot_sink_replaces_all_or_only_given_days(spark, tmp_path):
    path = str(tmp_path / "kpi")
    rows = kpis.daily_snapshots(orders(spark, [{"scheduled_start": T0 + timedelta(days=i)} for i in range(3)]), machines(spark))
    write_snapshots(rows, path, replace_days_only=True)
    write_snapshots(rows.limit(1), path, replace_days_only=True)
    assert spark.read.parquet(path).count() == 3
    write_snapshots(rows.limit(1), path)
    assert spark.read.parquet(path).count() == 1
    assert dict(spark.read.parquet(path).dtypes)["oee_score"] == "decimal(6,4)"
    write_csv(rows, str(tmp_path / "csv_out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv_out")).count() == 3


SMALL = replace(DEFAULT, models=ModelConfig(
    AnomalyConfig(5, 32), BoostConfig(2, 2, 0.1, positive_weight=4.0), BoostConfig(2, 2, 0.1), cv_splits=2))


def test_whole_pipeline(spark, csv_dir, tmp_path):
    run = Pipeline(spark, str(tmp_path / "root"), SMALL)
    store = Path(urlparse(ensure_checkpoint_dir(spark)).path)
    before = set(store.iterdir())
    run.run(str(csv_dir))
    assert not [p for p in set(store.iterdir()) - before if p.name.startswith("table-")]
    root = str(tmp_path / "root" / "tables")
    scored = read_tables(spark, root).work_orders
    assert scored.count() == 120 and scored.filter("risk_score IS NULL").count() == 0
    flagged = read_tables(spark, root).machine_telemetry
    assert flagged.filter("anomaly_flag").count() == 300
    snapshots = read_published(spark, root, "kpi_snapshots", KPI_SNAPSHOTS)
    assert snapshots.agg({"anomaly_count": "sum"}).first()[0] > 0
    published = latest(spark, root)
    assert read_stored(spark, root, published, "mv_plant_summary").count() == 2
    run.score()
    run.build_kpis()
    again = latest(spark, root)
    for name in ("work_orders", "kpi_snapshots"):
        assert again.tables[name] == published.tables[name]  # the same results write nothing
    pages = tmp_path / "root" / "reports" / "pages"
    rows = {p.name: read_parquet(spark, str(p)).count() for p in pages.iterdir()}
    assert len(rows) == 26
    # The readings are cool and all alike, so nothing overheats and nothing correlates.
    assert {name for name, n in rows.items() if n == 0} <= {"equipment_overheat_spans", "equipment_correlation"}
    assert rows["risk_scatter"] == 120 and rows["scorecard"] == 2
    evaluation = tmp_path / "root" / "reports" / "evaluation"
    rows = {p.name: read_parquet(spark, str(p)).count() for p in evaluation.iterdir()}
    assert rows["confusion"] == 4 and rows["tree_importance"] == 26 and rows["permutation_importance"] == 15
    assert read_parquet(spark, str(evaluation / "roc")).select("model").distinct().count() == 3
    held_out = read_parquet(spark, str(evaluation / "confusion")).agg({"n": "sum"}).first()[0]
    assert held_out == 24
    constraints = read_parquet(spark, str(tmp_path / "root" / "reports" / "kpi_constraints"))
    assert constraints.filter("level <> 'INFO'").count() == 0
    assert constraints.filter("check = 'unique:snapshot_date+plant_id'").count() == 1


def test_validation_report_is_stored_before_the_gate_stops(spark, csv_dir, tmp_path):
    text = (csv_dir / "work_orders.csv").read_text().replace(",100,", ",-1,")
    (csv_dir / "work_orders.csv").write_text(text)
    run = Pipeline(spark, str(tmp_path / "root"), SMALL)
    run.ingest(str(csv_dir))
    with pytest.raises(ValidationError):
        run.validate()
    assert read_parquet(spark, str(tmp_path / "root" / "reports" / "validation")).count() > 20


def test_exact_integers_and_absent_columns(spark, tmp_path):
    from pyspark.sql import types as T

    from millwright.sources.readers import read_csv, read_parquet

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())])
    (tmp_path / "t.csv").write_text("id\n9007199254740993\n12.0\n12.5\nabc\n")
    rows = read_csv(spark, str(tmp_path / "t.csv"), schema).collect()
    assert [(r["id"], r["x"]) for r in rows] == [(9007199254740993, None), (12, None), (None, None), (None, None)]
    spark.range(2).write.parquet(str(tmp_path / "p"))
    out = read_parquet(spark, str(tmp_path / "p"), schema)
    assert out.dtypes == [("id", "bigint"), ("x", "double")] and out.where("x is null").count() == 2
