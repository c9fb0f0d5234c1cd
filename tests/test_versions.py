"""Published versions, merges by bucket, refresh by difference, rejected lines."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest

from millwright.config import LoadConfig
from millwright.plans import refresh, views
from millwright.schemas import KPI_SNAPSHOTS, PLANTS
from millwright.sources import files, versions
from millwright.sources.load import RejectedRows, load_csvs, write_back
from millwright.sources.merge import RepeatedKeys, stage_merge, stage_replace
from millwright.sources.readers import check_csv, read_published, read_tables
from tests.builders import machines, orders, plants


def numbers(spark, n, change=0):
    return spark.range(n).selectExpr("id", f"CAST(id + {change} AS INT) AS x", "CAST(id AS STRING) AS s")


def put(spark, root, **tables):
    base = versions.latest(spark, root)
    staged = {n: versions.stage(df, root, n, [df.columns[0]], 4) for n, df in tables.items()}
    return versions.publish(spark, root, base, staged)


def rows_of(spark, root, name):
    rows = versions.read_stored(spark, root, versions.latest(spark, root), name)
    return sorted(map(tuple, rows.collect()), key=repr)


def content(root):
    return {p: p.read_bytes() for p in Path(root).rglob("*.parquet") if not p.name.startswith(".")}


def test_versions_follow_each_other(spark, tmp_path):
    root = str(tmp_path)
    assert versions.latest(spark, root).number == 0
    assert versions.read_stored(spark, root, versions.latest(spark, root), "a") is None
    put(spark, root, a=numbers(spark, 5), b=numbers(spark, 0))
    first = versions.latest(spark, root)
    put(spark, root, a=numbers(spark, 3))
    assert versions.latest(spark, root).number == 2
    assert len(rows_of(spark, root, "a")) == 3 and rows_of(spark, root, "b") == []
    assert versions.read_stored(spark, root, first, "a").count() == 5  # a reader of the old version goes on
    assert versions.drop_versions(spark, root, keep=1) == len(first.tables["a"].parts)
    assert len(rows_of(spark, root, "a")) == 3 and versions.drop_versions(spark, root, keep=1) == 0
    with pytest.raises(ValueError):
        versions.drop_versions(spark, root, keep=0)


def test_two_writers(spark, tmp_path):
    root = str(tmp_path)
    base = put(spark, root, a=numbers(spark, 2), b=numbers(spark, 2))
    put(spark, root, a=numbers(spark, 3))
    other = versions.stage(numbers(spark, 4), root, "b", ["id"], 4)
    versions.publish(spark, root, base, {"b": other})  # another table: both changes stay
    assert len(rows_of(spark, root, "a")) == 3 and len(rows_of(spark, root, "b")) == 4
    with pytest.raises(versions.CommitConflict, match="a"):
        versions.publish(spark, root, base, {"a": other})


def test_a_lost_race_is_tried_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    base = put(spark, root, a=numbers(spark, 2))
    mine = versions.stage(numbers(spark, 5), root, "c", ["id"], 4)
    create = files.create_text

    def beaten(session, path, text):
        monkeypatch.setattr(files, "create_text", create)
        put(spark, root, b=numbers(spark, 7))
        return create(session, path, text)

    monkeypatch.setattr(files, "create_text", beaten)
    assert versions.publish(spark, root, base, {"c": mine}).number == 3
    assert [len(rows_of(spark, root, n)) for n in "abc"] == [2, 7, 5]


def test_an_unfinished_manifest_is_no_version(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, a=numbers(spark, 2))
    text = (tmp_path / "_manifests" / "000000000001.json").read_text()
    for broken in ("", text[: len(text) // 2]):
        assert files.create_text(spark, f"{root}/_manifests/000000000002.json", broken)
        assert versions.latest(spark, root).number == 1 and len(rows_of(spark, root, "a")) == 2
        with pytest.raises(versions.CommitConflict, match="unfinished"):
            put(spark, root, a=numbers(spark, 3))
        assert versions.recover(spark, root) == [2]
    assert put(spark, root, a=numbers(spark, 3)).number == 2 and versions.recover(spark, root) == []


PLANT_LINES = "plant_id,plant_code,plant_name,region,capacity_units\n"
MACHINE_LINES = "machine_id,machine_code,plant_id,machine_type,install_date,expected_life_years\n"


@pytest.mark.parametrize("step", range(1, 6))
def test_a_load_that_fails_at_any_step_leaves_the_old_tables(spark, tmp_path, monkeypatch, step):
    """Steps of a load of two files: two tables staged, rejects staged, manifest written; the fifth step does not exist."""
    csv, root = tmp_path / "csv", str(tmp_path / "tables")
    csv.mkdir()
    (csv / "plants.csv").write_text(PLANT_LINES + "1,P1,One,,1\n")
    (csv / "machines.csv").write_text(MACHINE_LINES + "1,M1,1,CNC,2020-01-01,\n")
    load_csvs(spark, str(csv), root)
    (csv / "plants.csv").write_text(PLANT_LINES + "1,P1,One,,1\n2,P2,Two,,2\n")
    (csv / "machines.csv").write_text(MACHINE_LINES + "1,M1,1,CNC,2020-01-01,\n2,M2,2,CNC,2020-01-01,\n")
    done = 0

    def counted(real):
        def call(*args, **kwargs):
            nonlocal done
            done += 1
            if done == step:
                raise OSError("no room")
            return real(*args, **kwargs)
        return call

    monkeypatch.setattr("millwright.sources.load.stage", counted(versions.stage))
    monkeypatch.setattr(files, "create_text", counted(files.create_text))
    if step == 5:
        load_csvs(spark, str(csv), root)
    else:
        with pytest.raises(OSError, match="no room"):
            load_csvs(spark, str(csv), root)
    tables = read_tables(spark, root)
    assert (tables.plants.count(), tables.machines.count()) == ((2, 2) if step == 5 else (1, 1))


def test_merge_equals_write_back_and_leaves_other_buckets(spark, tmp_path):
    root = str(tmp_path)
    kinds = "id long, x int, s string"
    table = spark.createDataFrame([(i, i, str(i)) for i in range(40)] + [(7, -7, "again"), (None, 1, "no key")], kinds)
    base = put(spark, root, t=table)
    before = content(root)
    updates = spark.createDataFrame([(7, 700), (99, 1), (None, 5), (8, 8)], "id int, x int")
    after = stage_merge(spark, root, base, "t", updates, ["x"])
    versions.publish(spark, root, base, {"t": after})
    assert rows_of(spark, root, "t") == sorted(map(tuple, write_back(table, updates, "id", ["x"]).collect()), key=repr)
    assert {r[1] for r in rows_of(spark, root, "t") if r[0] == 7} == {700}
    assert len(set(base.tables["t"].parts.values()) - set(after.parts.values())) == 1  # the bucket of key 7
    assert {p: b for p, b in content(root).items() if p in before} == before


def test_merge_without_effect_and_repeated_keys(spark, tmp_path):
    root = str(tmp_path)
    base = put(spark, root, t=numbers(spark, 10), none=numbers(spark, 0))
    same = spark.createDataFrame([(3, 3), (77, 1)], "id long, x int")
    assert stage_merge(spark, root, base, "t", same, ["x"]) == base.tables["t"]
    assert stage_merge(spark, root, base, "none", same, ["x"]) == base.tables["none"]
    assert stage_merge(spark, root, base, "t", same.limit(0), ["x"]) == base.tables["t"]
    with pytest.raises(RepeatedKeys):
        stage_merge(spark, root, base, "t", same.unionByName(same), ["x"])
    to_null = spark.createDataFrame([(3, None)], "id long, x int")
    versions.publish(spark, root, base, {"t": stage_merge(spark, root, base, "t", to_null, ["x"])})
    assert (3, None, "3") in rows_of(spark, root, "t")


def test_replace_deletes_and_inserts(spark, tmp_path):
    root = str(tmp_path)
    base = put(spark, root, t=numbers(spark, 10))
    keys = spark.createDataFrame([(2,), (3,), (50,)], "id long")
    new = spark.createDataFrame([(3, 30, "a"), (3, 31, "b"), (50, 5, "c")], "id long, x int, s string")
    versions.publish(spark, root, base, {"t": stage_replace(spark, root, base, "t", keys, new)})
    kept = [r for r in sorted(map(tuple, numbers(spark, 10).collect())) if r[0] not in (2, 3)]
    assert rows_of(spark, root, "t") == sorted(kept + [(3, 30, "a"), (3, 31, "b"), (50, 5, "c")], key=repr)
    with pytest.raises(ValueError, match="outside"):
        stage_replace(spark, root, base, "t", keys.limit(1), new)


def snapshot(day, plant, oee, anomalies=1, mttr=1.25):
    return (date(2024, 1, 1) + timedelta(days=day), plant, oee, 0.5, 0.5, 0.5, mttr, 2.0, 0.1, 0.01, 1, anomalies, 10)


def test_refresh_by_difference_equals_a_new_computation(spark, tmp_path):
    root, buckets = str(tmp_path), 8
    who, work = plants(spark, ("Alpha", "Beta", "Gamma")), orders(spark, [{"risk_score": 0.9, "risk_label": 1}, {}])

    def check(rows, named=who):
        kpis = spark.createDataFrame(rows, KPI_SNAPSHOTS)
        for name, whole in (("mv_plant_summary", views.mv_plant_summary(kpis, named)), ("mv_daily_oee", views.mv_daily_oee(kpis, named))):
            assert rows_of(spark, root, name) == sorted(map(tuple, whole.collect()), key=repr)

    def save(rows, keys=None):
        base = versions.latest(spark, root)
        df = spark.createDataFrame(rows, KPI_SNAPSHOTS)
        if keys is None:
            table = versions.stage(df, root, refresh.KPIS, ["snapshot_date"], buckets)
        else:
            days = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=d),) for d in keys], "snapshot_date date")
            table = stage_replace(spark, root, base, refresh.KPIS, days, df)
        versions.publish(spark, root, base, {refresh.KPIS: table})

    rows = [snapshot(d, p, 0.1 + d / 100 + p / 1000) for d in range(12) for p in (1, 2)] + [snapshot(3, 3, None, None, None)]
    save(rows)
    assert refresh.refresh_views(spark, root, work, who, machines(spark))
    check(rows)
    assert refresh.refresh_views(spark, root, work, who, machines(spark)) == []  # nothing changed, nothing read
    check(rows)
    first = versions.latest(spark, root)
    # Day 2 changes, day 3 (the only one of the third plant) goes, day 40 is new.
    new = [snapshot(2, 1, 0.9876), snapshot(40, 2, 0.3333)]
    save(new, keys=[2, 3, 40])
    assert 0 < len(refresh.refresh_views(spark, root, work, who, machines(spark))) <= 3
    now = [r for r in rows if r[0].day not in (3, 4)] + new
    check(now)
    assert len(rows_of(spark, root, "mv_top_risk_work_orders")) == 1
    assert versions.read_stored(spark, root, first, "mv_plant_summary").count() == 3
    renamed = plants(spark, ("Alpha", "Other", "Gamma"))
    refresh.refresh_views(spark, root, work, renamed, machines(spark))
    check(now, renamed)


def test_changed_days(spark, tmp_path):
    root = str(tmp_path)
    rows = [snapshot(d, 1, 0.5) for d in range(4)]
    put(spark, root, kpi_snapshots=spark.createDataFrame(rows, KPI_SNAPSHOTS))
    now = spark.createDataFrame([rows[0], snapshot(1, 1, 0.6), rows[2], snapshot(9, 1, 0.5)], KPI_SNAPSHOTS)
    found = sorted(r[0].day for r in refresh.changed_days(spark, root, now).collect())
    assert found == [2, 4, 10]


BAD_PLANTS = (
    "plant_id,plant_code,plant_name,region,capacity_units,note\n"
    "1,P1,One,North,5.0,x\n"       # good: a whole number
    "two,P2,Two,,7,x\n"            # a word for a number
    "3,P3,Three,,7.5,x\n"          # half a unit
    "x4,P4,Four,,many,x\n"         # two cells
    "5,P5,Five\n"                  # torn
    "6,P6,\"Six, the last\",,,\n"  # good
    "7,P7,Seven,,1,x,y\n"          # one field too many
)


def test_rejected_lines_have_file_text_and_column(spark, tmp_path):
    (tmp_path / "plants.csv").write_text(BAD_PLANTS)
    checked = check_csv(spark, str(tmp_path / "plants.csv"), PLANTS)
    assert sorted(r["plant_id"] for r in checked.accepted().collect()) == [1, 6]
    found = {r["line"]: r for r in checked.rejected().collect()}
    assert len(found) == 5 and all(r["file"].endswith("plants.csv") for r in found.values())
    reasons = {line: [(x["column"], x["value"]) for x in r["reasons"]] for line, r in found.items()}
    assert reasons["two,P2,Two,,7,x"] == [("plant_id", "two")]
    assert reasons["3,P3,Three,,7.5,x"] == [("capacity_units", "7.5")]
    assert reasons["x4,P4,Four,,many,x"] == [("plant_id", "x4"), ("capacity_units", "many")]
    assert (None, "5,P5,Five") in reasons["5,P5,Five"] and (None, "7,P7,Seven,,1,x,y") in reasons["7,P7,Seven,,1,x,y"]


def test_a_load_counts_rejects_and_keeps_to_its_bound(spark, tmp_path):
    csv, root = tmp_path / "csv", str(tmp_path / "tables")
    csv.mkdir()
    (csv / "plants.csv").write_text(BAD_PLANTS)
    with pytest.raises(RejectedRows, match="plants: 5 of 7 lines"):
        load_csvs(spark, str(csv), root)
    assert versions.latest(spark, root).number == 0
    assert load_csvs(spark, str(csv), root, LoadConfig(max_reject_share=0.8)) == {"plants": 2}
    kinds = versions.read_stored(spark, root, versions.latest(spark, root), "rejects").schema
    rejects = read_published(spark, root, "rejects", kinds)
    assert rejects.count() == 5 and {r["table"] for r in rejects.collect()} == {"plants"}
