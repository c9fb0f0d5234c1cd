"""Every registered query with SQL equals DuckDB, value for value."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con



def _key(row):
    return tuple((v is None, v or "") for v in row)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    as_text = lambda rows: sorted((tuple(None if v is None else repr(v) for v in r) for r in rows), key=_key)
    assert as_text(got) == as_text(want)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"snapshot_date", "plant_id", "oee_score"} <= set(df.columns)
