"""Ordered operators against plain Python, on both the plain and the block path."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millwright.operators.ordering import LastBefore, RollingRows, RowNumber, over_key_order, row_index, running_sums
from millwright.operators.sampling import hash_sample
from millwright.operators.stats import contiguous_spans, exact_quantile, histogram, pareto


def _rows(n=600, hot_share=0.5, seed=3):
    rng = random.Random(seed)
    keys = [1 if rng.random() < hot_share else rng.randint(2, 9) for _ in range(n)]
    return [
        (i, keys[i], rng.randint(0, n // 3), float(rng.randint(0, 9)), i if rng.random() < 0.02 else None)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def frame(spark):
    rows = _rows()
    return rows, spark.createDataFrame(rows, "id long, k int, t int, v double, mark long").repartition(5)


def _expected(rows, n, skip):
    out = {}
    for key in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        last = None
        for i, r in enumerate(group):
            window = group[max(0, i - n):i] if skip else group[max(0, i - n + 1):i + 1]
            out[r[0]] = (sum(w[3] for w in window) if window else None, i + 1, last)
            last = r[4] if r[4] is not None else last
    return out


@pytest.mark.parametrize("max_group, block", [(10**6, 100), (0, 7), (0, 40), (0, 10**6)])
@pytest.mark.parametrize("skip", [False, True])
def test_over_key_order(frame, max_group, block, skip):
    rows, df = frame
    specs = [RollingRows("s", lambda: F.sum("v"), 5, skip), RowNumber("n"), LastBefore("last", "mark")]
    out = over_key_order(df, "k", [F.col("t").asc(), F.col("id").asc()], specs, max_group, block)
    assert out.columns == [*df.columns, "s", "n", "last"]
    got = {r["id"]: (r["s"], r["n"], r["last"]) for r in out.collect()}
    assert got == _expected(rows, 5, skip)


def test_frame_longer_than_block(frame):
    rows, df = frame
    specs = [RollingRows("s", lambda: F.sum("v"), 30)]
    out = over_key_order(df, "k", [F.col("t").asc(), F.col("id").asc()], specs, 0, 3)
    want = {i: v[0] for i, v in _expected(rows, 30, False).items()}
    assert {r["id"]: r["s"] for r in out.collect()} == want


def test_row_index_is_exact(frame):
    rows, df = frame
    out = row_index(df, [F.col("t").desc(), F.col("id").asc()])
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    assert {r["id"]: r["row_index"] for r in out.collect()} == want


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_running_sums(frame, max_rows):
    rows, df = frame
    out = running_sums(df, [F.col("t").asc(), F.col("id").asc()], {"c": "v"}, max_rows)
    total, want = 0.0, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        total += r[3]
        want[r[0]] = total
    assert {r["id"]: r["c"] for r in out.collect()} == want


def test_no_single_task_window_in_block_plan(frame):
    _, df = frame
    out = over_key_order(df, "k", [F.col("t").asc(), F.col("id").asc()], [RollingRows("s", lambda: F.sum("v"), 5)], 0, 50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_block" in plan


@pytest.mark.parametrize("n", [0, 1, 50, 600, 9999])
def test_hash_sample_size_and_stability(frame, n):
    rows, df = frame
    one = {r["id"] for r in hash_sample(df, "id", n, 7).collect()}
    two = {r["id"] for r in hash_sample(df.repartition(3), "id", n, 7).collect()}
    assert len(one) == min(n, len(rows))
    assert one == two


@pytest.mark.parametrize("max_rows", [10**6, 0])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_exact_quantile(spark, q, max_rows):
    import numpy as np

    values = [float(v) for v in np.random.default_rng(5).integers(0, 40, 301)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantile(df, "x", q, max_rows=max_rows).first()["quantile"]
    assert got == pytest.approx(float(np.quantile([v for v in values if v is not None], q)))


def test_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantile(df, "x", 0.5).first()["quantile"] is None


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_pareto(spark, max_rows):
    df = spark.createDataFrame([("a", 1), ("b", 6), ("c", 3), ("b", 0), (None, 9)], "p string, d int")
    got = [(r["p"], r["total"], r["pct"], r["cum_pct"]) for r in pareto(df, "p", "d", max_rows).orderBy("pareto_rank").collect()]
    assert got == [("b", 6, 60.0, 60.0), ("c", 3, 30.0, 90.0), ("a", 1, 10.0, 100.0)]


def test_pareto_without_defects(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "p string, d int")
    assert [r["pct"] for r in pareto(df, "p", "d").collect()] == [0.0, 0.0]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.0199,), (0.02,), (0.999,), (1.0,), (None,)], "x double")
    assert {r["bin"]: r["n"] for r in histogram(df, "x", 50).collect()} == {0: 2, 1: 1, 49: 2}


def test_contiguous_spans(spark):
    days = ["2022-01-01", "2022-01-02", "2022-01-04", "2022-01-07"]
    df = spark.createDataFrame([("a", d) for d in days], "k string, d string").withColumn("d", F.col("d").cast("date"))
    got = [(str(r["span_start"]), str(r["span_end"]), r["days"]) for r in contiguous_spans(df, "k", "d", 2).orderBy("span").collect()]
    assert got == [("2022-01-01", "2022-01-04", 3), ("2022-01-07", "2022-01-07", 1)]


@pytest.mark.parametrize("max_group", [10**6, 0])
def test_null_keys_have_no_group(spark, max_group):
    rows = [(i, None if i % 3 == 0 else i % 2, i) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, k int, v long")
    specs = [RollingRows("s", lambda: F.sum("v"), 3), RowNumber("n"), LastBefore("last", "v")]
    out = {r["id"]: r for r in over_key_order(df, "k", [F.col("id")], specs, max_group, 7).collect()}
    for key in (0, 1):
        group = [r for r in rows if r[1] == key]
        for i, r in enumerate(group):
            assert (out[r[0]]["n"], out[r[0]]["last"]) == (i + 1, group[i - 1][2] if i else None)
            assert out[r[0]]["s"] == sum(x[2] for x in group[max(0, i - 2):i + 1])
    assert all((out[r[0]]["s"], out[r[0]]["n"], out[r[0]]["last"]) == (None,) * 3 for r in rows if r[1] is None)


def test_running_sums_over_nulls(spark):
    df = spark.createDataFrame([(i, i if i in (10, 20, 30) else None) for i in range(40)], "id long, v long").repartition(4)
    one, many = (running_sums(df, [F.col("id")], {"t": "v"}, n).orderBy("id").collect() for n in (100, 0))
    assert one == many
    assert [r["t"] for r in one] == [sum(x for x in (10, 20, 30) if x <= i) for i in range(40)]


@pytest.mark.parametrize("n", [20, 50, 100, 200])
def test_hash_sample_keeps_rows_without_ids(spark, n):
    df = spark.createDataFrame([(None if i < 30 else i,) for i in range(100)], "id long")
    assert hash_sample(df, "id", n).count() == min(n, 100)
