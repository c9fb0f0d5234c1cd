"""Hard negatives against a search through all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, uid string, block string"
LONG = (1 << 63) - 1


def brute(rows, step, cfg):
    good = [
        (n, i, y, [math.floor(x * 256) if abs(x) < 1e15 else int(x) * 256 for x in v]) for n, (i, v, y, *_) in enumerate(rows)
        if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, fit = [], lambda s: max(-LONG - 1, min(LONG, s))
    for n, i, y, v in good:
        if i is None or i % step:
            continue
        others = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, z) for m, j, z, w in good if m != n and len(w) == len(v)]
        others.sort(key=lambda t: t[:3])
        for s, null, j, _ in [o for o in others if o[3] == y][: cfg.positives]:
            inside = [o for o in others if o[3] != y and -cfg.low_percent * s <= -100 * o[0] <= -100 * s][: cfg.negatives]
            out += [(i, None if null else j, k, None if u else g, fit(-s), fit(-t)) for k, (t, u, g, _) in enumerate(inside, 1)]
    return sorted(out, key=str)


def table(seed, n):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0.3, 1, 6).round(2).tolist(), int(rng.integers(0, 3)), "a", "b") for i in range(n)]
    hot = [0.5, 0.25, 0.5, 0.0, 1.0, 0.75]
    rows += [(1000 + i, hot, i % 2, None, None) for i in range(n // 2)]
    rows += [rows[0], rows[0], (0, hot, 1, "a", "b"), (None, hot, 1, "a", "b"), (None, hot, 0, "a", "b"), (5, None, 1, "", ""), (10, hot, None, "", "")]
    rows += [(20, [None, *hot[1:]], 1, "", ""), (30, [float("nan"), *hot[1:]], 1, "", ""), (40, [float("inf"), *hot[1:]], 1, "", "")]
    rows += [(2000 + i, [1.0, float(i)], i % 2, "", "") for i in range(8)] + [(3000 + i, [], i % 2, "", "") for i in range(6)]
    return rows


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_equals_all_pairs(spark, monkeypatch, block_rows):
    monkeypatch.setattr(hn, "BLOCK_ROWS", block_rows)
    rows = table(3, 60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = hn.hard_negatives(df, F.col("id") % 10 == 0, F.col("label"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 10, hn.Mining())


def test_other_numbers_and_magnitudes(spark):
    rows = [(i, [1e12 * (i + 1), 3.0, -1e-9 * i], i % 3, "", "") for i in range(12)] + [(12, [1e200, 1.0, 0.0], 0, "", ""), (13, [1e200, 1.0, 0.0], 0, "", "")]
    cfg = hn.Mining(positives=2, negatives=3, low_percent=10)
    df = spark.createDataFrame(rows, SCHEMA)
    got = hn.hard_negatives(df, F.col("id") % 2 == 0, F.col("label"), cfg)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 2, cfg)


def test_iterator_streams_one_anchor_at_a_time():
    stream = hn._windows(hn.Mining(negatives=1))
    pairs = iter([((7, -10, 0, False, 1), 70), ((7, -9, 1, False, 2), 70), ((8, -5, 1, False, 2), 80)])
    out = stream(pairs)
    assert next(out) == (70, 1, 1, 2, 10, 9)
    assert list(out) == []


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(df, F.col("id") % 10 == 0, F.col("label")).count() == 0
