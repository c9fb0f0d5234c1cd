"""Periodic runs against a search by definition."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millwright.llm import queries
from millwright.llm.runs import PRIME, RunRule, find_runs, inverse_transform, periodic_runs, transform
from tests.llm.conftest import DOCS


def brute(words, min_words=24, times=3):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_words, times * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = j + 1
    return sorted((i, length, q) for (i, length), q in found.items())


def test_transform_inverts_and_convolves():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, PRIME, (3, 16)), rng.integers(0, PRIME, (3, 16))
    assert (inverse_transform(transform(a)) == a).all()
    made = inverse_transform(transform(a) * transform(b) % PRIME)
    want = [[sum(int(x[i]) * int(y[(k - i) % 16]) for i in range(16)) % PRIME for k in range(16)] for x, y in zip(a, b)]
    assert made.tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9))
def test_runs_by_definition(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(rng.randint(1, 5)):
        unit = [rng.randint(0, rng.choice([1, 2, 4, 50])) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 60]))]
        times = rng.choice([1, 2, 3, 3, 4, 9])
        out += (unit * times)[: len(unit) * times - rng.randint(0, min(2, len(unit)))]
        out += [rng.randint(0, 60) for _ in range(rng.randint(0, 12))]
    assert find_runs(np.array(out, np.int64)) == brute(out)


@pytest.mark.parametrize("words", [[], [1], [1] * 23, [1] * 24, [1] * 1000, list(range(300)), [0, 1] * 500 + [0, 2] * 400, [0] * 100 + [1] + [0] * 99])
def test_plain_cases(words):
    assert find_runs(np.array(words, np.int64)) == brute(words)


def test_long_text_is_quick():
    words = list(range(70_000)) * 3 + [5] * 100_000
    assert find_runs(np.array(words)) == [(0, 210_000, 70_000), (210_000, 100_000, 1)]


def test_rule_needs_three_periods():
    with pytest.raises(ValueError):
        RunRule(min_times=2)


def test_odd_rows_and_clashing_columns(spark, odd_docs, no_docs):
    docs = odd_docs.selectExpr("*", "1 AS runs", "2 AS r", "3 AS doc")
    rows = periodic_runs(docs).collect()
    assert len(rows) == docs.count() and {r.r for r in rows} == {2} and {r.doc for r in rows} == {3}
    for r in rows:
        words = (r.text or "").split(" ") if (r.text or "").startswith("w") else (r.text or "").split()
        assert r.n_words == len(words) and (r.collapsed == "") == (not words)
    long = next(r for r in rows if r.doc_id == 4)
    assert [tuple(x) for x in long.runs] == [(0, 20_000, 997)] and long.collapsed == " ".join(f"w{i}" for i in range(997))
    assert periodic_runs(no_docs).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 300))) for _ in range(80)]
    texts += [None, "", "  \n", "a b " * 40, "x " * 30 + "\ty\n" + "x y z " * 9]
    rows = [(i * 7 + (1 << 54), t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, "z " * 40, "en", "s", 0)]
    spark.createDataFrame(rows, DOCS).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got, planted = {r.doc_id: r for r in queries.op12_runs(spark, str(tmp_path)).collect()}, 0
    for i, t, *_ in rows:
        words = (t or "").split()
        n, h = len(words), 1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g, planted = h // 10, planted + 1
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = brute(words)
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        want = (
            i, len(runs), *best, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
            sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
        )
        assert tuple(got[i]) == want
    assert planted > 2 and len(got) == len(rows)
