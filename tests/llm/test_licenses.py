"""Licence scans against brute force, and inheritance along paths."""

from __future__ import annotations

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from millwright.llm import licenses


def slow_best(line):
    idf, other, vectors = licenses.weights(licenses.NOTICES)
    counts = Counter(licenses._words(line))
    norm = math.sqrt(sum((n * idf.get(w, other)) ** 2 for w, n in counts.items())) or 1
    scores = [(-round(sum(n * idf.get(w, other) * v.get(w, 0) for w, n in counts.items()) / norm, 9), name) for name, v in vectors.items()]
    score, name = min(scores)
    return (name, -score) if -score >= licenses.THRESHOLD else None


def test_lines_equal_brute_force(spark):
    lines = [*licenses.NOTICES.values(), "licensed UNDER the apache licence version 2.0!", "my rights", "license license", "",
             "Licensed under CC BY-NC 4.0.", "a long line that only speaks of a license among many other words", "nothing"]
    df = spark.createDataFrame([(i, 0, x) for i, x in enumerate(lines)], "row long, pos int, line string")
    found = {r.row: (r.license, r.score) for r in licenses.matching_lines(df, licenses.NOTICES, licenses.THRESHOLD).collect()}
    assert {k: v[0] for k, v in found.items()} == {i: b[0] for i, x in enumerate(lines) if (b := slow_best(x))}
    assert all(abs(found[i][1] - slow_best(lines[i])[1]) < 1e-8 for i in found)


def test_mangled_notices_equal_brute_force(spark):
    rng = random.Random(5)
    lines = []
    for text in licenses.NOTICES.values():
        for _ in range(60):
            words = licenses._words(text)
            for _ in range(rng.randrange(1, 4)):
                words.pop(rng.randrange(len(words))) if len(words) > 1 else None
            lines.append(" ".join([*words, *rng.choices(["the", "project", "license", "rights"], k=rng.randrange(3))]))
    df = spark.createDataFrame([(i, 0, x) for i, x in enumerate(lines)], "row long, pos int, line string")
    found = {r.row: r.license for r in licenses.matching_lines(df, licenses.NOTICES, licenses.THRESHOLD).collect()}
    assert found == {i: b[0] for i, x in enumerate(lines) if (b := slow_best(x))}


def test_inheritance(spark):
    mit, gpl = licenses.NOTICES["MIT"], licenses.NOTICES["GPL-3.0"]
    rows = [("LICENSE", mit), ("a/x.py", "code"), ("a/b/COPYING", f"some words\n{gpl}\nmore"), ("a/b/c/y.py", "code"), ("a/b/z.py", f"# {mit}\ncode"),
            ("q/only", f"\n{gpl}\n"), ("q/r/s", None), (None, "code"), (None, mit), ("a/x.py", "code")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, path string, text string").withColumn("row", F.lit("x")).withColumn("score", F.lit("y"))
    out = licenses.scan_licenses(df.repartition(3), F.col("path"))
    found = {r.doc_id: (r.license, r.license_from) for r in out.collect()}
    assert found == {
        0: ("MIT", "own"), 1: ("MIT", ""), 2: ("GPL-3.0", "own"), 3: ("GPL-3.0", "a/b"), 4: ("MIT", "own"), 5: ("GPL-3.0", "own"),
        6: ("GPL-3.0", "q"), 7: (None, None), 8: ("MIT", "own"), 9: ("MIT", ""),
    }
    assert {r.row for r in out.collect()} == {"x"}
    assert licenses.scan_licenses(df.limit(0), F.col("path")).count() == 0


def test_odd_documents(odd_docs):
    out = licenses.scan_licenses(odd_docs, F.concat_ws("/", "source", "doc_id"))
    assert out.count() == odd_docs.count() and set(out.columns) == {*odd_docs.columns, "license", "n_notices", "license_from"}
