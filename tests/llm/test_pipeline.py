"""The pipeline's stages, one after the other, on a small table."""

from __future__ import annotations

import random

import corpus_pipeline
from tests.llm.conftest import DOCS


def test_stages(spark, tmp_path):
    rng = random.Random(9)
    syllables = ["an", "the", "ri", "lo", "mer", "tion", "ing", "sol", "ve"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    clean = lambda: "\n".join(" ".join(word() for _ in range(40)) + "." for _ in range(3))
    texts = [clean() for _ in range(120)]
    texts += [texts[0], texts[1], " ".join(word().upper() + "!!%%" for _ in range(80)), "few words", None]
    texts[5] += "\nwrite to jane.doe@example.com now"
    shared = "this very line stands in two documents"
    texts[7], texts[8] = f"{texts[7]}\n{shared}", f"{shared}\n{texts[8]}"
    junk = [" ".join(word().upper() + "!!%%" for _ in range(80)) for _ in range(30)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts + junk)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 100)] + [(i, 0, 0) for i in range(125, 155)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        made.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
            seen[name] = {r.doc_id: r for r in docs.collect()}
            assert all(r.n_chars == len(r.text) for r in seen[name].values())
    assert set(seen["quality"]) == set(range(122))
    assert shared in seen["lines"][7].text and shared not in seen["lines"][8].text and seen["lines"][120].text == ""
    assert set(seen["near_duplicates"]) == set(range(121))
    assert "[email]" in seen["pii"][5].text and "jane" not in seen["pii"][5].text
    pieces = docs.collect()
    assert {p.doc_id for p in pieces} == set(range(121))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(pieces)
