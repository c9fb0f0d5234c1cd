"""External suffix sorting and the removal of repeated strings, against brute force."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millwright.llm import induced, queries, substrings
from millwright.llm.induced import DiskQueue, SuffixSorter
from tests.llm.conftest import DOCS


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9))
def test_suffixes_and_prefixes(tmp_path_factory, seed):
    rng = random.Random(seed)
    text = [rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 60))] * rng.choice([1, 1, 2, 4]) + [0]
    cap, folder = rng.choice([1, 3, 100]), str(tmp_path_factory.mktemp("sort"))
    induced.SLICE, before = rng.choice([1, 2, 5, 1 << 18]), induced.SLICE
    try:
        sorter = SuffixSorter(np.array(text), max(text) + 1, folder, cap, held=rng.choice([0, 7, 1000]), in_memory=rng.choice([0, 5, 1000]))
        pairs = [(int(a), int(p)) for at, prefix in sorter.descending() for a, p in zip(at, prefix)]
    finally:
        induced.SLICE = before
    want = sorted(range(len(text) - 1), key=lambda i: text[i:], reverse=True)

    def common(a, b):
        k = 0
        while k < cap and text[a + k] == text[b + k]:
            k += 1
        return k

    assert [a for a, _ in pairs] == want
    assert [p for _, p in pairs][1:] == [common(a, b) for a, b in zip(want, want[1:])]
    assert not os.listdir(folder)


def test_queue_keeps_arrivals_in_order_on_disk(tmp_path):
    rng = np.random.default_rng(5)
    queue, want = DiskQueue(str(tmp_path), held=20), []
    for k in range(60):
        keys = rng.integers(0, 9, 5)
        queue.push(keys, np.arange(5) + 5 * k, np.zeros(5, np.uint16))
        want += [(int(x), 5 * k + i) for i, x in enumerate(keys)]
    assert queue.stored
    got = []
    while len((part := queue.peek(7))[0]):
        got += list(zip(part[0].tolist(), part[1].tolist()))
        queue.drop(part[3])
    assert got == sorted(want) and not os.listdir(tmp_path)


def brute(rows, length):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = np.zeros(len(data), bool)
        for a in range(len(data) - length + 1):
            piece = data[a : a + length]
            gone[a : a + length] |= piece in seen
            seen.add(piece)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int))).tolist()
        out[i] = (rows[i][0], len(data), int(gone.sum()), list(zip(edges[::2], edges[1::2])), bytes(np.frombuffer(data, np.uint8)[~gone]))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aébc") for _ in range(rng.randint(1, 4)))
    passage = [" ".join(word() for _ in range(rng.randint(length // 3, length))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(passage) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(0, length // 2))) for _ in range(rng.randint(0, 4))]
        text = rng.choice(["", " ", "\n"]).join(parts)
        if text and rng.random() < 0.5:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["x", "", "yy"]) + text[at + 1 :]
        texts.append(text)
    return texts + [None, "", "a" * (3 * length), "ab" * length, "a" * (length - 1), texts[0], texts[1]]


@pytest.mark.parametrize("seed, length, common, piece", [(1, 12, 10**6, 1 << 20), (2, 20, 3, 64), (4, 40, 3, 1 << 20), (3, 100, 10**6, 1 << 20)])
def test_equals_brute_force(spark, monkeypatch, seed, length, common, piece):
    monkeypatch.setattr(substrings, "COMMON_LEAST", common)
    monkeypatch.setattr(substrings, "SAMPLE", 1)
    monkeypatch.setattr(substrings, "PIECE_BYTES", piece)
    rows = [(i * 3, t) for i, t in enumerate(corpus(seed, length))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    if common == 3:
        assert len(substrings._common(df.selectExpr("doc_id AS number", "text"), length))
    got = {r.doc_id: (r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in substrings.remove_repeats(df, length).collect()}
    assert got == {v[0]: v for v in brute(rows, length).values()}


@pytest.mark.parametrize("seed, held", [(1, 1 << 16), (2, 3), (3, 0)])
def test_settled_segments(monkeypatch, seed, held):
    monkeypatch.setattr(substrings, "HELD_ROWS", held)
    rng = random.Random(seed)
    sides = lambda: rng.choice([0, 0, *range(1, 256)])
    contents = [(((rng.randint(-40, 40) << 16) | (sides() << 8) | sides()), c) for c in range(400)]
    contents += [((7 << 16) | (rng.randint(1, 255) << 8) | sides(), 1000 + c) for c in range(40)]
    rows = sorted((*rng.choice(contents), doc, rng.randint(0, 9)) for doc in range(900))
    names, parts, lo = ("m", "c", "doc", "pos", "size", "gone"), [], 0
    while lo < len(rows):
        step = rng.randint(1, 40)
        part = [(*r, 100, False) for r in rows[lo : lo + step]]
        parts.append(pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*part)], names))
        lo += step
    got = [tuple(r.values()) for b in substrings._settle(iter(parts)) for r in b.to_pylist()]
    firsts = [r for i, r in enumerate(rows) if not i or rows[i - 1][:2] != r[:2]]
    like = lambda a, b: a != b and a >> 16 == b >> 16 and ((a ^ b) & 0xFF == 0 != a & 0xFF or (a ^ b) & 0xFF00 == 0 != a & 0xFF00)
    same = lambda a, b: a is not b and (a[0] == b[0] and a[0] & 0xFFFF > 0 or like(a[0], b[0]))
    need = {(r[0] >> 16, *r[2:], 100, True) for r in firsts if any(same(r, x) for x in firsts)}
    every = {(r[0] >> 16, *r[2:], 100, True) for r in firsts}
    found = {r for r in got if r[-1]}
    assert len(set(got)) == len(got) and need <= found <= every and (held < 4 or found == need < every)
    assert {r for r in got if not r[-1]} == {(r[0] >> 16, *r[2:], 100, False) for r in set(rows) - set(firsts)}


def test_only_segments_with_a_like_side_are_compared(spark):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    phrase, longer = noise(60), noise(130)
    texts = [noise(150) + phrase + noise(150) for _ in range(30)] + [noise(120) + longer + noise(120) for _ in range(2)]
    base = spark.createDataFrame(list(enumerate(texts)), "number long, text string").repartition(3)
    # Beside 60 shared bytes no string of 100 is: hardly any of the 30 documents is to be sorted. The other two are.
    docs = [r.doc for r in substrings._settled(base, 100).where("first").collect()]
    assert len({d for d in docs if d < 30}) < 10 and {30, 31} <= set(docs)
    got = {r.number: (r.n_removed, bytes(r.kept)) for r in substrings.remove_repeats(base.selectExpr("number", "number AS doc_id", "text")).collect()}
    assert got == {k: (v[2], v[4]) for k, v in brute(list(enumerate(texts)), 100).items()}


@pytest.mark.parametrize("few, dtype", [(0, np.int64), (1 << 9, np.int64), (0, np.uint16), (1 << 9, np.uint16)])
def test_buckets_and_stretches_give_one_order(tmp_path, monkeypatch, few, dtype):
    monkeypatch.setattr(induced, "FEW", few)
    for seed in range(40):
        rng = random.Random(seed)
        monkeypatch.setattr(induced, "SLICE", rng.choice([1, 3, 1 << 18]))
        text = [rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 60))] * rng.choice([1, 3]) + [0]
        cap = rng.choice([2, 7, 30])
        sorter = SuffixSorter(np.array(text, dtype), 6, str(tmp_path), cap, held=rng.choice([0, 9, 1000]), in_memory=rng.choice([0, 5, 1000]))
        pairs = [(int(a), int(p)) for at, prefix in sorter.descending() for a, p in zip(at, prefix)]
        order = sorted(range(len(text) - 1), key=lambda i: text[i:], reverse=True)
        common = [len(os.path.commonprefix([text[a : a + cap], text[b : b + cap]])) for a, b in zip(order, order[1:])]
        assert [a for a, _ in pairs] == order and [p for _, p in pairs][1:] == common and not os.listdir(tmp_path)


def test_a_scan_of_bytes_puts_no_tuple_in_order_twice(tmp_path, monkeypatch):
    seen, peek = [], DiskQueue.peek
    monkeypatch.setattr(DiskQueue, "peek", lambda self, limit: (part := peek(self, limit), seen.append(len(part[0])))[0])
    rng = random.Random(3)
    text = np.array([rng.randint(2, 200) for _ in range(20_000)] * 2 + [0], np.uint16)
    assert sum(len(at) for at, _ in SuffixSorter(text, 258, str(tmp_path), 100).descending()) == len(text) - 1
    assert sum(seen) < len(text)  # the stars by their first characters only


def test_doubling():
    rng = random.Random(2)
    for _ in range(200):
        names = [rng.randint(1, rng.choice([1, 2, 9])) for _ in range(rng.randint(0, 50))] * rng.choice([1, 3]) + [0]
        assert induced.doubled(np.array(names)).tolist() == sorted(range(len(names)), key=lambda i: names[i:])


def test_odd_rows_and_clashing_columns(spark, odd_docs, no_docs):
    docs = odd_docs.selectExpr("*", "1 AS number", "3 AS r")
    rows = substrings.remove_repeats(docs, 5).collect()
    assert len(rows) == docs.count() and {r.number for r in rows} == {1} and {r.r for r in rows} == {3}
    assert [r.n_removed for r in rows if r.doc_id is None] != [] and all(r.n_bytes == len((r.text or "").encode()) for r in rows)
    fives = sorted((r.n_removed, bytes(r.kept)) for r in rows if r.doc_id == 5)
    assert fives == [(0, b"one two"), (7, b"")]
    assert sorted(bytes(r.kept) for r in rows if r.doc_id is None) == [b"", b""]
    assert substrings.remove_repeats(no_docs).count() == 0


def test_query(spark, tmp_path):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(corpus(9, 100))]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in queries.op13_substrings(spark, str(tmp_path)).collect()}
    assert got == {v[0]: (v[1], v[2], len(v[3])) for v in brute(rows, 100).values()}
