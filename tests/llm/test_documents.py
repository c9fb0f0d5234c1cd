"""Operators on documents against brute force, and on awkward input."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millwright.llm import bpe, packing, pii, quality, simhash, tagger
from millwright.llm.components import components
from millwright.llm.line_dedup import dedup_lines
from millwright.llm.queries import RANKS, TOKENIZER
from millwright.llm.sharding import balanced_shards

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def slow_fingerprint(text):
    words = WORD.findall(fold(text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b, n in counts.items() if 2 * n > len(shingles))


def classes_of(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@given(st.text(alphabet="ab A\n\tÉ", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [2, 4])
def test_masks_cover(radius):
    rng = random.Random(radius)
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(2000):
        bits = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not bits & m for m in masks)


def test_linked_fingerprints_equal_all_pairs(spark):
    rng = random.Random(1)
    prints = set()
    for _ in range(40):
        prints.add(at := rng.getrandbits(64))
        for _ in range(6):
            prints.add(at := at ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = classes_of(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2])
    edges = simhash.linked_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"))
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 2 for r in edges.collect())
    found = {r.node: r.root for r in components(edges).collect()}
    assert {p: found.get(p, p) for p in signed} == want


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(5, 5), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_on_odd_documents(odd_docs, no_docs):
    found = simhash.near_duplicates(odd_docs)
    rows = {(r.doc_id, r.fp): r.component_id for r in found.collect()}
    assert found.count() == odd_docs.count()
    assert rows[(1, 0)] == rows[(2, 0)] == rows[(3, 0)] == rows[(None, 0)] == 1
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and all(r["_hash"] == r["key"] == "x" for r in kept.collect())
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7, 8]
    assert simhash.near_duplicates(no_docs).count() == simhash.drop_near_duplicates(no_docs).count() == 0


def slow_lines(docs):
    key = lambda line: fold(line.strip(" \t\n\x0b\f\r"))
    homes = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            homes.setdefault(key(line), set()).add(i)
    first = {k: min(x for x in v if x is not None) for k, v in homes.items() if len(k) >= 10 and len(v) >= 2}
    return [
        (i, "\n".join(x for x in (text or "").split("\n") if first.get(key(x), i) == i), (text or "").count("\n") + 1)
        for i, text in docs
    ]


def test_line_dedup(spark, odd_docs, no_docs):
    rng = random.Random(2)
    lines = ["a common line here", "A Common LINE here\t", "short", "", "another shared line", " x ", "not so common line"]
    docs = [(i, "\n".join(rng.choice(lines) + ("" if rng.random() < 0.8 else str(i)) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    out = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert sorted((r.doc_id, r.text, r.n_lines) for r in out.collect()) == sorted(slow_lines(docs))
    odd = dedup_lines(odd_docs)
    assert set(odd.columns) == {*odd_docs.columns, "n_dropped"} and all(r["_hash"] == r["pos"] == "x" for r in odd.collect())
    want = slow_lines([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert Counter((r.doc_id, r.text, r.n_lines) for r in odd.collect()) == Counter(want)
    assert dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize("hot", [0, 400])
def test_shards_are_even_and_keep_copies_together(spark, hot):
    rows = [(i, f"text {i}") for i in range(600)] + [(1000 + i, f"pair {i % 150}") for i in range(300)]
    rows += [(2000 + i, "hot") for i in range(hot)]
    found = balanced_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 24).collect()
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(s) for s in slots.values()]
    assert len(found) == len(rows) and max(counts) - min(counts) <= 1
    text = dict(rows)
    places = {}
    for r in found:
        places.setdefault(text[r.doc_id], set()).add(r.shard)
        assert (r.size, r.text_crc32) == (len(text[r.doc_id]) + 8, zlib.crc32(text[r.doc_id].encode()))
    pairs = [p for t, p in places.items() if t.startswith("pair")]
    assert sum(len(p) == 1 for p in pairs) >= 0.9 * len(pairs)


@pytest.mark.parametrize("sizes,most", [([80], 0), ([80] * 12 + [20] * 30 + [2] * 200, 24), ([50] * 48, 4), ([800], 1)])
def test_groups_that_fit_a_shard_stay_whole(spark, sizes, most):
    texts = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)]
    texts += [f"single {i}" for i in range(2400 - len(texts))]
    found = balanced_shards(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), 24).collect()
    places = {}
    for r in found:
        places.setdefault(texts[r.doc_id], set()).add(r.shard)
    counts = Counter(r.shard for r in found)
    assert set(counts.values()) == {100}
    cut = [t for t, p in places.items() if len(p) > 1]
    assert len(cut) <= most and (len(sizes) > 1 or all(len(places[t]) <= 12 for t in cut))


def test_shards_of_odd_documents(odd_docs, no_docs):
    found = balanced_shards(odd_docs).collect()
    assert sorted(r.slot for r in found) == [0] * odd_docs.count() and len({r.shard for r in found}) == len(found)
    assert balanced_shards(no_docs).count() == 0


def slow_measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


@given(st.text(alphabet="ab #\n\té ", max_size=60))
def test_measures(text):
    assert quality.measures(text) == slow_measures(text)


def test_quality_separates_and_keeps_all_rows(spark, odd_docs, no_docs):
    rng = random.Random(4)
    clean = lambda: " ".join(rng.choice(["river", "stone", "light", "garden", "of", "the"]) + rng.choice(["", "s", "ly"]) for _ in range(90))
    junk = lambda: " ".join(rng.choice(["RIVER", "STONE", "GARDEN"]) + rng.choice(["!!", "%%%", "###"]) + str(rng.randint(0, 99)) for _ in range(90))
    docs = [(i, clean() if i % 4 else junk()) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 400, 2)] + [(None, 1), (1, None)], "doc_id long, quality int")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    model = quality.fit_quality(frame, labels)
    kept = {r.doc_id: r.kept for r in quality.judge(frame, model).collect()}
    assert all(kept[i] == bool(i % 4) for i, _ in docs)
    odd = quality.judge(odd_docs, model)
    assert odd.count() == odd_docs.count() and len(set(odd.columns)) == len(odd.columns)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in odd.collect())
    nothing = quality.fit_quality(frame, labels.limit(0))
    assert all(r.kept == (not r.base_failed) for r in quality.judge(frame, nothing).collect())
    assert quality.judge(no_docs, quality.fit_quality(no_docs, labels)).count() == 0


def test_quality_uses_every_label(spark):
    rng = random.Random(8)
    n = 24_000
    texts = ["".join(rng.choice("abcdef" if i % 3 else "defghi") for _ in range(rng.randint(0, 12))) for i in range(n)]
    good = [i % 3 > 0 or i % 30 == 0 for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels, keep_share=0.9)

    fit = {r.id for r in spark.range(n).where("pmod(xxhash64('fit', id), 2) = 0").collect() if good[r.id]}
    counts = np.ones((2, 2, quality.BUCKETS))
    for i, text in enumerate(texts):
        for found in quality.buckets(text):
            for side in (0, 1) if i in fit else (0,):
                np.add.at(counts[side].reshape(-1), found, 1)
    logs = np.log(counts / counts.sum(axis=2, keepdims=True))
    assert np.allclose(model.weights, (logs[1] - logs[0]).reshape(-1), rtol=0, atol=1e-12)

    scores = [(quality.score(t, model.weights.astype(np.float32)), good[i]) for i, t in enumerate(texts) if i not in fit]
    ok, bad = (np.sort([s for s, g in scores if g is kind]) for kind in (True, False))
    cuts = sorted({s for s, _ in scores if np.searchsorted(ok, s) <= int((1 - 0.9) * len(ok))})
    best = max(cuts, key=lambda c: (int(np.searchsorted(bad, c)) * len(ok) - int(np.searchsorted(ok, c)) * len(bad), -c))
    assert model.threshold == (best + cuts[cuts.index(best) - 1]) / 2
    frame = spark.createDataFrame(scores, "score double, good boolean")
    assert quality.pick_threshold(frame, 0.9, max_rows=0) == model.threshold
    assert quality.pick_threshold(frame.where("good"), 0.9) == -np.inf


def slow_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0])):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@settings(max_examples=500)
@given(st.one_of(st.text(alphabet="a@.1 +-(%", max_size=40), st.text(alphabet="1.2", max_size=30), st.text(alphabet="+0(4) -", max_size=30)))
def test_base_spans(text):
    assert pii.base_spans(text) == slow_spans(text)


def test_luhn_cards():
    assert pii.base_spans("x 4111 1111 1111 1111 y 4111111111111112") == [(2, 2, 21)]


def test_gradients():
    p, rng = tagger.initial(3, 4, 5, 0), np.random.default_rng(1)
    x, y = rng.integers(0, 20, (4, 7)), rng.integers(0, 3, (4, 7))
    loss, gradients = tagger.loss_and_gradients(p, x, y)
    for name, values in p.items():
        at = tuple(rng.integers(0, n) for n in values.shape) if name != "embed" else (int(x[0, 0]), 1)
        near = {k: v.copy() for k, v in p.items()}
        near[name][at] += 1e-5
        assert (tagger.loss_and_gradients(near, x, y)[0] - loss) / 1e-5 == pytest.approx(gradients[name][at], abs=1e-3)


def test_tagger_finds_held_out_spellings(spark, odd_docs, no_docs):
    rng = random.Random(6)
    words = lambda: " ".join(rng.choice(["then", "river", "light", "of", "version 2.0", "in 1999,"]) for _ in range(8))
    phone = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    mail = lambda: f"user.{rng.randint(10, 99)}@mail{rng.randint(1, 9)}.example.com"
    texts = [f"{words()} {rng.choice([phone, mail])()} {words()}" for _ in range(500)] + [words() for _ in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:400] + texts[500:])], "doc_id long, text string")
    model = pii.fit_tagger(docs)
    held = [re.sub(r"\+1 ", "", t) for t in texts[400:500] if "(" in t]
    found = pii.find_all(held, model)
    right = sum(any(k == 3 and t[a:b] == re.search(r"\(\d+\) [\d-]+", t)[0] for a, k, b, _ in s) for t, s in zip(held, found))
    assert right >= 0.9 * len(held)
    assert all(b for s in pii.find_all(texts[500:], model) for *_, b in s)
    odd = pii.find_pii(odd_docs, model)
    assert odd.count() == odd_docs.count() and len(set(odd.columns)) == len(odd.columns)
    assert [(s.kind, s.base) for s in odd.where("doc_id = 8").first().spans] == [("email", True), ("card", True)]
    masked = {r.doc_id: r.text for r in pii.mask_pii(odd_docs, model).collect()}
    assert masked[8] == "é日本 😀 [email] [card]" and masked[2] == "" and masked[1] is None
    assert pii.fit_tagger(no_docs) is None and pii.find_pii(no_docs, None).count() == 0


def test_windows_meet_in_one_answer():
    assert pii.stretches("a" * 100 + "1" + "b" * 200 + "2") == [(2, 4), (8, 10)]
    assert pii.mask("ab12cd", [(1, 1, 3, True), (2, 3, 4, True)]) == "a[ip]cd"


@pytest.fixture(scope="module")
def multi():
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Bpe(ranks, public_tokenizers.PATTERN), own


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=" \n\tab'1.é s", max_size=60), st.text(alphabet="abce", max_size=300)))
def test_bpe_equals_the_library(multi, text):
    own, library = multi
    ids = own.encode(text)
    assert ids == library.encode_ordinary(text)
    assert own.decode(ids) == text.encode()
    if text:
        assert bpe.merge(text.encode(), own.ranks) == library._encode_single_piece(text.encode())


def test_bpe_of_a_long_piece(multi):
    own, _ = multi
    assert own.decode(own.encode("ab" * 50_000)) == b"ab" * 50_000


def test_bpe_columns(spark, odd_docs, no_docs):
    ids = bpe.encoded(F.col("text"), RANKS, public_tokenizers.PATTERN)
    out = odd_docs.select("text", ids.alias("t")).withColumn("back", bpe.decoded(F.col("t"), RANKS, public_tokenizers.PATTERN))
    assert all(bytes(r.back) == (r.text or "").encode() for r in out.collect())
    assert no_docs.select(ids).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=" \n\tab'1.é s<|", max_size=60)))
def test_token_ids_equal_the_tokenizers_library(text):
    library = Tokenizer.from_file(TOKENIZER)
    library.encode_special_tokens = True
    assert packing.token_ids(TOKENIZER).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_packing(spark, odd_docs, no_docs):
    library = Tokenizer.from_file(TOKENIZER)
    for docs in (odd_docs, spark.createDataFrame([(i, "copy " * (i % 700)) for i in range(200)], "doc_id long, text string")):
        want = Counter(np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for r in docs.collect())
        pieces = packing.pack(docs, TOKENIZER).collect()
        windows = {}
        for p in pieces:
            windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
        for spans in windows.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= 1024
        assert sum(sum(n for _, n in s) < 1024 for s in windows.values()) <= 1
        assert sum(p.length for p in pieces) == sum(len(x) // 4 * n for x, n in want.items())
        crcs = {(p.doc_id, p.start, p.length, p.doc_tokens): p.ids_crc32 for p in pieces}
        whole = {zlib.crc32(x) for x in want}
        assert all(c in whole for (_, start, length, total), c in crcs.items() if (start, length) == (0, total))
    assert packing.pack(no_docs, TOKENIZER).count() == 0


def test_bm25_neighbours_equal_brute_force():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 60, rng.integers(5, 20)).astype("<u4") for _ in range(50)]
    index = packing.Bm25(docs)
    df = Counter(t for d in docs for t in set(d.tolist()))
    mean = np.mean([len(d) for d in docs])

    def weight(term, doc):
        n = Counter(doc.tolist())[term]
        idf = np.log1p((len(docs) - df[term] + 0.5) / (df[term] + 0.5))
        return idf * n * (packing.K1 + 1) / (n + packing.K1 * (1 - packing.B + packing.B * len(doc) / mean))

    scores = [sum(weight(t, d) for t in set(docs[0].tolist())) if i else 0 for i, d in enumerate(docs)]
    used = np.zeros(len(docs), bool)
    used[0] = True
    assert index.neighbours(0, used, 5).tolist() == np.argsort(-np.array(scores), kind="stable")[:5].tolist()
    assert sorted(packing.pack_order(docs, 64)) == list(range(50))


def test_line_dedup_query_equals_sql(spark):
    from millwright.llm.queries import QUERIES
    from millwright.llm.sql import ORACLES

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(con.execute(ORACLES["op2_line_dedup"]).fetchall())
    got = QUERIES["op2_line_dedup"](spark, "/root/testdata/sf0.001").select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == want


def test_many_short_documents_are_packed_in_bounded_indexes(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a b', '') AS text")
    pieces = packing.pack(docs, TOKENIZER, shard_tokens=40_000).collect()
    assert sorted(p.doc_id for p in pieces if p.start == 0) == list(range(3000))
    windows = {}
    for p in pieces:
        windows[p.sequence_id] = windows.get(p.sequence_id, 0) + p.length
    shards = -(-sum(p.doc_tokens + packing.DOCUMENT_COST for p in pieces if p.start == 0) // 40_000)
    assert sum(n < 1024 for n in windows.values()) <= shards
