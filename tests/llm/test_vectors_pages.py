"""Nearest neighbours and page texts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import pages
from millwright.llm.curves import nearest
from millwright.llm.hilbert import hilbert_index


@pytest.mark.parametrize("dims, bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_hilbert_steps_to_a_neighbour(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    at = hilbert_index(cells, bits)
    assert sorted(at) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def _exact(rows, k):
    good = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in good:
        if q is not None and q % 20 == 0:
            scores = [(-float(np.cumsum(good[q] * v)[-1]), i) for i, v in good.items() if i is not None and i != q]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("scale", [False, True])
def test_recall_with_hot_vectors_and_useless_ones(spark, scale):
    rng = np.random.default_rng(7)
    unit = lambda v: v / np.linalg.norm(v)
    rows = [(i, (unit(rng.normal(size=16)) * (rng.uniform(0.5, 2) if scale else 1)).tolist()) for i in range(900)]
    rows += [(i, rows[0][1]) for i in range(900, 1300)]
    rows += [(1300, None), (1320, [0.0] * 16), (1340, [float("nan")] * 16), (1360, [None] + [1.0] * 15), (None, rows[1][1]), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).repartition(4)
    found = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = _exact(rows, 20)
    assert set(found) == set(want)
    hits = 0
    for q, mine in found.items():
        assert [r for r, _, _ in sorted(mine)] == list(range(1, 21))
        true = dict(want[q])
        hits += sum(i in true for _, i, _ in mine)
        assert all(s == pytest.approx(true[i], rel=1e-12) for _, i, s in mine if i in true)
        assert [(-s, i) for _, i, s in sorted(mine)] == sorted((-s, i) for _, i, s in mine)
    assert hits >= 0.9 * 20 * len(want)
    if not scale:
        assert [i for _, i, _ in sorted(found[900])] == [0, *range(901, 920)]


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in nearest(df, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 0.5)]
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">menu {i}</a></li></ul></nav><div class="ad">Buy {i}</div><div id='cookie-notice'>We use cookies</div>
<article><h1>Title {i}</h1><p>First &amp; <b>bold{i}<br>line  here<p>Second &lt;{i}&gt; paragraph</p><p>Read more on this site</p>
<form><input value="x>y">Sign up</form></article><section class="comments"><p>Nice {i}</p></section>
<aside>Side</aside><footer>&copy; host</footer></body></html>"""


def test_main_text_without_template(spark):
    rows = [(i, f"https://h.example/{i}", PAGE.format(i=i)) for i in range(12)]
    rows += [(100, "https://one.example/x", "<p>Only <i>text</i><div class=sidebar>no</div><p>a &lt; b"), (101, None, None), (102, "", "")]
    rows += [(103, "https://cut.example", "<article><p>cut off <a href="), (0, "https://h.example/0", PAGE.format(i=0))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert pages.main_text(df).count() == len(rows)
    for i in range(12):
        assert found[i] == f"Title {i}\nFirst & bold{i} line here\nSecond <{i}> paragraph"
    assert (found[100], found[101], found[102], found[103]) == ("Only text\na < b", "", "", "cut off")
    assert pages.main_text(df.limit(0)).count() == 0


def test_copies_of_a_page_make_no_template(spark):
    rows = [(i, f"https://h.example/{i}", PAGE.format(i=1)) for i in range(20)]
    found = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in found} == {"Title 1\nFirst & bold1 line here\nSecond <1> paragraph\nRead more on this site"}


@pytest.mark.parametrize("broadcast_tokens", [0, 100])
def test_template_goes_by_either_join(spark, broadcast_tokens):
    page = "<article><h1>Title {i}</h1><p>Own words {i}</p><p>Read more on this site</p></article>"
    rows = [(i, "https://h.example/x", page.format(i=i)) for i in range(12)] + [(20, "https://other.example", page.format(i=20))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r.page_id: r.text for r in pages.main_text(df, broadcast_tokens).collect()}
    assert {i: found[i] for i in range(12)} == {i: f"Title {i}\nOwn words {i}" for i in range(12)}
    assert found[20] == "Title 20\nOwn words 20\nRead more on this site"


@pytest.mark.parametrize("source, want", [
    ('<div class="layout has-sidebar"><p>Out</p><article><p>Text</p></article></div>', ["Text"]),
    ('<div id="page" class="no-comments"><article><p>Text</p></article></div>', ["Text"]),
    ('<div class="sidebar"><article><p>Text</p></article></div>', ["Text"]),
    ('<form><main><p>Text</p><form><p>Sign up</p></form></main></form>', ["Text"]),
    ('<article><section id="related-work"><p>Text</p></section><div class="notice-of-results"><p>More</p></div></article>', ["Text", "More"]),
    ('<main><h1>Top</h1><div class="banner"><article><p>Text</p></article></div></main>', ["Top", "Text"]),
    ('<article><p>Text</p><div class="comments"><article><p>Nice</p></article></div></article>', ["Text"]),
    ('<article><p>Text</p></article><div class="related"><article><p>Teaser</p></article></div>', ["Text"]),
    ('<main><p>Text</p></main><aside><article><p>Teaser</p></article></aside>', ["Text"]),
    ('<article><p>Text</p><div id="cookie-notice">Cookies</div></article><div hidden><article>Unseen</article></div>', ["Text"]),
])
def test_furniture_does_not_take_the_article(source, want):
    assert [text for _, text, inside in pages.read_page(source)[1] if inside] == want
