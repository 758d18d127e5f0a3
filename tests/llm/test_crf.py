from __future__ import annotations

import itertools
import time

import numpy as np
import pytest

from brute import plain_blocks

from orderloom.llm import crf
from orderloom.llm.dom import blocks_of
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return crf.train(crf.labelled_pages())


def texts(html):
    return [b.text for b in blocks_of(html)]


def test_blocks():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><p>a &amp; b&nbsp;\n c<br>d<p>e <b>f</b>g"
        "<ul><li>one<li>two <a href='x>y'>link</a></ul><!-- <p>no --><script>x='</p>'</script><div>h<div>i</div>j"
    )
    assert texts(page) == ["a & b c d", "e fg", "one", "two link", "h", "i", "j"]
    assert [b.linked for b in blocks_of(page)][3] == 4
    assert blocks_of(page)[1].path[-1][0] == "p" and len(blocks_of(page)[1].path) == 3
    assert blocks_of('<div class="siteHeader main-nav" id=x1>y')[0].path == (("div", ("site", "header", "main", "nav", "x")),)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<nav><svg class="i"/></nav><article><p>Long article text.</p></article>', ["Long article text."]),
        ("<header><button>Menu</header><article><p>Long text.</article>", ["Long text."]),
        ("<div><select><option>a</div><p>b", ["b"]),
        ("<div><iframe src=x></div><div><video><p>no</p></div><div><object></div><p>b", ["b"]),
        ("<p>a <button>x<div>y</div><br>z</button>b <svg><path d='M0'/><title/><text>t</text></svg>c</p>d", ["a b c", "d"]),
        ("<ul><li>a<template><li>x<p>y</template>b<li>c", ["ab", "c"]),
        ("<nav><svg><path><p>a</nav><p>b", ["a", "b"]),
        ("<p><button>a<button>b</button>c", ["c"]),
        ("<p>Let <math><mi>x</mi><mspace/><mo>=</mo><mn>1</mn></math> be.</p>", ["Let x=1 be."]),
        ("<script>'<p>no</p>'</SCRIPT ><textarea><p>no</textarea><p>b<style>p{}", ["b"]),
    ],
)
def test_hidden_elements_end_with_the_element_around_them(page, want):
    assert texts(page) == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>A&am<b>p;</b> x &l<i>t;</i></p>", ["A&amp; x &lt;"]),
        ("<p>a &lt<b>b</b> &amp; &#x41;</p>", ["a <b & A"]),
        ("<p title='5\" tall'>a</p><p title=\"it's\">b", ["a", "b"]),
        ('<p title="5" tall">a</p><p class=x>b</p>', ["a", "b"]),
        ("<p>a <x b", ["a <x b"]),
        ("<p>a</p> 1 < 2 <!-- b", ["a", "1 < 2"]),
        ("<p>a</p> b <q 'c", ["a", "b <q 'c"]),
    ],
)
def test_references_and_quotes(page, want):
    assert texts(page) == want


@pytest.mark.parametrize(
    "unit", ["<a href='x ", '<p class="', "</a ", "<a ", '<a x=">"', "<a x='>' ", "<a =\"'>", '<b x="', "<!", "<!-", "=\"<p>", "<a b='\">"]
)
def test_damaged_tags_take_linear_time(unit):
    def took(n):
        page = unit * n
        times = []
        for _ in range(3):
            began = time.process_time()
            blocks_of(page)
            times.append(time.process_time() - began)
        return min(times)

    small, large = took(8_000), took(64_000)
    assert large < 0.5 or large < 20 * small  # squared time: 64 times


def test_blocks_against_another_reader(spark):
    pages = [p.html for p in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert [texts(p) for p in pages] == [plain_blocks(p) for p in pages]


def test_pages_of_open_hidden_elements_take_linear_time():
    for page in ("<svg>", "<object>", "<button>", "<svg/>", "<title>x</title>", "<object></p>", "<math><p>x", "<select></div>"):
        began = time.time()
        blocks_of(page * 20_000)
        assert time.time() - began < 20


@pytest.mark.parametrize("html", [None, "", "  ", "<", "<a", "<p", "<!--", "<script>x", "</p></div>", "<p></p>"])
def test_pages_without_blocks(html, model):
    found = crf.main_text(html, crf.Scorer(model["weights"]), model)
    assert found == "" or html in ("<", "<a", "<p")


def test_long_and_damaged_pages_take_linear_time(model):
    scorer = crf.Scorer(model["weights"])
    for page in ("<div>" * 20_000 + "x", '<a "' * 20_000, "<p>word " * 20_000, "<" * 50_000, "<b>x" * 3_000, "<div>x" * 20_000):
        began = time.time()
        crf.main_text(page, scorer, model)
        assert time.time() - began < 20


def test_viterbi_against_all_label_runs():
    rng = np.random.default_rng(5)
    for n in range(1, 7):
        s, t, a, z = rng.normal(size=n).tolist(), rng.normal(size=(2, 2)), rng.normal(size=2), rng.normal(size=2)

        def worth(y):
            steps = sum(t[i, j] for i, j in zip(y, y[1:]))
            return a[y[0]] + z[y[-1]] + steps + sum(v for v, k in zip(s, y) if k)

        best = max(itertools.product((0, 1), repeat=n), key=worth)
        assert crf.viterbi(s, t.tolist(), a.tolist(), z.tolist()) == list(best)
        # Marginals against sums over all runs.
        every = list(itertools.product((0, 1), repeat=n))
        p = np.exp([worth(y) for y in every])
        want = [sum(w for w, y in zip(p, every) if y[i]) / p.sum() for i in range(n)]
        assert crf._expected(np.array(s), t, a, z)[0][:, 1] == pytest.approx(want)


def test_held_out_layouts(model):
    scorer, right, all_blocks = crf.Scorer(model["weights"]), 0, 0
    for blocks, labels in crf.labelled_pages(200, seed=77):
        found = crf.viterbi([scorer.score(b) for b in blocks], model["trans"], model["start"], model["end"])
        right += sum(a == b for a, b in zip(found, labels))
        all_blocks += len(labels)
    assert right / all_blocks > 0.99


def test_a_page_of_every_part(model):
    page = """<body><header class="site-header"><a href="/">The Daily</a></header>
    <div id="cookie-banner">We use cookies. <a href="#">Accept</a></div>
    <nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport</a></li></ul></nav>
    <div class="post-content"><h1>Harvest begins early</h1><p>Farmers in the north began the harvest this week,
    ten days before the usual date. The dry spring is to blame.</p><div class="advert">Buy boots now!</div>
    <h2>A dry year</h2><p>Rain fell on only four days. <em>Nobody</em> had seen that before.</p>
    <ul><li>Wheat is down a fifth.</li><li>Barley held up.</li></ul></div>
    <div id="comments"><h3>2 comments</h3><div class="comment"><p>We had the same here in the south, I think it will
    get worse every year.</p></div></div><aside class="sidebar"><h3>Most read</h3><a href="/x">Other story</a></aside>
    <form class="newsletter"><label>Email</label><input></form><footer>&copy; 2024 The Daily. Imprint</footer>"""
    assert crf.main_text(page, crf.Scorer(model["weights"]), model).split("\n") == [
        "Harvest begins early",
        "Farmers in the north began the harvest this week, ten days before the usual date. The dry spring is to blame.",
        "A dry year", "Rain fell on only four days. Nobody had seen that before.",
        "Wheat is down a fifth.", "Barley held up.",
    ]


def test_query_finds_the_articles(spark):
    pages = {p.page_id: p for p in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = QUERIES["op1_crf_main_text"](spark, SF).collect()
    assert len(found) == len(pages)
    same = 0
    for r in found:
        inside = [b.text for b in blocks_of(pages[r.page_id].html) if any(p[0] == "article" for p in b.path)]
        same += r.text == "\n".join(inside)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
    assert same / len(found) > 0.98


def test_odd_rows(spark, model):
    rows = [(1, None, "a"), (1, "", "b"), (None, "<article><p>One more story here.</p></article>", "c")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = crf.extract(pages, model)
    assert found.columns == ["page_id", "html", "text"]
    assert [r.text for r in found.collect()] == ["", "", "One more story here."]
    assert crf.extract(pages.limit(0), model).count() == 0
