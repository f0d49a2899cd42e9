import itertools
import math
import time
import random

import numpy as np
import pytest

from loadledger.llm import QUERIES
from loadledger.llm.html import Field, blocks_of, extract, fit, labelled_page, train

PAGES = "page_id long, url string, html string"
POOL = [f"{a} {b} of the {c} and more {a} words, told at some length." for a in "ab" for b in "cdef" for c in "ghijk"]


@pytest.fixture(scope="module")
def field():
    return fit(POOL)


def texts(html):
    return [block.text for block in blocks_of(html)]


def test_blocks_of_broken_and_nested_markup():
    assert texts("<p><b>One&amp;&lt;<br><p>two&nbsp;\n three<div>four<span> five</span></div>six") == [
        "One&<", "two three", "four five", "six"]
    assert texts("<script>var t='</p>';x<y</script><style>p{}</style><title>t</title>plain <!-- c --> text") == ["plain text"]
    assert texts("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></div></p>f") == ["a", "b", "c", "d", "e", "f"]
    assert texts(None) == texts("") == texts(" \n ") == []
    assert texts("<p>open <b") in (["open"], ["open <b"])
    assert texts("x" * 500_000 + "<p>" * 20_000 + "end") == ["x" * 500_000, "end"]
    assert len(texts("<div class='a1 b2'>" * 3_000 + "deep" + "</i>" * 3_000)) == 1


def test_viterbi_finds_the_best_labelling():
    rng = random.Random(0)
    names = ["parent:p", "parent:li", "in:p", "in:li", "words:1", "words:2", "ends:True", "ends:False", "links:0", "place:0"]
    for _ in range(60):
        field = Field({n: rng.uniform(-2, 2) for n in names}, np.array([[rng.uniform(-2, 2) for _ in "ab"] for _ in "ab"]))
        html = "".join(rng.choice(["<p>one two.</p>", "<li>x</li>", "<p>y</p>"]) for _ in range(rng.randint(1, 7)))
        blocks = blocks_of(html)
        scores = [sum(field.weights.get(f, 0) for f in b.features) for b in blocks]

        def value(labels):
            return sum(s for s, y in zip(scores, labels) if y) + sum(field.change[a, b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product((0, 1), repeat=len(blocks)), key=value)
        got = field.content(html)
        assert got == [b.text for b, y in zip(blocks, best) if y]


def test_training_raises_the_likelihood_over_all_labellings():
    rng = random.Random(1)
    pages = [[(frozenset({"bias", f"f{rng.randrange(3)}"}), rng.randrange(2)) for _ in range(rng.randint(1, 4))] for _ in range(6)]

    def likelihood(field):
        total = 0.0
        for page in pages:
            scores = [sum(field.weights[f] for f in features) for features, _ in page]

            def value(labels):
                return sum(s for s, y in zip(scores, labels) if y) + sum(field.change[a, b] for a, b in itertools.pairwise(labels))

            total += value([y for _, y in page]) - math.log(
                sum(math.exp(value(labels)) for labels in itertools.product((0, 1), repeat=len(page))))
        return total

    fitted = train(pages, rounds=400, decay=0.0)
    best = likelihood(fitted)
    for name in fitted.weights:
        for by in (-0.3, 0.3):
            moved = Field(fitted.weights | {name: fitted.weights[name] + by}, fitted.change)
            assert likelihood(moved) <= best + 1e-3
    for a, b in itertools.product((0, 1), repeat=2):
        change = fitted.change.copy()
        change[a, b] += 0.3
        assert likelihood(Field(fitted.weights, change)) <= best + 1e-3


def test_held_out_accuracy(field):
    draw = random.Random(77)
    right = wrong = missed = 0
    for _ in range(200):
        html, blocks = labelled_page(POOL, draw)
        want, got = {t for t, label in blocks if label}, set(field.content(html))
        right += len(want & got)
        wrong += len(got - want)
        missed += len(want - got)
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.95


def test_planted_page(field):
    html = """<html><body><div class="wrapper"><header><p>Site of the day</p></header>
    <nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies to tell who you are.</p><button>Yes</button></div>
    <div class="content"><h1>A title</h1><p>First &eacute;t&eacute; paragraph, with a <a href=#>link</a> inside.</p>
    <div class="ad">Buy this thing now.</div><p>Second   paragraph.</p><ul><li>A point</li></ul></div>
    <div class="sidebar"><h3>Popular</h3><a href=#>Another story</a></div>
    <section id="comments"><div class="comment"><p>I read this and I liked it very much.</p></div></section>
    <form><label>Search</label><input></form><footer>&copy; 2024 The site</footer></div></body></html>"""
    assert field.content(html) == ["A title", "First été paragraph, with a link inside.", "Second paragraph.", "A point"]


def test_given_pages_give_their_articles(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op6_html_extraction"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        inner = pages[r.page_id].html.split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        assert r.text == "\n".join(texts(inner)) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_null_and_repeated_rows_and_empty_table(spark, field):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "v", "<article><p>Some text of it.</p></article>")]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], PAGES + ", text int, id string")
    got = sorted((tuple(r) for r in extract(docs, field).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (2, "u", "", 0), (2, "u", "", 0), (None, "v", "Some text of it.", 16)], key=repr)
    assert extract(docs.limit(0), fit([])).collect() == []


def texts_of(page):
    return [block.text for block in blocks_of(page)]


def test_what_does_not_show_neither_leaks_nor_cuts():
    assert texts_of("<p>Pick <button><div>Click me</div></button> one</p>") == ["Pick one"]
    assert texts_of("<p>Text <svg><g><text>chart <p>label</text></g></svg>goes on</p>") == ["Text goes on"]
    assert texts_of("<p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>TeX</annotation></math> is</p>") == ["Energy E=m is"]
    assert texts_of("<p>a</p><noscript><p>b</p></noscript><object><p>c</p></object><p>d</p>") == ["a", "b", "c", "d"]
    assert texts_of("<div><svg><path>x</div><p>after</p><iframe src=x><p>more</p>") == ["after", "more"]
    assert texts_of("<p>one<script>two<p></script> three</p><div hidden>four<div>five</div>six</div><p>seven") == ["one three", "seven"]
    assert texts_of("<ul><li>a<li>b <b>c<li>d</ul>e") == ["a", "b c", "d", "e"]


def test_unclosed_tags_take_linear_time():
    for piece in ("<font>x<hr>", "<b>x<p>", "<svg>x</i>", "<div><b>x", "<li><font>x"):
        began = time.process_time()
        assert blocks_of(piece * (1_000_000 // len(piece))) is not None
        assert time.process_time() - began < 20
