"""Main text: the model against enumeration of all labellings, and pages whose text is known."""

import html
import itertools
import math
import re
import time

import pytest

from tripmart.llm import htmltext
from tripmart.llm.htmltext import Node, extract_text, features, main_text, marginals, parse, train_pages


def plain(page):
    """Text of the article of the supplied pages, which all have one and nothing else in it."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b) if "<" in b else b).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def model(spark):
    return train_pages(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def test_supplied_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").repartition(3)
    out = {r.page_id: r.text for r in extract_text(pages, model).collect()}
    expected = {r.page_id: plain(r.html) for r in pages.collect()}
    wrong = [i for i in expected if out[i] != expected[i]]
    assert not wrong, (out[wrong[0]], expected[wrong[0]])


def test_marginals_by_enumeration(model):
    page = "<body><nav><a>x</a></nav><div class=story><p>Some text here.</p><ul><li><a>y</a></li></ul></div></body>"
    found = marginals(parse(page), model)
    nodes = [n for n, _ in found]
    place = {id(n): k for k, n in enumerate(nodes)}
    parent = {place[id(c)]: k for k, n in enumerate(nodes) for c in n.children}
    total, content = 0.0, [0.0] * len(nodes)
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        score = sum(
            model.pair[1 if k == 0 else labels[parent[k]]][labels[k]]
            + sum(model.seen[f][labels[k]] for f in features(n) if f in model.seen)
            for k, n in enumerate(nodes)
        )
        p = math.exp(score)
        total += p
        for k, y in enumerate(labels):
            content[k] += p * y
    assert [p for _, p in found] == pytest.approx([c / total for c in content])


OTHER_PAGE = """<!doctype html><html><head><title>No</title><style>p > a {}</style></head><body class="page">
<header class="site-header"><div class="logo">The Site</div><nav class="main-menu"><ul><li><a href="/">Home</a><li>
<a href="/b?x=1&amp;y=2">Blog</a></ul></nav></header>
<div class="cookie-consent"><p>This site uses cookies. Read on to agree to all of them.</p><button>OK</button></div>
<main><article class="post"><h1>On bridges &amp; rivers</h1>
<p>A bridge crosses a river,   and a <a href="/r">river</a> runs under
a bridge.<br>So it has been &mdash; always.
<p>Not <em>every</em> river has one&#46; <script>var x = "<p>no</p>";</script>
<blockquote>Build it well.</blockquote>
<ul><li>Stone lasts long.</li><li>Wood is cheap.</li></ul>
<div class="ad-banner"><p>Bridges for sale, call now.</p></div>
<table><tr><td>Length<td>12 m</table>
<p>That is all.</p></article>
<section id="comments"><h2>3 comments</h2><div class="comment"><p>What a fine piece on rivers, thank you so much.</p></div>
<form action="/c"><label>Your comment</label><textarea>words</textarea></form></section></main>
<aside class="sidebar"><h3>Popular</h3><p>Ten bridges that one has to see before they are gone.</p></aside>
<footer><p>&copy; The Site. All rights reserved.</p></footer><!-- <p>end</p> --></body></html>"""


def test_a_page_of_another_make(model):
    assert main_text(OTHER_PAGE, model).split("\n\n") == [
        "On bridges & rivers",
        "A bridge crosses a river, and a river runs under a bridge. So it has been — always.",
        "Not every river has one.",
        "Build it well.",
        "Stone lasts long.",
        "Wood is cheap.",
        "Length",
        "12 m",
        "That is all.",
    ]


def test_edges(spark, model):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "just words"), (4, "u", "<p>unclosed <b>text & more"), (5, "u", "< 3 > <")]
    rows += [(6, "u", "<div>" * 3000 + "<p>deep.</p>"), (7, "u", "<p>" + "long " * 40_000), (7, "u", "<script>alert(1)")]
    rows += [(None, "u", "<p title='a > b'>Attributes are left out.</p><!-- open")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = {(r.page_id, r.text[:20]) for r in extract_text(pages, model).collect()}
    assert len(out) == len(rows)
    by_id = {i: t for i, t in out if i != 7}
    assert by_id[1] == by_id[2] == "" and by_id[4] == "unclosed text & more" and by_id[6] == "deep."
    assert by_id[None] == "Attributes are left "
    assert {t for i, t in out if i == 7} == {("long " * 4)[:20], ""}
    nothing = train_pages(pages.where("false"))
    assert extract_text(pages.where("false"), nothing).count() == 0
    assert isinstance(parse(""), Node) and htmltext.SEED_PAGES


FIRST, LAST = "The first paragraph tells at some length what happened.", "The last paragraph tells at length how it ended."


@pytest.mark.parametrize("tag", ["svg", "math", "object", "select", "button", "noscript", "template"])
def test_unclosed_elements_swallow_nothing(model, tag):
    page = f"<nav><a>Home</a></nav><article><h1>A heading</h1><p>{FIRST}</p><{tag}><p>{LAST}</p></article>"
    assert main_text(page, model).split("\n\n") == ["A heading", FIRST, LAST]
    later = page.replace("</article>", f"<{tag}>word</{tag}><p>{FIRST}</p></article>")
    assert {FIRST, LAST} <= set(main_text(later, model).split("\n\n"))
    assert main_text(later, model).count(FIRST) == 2


def test_formulas_objects_and_preformatted_text_stay(model):
    page = (
        f"<article><h1>A heading</h1><p>Here <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds in all cases.</p><p>{FIRST}</p>"
        "<xmp>if a < b: print('<p>') &amp; go on.</xmp><object data=x><p>This text stands for the object.</p></object>"
        f"<p>An <svg viewBox=x><path d=y /></svg> icon parts no text.</p><p>{LAST}</p><button>Share it</button>"
        "<select><option>one<option>two</select></article>"
    )
    assert main_text(page, model).split("\n\n") == [
        "A heading",
        "Here x=1 holds in all cases.",
        FIRST,
        "if a < b: print('<p>') &amp; go on.",
        "This text stands for the object.",
        "An icon parts no text.",
        LAST,
    ]


def test_unclosed_elements_cost_no_walks():
    """Twenty thousand open elements, and as many closing tags of others: no step looks through all that is open."""
    n = 20_000
    start = time.perf_counter()
    for page in ("<div>" * n + "<b>x</b>" * n, "<table><tr><td><p>" + "<div>" * n + "<td>x" * n, "<li>" * n + "</ul>" * n):
        parse(page)
    assert time.perf_counter() - start < 20


def test_extra_columns_of_clashing_names(spark):
    rows = [(1, "u", "<p>Words of a paragraph.</p>", "a", "b"), (2, "v", None, "c", "d")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, __p0 string")
    got = extract_text(df, train_pages(df)).collect()
    assert {r.page_id: r.text for r in got} == {1: "Words of a paragraph.", 2: ""}
