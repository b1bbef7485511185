"""Main texts of pages made from known articles; hard pages in linear time."""

import random
import time

import pytest

from brook.llm import htmltext

PAGES = "page_id long, url string, html string, host string, path string, h int"
ARTICLE = "".join(f"<p>Paragraph {i} of the article, with commas, and some more words to read here.</p>" for i in range(4))
TEXT = "\n".join(f"Paragraph {i} of the article, with commas, and some more words to read here." for i in range(4))


def extract(html):
    page = htmltext.Page(html)
    return page.extract(None)


@pytest.mark.parametrize(
    "html",
    [
        f"<div class='layout has-sidebar'>{ARTICLE}</div>",
        f"<body><div class='no-sidebar'>{ARTICLE}</div></body>",
        f"<article class='post share-enabled'>{ARTICLE}</article>",
        f"<main id='main-header-content'>{ARTICLE}</main>",
        f"<div id='page-with-banner'>{ARTICLE}</div>",
        f"<body><form action=/x><div>{ARTICLE}</div></form></body>",
        f"<body><div class=widget>{ARTICLE}</div></body>",
        f"<body><form><nav><a href=/>Home</a> <a href=/b>B</a></nav><div>{ARTICLE}</div><div class=cookie-notice>We use cookies</div></form></body>",
        f"<article>{ARTICLE}</article><section class='comments'>" + "<p>A reader says something long, and longer, and more.</p>" * 20 + "</section>",
        f"<nav>{'<a href=/x>menu</a> ' * 400}</nav><article>{ARTICLE}</article>",
    ],
)
def test_articles_are_kept_whole(html):
    assert extract(html) == TEXT


def test_formulas_and_drawings_in_an_article_are_text():
    html = "<article><p>Area is <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here.</p><p><svg><style>a{}</style><text>label</text></svg></p></article>"
    assert extract(html) == "Area is x=2 here.\nlabel"


def test_bad_nesting_and_depth_are_linear():
    hard = [
        "<p>" + "<i>" * 20_000 + "</b>" * 20_000 + "end",
        "<b>x<div>" + "<i>" * 20_000 + "</b>" * 20_000 + "end",
        "<div>" * 20_000 + "deep" + "</div>" * 20_000,
        "<i>" * 20_000 + "a<br>" * 20_000,
        "<ul>" + "<li><b>x" * 20_000,
        "<div class=x1>" * 5_000 + "<p>t</p>" * 5_000,
    ]
    for html in hard:
        start = time.process_time()
        page = htmltext.Page(html)
        page.candidates()
        assert page.extract(None)
        assert time.process_time() - start < 2.0, html[:20]


def template(k, body, noise):
    wrap = ["<div class='t{0}'><div class=main>{1}</div></div>", "<main class=m{0}><section>{1}</section></main>", "<table class=l{0}><tr><td class=c>{1}</td></tr></table>"]
    inner = wrap[k % 3].format("abcdefghijklmnopqrstuvwxyz"[k], body)
    return f"<html><body><header>Site {noise}</header><nav><a href=/>x</a></nav>{inner}<div class=box><p>{noise}</p></div><footer>(c)</footer></body></html>"


def test_a_host_with_many_templates_extracts_every_page(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for n in range(240):
        k = n % 12
        blocks = [" ".join(rng.choices("river stone, window garden, letter music number".split(), k=rng.randint(12, 30))) for _ in range(rng.randint(2, 6))]
        noise = "short teaser"
        if n >= 228:  # a page of every template whose box is longer than its article
            blocks, noise = ["a little text"], "a very long box on one page, with commas, and words, " * 9
        rows.append((n, "http://h.example/x", template(k, "".join(f"<p>{b}</p>" for b in blocks), noise), "x", "y", 1))
        want[n] = "\n".join(blocks)
    got = {r["page_id"]: r["text"] for r in htmltext.extract_text(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
    assert got == want


def test_repeated_and_null_rows(spark):
    rows = [(1, "http://a/", f"<article>{ARTICLE}</article>", "x", "y", 1)] * 3 + [(None, None, None, None, None, None), (2, "no url", "", "x", "y", 1)]
    got = sorted(((r["page_id"] or 0), r["text"]) for r in htmltext.extract_text(spark.createDataFrame(rows, PAGES)).collect())
    assert got == [(0, ""), (1, TEXT), (1, TEXT), (1, TEXT), (2, "")]
