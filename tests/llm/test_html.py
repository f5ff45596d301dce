import html
import re

import pytest

from tidemark.llm import html_op as op

SCHEMA = "page_id long, url string, html string, text string, n_chars int"


def run(spark, rows):
    df = spark.createDataFrame([(i, "u", h, "x", 1) for i, h in rows], SCHEMA)
    return {r.page_id: r.text for r in op.digest(op.extract(df)).collect()}


P1 = "The first paragraph of the article has some sentences, with commas. It goes on for a while, as prose does."
P2 = "A second one follows; it says more, and then it ends."
BLOG = f"""<!doctype html><html><head><title>T | site</title><style>p {{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1><nav><ul><li><a href=/>Home</a><li><a href=/a>About, us.</a></ul></nav></header>
<div id="cookie-notice"><p>We use cookies, as all sites do. Accept them, please, or go away now.</p></div>
<main><article><h1>Title &amp; more</h1><p>{P1}<p>{P2} <a href=x>A link</a>, too.</p><ul><li>One item</li><li>Two &lt;items&gt;</li></ul>
<script>var a = "</p><p>code, code, code.";</script><div class="ad-box">Buy this, it is cheap.</div>
<form><label>Mail</label><input><button>Send it</button></form></article></main>
<aside><p>Another story, which is long enough to look like prose, with commas, and so on and on.</p></aside>
<section class="comments"><p>Great post, I liked it, really, it was good, thanks a lot for writing it.</p></section>
<footer><p>Imprint, privacy, terms. All rights reserved, of course, as always.</p></footer></body></html>"""


def test_a_blog_page(spark):
    want = f"Title & more\n\n{P1}\n\n{P2} A link, too.\n\nOne item\n\nTwo <items>"
    assert run(spark, [(1, BLOG)]) == {1: want}


def test_pages_without_semantic_elements():
    menu = "".join(f"<li><a href=/{i}>Entry {i}</a></li>" for i in range(12))
    page = f"<body><div><ul>{menu}</ul></div><div><h2>Head</h2><p>{P1}</p><p>{P2}</p><p>{P1}</p></div><div><a href=x>imprint</a> <a href=y>terms</a></div></body>"
    assert op.main_text(page) == f"Head\n\n{P1}\n\n{P2}\n\n{P1}"


PROSE = [f"Paragraph {i} of the article says something, at some length, and then it ends in a full stop." for i in range(6)]
ARTICLE = "<article>" + "".join(f"<p>{p}</p>" for p in PROSE) + "</article>"
AROUND = "<header><a href=/>Site</a></header>{}<footer><p>Imprint, privacy, terms and so on, of course.</p></footer>"


@pytest.mark.parametrize("page", [
    "{}", '<div class="has-sidebar">{}</div>', '<main>{}<section class="toc-section"><p>One, two, three.</p></section></main>', '<div class="content-sidebar-wrap">{}</div>',
    '<div class="content-sidebar-wrap"><main>{}</main><div class="sidebar"><p>Another story, which goes on, and on.</p></div></div>',
    '<div class="post comments-open">{}<div class="comments"><p>Great post, I liked it, thanks.</p></div></div>', '<form id="aspnetForm">{}</form>',
    '<div class="layout layout--related">{}</div>', '<div id="modal-root">{}</div>', '<div role="dialog"><div class="overlay">{}</div></div>'])
def test_an_article_in_a_marked_wrapper(page):
    for around in ("<body>{}</body>", f"<body>{AROUND}</body>"):
        assert op.main_text(around.format(page.format(ARTICLE))) == "\n\n".join(PROSE)


def test_marked_elements_beside_the_article_stay_out():
    for mark in ('<div class="comments">{}</div>', "<form>{}</form>", '<div role="dialog">{}</div>', '<div id="related-posts">{}</div>'):
        aside = mark.format("".join(f"<p>Reader {i} has something to say here, too, and says it.</p>" for i in range(5)))
        assert op.main_text(f"<body>{ARTICLE}{aside}</body>") == "\n\n".join(PROSE)


def test_broken_markup():
    assert op.main_text(f"<article><p><b>{P1}<br>x<p>{P2}</i></div>") == f"{P1} x\n\n{P2}"
    assert op.main_text(f"<article><p title='a>b' data=\"<p>\">{P1}</p><!-- <p>no</p> --><p>{P2}") == f"{P1}\n\n{P2}"
    assert op.main_text(f"<p>{P1}<!-- open") == P1
    assert op.main_text("a < b & c &amp; d &#233;&nbsp; e") == "a < b & c & d é e"
    assert op.main_text("<p>1</p><script>never closed <p>x</p>") == "1"
    assert op.main_text("<" * 3000 + "a") == "<" * 3000 + "a"
    assert op.main_text("<div " + "\"" * 20001 + ">x") != ""


def test_nulls_empty_long_and_repeated_rows(spark):
    long = "<article>" + f"<p>{P1}</p>" * 4000 + "</article>"
    rows = [(None, None), (1, ""), (2, "<nav>a</nav>"), (3, "plain  text"), (3, "plain  text"), (4, long), (5, "<p></p>")]
    assert run(spark, rows) == {None: "", 1: "", 2: "", 3: "plain text", 4: "\n\n".join([P1] * 4000), 5: ""}
    assert op.extract(spark.createDataFrame(rows and [(i, "u", h, "x", 1) for i, h in rows], SCHEMA)).count() == 7
    assert run(spark, []) == {}


def test_given_pages(spark):
    """The given pages hold their article in one element, as headings and paragraphs."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in op.digest(op.extract(df)).collect()}
    for r in df.collect():
        body = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " ")))).strip() for x in re.split("</?(?:p|h1)>", body)]
        want = "\n\n".join(x for x in parts if x)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)
