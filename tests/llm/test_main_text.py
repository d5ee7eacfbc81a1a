from __future__ import annotations

import re
import html as references

from pyspark.sql import functions as F

from tablewright.llm import main_text, queries
from tablewright.llm.labelled_pages import PAGES

TREE = main_text.train(PAGES)


def text(page):
    return main_text.extract(page, TREE)


def brute(page):
    """Blocks inside <article>, cut at every tag but b and br: enough for the test tables."""
    inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inside.replace("<br>", " ")))
    lines = [" ".join(references.unescape(re.sub(r"<[^>]*\Z", "", p)).split()) for p in parts]
    return "\n".join(x for x in lines if x)


def test_query(spark, tables):
    got = {r.page_id: r for r in queries.op4_main_text(spark, tables).collect()}
    pages = spark.read.parquet(f"{tables}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        want = brute(p.html)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want) and got[p.page_id].url == p.url


def test_training_pages_are_learned():
    for page in PAGES:
        kept = "\n".join(
            b.text for keep, piece in page if keep for b in main_text.blocks(piece)
        )
        assert text("".join(piece for _, piece in page)) == kept


def test_unseen_page():
    page = """<!DOCTYPE html><html><body class="home menu"><header class="site-header"><a href="/">Site</a> slogan</header>
    <nav role=navigation><a href=1>One</a><a href=2>Two</a></nav>
    <div id='consent-banner'>We value your privacy &amp; cookies.</div>
    <article><header><h1>Title &lt;here&gt;</h1></header><p>First <b>bold</b>&nbsp;and
      <i>more</i> text<br>goes on.</p><script>if (a < b) { x("</p>") }</script><style>p{}</style>
    <div class="ad-slot">Buy now</div><p title="a > b">One.<p>Two.
    <figure><img src=x><figcaption>A caption</figcaption></figure>
    <section class="comments"><h3>Comments</h3><p>A reader says a good many things here.</p></section></article>
    <aside class=sidebar><p>Aside text that is long enough to look like a paragraph of an article.</p></aside>
    <form><input name=q><p>Search this site</p></form><!-- <p>hidden</p> -->
    <footer>Footer &copy; 2020</footer></body></html>"""
    assert text(page) == "Title <here>\nFirst bold and more text goes on.\nOne.\nTwo.\nA caption"


def test_layout_wrappers_do_not_hide_an_article():
    inside = "<h1>Title</h1><p>One paragraph of the article stands here.</p><p>Two.</p>"
    want = "Title\nOne paragraph of the article stands here.\nTwo."
    for name in ("has-sidebar", "content-with-menu", "layout-no-sidebar", "page-header-fixed", "social-wrapper", "site with-ads"):
        for page in (f'<div class="{name}"><article>{inside}</article></div>', f'<body class="{name}"><main>{inside}</main></body>'):
            assert text(page) == want, page
    assert text(f"<form><article>{inside}</article></form>") == want
    assert text(f"<header class='masthead'><article>{inside}</article></header>") == want


def test_names_count_whole():
    for name in ("id='related-work'", "class='share-prices'", "class='search-results'", "class='comment-free zone'", "id=noticeable"):
        page = f"<article><p>A first paragraph.</p><div {name}><p>A paragraph that belongs here.</p></div></article>"
        assert text(page) == "A first paragraph.\nA paragraph that belongs here.", name
    for name in ("class='ad-slot'", "id='cookieNotice'", "class='x comment-list y'", "role=navigation", "class=site-footer", "class='sidebar-2'"):
        page = f"<article><p>A first paragraph.</p><div {name}><p>A paragraph that does not belong.</p></div></article>"
        assert text(page) == "A first paragraph.", name


def test_articles_of_others_stay_out():
    page = "<article><p>The text itself.</p></article><section class=comments><article><p>I say so too.</p></article></section>"
    assert text(page + "<aside><article><p>A teaser.</p></article></aside>") == "The text itself."


def test_formulas_and_plain_pages():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be.</p><noscript><p>Plain form.</p></noscript></article>"
    assert text(page) == "Let x=2 be.\nPlain form."
    assert text("<p>Just words.</p>") == "Just words."
    assert text("<nav>a</nav>") == text("<aside>some words here</aside>") == text("<footer>a b</footer>") == ""


def splits(node):
    return set() if isinstance(node, main_text.Leaf) else {main_text.FEATURES[node.feature]} | splits(node.low) | splits(node.high)


def test_the_tree_asks_the_neighbours():
    used = splits(TREE)
    assert "words before" in used and used & {"words after", "link density before", "link density after"}
    long = "Nobody in the town had ever seen so many boats on the lake as in the week before the great storm came. " * 2
    page = f"<div>Opening hours</div><div>Jobs</div><div>{long}</div><div>It was late.</div><div>{long}</div><div>Save</div><div>Share it</div>"
    assert "It was late." in text(page) and "Jobs" not in text(page) and "Share it" not in text(page)


def test_odd_pages():
    assert text("") == "" and text("<") == "" and text("   ") == ""
    assert text("<article><p>a < b and c</article>") == "a < b and c"
    assert text("<article><p>cut off in the <b>mid") == "cut off in the mid"
    assert text("<article><p>cut in a tag</p><div cla") == "cut in a tag"
    assert text("<article><p>kept<script>var x = 1;") == "kept"
    assert text('<article><p>x &amp; y &#233; &eacute &am</p></article>') == "x & y é é &am"
    long = "<article>" + "<p>word word</p>" * 20_000 + "<" * 20_000 + "</article>"
    assert text(long).count("\n") >= 19_999


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>é x</article>"), (3, "v", "<nav>a</nav>"), (3, "v", "<nav>a</nav>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = main_text.main_texts(frame, PAGES).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "é x", 3), (1, "", 0), (2, "", 0), (3, "", 0), (3, "", 0)]
    assert main_text.main_texts(frame.where("false"), PAGES).collect() == []
