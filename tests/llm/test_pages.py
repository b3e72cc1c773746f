"""Main texts of given and of made pages."""

import html as references
import re
import time

import pytest
from pyspark.sql import functions as F

from sectoria.llm.pages import extracted, main_text, page_votes, read_page

ARTICLE = "<h1>A title here</h1><p>First sentence of the text, long enough to count.</p><p>Second one, with <b>bold</b> &amp; more.</p>"
TEXT = "A title here\n\nFirst sentence of the text, long enough to count.\n\nSecond one, with bold & more."


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


def between_tags(html):
    """Text of the given pages, whose article has no other containers."""
    inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    inside = re.sub(r"<br>|</?b>", " ", inside)
    blocks = (" ".join(references.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inside))
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    given = {r.page_id: r for r in pages.collect()}
    rows = extracted(pages).collect()
    assert len(rows) == len(given)
    for r in rows:
        assert r.text == between_tags(given[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == given[r.page_id].url


@pytest.mark.parametrize(
    "body",
    [
        f"<article>{ARTICLE}</article>",
        f"<main><div class='post-12'>{ARTICLE}</div></main>",
        f"<div id=content>{ARTICLE}<div class='related'><p>Other stories you may like to read next.</p></div></div>",
        f"<header><h2>Site name of all</h2></header><article>{ARTICLE}</article><aside><p>Side text, not wanted at all.</p></aside>",
        f"<article>{ARTICLE}<form><p>Your mail, please.</p><input></form></article>",
        f"<div class=cookie-notice><p>We use cookies. Accept all of them now, please, as everybody does.</p></div><div class=c1>{ARTICLE}</div>",
        f"<article>{ARTICLE}</article><section id='comments'><article class='comment'><p>{'Great text! ' * 40}</p></article></section>",
        f"<ul class='menu'><li><a href='/'>Home</a><li><a href='/x'>News</a></ul><div>{ARTICLE}</div><div><a href=1>One</a> <a href=2>Two</a></div>",
        f"<article>{ARTICLE}<script>var a = '<p>no</p>'</script><!-- <p>no</p> --></article><div class='ad'>Buy it now.</div>",
        f"<article><header>{ARTICLE[:21]}</header>{ARTICLE[21:]}<footer>Posted in news.</footer></article><footer>&copy; me</footer>",
    ],
)
def test_what_stands_beside_is_left_out(body):
    assert main_text(page(body), None) == TEXT


@pytest.mark.parametrize("html", ["", "plain words", "<p>open <b>tags <p>second", "<<>><a", "<div>" * 3000 + "deep", "&#65;&lt;p&gt; x", "<p>\xa0 a \n\t b </p>"])
def test_odd_html(html):
    assert main_text(html, None) == {
        "": "",
        "plain words": "plain words",
        "<p>open <b>tags <p>second": "open tags\n\nsecond",
        "<<>><a": "<<>><a",
        "<p>\xa0 a \n\t b </p>": "a b",
        "&#65;&lt;p&gt; x": "A<p> x",
    }.get(html, "deep")


def test_the_host_outvotes_a_page(spark):
    """On one page of the host a box is longer than the article; the other pages show where the article is."""
    box = f"<div class='x7'><p>{'Win a prize in our big game today. ' * 9}</p></div>"
    normal = page(f"<div class='story-1'>{ARTICLE * 3}</div>" + "<div class='x7'><p>Win.</p></div>")
    odd = page(f"<div class='story-2'>{ARTICLE}</div>{box}")
    rows = [(i, f"http://a.example/{i}", normal) for i in range(4)] + [(9, "http://a.example/9", odd), (10, None, odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r.page_id: r.text for r in extracted(pages).collect()}
    assert found[9] == TEXT and found[0].startswith(TEXT)
    assert "prize" in found[10]


def test_votes_name_generalised_paths():
    assert list(page_votes(page(f"<div class='Post-12 b'>{ARTICLE}</div>")))[0] == ">html>body>div.b.post-#"
    assert page_votes("") == {} and read_page("").blocks == []


def test_nulls_repeats_clashing_columns_and_no_rows(spark):
    rows = [(1, "http://a.b/x", None), (None, None, page(ARTICLE)), (2, "http://a.b", page(ARTICLE)), (2, "http://a.b", page(ARTICLE))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "path": F.lit("x"), "text": F.lit(0)})
    found = sorted(((r.page_id or 0), r.text, r.n_chars) for r in extracted(pages).collect())
    assert found == [(0, TEXT, len(TEXT)), (1, "", 0), (2, TEXT, len(TEXT)), (2, TEXT, len(TEXT))]
    assert extracted(pages.where("false")).collect() == []


@pytest.mark.parametrize(
    "body",
    [
        f"<div class='content with-sidebar'>{ARTICLE}</div>",
        f"<div class='sidebar-right'><div>{ARTICLE}</div><div class='sidebar'><p>Side text.</p></div></div>",
        f"<article class='post has-comments'>{ARTICLE}</article><div id='comments'><p>{'Great text! ' * 40}</p></div>",
        f"<div class='post-share-enabled'>{ARTICLE}</div><p>Small print.</p>",
        f"<form action='/x'><div id='wrap'>{ARTICLE}</div></form>",
        f"<form><div class='menu-open'><main>{ARTICLE}</main><div class='ad'>Buy it now.</div></div></form>",
        f"<div>{ARTICLE}</div><div class='comment-list'><p>{'Great text! ' * 20}</p></div>",
    ],
)
def test_names_of_layouts_and_forms_around_the_article(body):
    assert main_text(page(body), None) in (TEXT, f"{TEXT}\n\nSmall print.")


def test_the_path_of_the_host_is_not_left_out():
    html = page(f"<div class='promo-1'>{ARTICLE}</div><div class='x'><p>{'Another long box of text stands here. ' * 9}</p></div>")
    assert main_text(html, ">html>body>div.promo-#") == TEXT


def test_parts_of_forms_inside_the_article_are_left_out():
    body = f"<article>{ARTICLE.replace('Second one', '<button>Share this</button><label>Your mail</label>Second one')}</article>"
    assert main_text(page(body), None) == TEXT
    assert main_text(page(f"<article><button>open{ARTICLE}</article>"), None) == TEXT


@pytest.mark.parametrize(
    "html, text",
    [
        ("<div>" * 60_000 + "deep", "deep"),
        ("<div>" * 20_000 + "</section>" * 20_000 + "deep", "deep"),
        ("<a " * 100_000 + "<p>text", "text"),
        ("<b " * 50_000 + '"' + "x" * 100_000 + "<p>text.", '<b "' + "x" * 100_000 + "\n\ntext."),
        ("<!" * 50_000 + "<p>text", "text"),
        ("<script " * 50_000 + "<p>text", "text"),
        ("<body>" * 50_000 + "text", "text"),
        ("<form>" * 20_000 + "Some text.", "Some text."),
    ],
    ids=["nested", "unmatched", "unclosed", "quote", "declarations", "scripts", "bodies", "forms"],
)
def test_time_grows_with_the_page(html, text):
    """Each of them took minutes or gigabytes when work or paths grew with the depth."""
    start = time.process_time()
    assert main_text(html, next(iter(page_votes(html)), None)) == text
    assert time.process_time() - start < 20
