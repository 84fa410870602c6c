"""Main texts of hand-made pages, and of the table's pages by a plain rule."""

import html
import re

import pytest

from proseframe.llm.dom import Page
from proseframe.llm.maintext import main_text, with_main_text
from proseframe.llm.queries import op13_main_text

LONG = "A sentence of the article that is long enough to look like running text, with commas and all."
P = [f"Paragraph {i}. {LONG}" for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in P)
TEXT = " ".join(P)
LINKS = "<ul>" + "".join(f'<li><a href="/{i}">Section number {i}</a></li>' for i in range(12)) + "</ul>"
COMMENTS = "".join(f'<li class="comment"><article class="comment-body"><p>I, reader {i}, think so too. {LONG}</p></article></li>' for i in range(20))

AROUND = {
    "named": '<header><a href="/">Site</a> All the news</header><nav>{links}</nav>{main}<aside><p>{long}</p></aside><footer>&copy; Site, {long}</footer>',
    "classes": '<div class="site-header">Site</div><div id="mainMenu">{links}</div>{main}<div class="sidebar"><p>{long}</p></div><div class="siteFooter">{long}</div>',
    "roles": '<div role="banner">Site</div><div role="navigation">{links}</div>{main}<div role="complementary">{long}</div><div role="contentinfo">x</div>',
    "plain": "<div>{links}</div>{main}<div><a href='/a'>About</a> <a href='/b'>Terms of use</a> <a href='/c'>Help</a></div>",
    "extras": '<div class="cookie-notice"><p>{long}</p></div><div class="ad">Buy {long}</div>{main}<form action="/s"><label>Mail</label><input><p>{long}</p></form>'
    '<script>var a = "<p>{long}</p>";</script><noscript><p>{long}</p></noscript><section id="comments"><h2>20 comments</h2><ol>{comments}</ol></section>',
}
MAIN = {
    "article": "<article><h1>The title</h1>{body}</article>",
    "main": "<main><h1>The title</h1><div>{body}</div></main>",
    "divs": "<div id='page'><h1>The title</h1><div class='text'>{body}</div></div>",
    "own header": "<article><header><h1>The title</h1></header><div>{body}</div><footer>Tags: a, b</footer></article>",
}


@pytest.mark.parametrize("around", AROUND)
@pytest.mark.parametrize("main", MAIN)
def test_article_without_what_stands_around(around, main):
    inner = AROUND[around].format(links=LINKS, long=LONG, comments=COMMENTS, main=MAIN[main].format(body=BODY))
    page = f"<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body class='has-sidebar'>{inner}</body></html>"
    assert main_text(page) == f"The title {TEXT}"


CASES = [
    ("<p>One&nbsp;two &amp; &#x41;&eacute;&lt;b&gt;</p>", "One two & Aé<b>"),
    ("<div>in<b>li</b>ne <i>x</i>y<br>next<p>block</p>after</div>", "inline xy next block after"),
    ("<p>un<b>closed<p>second<li>item", "unclosed second item"),
    ("just text, no tags", "just text, no tags"),
    ("a < b and c > d", "a < b and c > d"),
    ("<p>x</p><!-- <p>hidden</p> --><p>y</p><!-- never ends <p>z</p>", "x y"),
    ("<p>kept</p><script>if (a</b>) '</p>'", "kept"),
    ("<p title='a>b' data-x=\"</p>\">text</p>", "text"),
    ("<p title='never ends>text</p>", "text"),
    ("<p>text<a href=", "text"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<html><head><meta charset=x><p>early body</p></html>trailing", "early body trailing"),
    ("<P>UPPER</P><SCRIPT>x</SCRIPT><Div CLASS=ad>no</DIV>", "UPPER"),
    ("<div hidden>no</div><div style='display: none'>no</div><p>yes</p>", "yes"),
    ("<![CDATA[x]]><?php y ?><p>z</p>", "z"),
    ("</p></b></div>", ""),
    ("<nav>only a menu</nav>", ""),
    ("   ", ""),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize("page, text", CASES)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_parts_of_one_article():
    halves = ["".join(f"<p>{p}</p>" for p in part) for part in (P[:3], P[3:])]
    page = f"<body><div>{LINKS}</div><div><div>{halves[0]}</div><div>{halves[1]}</div></div></body>"
    assert main_text(page) == TEXT


def test_text_broken_by_br():
    page = f"<body><div>{LINKS}</div><div>{'<br><br>'.join(P)}</div></body>"
    assert main_text(page) == TEXT


def test_short_article_with_many_comments():
    page = f"<body><article><h1>T</h1><p>{P[0]}</p></article><div id='comments'><ol class='comment-list'>{COMMENTS}</ol></div></body>"
    assert main_text(page) == f"T {P[0]}"


def test_very_long_and_very_deep_pages():
    words = " ".join(f"w{i}" for i in range(200_000))
    assert main_text(f"<article><p>{words}</p></article>") == words
    assert main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert main_text("<b>" * 20_000 + "<p>x" * 100) == " ".join("x" * 100)
    assert main_text("<a " * 50_000) == ""


def test_tree():
    page = Page("<ul><li>a<ul><li>b</ul><li>c</ul><p>d<div>e</div>")
    parents = {text: page.names[i] for i, text in page.texts if text}
    assert parents == {"a": "li", "b": "li", "c": "li", "d": "p", "e": "div"}
    depth = [i for i, t in page.texts if t == "c"][0]
    assert page.names[page.parents[depth]] == "ul" and page.parents[page.parents[depth]] == 0


def test_query_takes_articles_whole(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op13_main_text(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        text = " ".join(html.unescape(re.sub(r"</?(p|h1|br)[^>]*>", " ", inner).replace("<b>", "")).split())
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]]["url"], text, len(text))


def test_odd_rows(spark):
    rows = [(1, None, None, "old"), (1, None, None, "old"), (None, "u", "<p>a</p>", None), (3, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(tuple(r) for r in with_main_text(pages).fillna(-1, ["page_id"]).fillna("?").collect())
    assert got == [(-1, "u", "<p>a</p>", "a"), (1, "?", "?", ""), (1, "?", "?", ""), (3, "u", "", "")]
    assert with_main_text(pages.limit(0)).count() == 0
