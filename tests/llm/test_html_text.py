"""Main text of hand-made pages, and of the given pages against a plain cut."""

from __future__ import annotations

import html
import re

import pytest

from starloom.llm import html_text as H
from starloom.llm.queries import op4_html_text

from tests.conftest import SF001

PARAGRAPHS = [f"Paragraph {i} has quite some words in it, as an article's paragraphs have &amp; need." for i in range(4)]
ARTICLE = "<h1>Title</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
WANT = "\n".join(["Title", *[html.unescape(p) for p in PARAGRAPHS]])


@pytest.mark.parametrize("page", [
    f"<html><body><nav><a href=/>Home</a></nav><article>{ARTICLE}</article><footer>&copy; Us</footer></body></html>",
    f"<body><header>Big site</header><div id=main>{ARTICLE}</div><aside>See <a href=x>also</a> this</aside>",
    f"<div class='cookie-notice'>We use cookies, a lot of them, and tell you in many words.</div><main>{ARTICLE}</main>",
    f"<article>{ARTICLE}</article><div class=comments><p>First!</p><p>{'I disagree. ' * 50}</p></div>",
    f"<body><div><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div>{ARTICLE}</div><form>Name <input></form>",
    f"<article>{ARTICLE}<script>var t='</p>';</script><style>p{{}}</style><!-- <p>no</p> --></article>",
    f"<article>{ARTICLE.replace('</p>', '')}</article>",
    f"<div><div><div class='advert'>Buy!</div><section>{ARTICLE}</section></div></div>",
    f"<article>{ARTICLE.replace('words', '<b>wo<i>rd</i>s')}</article>".replace("<b>", "").replace("<i>rd</i>s", "rds"),
])
def test_article_of(page):
    assert H.extract(page) == WANT


def test_blocks_and_blanks():
    page = "<article><p>a\n b<br>c  <b>d</b>e</p><div>f<p>g</p>h</div><p>  </p><p>&lt;i&gt; &nbsp;x&amp</p></article>"
    assert H.extract(page) == "a b c de\nf\ng\nh\n<i> x&"


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<script>x</script>", "<!-- x", "<", "</p></div>",
                                  "<nav>a</nav>", "<a href='x", "<p", "<div " * 50])
def test_nothing_to_read_does_not_fail(page):
    assert isinstance(H.extract(page), str)


def test_deep_and_long_pages():
    assert H.extract("<div>" * 30_000 + "deep text" + "</div>" * 30_000) == "deep text"
    assert H.extract("<p>" + "word " * 200_000 + "</p>") == ("word " * 200_000).strip()


def test_given_pages(spark):
    """The generated pages hold one article element; its blocks are the text."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in op4_html_text(spark, SF001).collect()}
    assert got.keys() == pages.keys()
    for i, page in pages.items():
        inner = page[page.index("<article>") + 9:page.index("</article>")]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", "\n", re.sub(r"</?b>", "", p)))).strip()
                 for p in re.split(r"</?(?:h1|p)>", inner)]
        assert got[i]["text"] == "\n".join(p for p in parts if p)
        assert got[i]["n_chars"] == len(got[i]["text"])


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, None), (2, "u", "<p>x</p>"), (2, "u", "<p>x</p>")],
                               "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS id")
    assert sorted(tuple(r) for r in H.extract_text(df).collect() if r["url"]) == [(2, "u", "x")] * 2
    assert H.extract_text(df.where("false")).count() == 0


LINKS = "<p>See <a href=1>a long title of a page</a> and <a href=2>another title of a page</a>.</p>"
TABLE = "<table><tr><td><a href=1>One entry</a><td>x</tr><tr><td><a href=2>Two entries</a><td>y</tr></table>"


@pytest.mark.parametrize("extra,text", [
    (LINKS, ["See a long title of a page and another title of a page."]),
    ("<p><a href=1>One</a> <a href=2>Two</a></p>", ["One Two"]),
    (TABLE, ["One entry", "x", "Two entries", "y"]),
    ("<ul><li>A note on <a href=1>the first page</a><li><a href=2>The second page</a></ul>",
     ["A note on the first page", "The second page"]),
    ("<ul><li><a href=1>One</a> | <li><a href=2>Two</a></ul>", []),
])
def test_links_of_the_article_stay(extra, text):
    assert H.extract(f"<article>{ARTICLE}{extra}</article>") == "\n".join([WANT, *text])


@pytest.mark.parametrize("mark", ["class='content has-sidebar'", "class='post comments-open'", "id='legal-analysis'",
                                  "class='no-sidebar'", "class='sidebar'", "id=noticeBoard class='widget'"])
def test_a_box_word_does_not_remove_the_article(mark):
    assert H.extract(f"<body><nav>Home</nav><section {mark}>{ARTICLE}</section></body>") == WANT


@pytest.mark.parametrize("mark", ["class='site-footer'", "class='comment-list'", "id=relatedPosts", "role=banner",
                                  "class='x sidebar'", "hidden", "class='ad-slot-top'"])
def test_boxes_beside_the_article_go(mark):
    assert H.extract(f"<body><div>{ARTICLE}</div><div {mark}>Some other words.</div></body>") == WANT


def _p(n, word="words"):
    return "".join(f"<p>Paragraph {i} of {word} says something at the usual length, with a comma and an end.</p>"
                   for i in range(n))


def _plain(fragment):
    """A plain reading of an element: its blocks' texts."""
    parts = re.split(r"</?(?:h1|h2|p|section|div|ul|li|header|article|blockquote|table|tr|td|figure|figcaption)[^>]*>",
                     fragment)
    texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", p))).strip() for p in parts]
    return "\n".join(t for t in texts if t)


NESTED = [
    f"<h1>Title</h1><section>{_p(6, 'one')}</section><section>{_p(6, 'two')}</section>",
    f"<h1>Title</h1><section>{_p(6, 'one')}</section><section><h2>Short</h2>{_p(3, 'two')}</section>",
    f"{_p(3)}<ul>" + "".join(f"<li>Item {i} of the list with a few words</li>" for i in range(20)) + f"</ul>{_p(2, 'end')}",
    f"<header><h1>The title</h1></header>{_p(4)}",
    f"{_p(3)}<p>Then <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>",
    f"{_p(4)}<h2>Sources</h2><ul><li><a href=1>One source</a></li><li><a href=2>Another one</a></li></ul>",
    f"{_p(4)}<div class='legal'><h2>Legal side</h2>{_p(2, 'law')}</div>",
    f"<div class='text-block share'>{_p(3)}</div><blockquote>{_p(1, 'quote')}</blockquote>",
    f"{_p(2)}<figure><img src=x><figcaption>What one sees</figcaption></figure><table><tr><td>a</td><td>b</td></tr></table>",
    "<h1>Short one</h1><p>Just this.</p>",
]
AROUND = ["<nav><a href=/>Home</a> <a href=/n>News</a></nav>", "<div class='cookie-notice'><p>We use cookies.</p></div>",
          f"<div class='comments'>{_p(5, 'comment')}</div><footer><p>All rights reserved.</p></footer>"]


@pytest.mark.parametrize("inner", NESTED)
@pytest.mark.parametrize("tag", ["article", "main"])
def test_nested_articles_are_kept_whole(inner, tag):
    if tag == "main" and "legal" in inner or tag == "main" and ("share" in inner or "<header>" in inner):
        pytest.skip("only an article makes these its own")
    page = f"<html><body>{AROUND[0]}{AROUND[1]}<{tag}>{inner}</{tag}>{AROUND[2]}</body></html>"
    assert H.extract(page) == _plain(inner)


@pytest.mark.parametrize("inner", [
    f"<p>A lead paragraph of usual length that opens the text, with a comma.</p><div>{_p(5, 'one')}</div><div>{_p(4, 'two')}</div>",
    f"<h1>Title</h1><section>{_p(6, 'one')}</section><section>{_p(3, 'two')}</section>",
    f"{_p(3)}<ul>" + "".join(f"<li>Item {i} of the list with a few words</li>" for i in range(20)) + f"</ul>{_p(2, 'end')}",
])
def test_articles_without_an_article_element(inner):
    page = f"<body>{AROUND[0]}<div id=page><div id=post>{inner}</div></div>{AROUND[2]}</body>"
    assert H.extract(page) == _plain(inner)


def test_comments_in_an_article_are_cut():
    page = f"<article>{_p(4)}<article class='comment'><p>First!</p></article><div class='ad'>Buy</div></article>"
    assert H.extract(page) == _plain(_p(4))
