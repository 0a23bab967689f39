"""Main text of pages whose text is known, under many kinds of markup."""

from __future__ import annotations

import html
import re
import time

import pytest

from martloom.llm import html_blocks as hb

LONG = (
    "The house at the end of the street is the one that was built for the mayor of the town, and"
    " it has been empty for as long as anyone who lives here can remember."
)
OTHER = (
    "Nobody knows what became of the man who had it made, but there are those who say that he was"
    " last seen on the road to the coast with all that he had in one small bag."
)
TALK = "I have been there and it was the best of all the places that I have ever seen, so thank you for this."
TEXT = f"A house\n\n{LONG}\n\nSo.\n\n{OTHER}"
BODY = f"<h1>A house</h1><p>{LONG}</p><p>So.</p><p>{OTHER}</p>"


def _of_article(page):
    """What stands in the article of the tables' pages, in a plainer way."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    parts = re.split(r"</?(?:h1|p)>", inner[1] if inner else "")
    texts = [" ".join(html.unescape(re.sub("</?b>", "", re.sub("<br>", " ", p))).split()) for p in parts]
    return "\n\n".join(t for t in texts if t)


def test_pages_of_the_tables(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {r.page_id: (r.url, _of_article(r.html)) for r in pages.collect()}
    got = hb.extracted(pages).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize(
    "box",
    [
        '<nav><ul><li><a href="/a">The first of all</a><li><a href="/b">Second</a></ul></nav>',
        f'<div class="top menu-items"><p>{TALK}</p></div>',
        f"<footer><p>{TALK}</p></footer>",
        f"<aside><p>{TALK}</p></aside>",
        f'<div id="leftSidebar">{TALK}</div>',
        f'<div role="alert">{TALK}</div>',
        f'<div class="cookie-notice"><p>{TALK}</p><button>Yes</button></div>',
        f'<div class="ad">{TALK}</div>',
        f'<DIV CLASS=adBox>{TALK}</DIV>',
        f"<form action=x><p>{TALK}</p><select><option>One<option>Two</select></form>",
        f"<script>var a = '<p>{TALK}</p>';</script>",
        f"<style>p {{ color: red }}</style><!-- <p>{TALK}</p> -->",
        f'<section class="comments"><h3>Comments</h3><article><p>{TALK}</p></article></section>',
        f'<ol id="comment-list"><li><p>{TALK}</p></ol>',
        f'<p hidden>{TALK}</p>',
        f'<div style="display: none">{TALK}</div>',
        f"<noscript>{TALK}</noscript><template><p>{TALK}</p></template>",
        '<ul><li><a href="/a">One more story of the town</a></li><li><a href="/b">Another</a></li></ul>',
    ],
)
@pytest.mark.parametrize(
    "frame",
    [
        "{box}<article>BODY</article>",
        "<article>BODY{box}</article>",
        "<main>{box}<article class='post has-sidebar'>BODY</article>{box}</main>",
        "<div id=page>{box}<div class=content>BODY</div>{box}</div>",
    ],
)
def test_boxes_beside_the_text_go(box, frame):
    page = f"<html><head><title>T</title></head><body>{frame.format(box=box).replace('BODY', BODY)}</body></html>"
    assert hb.main_text(page) == TEXT


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("  \n ", ""),
        ("plain & simple", "plain & simple"),
        ("<p>a &amp;&lt;b&gt; &eacute;&#233;&#xe9; &nbsp; c", "a &<b> ééé c"),
        ("<article><p>one<br>two\n\tthree<br><br>four</article>", "one two three\n\nfour"),
        ("<article><p>a <b>b</i> c<p>d</b> e</article>", "a b c\n\nd e"),
        ("<article>x < y and 3<4 </p> z", "x < y and 3<4\n\nz"),
        ('<article data-x="a>b" title=\'<p>\'>kept', "kept"),
        ("<article><p title=don't>kept</p></article><p>not", "kept"),
        ("<article>kept<script>never closed", "kept"),
        ("<article>kept<!-- never closed", "kept"),
        ("<article>kept<p class=", "kept"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n\n2\n\n3"),
        ("<article><pre>if (a) <span class=comment>note</span></pre></article>", "if (a) note"),
        ("<article>\U0001f600 日本語の文章</article><div>menu</div>", "\U0001f600 日本語の文章"),
        ("<body><nav>only a menu</nav></body>", ""),
        ("<head><title>t</title><body><p>no end of the head", "no end of the head"),
        ("<article>a<svg><text>drawn</text></svg>b</article>", "a\n\nb"),
    ],
)
def test_markup(page, text):
    assert hb.main_text(page) == text


def test_second_pass_takes_the_nearest_label():
    page = [hb.Block(text="x") for _ in range(7)]
    labels = [False, None, None, True, None, None, False]
    assert hb.second_pass(labels, page) == [False, False, True, True, True, False, False]
    assert hb.second_pass([None, False], page[:2]) == [True, False]
    heading = [hb.Block(), hb.Block(heading=True), hb.Block()]
    assert hb.second_pass([True, None, False], heading) == [True, False, False]


def test_first_pass_without_a_marked_article():
    assert hb.first_pass(hb.Block(text=LONG), False) is True
    assert hb.first_pass(hb.Block(text=LONG, linked=len(LONG) - 9), False) is False
    assert hb.first_pass(hb.Block(text="So."), False) is None
    assert hb.first_pass(hb.Block(text="xqzt wvk " * 12), False) is False


@pytest.mark.parametrize(
    "piece",
    ["<a ", '<a x="', "<!--", "<div>", "<p>", "<b><i>", "</b>", "&", "<script>", "<", "<br>", "<a b='>", "</"],
)
def test_time_grows_with_the_page(piece):
    start = time.perf_counter()
    hb.main_text(piece * 100_000 + "end")
    assert time.perf_counter() - start < 20


def test_odd_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string, part int"
    big = "<article>" + f"<p>{LONG}</p>" * 5000
    rows = [
        (None, None, None, "t", "n", 1), (1, "u", "", "t", "n", 1), (1, "u", BODY, "t", "n", 1),
        (1, "u", BODY, "t", "n", 1), (2, None, big, None, None, None),
    ]
    got = [tuple(r) for r in hb.extracted(spark.createDataFrame(rows, schema).repartition(3)).collect()]
    long = "\n\n".join([LONG] * 5000)
    want = [(None, None, "", 0), (1, "u", "", 0), *[(1, "u", TEXT, len(TEXT))] * 2, (2, None, long, len(long))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert hb.extracted(spark.createDataFrame([], schema)).count() == 0
