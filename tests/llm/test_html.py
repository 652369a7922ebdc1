"""HTML extraction on layouts of many kinds, and the whole page table."""

import html
import re

import pytest

from lumenreg.llm import html_blocks as H
from lumenreg.llm.queries import op8_html
from tests.conftest import SF_SMALL

TEXT = ("The committee that was set up by the council in the spring has now told the public what it "
        "found, and it is not what they had been hoping for when the work began.")
MORE = ("It was not the first time that the people of the town had been asked to wait for the plan, "
        "and this was the reason that many of them did not come to the hall on the day.")

PAGES = {
    "article": (f"<nav><a href=x>Home</a></nav><article><h1>A title</h1><p>{TEXT}</p><p>Short.</p>"
                f"</article><footer>{MORE}</footer>", f"A title {TEXT} Short."),
    "open tags": (f"<article><p><b>Bold text<br><p>{TEXT}<p>End", f"Bold text {TEXT} End"),
    "ad inside": (f"<article><p>{TEXT}</p><div class='ad-box'>{MORE}</div><p>{MORE}</p></article>",
                  f"{TEXT} {MORE}"),
    "comments": (f"<main><p>{TEXT}</p><section id=comments><article><p>{MORE}</p></article></section>"
                 "</main>", TEXT),
    "comment article": (f"<article><p>{TEXT}</p></article><article class='comment'>{MORE}</article>",
                        TEXT),
    "div soup": (f"<body><div class=top-nav><a>Home</a> <a>News</a></div><div><h1>Title</h1><p>{TEXT} "
                 f"{MORE}</p><p>Yes.</p><p>{MORE} {TEXT}</p></div><div class='cookie-notice'>{TEXT}"
                 "</div></body>", f"Title {TEXT} {MORE} Yes. {MORE} {TEXT}"),
    "link list": (f"<article><p>{TEXT}</p><ul><li><a href=1>{MORE}</a></li></ul></article>", TEXT),
    "hidden": (f"<article><p hidden>{MORE}</p><p style='display: none'>{MORE}<p>{TEXT}"
               "<span aria-hidden='true'>x</span></article>", TEXT),
    "references": ("<article><p>Caf&eacute; &amp; bar&nbsp;&#8212; &lt;p&gt; " + TEXT + "</article>",
                   "Café & bar — <p> " + TEXT),
    "inline": (f"<article><p>foo<b>bar</b>  <i>baz</i>\n qux {TEXT}</article>",
               f"foobar baz qux {TEXT}"),
    "script": (f"<script>var t='</p><article>';</script><article><script>x</script><p>{TEXT}"
               "<style>p{}</style></article><!-- <article>no</article> -->", TEXT),
    "form": (f"<article><p>{TEXT}</p><form><label>Name</label><input> {MORE}</form></article>", TEXT),
    "article header": (f"<article><header><h1>Title</h1></header><p>{TEXT}</p></article>",
                       f"Title {TEXT}"),
    "role": (f"<div role=navigation>{MORE}</div><div role=main><p>{TEXT} {MORE}</p></div>",
             f"{TEXT} {MORE}"),
    "nested ad": (f"<article><div class=ads><div>{MORE}</div><div>{MORE}</div></div><p>{TEXT}</article>",
                  TEXT),
    "only short": ("<article><p>One.</p><p>Two.</p></article>", "One. Two."),
    "bare less-than": (f"<article><p>1 < 2 and {TEXT}</article>", f"1 < 2 and {TEXT}"),
    "no text": ("<html><head><title>x</title></head><body></body></html>", ""),
    "empty": ("", ""),
    "unclosed": ("<article><p title=\"never closed", ""),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_layout(name):
    page, want = PAGES[name]
    assert H.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    (f"<html><head><meta charset=utf-8><body><article><p>{TEXT}</p></article>", TEXT),
    (f"<head><title>t</title><link href=x><article><h1>T</h1><p>{TEXT}</p></article>", f"T {TEXT}"),
    (f"<head><meta charset=utf-8>{TEXT} {MORE}", f"{TEXT} {MORE}"),
    (f"<head><meta charset=utf-8> </head><body><article>{TEXT}</article></body>", TEXT)])
def test_head_without_an_end_tag(page, want):
    assert H.main_text(page) == want


@pytest.mark.parametrize("inside, want", [
    (f"<h1><a href=/p>Title</a></h1><p>{TEXT}</p>", f"Title {TEXT}"),
    (f"<p>{TEXT}</p><h2><a href='#s'>Section</a></h2><p>{MORE}</p>", f"{TEXT} Section {MORE}"),
    (f"<h1><a>T</a></h1><h2><a>S</a></h2><p>{TEXT}</p>", f"T S {TEXT}"),
    (f"<p>{TEXT}</p><p><a href=x>{MORE}</a></p><p>{TEXT}</p>", f"{TEXT} {MORE} {TEXT}"),
    (f"<h2><a>S</a></h2><p><a href=x>{MORE}</a></p><p>{TEXT}</p>", f"S {MORE} {TEXT}"),
    ("<h1><a>T</a></h1><p>One.</p>", "T One."),
    (f"<p>{TEXT}</p><ul><li>Smith, J. and Doe, A. (2004), <a>{MORE}</a></li><li>Roe, R. in the "
     f"Journal, <a>{MORE}</a></li></ul>",
     f"{TEXT} Smith, J. and Doe, A. (2004), {MORE} Roe, R. in the Journal, {MORE}"),
    (f"<p>{TEXT}</p><ul><li><a>{MORE}</a><li><a>{TEXT}</a></ul><p>{MORE}</p>", f"{TEXT} {MORE}")])
def test_linked_blocks_of_an_article(inside, want):
    assert H.main_text(f"<article>{inside}</article>") == want


def test_linked_cards_are_no_article():
    cards = f"<article><h3><a href=x>Card</a></h3></article><article><a href=y>{MORE}</a></article>"
    assert H.main_text(f"<article><p>{TEXT}</p></article>{cards}") == TEXT
    assert H.main_text(f"<div><p>{TEXT} {MORE}</p></div>{cards}") == f"{TEXT} {MORE}"


POLISH = ("Rada miejska ogłosiła wczoraj wyniki prac komisji, która powstała wiosną, lecz mieszkańcy "
          "oczekiwali czegoś zupełnie innego.")
CHINESE = "委员会昨天公布了调查结果，" * 10
CODE = "for (int k = 0; k != n; ++k) { total[k] += rows[k].weight * factor; } return total[n - 1];"
SLAVIC = "Na zebraniu i w domu mówiono o tym, że i rada, i burmistrz na pewno zmienią te plany wiosną."


@pytest.mark.parametrize("page, want", [
    (f"<div><h1>Komisja</h1><p>{POLISH}</p><p>Tak.</p><p>{POLISH}</p></div>",
     f"Komisja {POLISH} Tak. {POLISH}"),
    (f"<div><p>{POLISH}</p><p>{SLAVIC}</p><p>{POLISH}</p></div>", f"{POLISH} {SLAVIC} {POLISH}"),
    (f"<div><ul><li><a>{POLISH}</a></ul></div><div><p>{CHINESE}</p></div>", CHINESE),
    ("<div><p>We met at noon.</p><p>Nobody came.</p></div>", "We met at noon. Nobody came."),
    ("<div><a>Home</a></div><div><p>We met at noon.</p></div>", "We met at noon."),
    (f"<div><p>{TEXT} {MORE}</p><pre>{CODE}</pre><p>{MORE} {TEXT}</p><p>{CODE}</p></div>",
     f"{TEXT} {MORE} {CODE} {MORE} {TEXT}")])
def test_div_pages_without_stop_words(page, want):
    assert H.main_text(page) == want


LAYOUT = ["layout has-sidebar", "content with-sidebar", "no-ads", "post no-comments", "legal-news",
          "popular-science", "entry social-policy", "search-results", "has-left-sidebar",
          "sidebar-left", "sticky-footer-page"]


@pytest.mark.parametrize("name", LAYOUT)
def test_layout_names_do_not_hide_an_article(name):
    footer = f"<footer>{MORE}</footer><div class=comments>{TEXT} {MORE}</div><div>About us</div>"
    for tag in ("article", "main"):
        page = f"<div class='{name}'><{tag}><h1>T</h1><p>{TEXT}</p></{tag}></div>{footer}"
        assert H.main_text(page) == f"T {TEXT}"


@pytest.mark.parametrize("name", LAYOUT[:-1])
def test_layout_names_do_not_hide_long_blocks(name):
    assert H.main_text(f"<div id='{name}'><p>{TEXT} {MORE}</p><p>Yes.</p></div>") == f"{TEXT} {MORE} Yes."


@pytest.mark.parametrize("name", LAYOUT[4:8])
def test_topics_inside_an_article(name):
    inside = f"<p>{MORE}</p><div class='{name}'><p>{TEXT} {MORE}</p></div>"
    assert H.main_text(f"<article>{inside}</article>") == f"{MORE} {TEXT} {MORE}"


@pytest.mark.parametrize("name", ["sidebar", "cookie-notice", "comments", "comment-list", "site-footer",
                                  "legal", "top-nav", "social", "newsletter signup", "ads"])
def test_named_parts_stay_out(name):
    part = f"<div class='{name}'><p>{TEXT} {MORE}</p></div>"
    assert H.main_text(f"<div><p>{MORE} {TEXT}</p></div>{part}") == f"{MORE} {TEXT}"
    assert H.main_text(f"<article><p>{MORE}</p>{part}</article>") == MORE
    assert H.main_text(f"<div><p>{POLISH}</p></div>{part}") == POLISH


@pytest.mark.parametrize("page", [
    f"<form id=aspnetForm method=post><article><p>{TEXT}</p></article><select><option>x</select></form>",
    f"<form id=aspnetForm><input><div id=content><p>{TEXT} {MORE}</p></div><button>Go</button></form>",
    f"<div class='post comments-open'><p>{TEXT} {MORE}</p></div>",
    f"<div id=page class=comments-open><article><p>{TEXT}</p></article></div>",
    f"<nav><a href=/>Home</a> <a href=/b>Blog</a><article><p>{TEXT}</p></article>",
    f"<header><nav><a href=/>Home</a><main><p>{TEXT}</p></main>",
    f"<article class='reply-letter'><p>{TEXT}</p></article>",
    f"<article class='comment-free'><p>{TEXT}</p></article>",
    f"<div id='skip-target'><p>{TEXT} {MORE}</p></div>",
    f"<article><p>{MORE}</p><div class='article__banner-text'><p>{TEXT} {MORE}</p></div></article>",
    f"<article><p><a id=p1>{TEXT}</a></p><p><a name=p2>{MORE}</a></p></article>"])
def test_articles_are_not_lost(page):
    assert TEXT in H.main_text(page) and "Home" not in H.main_text(page) and "Go" not in H.main_text(page)


def test_threads_and_forms_stay_out():
    thread = f"<article class='comment-body'><p>{TEXT}</p></article><div class='comments'><p>{TEXT}</p></div>"
    form = f"<form class=newsletter><p>Sign up for our letters.</p><input><button>Go</button></form>"
    assert H.main_text(f"<article><p>{MORE}</p>{form}</article>{thread}") == MORE
    assert H.main_text(f"<nav><article><p>{TEXT}</p></article></nav><article><p>{MORE}</p></article>") == MORE


def test_stray_end_tags_take_linear_time():
    import time

    start = time.perf_counter()
    H.main_text("<div>" * 16_000 + "</section>" * 16_000)
    H.main_text("<nav>" + "<article><p>x</p></article>" * 5_000 + "</nav>")
    assert time.perf_counter() - start < 2


def test_long_pages_take_linear_time():
    H.main_text("<p " * 20_000)
    H.main_text("<!-" * 20_000 + "<a \"" * 5_000)
    assert H.main_text("<article>" + f"<p>{TEXT}</p>" * 5_000).count("committee") == 5_000


def test_query(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    out = {r["page_id"]: r for r in op8_html(spark, SF_SMALL).collect()}
    assert len(out) == len(pages)
    for r in pages:  # these pages mark the article; its blocks are cut at p, h1 and br
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x)).split())
                 for x in re.split("</?(?:p|h1|br)>", article)]
        want = " ".join(x for x in parts if x)
        assert (out[r["page_id"]]["text"], out[r["page_id"]]["n_chars"]) == (want, len(want))
