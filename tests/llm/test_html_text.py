"""HTML extraction: hand-written pages with boilerplate around an article, malformed markup, and the driver's pages."""

import html
import re

import pytest

from tracelake.llm import html_text as H

P1 = "The first paragraph of the story is long enough, has commas, and says something about the matter at hand."
P2 = "A second paragraph follows it, with <a href='/x'>one link</a> inside, and some more words to read &amp; keep."
P2T = "A second paragraph follows it, with one link inside, and some more words to read & keep."
NAV = "<nav><ul><li><a href='/'>Home</a><li><a href='/news'>News</a></ul></nav>"
HEAD = "<!doctype html><html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head>"

PAGES = {
    "article": f"{HEAD}<body>{NAV}<header><h1>Site</h1></header><article><h1>Head line</h1><p>{P1}</p><p>{P2}</article><footer>&copy; x</footer></body>",
    "div": f"{HEAD}<body><div id='masthead'>Site name</div><div class='main-content'><h1>Head line</h1><p>{P1}<p>{P2}</div>"
    f"<div class='sidebar'><p>{P1} sidebar, one, two, three, four</p></div><div class='footer-links'><p>About, us, and, them, all</p></div>",
    "comments": f"<body><main><h1>Head line</h1><div class='text'><p>{P1}</p><p>{P2}</p></div><section id='comments'><article class='comment'>"
    f"<p>{P1} I agree, fully, with all, of it.</p></article></section></main><aside><p>{P1}</p></aside>",
    "forms": f"<body><div class='cookie-notice'><p>We use cookies, all of them, always, and you agree to that by reading on, thanks.</p></div>"
    f"<form><p>Sign up, now, for our, letter, of, the, week, please and thank you very much indeed.</p><textarea>{P1}</textarea></form>"
    f"<div><h1>Head line</h1><p>{P1}</p><div class='ad-slot'><p>Buy, now, this, thing, here, for, less, than, ever.</p></div><p>{P2}</p>"
    f"<ul class='related-posts'><li><a href='1'>Other story one, two</a><li><a href='2'>Other story</a></ul></div>",
    "main": f"<body><header>Site, name, and, motto</header><main><header><h1>Head line</h1></header><section><p>{P1}</p><p>{P2}</p></section></main>"
    f"<div id='secondary' class='widget-area'><p>{P1} {P1} {P1}</p></div>",
    "roles": f"<body><div role='navigation'>{P1}</div><div style='display:none'><p>{P1}</p></div><div hidden><p>{P1}</p></div>"
    f"<div role='main'><h1>Head line</h1><p>{P1}</p><p>{P2}</p></div><div role='contentinfo'>{P1}</div><!-- <p>{P1}</p> -->",
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_article_without_boilerplate(name):
    assert H.main_text(PAGES[name]) == "\n\n".join(["Head line", P1, P2T])


def test_block_text():
    page = "<article><p>a\n b&nbsp;&nbsp;c<br>d &lt;p&gt; <b>e<i>f</b></i></p>\n<p> </p><pre>g\n  h</pre>tail</article>"
    assert H.main_text(page) == "a b c d <p> ef\n\ng h\n\ntail"


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!--", "<script>x", "<p>", "</p></div>", "<a " * 3000, "<div>" * 5000 + "x", "plain words only", "<p 'q\">z</p>"])
def test_odd_markup(page):
    out = H.main_text(page)
    assert "\n\n\n" not in out and out == out.strip()
    if "words" in page:
        assert out == page


def test_very_long_page():
    page = "<article>" + "".join(f"<p>Paragraph {i}, and more.</p>" for i in range(20_000)) + "</article>"
    assert H.main_text(page).count("\n\n") == 19_999


def test_driver_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in H.extract(pages).collect()}
    for row in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", re.sub("<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        r = got[row.page_id]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == row.url


def test_edge_rows(spark):
    rows = [(1, None, None, 3), (1, None, None, 3), (None, "u", "", 1), (2, "u", "<p>" + "w, " * 100_000, 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = sorted(((r.page_id or 0, r.url, r.n_chars) for r in H.extract(pages).collect()), key=str)
    assert got == sorted([(1, None, 0), (1, None, 0), (0, "u", 0), (2, "u", 299_999)], key=str)
    assert H.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "box",
    [
        "div class='overflow-hidden'", "div class='elementor-widget'", "div class='has-sidebar'", "div class='content-with-sidebar'", "div data-title='Ten hidden gems'",
        "section id='discussion'", "section id='related-work'", "div class='section' id='discussion'", "div title='a role=search b'", "div class='search-results-of-the-study'",
        "div class='post-header'", "div class='hidden lg:block'", "div class='content-sidebar-wrap'",
    ],
)
def test_names_that_hold_a_boilerplate_word(box):
    part = f"<{box}><h2 id='search-algorithms' class='related'>Inner head</h2><p>{P1}</p></{box.split()[0]}>"
    whole = "\n\n".join(["Head line", P2T, "Inner head", P1])
    assert H.main_text(f"<body>{NAV}<article><h1>Head line</h1><p>{P2}</p>{part}</article>") == whole
    assert H.main_text(f"<body>{NAV}<div><h1>Head line</h1><p>{P2}</p>{part}</div>") == whole


@pytest.mark.parametrize("name", ["widget", "sidebar", "main-menu", "notice"])
def test_article_in_a_block_named_boilerplate_is_not_lost_to_a_small_rest(name):
    body = "".join(f"<p>{i} {P1} {P1} {P1}</p>" for i in range(5))
    out = H.main_text(f"<body><p>We use cookies, and so on, as all do.</p><div class='{name}'><h1>Head line</h1>{body}<div class='share-links'><p>Share it, now.</p></div></div>")
    assert out.endswith("\n\n".join(["Head line", *(f"{i} {P1} {P1} {P1}" for i in range(5))])) and "Share" not in out


def test_long_comments_do_not_outweigh_the_article():
    talk = "".join(f"<div class='comment'><p>{P1} {P1}</p></div>" for _ in range(15))
    assert H.main_text(f"<body><div><h1>Head line</h1><p>{P1}</p><p>{P2}</p></div><div id='comments'>{talk}</div>") == "\n\n".join(["Head line", P1, P2T])


@pytest.mark.parametrize("tag", ["select", "object data='x'", "audio", "video src='x'", "noscript", "canvas", "template", "svg", "math", "svg width='1'/", "math/"])
@pytest.mark.parametrize("later", ["", "<svg><title>no</title><path d=''/></svg><select><option>no</select><video>no</video>"])
def test_unclosed_elements_do_not_swallow_the_page(tag, later):
    assert H.main_text(f"<article><h1>Head line</h1><div><{tag}></div><p>{P1}</p>{later}<p>{P2}</p></article>") == "\n\n".join(["Head line", P1, P2T])
    own = "" if tag.endswith("/") else "no such words"
    assert H.main_text(f"<article><h1>Head line</h1><p>{P1}<{tag}>{own}<p>{P2}</p></article>{later}") == "\n\n".join(["Head line", P1, P2T])


def test_closed_elements_leave_the_paragraph_whole():
    icon = "<svg viewBox='0 0 1 1'><svg><text>no</text></svg><text>no</text></svg><svg/><video><p>no</p></video><select><option>no<option>no</select>"
    assert H.main_text(f"<article><p>a {icon}b</p><p>{P1}</p><select><option>no<option>no</article>") == f"a b\n\n{P1}"
    assert H.main_text(f"<article><p>{P1}</p><script>never ended <p>{P2}</p>") == P1


STORY = "\n\n".join(["Head line", P1, P2T])


@pytest.mark.parametrize("n", [1, 60, 120, 400])
def test_comments_never_replace_the_article(n):
    talk = "".join(f"<div class='comment'><p>{i} {P1} {P1}</p></div>" for i in range(n))
    comments = f"<div class='comments'>{talk}</div>"
    assert H.main_text(f"<body><article><p>One line.</p></article>{comments}") == "One line."
    assert H.main_text(f"<body><article><h1>Head line</h1><p>{P1}</p><p>{P2}</p></article>{comments}") == STORY
    assert H.main_text(f"<body><div><p>One line.</p></div>{comments}") == "One line."
    assert H.main_text(f"<body>{comments}") == ""


@pytest.mark.parametrize("name", ["sidebar", "advert", "notice", "widget", "newsletter", "promo", "footer"])
def test_named_blocks_never_outweigh_an_article(name):
    box = f"<div class='{name}'><h1>Of the box</h1>" + f"<p>{P1} {P1}</p>" * 6 + "</div>"
    for tag in ("article", "main"):
        assert H.main_text(f"<body><{tag}><p>One line.</p></{tag}>{box}") == "One line."
        assert H.main_text(f"<body>{box}<div><{tag}><h1>Head line</h1><p>{P1}</p><p>{P2}</p></{tag}></div>") == STORY
    assert H.main_text(f"<body><div><h1>Head line</h1><p>{P1}</p><p>{P2}</p></div>{box}") == STORY


NOISE = f"<div class='cookie-notice'><p>We use cookies, all of them, and so on.</p></div><div id='comments'><p>{P1} I agree, fully.</p></div><footer><p>{P1}</p></footer>"


@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>", "{}", "<div class='widget'>{}</div>"])
def test_form_around_the_whole_page_is_a_wrapper(inner):
    story = inner.format(f"<h1>Head line</h1><p>{P1}</p><p>{P2}</p>")
    login = f"<form><p>Sign in, please, with your name, and your word. {P1}</p></form>"
    assert H.main_text(f"<body><form id='aspnetForm'>{NAV}{story}<select><option>no</select><button>Go</button>{NOISE}</form></body>") == STORY
    assert H.main_text(f"<body>{story}{login}{NOISE}") == STORY


def test_second_look_leaves_notices_comments_and_footers_out():
    text = f"<p>{P1}</p><p>{P2}</p>"
    assert H.main_text(f"<body><form>{NAV}{text}{NOISE}</form>") == "\n\n".join([P1, P2T])
    assert H.main_text(f"<body><aside>{text}</aside>{NOISE}") == "\n\n".join([P1, P2T])
    assert H.main_text(f"<body><div class='sidebar'>{text}</div>{NOISE}") == "\n\n".join([P1, P2T])
    assert H.main_text(f"<body>{NOISE}{NAV}") == ""


def test_lists_and_tables_of_the_article_stay():
    refs = "<h2>References</h2><ol><li><a href='a'>First source of the story</a><li><a href='b'>Second source</a></ol>"
    table = "<table><tr><td><a href='c'>A linked cell of the table, quite long</a></td><td>12</td></tr></table>"
    linked = "<table><tr><td><a href='c'>Only</a></td><td><a href='d'>links</a></td></tr></table>"
    mixed = "<ul><li><a href='e'>A long linked title of a thing</a>: why<li><a href='f'>Another long linked title</a></ul>"
    tags = "<ul><li><a href='t'>tag one</a><li><a href='u'>tag two</a></ul>"
    lone = "<div><a href='g'>The paper</a></div>"
    got = H.main_text(f"<article><h1>Head line</h1><p>{P1}</p>{table}<p>{P2}</p>{linked}{lone}{mixed}{tags}{refs}</article>")
    assert got.split("\n\n") == [
        "Head line", P1, "A linked cell of the table, quite long", "12", P2T, "Only", "links", "The paper",
        "A long linked title of a thing: why", "Another long linked title", "References", "First source of the story", "Second source",
    ]


@pytest.mark.parametrize("depth", [10, 399, 400, 401, 3000])
def test_deep_menus_stay_out(depth):
    menu = "<nav><ul><li>Deep menu entry one<li>Deep menu entry two</ul></nav>"
    page = "<body>" + "<div>" * depth + f"<h1>Head line</h1><p>{P1}</p>{menu}<div class='comments'><div><p>{P1}</p></div></div><p>{P2}</p>" + "</div>" * depth
    assert H.main_text(page) == STORY
