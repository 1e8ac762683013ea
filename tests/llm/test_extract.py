import html
import re

import pytest

from starweave.llm import extract as X
from starweave.llm.common import table

SCHEMA = "page_id long, url string, html string"


def by_pattern(page):
    """Text of a page of the test data: all that stands in its article."""
    body = re.search(r"(?s)<article>(.*?)</article>", page)[1]
    blocks = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>|<br>", lambda m: " " if m[0] == "<br>" else "", body))
    return "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)


def test_whole_table(spark, rows_of):
    rows = {r.page_id: r for r in X.query(table(spark, "/root/testdata/sf0.01", "pages")).collect()}
    pages = rows_of("pages", "/root/testdata/sf0.01")
    assert len(rows) == len(pages)
    for p in pages:
        assert rows[p["page_id"]].text == by_pattern(p["html"])
        assert rows[p["page_id"]].n_chars == len(rows[p["page_id"]].text) and rows[p["page_id"]].url == p["url"]


OTHER = """<!doctype html><HTML><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><a href="/">Site</a></header><div id=menu><a href=1>One</a> <a href=2>Two</a></div>
<div class='cookie-notice'>We use cookies</div>
<div class="post"><h1>A &amp; B</h1><p>First   para&shy;graph with <em>in</em>line words &#8211; and a <a href="x">link</a>.
<div class="ad">Buy now</div><p>Second paragraph, quite a few words long, so that it counts.<ul><li>item one</li><li>item two</li></ul>
<form><input value="q"><button>Send</button></form><script>if (a < b) { "</p>" }</script>
<blockquote>Quoted &eacute;&nbsp;&nbsp;words</blockquote></div>
<section id="comments"><p>Reader says hello there my friends</p></section><aside>Related things</aside>
<footer>&copy; 2024</footer></body></HTML>"""
TEXT = "A & B\nFirst para\xadgraph with inline words – and a link.\nSecond paragraph, quite a few words long, so that it counts.\nitem one\nitem two\nQuoted é words"


def test_a_page_of_another_kind(spark, rows_of):
    pages = spark.createDataFrame([(p["page_id"], p["url"], p["html"]) for p in rows_of("pages")] + [(10**6, "u", OTHER)], SCHEMA)
    got = {r.page_id: r.text for r in X.query(pages).collect()}
    assert got[10**6] == TEXT
    assert X.text_of(OTHER, {}) == TEXT


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<p>", ""), ("a < b &lt; c", "a < b < c"), ("<p>x<!-- y", "x"),
    ("<article><p>in</article>out", "in"), ("<nav>menu", ""), ("<script>x", ""), ("<p>a</nav></div>b", "a\nb"), ("<p title=\"a>b\">c</p>", "c"),
    ("<p hidden>no</p><p>yes yes</p>", "yes yes"), ("<article><header><h1>Title</h1></header><p>body</p><article class='comment'>hi</article></article>", "Title\nbody"),
    ("<p class=\"a>unclosed</p>", "unclosed"), ("<textarea>no</textarea>word", "word"),
])
def test_small_pages(page, text):
    assert X.text_of(page, {}) == text


def test_best_run_is_contiguous_and_drops_poor_ends():
    links = "".join(f"<div><a href='/{i}'>t{i}</a></div>" for i in range(30))
    assert X.text_of(links + "<p>" + "word " * 40 + "</p>" + links, {}).split() == ["word"] * 40


def test_nulls_repeats_empty_and_clashing_columns(spark):
    rows = [(1, "u", "<p>a b</p>"), (1, "u", "<p>a b</p>"), (None, None, "<main><p>c</main>"), (2, None, None), (3, "v", ""), (4, "w", "<p>" + "x " * 300000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS key")
    got = sorted(((r.page_id or 0, r.n_chars) for r in X.query(df).collect()))
    assert got == [(0, 1), (1, 3), (1, 3), (2, 0), (3, 0), (4, 599999)]
    assert X.query(spark.createDataFrame([], SCHEMA)).collect() == []


def frame(content):
    """A page with unclassed words and wrappers around ``content``."""
    links = "".join(f"<li><a href={i}>More of this {i}</a></li>" for i in range(8))
    return f"<html><body><div><div>Site <p>Site name and its motto</p></div><ul>{links}</ul></div>{content}<div><div>Find us <p>Where we are and when we open</p></div><ul>{links}</ul></div></body></html>"


STORY = "<h1>The title</h1><p>" + "word " * 100 + "</p><div><p>a short caption</p></div><p>" + "more " * 100 + "</p>"
STORY_TEXT = "The title\n" + " ".join(["word"] * 100) + "\na short caption\n" + " ".join(["more"] * 100)


def test_weights_of_marked_pages_hold_for_pages_without_a_mark(spark):
    inner = "<h1>A title</h1><p>" + "some words " * 40 + "</p><p>See <a href=x>this</a> too</p>"
    rows = [(i, f"u{i}", frame(f"<article>{inner}</article>")) for i in range(200)]
    rows.append((1000, "v", frame(f"<div id=content>{STORY}</div>")))
    df = spark.createDataFrame(rows, SCHEMA)
    learned = X.fit(df)
    assert not any(" in " in f or " out " in f or f in ("edge", "tag article") for f in learned)
    assert learned["word  p"] > 1 > learned["word  div"] == learned["word a li"] == X.LEAST
    assert learned["tag p"] > -1 and learned["tag div"] < -5 and learned["tag li"] < -5
    got = {r.page_id: r.text for r in X.query(df).collect()}
    assert got[1000] == STORY_TEXT
    assert all(got[i] == "A title\n" + " ".join(["some words"] * 40) + "\nSee this too" for i in range(200))


def test_words_right_in_the_mark_are_learned_as_those_of_the_block_around_it():
    found = {f: content for f, words, _, _, content in X.tokens("<body><main>in it</main><div><article>too</article></div>out") if words}
    assert found == {"word  body": False, "word  div": True}
    assert X.text_of("<article></article><p>all words of the page", {}) == "all words of the page"


LONG = "word " * 60


@pytest.mark.parametrize("page,text", [
    *[(f"<article><h1>T</h1><section id={slug}><h2>Head</h2><p>{LONG}</p></section></article>", "T\nHead\n" + LONG.strip())
      for slug in ("social-impact", "related-work", "notice-period", "comment-syntax", "menu", "form-design")],
    *[(f"<{tag}><p>{LONG}</p><h2 id={slug}>Head</h2><p>{LONG}</p></{tag}>", f"{LONG.strip()}\nHead\n{LONG.strip()}")
      for tag in ("article", "div") for slug in ("social-impact", "related-work", "notice-period", "comment-syntax", "related")],
    (f"<div><p>{LONG}</p><section id=social-impact><p>{LONG}</p></section></div>", f"{LONG.strip()}\n{LONG.strip()}"),
    *[(f"<div class='{label}'><nav>menu</nav><div class=sidebar>at the side</div><{tag}><h1>T</h1><p>{LONG}</p></{tag}></div>", "T\n" + LONG.strip())
      for label in ("layout sidebar-left", "app header-fixed", "page nav-open-left menu-top") for tag in ("article", "main", "div")],
    (f"<article><div class=article-header><h1>T</h1></div><p>{LONG}</p><div class=ad-slot>Buy</div><div class=share-buttons>Share</div><div id=comment-7>Hi</div></article>", "T\n" + LONG.strip()),
    (f"<article><p>{LONG}</p><section class=comment-list>{LONG * 5}</section><section id=comments>{LONG * 5}</section></article>", LONG.strip()),
    (f"<div><p>{LONG}</p></div><div id=site-sidebar>Some words</div><div id=comments><article class=comment>{LONG * 2}</article></div>", LONG.strip()),
    (f"<p>{LONG}</p><div class=cookie-bar>{LONG * 2}</div><div class=top-menu><a href=1>{LONG * 2}</a></div>", LONG.strip()),
    (f"<p>{LONG}</p><div class=related><article>{LONG}</article><article>{LONG}</article></div>", LONG.strip()),
    (f"<p>{LONG}</p><div class=related><article>One teaser</article></div>", LONG.strip()),
])
def test_labels_of_headings_and_layouts_are_not_those_of_boxes(page, text):
    assert X.text_of(page, {}) == text


TEASERS = "".join(f"<article class=card><h3>Teaser {i}</h3><p>{'a few words of another story '}</p></article>" for i in range(4))
FIGURES = "<div><figure><img src=a><img src=b></figure></div>" * 10


@pytest.mark.parametrize("page,text", [
    # teasers are articles beside the article; `main` comes before `article`
    (f"<main><article><h1>T</h1><p>{LONG}</p></article></main><section><h2>More</h2>{TEASERS}</section>", "T\n" + LONG.strip()),
    (f"<main><h1>T</h1><article><p>{LONG}</p></article><section><h2>More</h2>{TEASERS}</section></main>", "T\n" + LONG.strip()),
    (f"<body><div><main><h1>T</h1><p>{LONG}</p></main>{TEASERS * 30}</div></body>", "T\n" + LONG.strip()),
    (f"<article><h1>T</h1><p>{LONG}</p></article><section><h2>More</h2>{TEASERS}</section>", "T\n" + LONG.strip()),
    (f"<section><h2>More</h2>{TEASERS}</section><article><h1>T</h1><p>{LONG}</p></article>", "T\n" + LONG.strip()),
    (f"<article><h1>T</h1><p>{LONG}</p></article><article><p>{LONG}</p></article>", f"T\n{LONG.strip()}\n{LONG.strip()}"),
    (f"<article><p>{LONG}</p><article><p>a quoted story</p></article><p>end</p></article>", f"{LONG.strip()}\na quoted story\nend"),
    # no tags inside make the last words go, and no number of words outside makes them stay
    (f"<article><p>{LONG}</p>{FIGURES}<p>end</p></article>", f"{LONG.strip()}\nend"),
    (f"<article><p>first</p>{FIGURES * 20}<p>end</p></article>", "first\nend"),
    (f"<p>{LONG * 50}<article><p>in</p></article>{LONG * 50}", "in"),
    # ordinary names are no boxes there, unless they hold links
    (f"<article><p>{LONG}</p><section class=menu>Soup and bread</section><div class=form>The form of it</div></article>", f"{LONG.strip()}\nSoup and bread\nThe form of it"),
    (f"<article><p>{LONG}</p><div class=menu><a href=1>One</a> <a href=2>Two</a></div><div class=share>Share</div><p>end</p></article>", f"{LONG.strip()}\nend"),
])
def test_marked_pages_lose_nothing_but_boxes(page, text):
    for learned in ({}, {"word  p": 0.1, "tag p": -12.0, "tag div": -12.0, "tag img": -12.0}):
        assert X.text_of(page, learned) == text


@pytest.mark.parametrize("layout", ["frame", "table"])
def test_learned_weights_decide_pages_without_a_mark(spark, layout):
    def wrap(content):
        if layout == "frame":
            return frame(content)
        cells = "".join(f"<tr><td>Cell {i} of the site's table</td></tr>" for i in range(12))
        return f"<html><body><table>{cells}</table>{content}<table>{cells}</table></body></html>"

    inner = "<h1>A title</h1><p>" + "some words " * 40 + "</p><p>See <a href=x>this</a> too</p>"
    rows = [(i, f"u{i}", wrap(f"<article>{inner}</article>")) for i in range(50)]
    page = wrap(f"<div id=content>{STORY}</div>")
    learned = X.fit(spark.createDataFrame(rows, SCHEMA))
    assert X.text_of(page, learned) == STORY_TEXT
    # without weights, with equal ones, or with those of words or tags alone turned round, it comes out wrong
    turned = {f: -12.0 if w > -1 else -0.1 for f, w in learned.items() if f.startswith("tag")}
    assert X.text_of(page, learned | turned) != STORY_TEXT
    assert X.text_of(page, {f: 3.0 if f.startswith("word") else -0.1 for f in learned}) != STORY_TEXT
    assert X.text_of(page, {f: 0.1 if f.startswith("word") else -12.0 for f in learned}) != STORY_TEXT
