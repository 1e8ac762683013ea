"""Main text of HTML pages as the maximum-scoring run of words and tags.

A page is read as a sequence of words and tags. Elements that are never part of
an article (menus, headers and footers of the page, sidebars, notices, adverts,
forms, scripts, styles, reader comments) are left out of the sequence, by
element name, role, class name or id. Inside the content, and for ids of other
elements than boxes, a name counts only if all its parts are known, so that
`social-impact` is a heading's address and `social-links` a box; a heading goes
only by the class names of adverts and comments. A label of the page's layout
(`sidebar-left`) leaves an element in that holds `main`, the page's only article
or most of the words outside links. Of the rest, every word scores above zero and
every tag below; one linear scan finds the contiguous run with the largest sum,
and its words are the text. The weights are log odds of lying inside or outside
the content, counted per feature (for a word: whether it is in a link, and its
block; for a tag: its name) over labelled pages, that is, pages whose author
marked the content with an `article` or `main` element: at most ``SAMPLE_PAGES``
different ones, those with the smallest hash of their address. The mark is the
label and in no feature, so what is learned holds for pages without it.

On a page that has the mark itself, the mark outranks what is learned: words inside
weigh ``MARKED_WORD`` at least, the mark's own tags ``EDGE``, and all tags inside,
like all words outside, are scaled to weigh less than one marked word together. So
no word of the content goes for the tags before it, and nothing outside pays for
crossing the edge. Inside the content the class names of adverts, comments and
notices drop a box; ordinary words (`menu`, `form`) only if most of its words are
links. Where `main` holds an article, those outside are no content; of marks
beside each other, articles with less than one word for ``TEASER`` of the longest
are teasers: no content, and on pages with `main` they go with the box that holds
little else.

Null and empty pages, and pages without words, have an empty text. Long pages are
read whole, in one pass (two if labels or several marks have to be judged). Repeated
rows each have their result; an empty table has none. Columns beside page_id, url
and html are not read, whatever their names.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.llm.common import add_columns, bounded_sample

SAMPLE_PAGES = 1000
# Weights of features that no labelled page shows.
WORD, LINK_WORD, TAG = 1.0, 0.2, -0.5
# On pages with marked content: least weight of a word inside, weight of the tags that open and close the content.
MARKED_WORD, EDGE = 2.0, -8.0
REST = 0.4 * MARKED_WORD  # most that all tags inside, or all words outside, weigh together there
TEASER = 4  # an article beside one of more than so many times its words is a teaser
LEAST, MOST_WORD, MOST_TAG = 0.1, 3.0, 12.0

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_CONTENT = frozenset(("article", "main"))
_OUT = frozenset("aside button canvas datalist dialog footer form head iframe menu nav noscript object option script select style svg template textarea title".split())
_ROLES = frozenset("alert banner complementary contentinfo form navigation search dialog menu menubar".split())
_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus dropdown footer "
    "form header menu modal nav navbar navigation newsletter notice notices notification pagination paywall popup promo promoted promotion recommended related replies "
    "reply share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription toolbar warning widget widgets".split()
)
_COMMENTS = frozenset("comment comments reply replies disqus".split())
_ADS = _COMMENTS | frozenset("ad ads adv advert adverts advertisement advertising promo promoted promotion sponsor sponsored".split())
_NOTICES = _ADS | frozenset("consent cookie cookies modal newsletter notice notices notification paywall popup recommended related signup skip subscribe subscription warning".split())
# Words that an author may use for a part of the article.
_ORDINARY = frozenset("banner dropdown footer form menu skip toolbar warning widget widgets".split())
# Parts of names that say nothing about what an element holds.
_FORMS = frozenset(
    "area articles bar block body bottom box button buttons col column container content count div global group inner item items left link links list main meta "
    "outer page panel posts primary respond right row secondary section site slot space thread top unit wrap wrapper zone".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOXES = frozenset("div ol table td ul".split())  # their ids name places of the page; ids of others may be headings' addresses
_STAYS, _LINKS, _LAYOUT, _NOTICE, _GONE = range(5)
_STATES = frozenset("has no with without open is".split())  # class names like has-sidebar tell about the page, not the element
_BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_PLACES = _BLOCKS - _CONTENT  # blocks that may lie inside or outside the content
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|([^<]+)|(<)""", re.S
)
_MARK = re.compile(r"<(?:article|main)(?![^\s/>])", re.I)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


def _label(label: str, loose: bool) -> frozenset:
    """The known names in a class name or id; unless ``loose``, none if one of its parts is not known."""
    parts = frozenset(p for p in re.split(r"[-_]+", label) if p and not p.isdigit())
    known = parts & _CLASSES
    return known if known and not parts & _STATES and (loose or parts <= _CLASSES | _FORMS) else frozenset()


def _left_out(name: str, attrs: str, in_content: bool) -> int:
    """_STAYS; _GONE; or _LINKS, _LAYOUT, _NOTICE: goes unless it holds what `_wrappers` asks for."""
    if name in _OUT or (name == "header" and not in_content):
        return _GONE
    if not attrs or name in ("html", "body"):
        return _STAYS
    found = _STAYS
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden":
            return _STAYS if name in _CONTENT else _GONE
        if key == "role" and value in _ROLES:
            return _GONE
        if key not in ("class", "id") or (name in _HEADINGS and key == "id"):
            continue
        for label in value.split():
            strict = _label(label, False)
            if name in _CONTENT:
                if in_content and strict & _COMMENTS:
                    return _GONE
                continue
            if strict & _ADS:
                return _GONE
            if name in _HEADINGS:
                continue
            if in_content:
                known = strict - {"header"} if key == "class" else frozenset()
            else:
                known = strict if key == "id" and name not in _BOXES else _label(label, True)
            if in_content and known and known <= _ORDINARY:
                found = max(found, _LINKS)
            elif known:
                found = max(found, _NOTICE if known & _NOTICES else _LAYOUT)
    return found


def _scan(page: str):
    """Yields (element name or '' for text, is a closing tag, attributes or text, place) in page order."""
    pos, size = 0, len(page)
    low = None
    while pos < size:
        at, m = pos, _TOKEN.match(page, pos)
        pos = m.end()
        if m[7] is not None or m[8] is not None:
            yield "", False, m[0], at
            continue
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = bool(m[1] or m[4])
        yield name, closing, m[3] or m[6] or "", at
        if name in _RAW and not closing:
            low = page.lower() if low is None else low
            end = low.find(f"</{name}", pos)
            if end < 0 or len(low) != size:  # unclosed, or lower case of another length
                found = re.compile(f"</{name}", re.I).search(page, pos)
                end = found.start() if found else size
            close = page.find(">", end)
            pos = size if close < 0 else close + 1


def _marks(page: str) -> tuple[set[int], set[int]]:
    """(places of the elements that are the content, places of boxes of teasers in it) of a page with several marks."""
    stack: list[tuple] = []
    holders: list[tuple[int, str, int, tuple[int, ...]]] = []  # elements with articles and no main: place, name, all words, their numbers
    found: list[tuple[int, int, int, bool]] = []  # articles: place, words outside links, all words, lies in main
    mains: dict[int, int] = {}  # place -> words outside links
    out = links = inside = depth = plain = every = 0

    def close() -> str:
        nonlocal out, links, inside, depth
        name, at, gone, was_plain, was_every, was_found, was_mains = stack.pop()
        out -= gone
        links -= name == "a"
        if not out and not gone:
            if name == "main":
                inside -= 1
                if every > was_every:
                    mains[at] = plain - was_plain
            elif name == "article":
                depth -= 1
                if not depth:
                    found.append((at, plain - was_plain, every - was_every, inside > 0))
            if len(found) > was_found and len(mains) == was_mains:
                holders.append((at, name, every - was_every, tuple(range(was_found, len(found)))))
        return name

    for name, closing, text, at in _scan(page):
        if not name:
            n = 0 if out else len(text.split())
            every += n
            plain += 0 if links else n
        elif closing:
            if any(x[0] == name for x in stack):
                while close() != name:
                    pass
        elif name not in _VOID and name not in _RAW:
            gone = not out and _left_out(name, text, inside + depth > 0) == _GONE
            stack.append((name, at, gone, plain, every, len(found), len(mains)))
            out += gone
            links += name == "a"
            if not out:
                inside += name == "main"
                depth += name == "article"
    while stack:
        close()
    # where `main` holds an article, those outside are none
    able = [i for i, x in enumerate(found) if x[3]] or range(len(found))
    longest = max([found[i][1] for i in able], default=0)
    if not any(x[3] for x in found):
        longest = max([longest, *mains.values()])
    teasers = {i for i in able if TEASER * found[i][1] < longest}
    gone = {at for at, _, words, held in holders if teasers.issuperset(held) and 2 * sum(found[i][2] for i in held) >= words}
    return mains.keys() | {found[i][0] for i in able if i not in teasers and not found[i][3]}, gone if mains else set()


def _wrappers(page: str, marks: set[int] | None) -> set[int]:
    """Places of the elements that stay in spite of a label.

    A label of ordinary words inside the content goes only from elements with more
    words in links than outside. Others stay that hold `main`; or the page's only article, a notice if it also holds most
    of the words; or, unless the label is a notice's, most of the words outside
    notices. Words in links or in what goes do not count. ``marks``: see `tokens`.
    """
    stack: list[tuple[str, int, int, tuple]] = []
    held: list[tuple[int, int, tuple]] = []
    out = notices = content = links = 0
    words = every = linked = mains = articles = 0  # words: outside notices; every: all outside links

    def close() -> str:
        nonlocal out, notices, content, links
        name, level, at, before = stack.pop()
        out -= level == _GONE
        notices -= level == _NOTICE
        content -= name in _CONTENT and (marks is None or at in marks)
        links -= name == "a"
        if level not in (_STAYS, _GONE):
            held.append((at, level, tuple(x - y for x, y in zip((words, every, linked, mains, articles), before))))
        return name

    for name, closing, text, at in _scan(page):
        if not name:
            n = 0 if out else len(text.split())
            if links:
                linked += n
                continue
            every += n
            words += 0 if notices else n
        elif closing:
            if any(x[0] == name for x in stack):
                while close() != name:
                    pass
        elif name not in _VOID and name not in _RAW:
            level = _STAYS if out else _left_out(name, text, content > 0)
            stack.append((name, level, at, (words, every, linked, mains, articles)))
            if name in _CONTENT and not out and not _left_out(name, text, True):
                mains += name == "main"
                articles += name == "article"
            out += level == _GONE
            notices += level == _NOTICE
            content += name in _CONTENT and (marks is None or at in marks)
            links += name == "a"
    while stack:
        close()
    return {
        at for at, level, (w, e, n, m, a) in held
        if m or (level == _LINKS and n <= e) or (a == articles == 1 and (level == _LAYOUT or 2 * e > every)) or (level == _LAYOUT and 2 * w > words)
    }


def tokens(page: str):
    """Yields (feature, words, raw text, is a block edge, inside content) of a page without the parts left out.

    No feature tells whether it is inside; the outermost tags of the content are
    ``edge``. Where a page has several marks, `_marks` says which are the content.
    """
    marks, teasers = _marks(page) if len(_MARK.findall(page)) > 1 else (None, frozenset())
    stack: list[tuple[str, bool, bool]] = []
    out = content = links = 0  # open elements of each sort
    kept = None
    for name, closing, text, at in _scan(page):
        if not name:
            if not out:
                block = next((n for n, _, _ in reversed(stack) if n in _PLACES), "")
                yield f"word {'a' if links else ''} {block}", len(text.split()), text, False, content > 0
            continue
        if closing:
            if any(x[0] == name for x in stack):
                while True:
                    n, gone, mark = stack.pop()
                    out -= gone
                    content -= mark
                    links -= n == "a"
                    if n == name:
                        break
                if not out:
                    yield "" if gone else "edge" if mark and not content else f"tag {name}", 0, "", name in _BLOCKS, content > 0
            elif not out:
                yield f"tag {name}", 0, "", name in _BLOCKS, content > 0
            continue
        was = content > 0
        mark = name in _CONTENT and (marks is None or at in marks)
        level = _STAYS if out else _GONE if at in teasers else _left_out(name, text, was)
        if level not in (_STAYS, _GONE):
            kept = _wrappers(page, marks) if kept is None else kept
        gone = level != _STAYS and (level == _GONE or at not in kept)
        if not out and not gone:
            yield "edge" if mark and not was else f"tag {name}", 0, " " if name in ("br", "wbr", "img") else "", name in _BLOCKS, was
        elif not out and name in _BLOCKS:
            yield "", 0, "", True, was  # what is left out still parts the blocks around it
        if name in _VOID or name in _RAW:
            continue
        stack.append((name, gone, mark))
        out += gone
        content += mark
        links += name == "a"


def weights(counts: dict) -> dict:
    """Feature -> weight from (times inside, times outside) the content."""
    out = {}
    for f, (inside, outside) in counts.items():
        odds = math.log((inside + 0.5) / (outside + 0.5))
        out[f] = min(MOST_WORD, max(LEAST, odds)) if f.startswith("word") else min(-LEAST, max(-MOST_TAG, odds))
    return out


def text_of(page: str | None, learned: dict) -> str:
    """Main text: blocks in page order, joined by line feeds; '' if there is none."""
    if not page:
        return ""
    seq = list(tokens(page))
    marked = any(words and content for _, words, _, _, content in seq)
    inner = outer = 1.0  # scales of the tags inside and the words outside on a marked page
    if marked:
        tags = -sum(learned.get(f, TAG) for f, _, _, _, content in seq if f.startswith("tag") and content)
        around = sum(words for f, words, _, _, content in seq if f.startswith("word") and not content)
        inner, outer = min(1.0, REST / tags) if tags else 1.0, min(LEAST, REST / around) if around else LEAST
    total, start, best, first, last = 0.0, 0, 0.0, 0, 0
    for i, (feature, words, _, _, content) in enumerate(seq):
        if feature.startswith("word"):
            weight = learned.get(feature, LINK_WORD if feature.startswith("word a ") else WORD)
            if marked:
                weight = max(weight, MARKED_WORD) if content else outer
            total += words * weight
        elif feature:
            weight = EDGE if feature == "edge" else learned.get(feature, TAG)
            total += inner * weight if marked and content and feature != "edge" else weight
        if total > 0 and total >= best:
            best, first, last = total, start, i + 1
        if total < 0:
            total, start = 0.0, i + 1
    blocks, part = [], []
    for _, _, raw, edge, _ in seq[first:last]:
        if edge:
            blocks.append("".join(part))
            part = []
        elif raw:
            part.append(raw)
    blocks.append("".join(part))
    return "\n".join(b for b in (" ".join(entities.unescape(x).split()) for x in blocks) if b)


def fit(pages: DataFrame, url: str = "url", html: str = "html") -> dict:
    """Weights from at most ``SAMPLE_PAGES`` labelled pages; none if no page is labelled."""
    marked = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).where(F.col("html").rlike("(?i)<(article|main)[ \\t\\r\\n>]"))
    marked = marked.withColumn("key", F.xxhash64("html"))
    chosen = bounded_sample(marked.withColumn("all", F.lit(1)), "all", ["url", "key"], SAMPLE_PAGES)
    chosen = F.broadcast(chosen.select("url", "key"))  # at most SAMPLE_PAGES rows
    sample = marked.join(chosen, marked["url"].eqNullSafe(chosen["url"]) & (marked["key"] == chosen["key"]), "left_semi")

    def count(batches):
        inside, outside = Counter(), Counter()
        for b in batches:
            for page in b.column(0).to_pylist():
                for feature, words, _, _, content in tokens(page):
                    if feature and feature != "edge":
                        (inside if content else outside)[feature] += words if feature.startswith("word") else 1
        names = sorted(inside.keys() | outside.keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([inside[n] for n in names], pa.int64()), pa.array([outside[n] for n in names], pa.int64())], names=["f", "i", "o"])

    rows = sample.select("html").mapInArrow(count, "f string, i long, o long").groupBy("f").agg(F.sum("i"), F.sum("o")).collect()
    return weights({f: (i, o) for f, i, o in rows if i + o})


def query(pages: DataFrame) -> DataFrame:
    """op1: page_id, url, text, n_chars of every row; null and empty pages, and pages without words, have an empty text."""
    pages = pages.select("page_id", "url", "html")
    learned = fit(pages)

    def run(b):
        out = [text_of(p, learned) for p in b.column(2).to_pylist()]
        return [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]

    return add_columns(pages, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], run, keep=["page_id", "url"])
