"""Record extraction from landed HTML listing pages.

Each page is one row; cards are found with regular expressions inside the
JVM (no per-row Python), exploded to one row per card, and labelled text is
picked from the card's stripped text strings.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.functions.text import first_matching, labelled_nodes, strip_ws, unescape_html

# An anchor's address (with its quotes, if any) and its content.
ANCHOR = r"""(?is)<a\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>(.*?)</a\s*>"""
QUOTES = r"""^["']|["']$"""


def _tag_patterns(tag: str) -> tuple[str, str, str, str]:
    """Patterns for the tags named ``tag``: a token of the page, a token that starts an element, the value of its class, one that closes itself."""
    value = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
    end_tag, start_tag = rf"</{tag}(?=[\s>/])[^>]*+>", rf"""<{tag}(?=[\s>/])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
    token = rf"(?is)(<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>|{end_tag}|{start_tag})"
    # the value of the class attribute, which no other attribute's value can be taken for
    class_value = rf"""(?is)^<{tag}(?:\s+(?!class[\s=>/])[^\s=>"']++(?:\s*=\s*{value})?+)*+\s+class\s*=\s*({value})"""
    closes_itself = rf"""(?is)^<{tag}(?:\s+[^\s=>"'/]++(?:\s*=\s*{value})?+)*+\s*/>$"""  # an unquoted value takes the slash
    return token, rf"(?is)^<{tag}[\s>/]", class_value, closes_itself


def _has_class(t: Column, class_value: str, cls: str) -> Column:
    names = F.split(F.regexp_replace(F.regexp_extract(t, class_value, 1), r"""^["']|["']$""", ""), r"[\s\x{0b}]+")
    return F.array_contains(names, cls)


def has_element(html: Column | str, tag: str, cls: str) -> Column:
    """Whether ``elements`` finds any: the first start tag with the class answers, no element is put together."""
    page = F.col(html) if isinstance(html, str) else html
    token, starts, class_value, _ = _tag_patterns(tag)
    return F.exists(F.regexp_extract_all(page, F.lit(token), 1), lambda t: t.rlike(starts) & _has_class(t, class_value, cls))


def elements(html: Column | str, tag: str, cls: str) -> Column:
    """The outer HTML of every ``tag`` element with the class token ``cls``, in order of their start tags (H1).

    No regular expression matches balanced tags, but the tags of one name are a short list:
    the page is cut at them, their depth is a running sum over that list, and an element ends
    where the depth is back at its own. Elements inside others are found too. Comments, script
    and style bodies hold no tags; a tag that closes itself is an empty element; what is open at
    the end of the page ends there. All of this is one expression in the JVM; null gives null.
    """
    page = F.col(html) if isinstance(html, str) else html
    token, start_tag, class_value, closes_itself = _tag_patterns(tag)
    tokens = F.regexp_extract_all(page, F.lit(token), 1)
    between = F.split(page, token)

    def read(gap: Column, t: Column) -> Column:
        """What a token means (1: begins an element, -1: ends one, 2: both, 0: neither), and its length and that of the text before it."""
        starts = t.rlike(start_tag)
        kind = F.when(t.rlike(rf"(?is)^</{tag}[\s>/]"), -1).when(t.rlike(closes_itself), 2).when(starts, 1).otherwise(0)
        return F.struct(F.length(gap).alias("gap"), F.length(t).alias("size"), kind.alias("kind"), _has_class(t, class_value, cls).alias("mine"))

    # side by side, so that neither list is made again for each tag
    steps = F.zip_with(F.slice(between, F.lit(1), F.size(tokens)), tokens, read)
    spans = "array<struct<first:int,depth:int,behind:int>>"
    start = F.struct(F.lit(1).alias("at"), F.lit(0).alias("depth"), F.array().cast(spans).alias("open"), F.array().cast(spans).alias("done"))

    def step(acc: Column, t: Column) -> Column:
        first = acc["at"] + t["gap"]
        behind = first + t["size"]
        span = F.struct(first.alias("first"), (acc["depth"] + 1).alias("depth"), behind.alias("behind"))
        top = F.try_element_at(acc["open"], F.lit(-1))
        ends = (t["kind"] == -1) & F.coalesce(top["depth"] == acc["depth"], F.lit(False))
        closed = F.array(F.struct(top["first"].alias("first"), top["depth"].alias("depth"), behind.alias("behind")))
        return F.struct(
            behind.alias("at"),
            F.when(t["kind"] == 1, acc["depth"] + 1).when(t["kind"] == -1, F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"]).alias("depth"),
            F.when((t["kind"] == 1) & t["mine"], F.concat(acc["open"], F.array(span))).when(ends, F.slice(acc["open"], F.lit(1), F.size(acc["open"]) - 1)).otherwise(acc["open"]).alias("open"),
            F.when((t["kind"] == 2) & t["mine"], F.concat(acc["done"], F.array(span))).when(ends, F.concat(acc["done"], closed)).otherwise(acc["done"]).alias("done"),
        )

    def finish(acc: Column) -> Column:
        left = F.transform(acc["open"], lambda s: F.struct(s["first"].alias("first"), s["depth"].alias("depth"), (F.length(page) + 1).alias("behind")))
        return F.transform(F.array_sort(F.concat(acc["done"], left)), lambda s: F.substr(page, s["first"], s["behind"] - s["first"]))

    return F.when(page.isNotNull(), F.aggregate(steps, start, step, finish))


def _cards(card_pattern) -> Column:
    """A page's cards: the one group of a regular expression, or the elements of a ``(tag, class)`` pair."""
    if isinstance(card_pattern, tuple):
        return elements("html", *card_pattern)
    return F.regexp_extract_all(F.col("html"), F.lit(card_pattern), 1)


def _has_cards(card_pattern) -> Column:
    """Whether a page has a card: true with the first one, the others are not looked for."""
    if isinstance(card_pattern, tuple):
        return has_element("html", *card_pattern)
    return F.col("html").rlike(card_pattern)


def card_fragments(pages: DataFrame, card_pattern, id_col: str = "page_id") -> DataFrame:
    """One row per repeated element (H1): (page id, position, card html).

    ``card_pattern`` is a regex with one group (flat cards) or a ``(tag, class)`` pair
    (cards that may nest their own tag, see ``elements``).
    """
    return pages.select(F.col(id_col), F.posexplode(_cards(card_pattern)).alias("card_pos", "card"))


def _labelled(strings: Column, needle: str) -> Column:
    """The first of ``strings`` that holds ``needle`` when it is stripped; only those that hold it at all are stripped."""
    hits = F.transform(F.filter(strings, lambda s: s.contains(needle)), strip_ws)
    return first_matching(F.filter(hits, lambda s: s != F.lit("")), needle)


def extract_cards(
    pages: DataFrame,
    card_pattern,
    base_url: str,
    labels: Mapping[str, str],
    id_col: str = "page_id",
) -> DataFrame:
    """Title / Link / labelled texts per card; cards without an anchor are skipped."""
    # a card's anchor is found once, inside the array, where no filter can be pushed past it and compute it again;
    # its parts are read from the anchor alone
    found = F.transform(_cards(card_pattern), lambda c: F.struct(c.alias("card"), F.regexp_extract(c, ANCHOR, 0).alias("a")))
    cards = pages.select(F.col(id_col), F.posexplode(found).alias("card_pos", "_sw_c")).filter(F.col("_sw_c.a") != "")
    # a column of its own: the labels share the decoded strings
    with_anchor = cards.withColumn("_sw_texts", labelled_nodes(F.col("_sw_c.card"), list(labels.values()))) if labels else cards
    out = {
        "Title": strip_ws(unescape_html(F.regexp_replace(F.regexp_extract("_sw_c.a", ANCHOR, 2), r"<[^>]*>", ""))),
        "Link": F.concat(F.lit(base_url), unescape_html(F.regexp_replace(F.regexp_extract("_sw_c.a", ANCHOR, 1), QUOTES, ""))),
    }
    for name, needle in labels.items():
        out[name] = _labelled(F.col("_sw_texts"), needle)
    return with_anchor.select(F.col(id_col), F.col("card_pos"), *[v.alias(k) for k, v in out.items()])


def card_counts(pages: DataFrame, card_pattern, id_col: str = "page_id") -> DataFrame:
    """Number of cards per page (0 for a page without cards)."""
    return pages.select(
        F.col(id_col), F.size(_cards(card_pattern)).alias("n_cards")
    )


def pages_until_empty(
    pages: DataFrame, card_pattern, min_cards: int = 1, id_col: str = "page_id"
) -> DataFrame:
    """Pages before the first one with fewer than ``min_cards`` cards.

    The first empty page id is a scalar subquery (one value), not a join.
    """
    counts = card_counts(pages, card_pattern, id_col)
    first_empty = counts.filter(F.col("n_cards") < min_cards).agg(F.min(id_col)).scalar()
    return counts.filter(first_empty.isNull() | (F.col(id_col) < first_empty))


def listing_cards(
    pages: DataFrame, card_pattern, base_url: str, labels: Mapping[str, str], id_col: str = "page_id"
) -> DataFrame:
    """The listing job as a whole (D10): the cards of all pages before the first one without any."""
    first_empty = pages.filter(~_has_cards(card_pattern)).agg(F.min(id_col)).scalar()
    read = pages.filter(first_empty.isNull() | (F.col(id_col) < first_empty))
    return extract_cards(read, card_pattern, base_url, labels, id_col)
