"""String helpers: key normalisation, whitespace strip, HTML text nodes."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() whitespace (ASCII + NBSP + common Unicode spaces).
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


# A character reference behind its ampersand.
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

# Script/style bodies and comments carry no text (no backreferences, so the
# same pattern runs in any regex engine).
NON_TEXT = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c) -> Column:
    """One normalisation for both sides of a join on text keys."""
    return F.upper(F.trim(_c(c)))


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace of every kind (``F.trim`` strips spaces only)."""
    return F.regexp_replace(_c(c), rf"^{_WS}+|{_WS}+$", "")


def _named(name: Column) -> Column:
    """The character of a named reference, looked up among the names with the same first letter."""
    by_first: dict[int, list] = {}
    for n, c in sorted(name2codepoint.items()):
        by_first.setdefault(ord(n[0]), []).extend((F.lit(n), F.lit(chr(c))))
    none = F.create_map().cast("map<string,string>")
    maps = [F.create_map(*by_first[i]) if i in by_first else none for i in range(ord("A"), ord("z") + 1)]
    return F.try_element_at(F.get(F.array(*maps), F.ascii(name) - ord("A")), name)


def _once(value: Column, fn) -> Column:
    """``fn`` of ``value``, which is computed once however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _reference(name: Column) -> Column:
    """The character of a reference without ``&`` and ``;``: #8217, #x2019 or a name; NULL if there is none."""
    code = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2))).cast("int")

    def char(c: Column) -> Column:
        return F.when(c.between(1, 0xD7FF) | c.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"))

    return F.when(name.startswith("#"), _once(code, char)).otherwise(_named(name))


def unescape_html(c) -> Column:
    """Decodes numeric and named (HTML 4) character references, once: ``&amp;lt;`` becomes ``&lt;``."""

    def piece(x: Column) -> Column:
        return F.coalesce(F.concat(_reference(x["name"]), F.substr(x["p"], F.length(x["name"]) + 2)), F.concat(F.lit("&"), x["p"]))

    def decoded(pieces: Column) -> Column:
        behind = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
        named = F.transform(behind, lambda p: F.struct(p.alias("p"), F.regexp_extract(p, REFERENCE, 1).alias("name")))
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(named, piece), ""))

    return F.when(F.instr(_c(c), "&") > 0, _once(F.split(_c(c), "&"), decoded)).otherwise(_c(c))


def html_text_nodes(c) -> Column:
    """Array of stripped, non-empty text strings of an HTML fragment (H3).

    Script/style bodies and comments are not text, as in an HTML parser.
    """
    stripped = F.transform(_raw_nodes(c), lambda s: strip_ws(unescape_html(s)))
    return F.filter(stripped, lambda s: s != F.lit(""))


def _raw_nodes(c) -> Column:
    return F.split(F.regexp_replace(_c(c), NON_TEXT, "<>"), r"<[^>]*>")


def labelled_nodes(c, needles: Sequence[str]) -> Column:
    """The decoded text strings of a fragment that can hold one of ``needles``, in order, not stripped.

    A string without a reference is what it decodes to, so it can't if none of them is in it.
    """

    def can(s: Column) -> Column:
        out = s.contains("&")
        for needle in needles:
            out = out | s.contains(needle)
        return out

    return F.transform(F.filter(_raw_nodes(c), can), unescape_html)


def first_matching(arr, needle: str, default: str = "") -> Column:
    """First element containing ``needle`` or ``default``."""
    hits = F.filter(_c(arr), lambda s: s.contains(needle))
    return F.coalesce(F.try_element_at(hits, F.lit(1)), F.lit(default))
