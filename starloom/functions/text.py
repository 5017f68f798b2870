"""Text clean-up: fallbacks, HTML to text, keyword tags, list cells."""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .core import WHITESPACE, ColumnOrName, blank_to_null, col, let, lookup, strip, text_array

UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def first_non_blank(*columns: ColumnOrName) -> Column:
    """First value that is neither NULL nor blank text, unchanged."""
    return F.coalesce(*[F.when(strip(c) != "", col(c)) for c in columns])


def rewrite_delimiter(c: ColumnOrName, old: str = " | ", new: str = ", ") -> Column:
    return F.replace(F.trim(col(c)), F.lit(old), F.lit(new))


def is_free_text(c: ColumnOrName) -> Column:
    """Whether a price text means free: ``free``, ``0`` or blank. NULL is not free."""
    return F.coalesce(F.lower(strip(c)).isin(fixed.FREE_TEXTS), F.lit(False))


# --- HTML -------------------------------------------------------------------------

def _code_point(n: Column) -> Column:
    """Character for a code point, by the HTML rules for bad ones."""
    valid = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    windows = {
        str(i): bytes([i]).decode("cp1252", errors="ignore") or chr(i) for i in range(0x80, 0xA0)
    }
    dropped = (
        n.between(0x1, 0x8) | n.between(0xE, 0x1F) | n.between(0x7F, 0x9F) | (n == 0xB)
        | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (
        F.when(n.between(0x80, 0x9F), lookup(n.cast("string"), windows))
        .when(n == 0x0D, F.lit("\r"))
        .when(~valid, F.lit("�"))
        .when(dropped, F.lit(""))
        .otherwise(char)
    )


def _entity(piece: Column) -> Column:
    """One ``&...`` piece decoded; unknown ones are kept as they are."""
    name = F.substr(piece, F.lit(2))
    hexadecimal = F.regexp_extract(piece, "^&#[xX]([0-9a-fA-F]+)", 1)
    decimal = F.regexp_extract(piece, "^&#([0-9]+)", 1)
    # More than nine digits is beyond the last code point whatever they are.
    number = (
        F.when((hexadecimal != "") & (F.length(hexadecimal) <= 8), F.conv(hexadecimal, 16, 10).cast("long"))
        .when((decimal != "") & (F.length(decimal) <= 9), decimal.cast("long"))
        .otherwise(F.lit(0x110000))
    )
    # The references of everyday pages are found first.
    names = {n: html5[n] for n in ["amp;", "nbsp;", "lt;", "gt;", "quot;", "copy;"]} | html5
    # Names that may be written without the semicolon, longest first.
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    prefix = F.regexp_extract(name, "^(" + "|".join(bare) + ")", 1)
    return (
        F.when(F.startswith(piece, F.lit("&#")), _code_point(number))
        .otherwise(
            F.coalesce(
                lookup(name, names),
                F.when(
                    prefix != "",
                    F.concat(lookup(prefix, {n: html5[n] for n in bare}), F.substr(name, F.length(prefix) + 1)),
                ),
                piece,
            )
        )
    )


_PIECES = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|&|[^&]+"


def unescape_html(c: ColumnOrName) -> Column:
    """Character references decoded in one pass over the text."""
    text = col(c)
    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    decoded = F.transform(
        pieces,
        lambda p: F.when(F.startswith(p, F.lit("&")) & (F.length(p) > 1), _entity(p)).otherwise(p),
    )
    # Text without a single "&" skips the split altogether.
    return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)


def html_to_text(c: ColumnOrName) -> Column:
    """Tags to blanks, references decoded, whitespace collapsed; NULL gives ``''``."""
    bare = F.regexp_replace(F.coalesce(col(c), F.lit("")), "<[^>]+>", " ")
    return strip(F.regexp_replace(unescape_html(bare), f"{WHITESPACE}+", " "))


# Fixed value: what a page holds but does not show.
_UNSEEN = r"(?is)<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</\1\s*>"


def visible_text(c: ColumnOrName) -> Column:
    """:func:`html_to_text` without comments and the bodies of scripts and styles."""
    return html_to_text(F.regexp_replace(F.coalesce(col(c), F.lit("")), _UNSEEN, " "))


# --- keyword tags --------------------------------------------------------------------

WORD = r"[\p{L}\p{N}_]"


def _whole_word(word: str) -> str:
    return r"\b" + re.escape(word) + r"\b"


def _keyword_pattern(keywords: Sequence[str]) -> str:
    """Zero-width match at every keyword, the longest one at a position in group 1.

    Alternatives share their first letter, so most positions fail on one character.
    A boundary means a change between word and other characters on either side.
    """
    by_letter: dict[str, list[str]] = {}
    for k in sorted(keywords, key=lambda k: (-len(k), k)):
        ends_in_word = k[-1].isalnum() or k[-1] == "_"
        after = f"(?!{WORD})" if ends_in_word else f"(?={WORD})"
        by_letter.setdefault(k[0], []).append(re.escape(k[1:]) + after)
    branches = [f"{re.escape(first)}(?:{'|'.join(rest)})" for first, rest in by_letter.items()]
    return f"(?<!{WORD})(?=({'|'.join(branches)}))"


def keyword_tags(c: ColumnOrName, keywords: Sequence[str] = fixed.SKILLS) -> Column:
    """Keywords that occur as whole words, case ignored, in the order of the list.

    One pass over the text finds the longest keyword at every position; keywords that
    are whole words inside a longer one (``React`` in ``React Native``) are then added
    from a fixed table. Keywords start with a word character; a boundary follows the last
    one, so ``C++`` counts only before a word character.
    """
    lowered = {k.lower(): k for k in reversed(keywords)}
    anywhere = _keyword_pattern(list(lowered))
    implied = {
        k: [lowered[k]] + [lowered[o] for o in lowered if o != k and re.match(_whole_word(o), k)]
        for k in lowered
    }
    hits = F.array_distinct(F.regexp_extract_all(F.lower(col(c)), F.lit(anywhere), F.lit(1)))
    # Only keywords that hold others are in the table; the rest stand for themselves.
    wider = {k: "\n".join(o.lower() for o in names) for k, names in implied.items() if len(names) > 1}
    found = F.flatten(
        F.transform(hits, lambda h: F.coalesce(F.split(lookup(h, wider), "\n"), F.array(h)))
    )
    ordered = list(dict.fromkeys(k.lower() for k in keywords))
    kept = F.array_intersect(text_array(ordered), found)
    return F.transform(kept, lambda k: lookup(k, {o: lowered[o] for o in ordered}))


def skill_list(
    topics: ColumnOrName, description: ColumnOrName, headline: ColumnOrName
) -> Column:
    """Usable topic titles; where there is none, keywords of the description or headline."""
    titles = F.transform(F.coalesce(col(topics), F.array().cast("array<string>")), strip)
    short = F.filter(titles, lambda t: (t != "") & (F.length(t) <= fixed.SKILL_MAX_LENGTH))
    text = F.coalesce(blank_to_null(description), blank_to_null(headline))
    tags = F.coalesce(keyword_tags(text), F.array().cast("array<string>"))
    return F.when(F.size(short) > 0, short).otherwise(tags)


# --- list cells -----------------------------------------------------------------------

def is_opaque_id(c: Column) -> Column:
    """Whether a text is a taxonomy id or a UUID rather than a name."""
    text = F.lower(strip(c))
    return F.startswith(text, F.lit("taxonomy:")) | F.rlike(text, F.lit(UUID))


def distinct_ignoring_case(c: Column) -> Column:
    """First spelling of every text, in order of appearance."""
    def first_spellings(names: Column) -> Column:
        folded = F.transform(names, lambda x: F.lower(x))
        return let(folded, lambda f: F.filter(names, lambda x, i: F.array_position(f, F.lower(x)) == i + 1))

    return let(c, first_spellings)


def clean_names(c: ColumnOrName) -> Column:
    """An array of names: stripped, without blanks and opaque ids, without repeats."""
    names = F.transform(col(c), strip)
    kept = F.filter(names, lambda n: n.isNotNull() & (n != "") & ~is_opaque_id(n))
    return distinct_ignoring_case(kept)


def clean_people(c: ColumnOrName, ignored: Sequence[str] = ("instructor", "mentor")) -> Column:
    """An array of comma-separated name lists to single names, without role words."""
    given = F.filter(col(c), lambda n: n.isNotNull())
    parts = F.flatten(F.transform(given, lambda n: F.split(n, ",")))
    names = F.transform(parts, strip)
    kept = F.filter(names, lambda n: (n != "") & ~F.lower(n).isin(list(ignored)))
    return F.array_distinct(kept)


def slug_to_title(c: Column) -> Column:
    """``data-science`` to ``Data Science``; every run of letters is capitalized."""
    runs = F.regexp_extract_all(F.replace(c, F.lit("-"), F.lit(" ")), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")
