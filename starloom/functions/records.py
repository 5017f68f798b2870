"""Fields out of raw JSON and HTML records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .core import ColumnOrName, blank_to_null, col, let, lookup, strip, whole_number
from .text import first_non_blank, visible_text
from .times import iso_duration_words, parse_page_date


# --- JSON records -------------------------------------------------------------------

def json_text(c: ColumnOrName, path: str) -> Column:
    """Text at a JSON path; NULL when absent or JSON null."""
    return F.get_json_object(col(c), path)


def json_first(c: ColumnOrName, *paths: str) -> Column:
    """First non-blank text among several paths of one record."""
    return first_non_blank(*[json_text(c, p) for p in paths])


def locale_name(c: ColumnOrName) -> Column:
    """Locale object (or plain text) to a language name; ``''`` when there is none."""
    raw = col(c)
    is_object = F.startswith(F.ltrim(raw), F.lit("{"))
    named = [blank_to_null(json_text(raw, f"$.{k}")) for k in ("simpleEnglishTitle", "title", "locale")]
    return F.coalesce(F.when(is_object, F.coalesce(*named)).otherwise(raw), F.lit(""))


# The tokens of a JSON text (a key carries its colon), a number or truth value, and what names an object in a
# list of skills or of people.
_TOKENS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*+:)?|[\[\]{},]|[^\s"\[\]{},:]++'
_SCALAR = r"^(-?[0-9][0-9eE.+-]*|true|false)"
SKILL_NAMES = ["name", "title", "displayName", "label", "skillName", "text"]
PERSON_NAMES = ["name", "title", "fullName", "displayName", "description", "summary", "text"]


def json_tokens(c: ColumnOrName) -> Column:
    """The tokens of a JSON text in order: one pass over the text, from which any number of keys can be read."""
    return F.regexp_extract_all(col(c), F.lit(_TOKENS), F.lit(0))


def _is_key(token: Column, words: Sequence[str]) -> Column:
    """Whether a token is a key that contains one of the words, whatever the case."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(F.lower(token), F.lit(word.lower()))
    return F.endswith(token, F.lit(":")) & found


def _present(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())


def _text_of(token: Column) -> Column:
    """The text that a token in quotes stands for."""
    plain = F.substr(token, F.lit(2), F.length(token) - 2)
    return F.when(F.contains(token, F.lit("\\")), json_text(F.concat(F.lit('{"v":'), token, F.lit("}")), "$.v")).otherwise(plain)


def _scalars(tokens: Column, words: Sequence[str]) -> Column:
    """(at, kind, value) of the keys found whose value is no object or array; the value is the token behind the key."""
    def read(key: Column, at: Column) -> Column:
        token = F.try_element_at(tokens, at + 2)
        kind = F.substr(token, F.lit(1), F.lit(1))
        value = F.when(kind == '"', _text_of(token)).otherwise(blank_to_null(F.regexp_extract(token, _SCALAR, 1)))
        return F.when(_is_key(key, words) & ~kind.isin("{", "["), F.struct(at.alias("at"), kind.alias("kind"), value.alias("value")))

    return _present(F.transform(tokens, read))


def _containers(tokens: Column, words: Sequence[str]) -> Column:
    """(at, kind, value) of the keys found whose value is an object or array; the value is its JSON text.

    The depth of a bracket follows from its place: the i-th bracket that is the k-th to open has k open and i - k closed before
    it. At one depth opening and closing brackets take turns, so in order of depth and place the one after an opening bracket
    closes it. Nothing is carried from bracket to bracket: the work grows with the tokens and the values returned.
    """
    def bracket(token: Column, at: Column) -> Column:
        opens = token.isin("{", "[")
        found = opens & (at > 0) & F.coalesce(_is_key(F.get(tokens, F.greatest(at - 1, F.lit(0))), words), F.lit(False))
        return F.when(opens | token.isin("}", "]"), F.struct(at.alias("at"), opens.alias("opens"), found.alias("found")))

    def placed(brackets: Column, opening: bool) -> Column:
        numbered = F.transform(brackets, lambda b, i: F.struct(i.alias("i"), b.alias("b")))
        side = F.filter(numbered, lambda x: x["b"]["opens"] if opening else ~x["b"]["opens"])
        return F.transform(side, lambda x, k: F.struct(
            (2 * k + 1 - x["i"] if opening else x["i"] - 2 * k).alias("depth"), x["b"]["at"].alias("at"), x["b"]["opens"].alias("opens"),
            x["b"]["found"].alias("found")))

    def spans(ordered: Column) -> Column:
        def span(b: Column, i: Column) -> Column:
            after = F.get(ordered, i + 1)
            closed = b["found"] & (after["depth"] == b["depth"]) & ~after["opens"]
            return F.when(closed, F.struct(b["at"].alias("start"), after["at"].alias("stop")))

        return _present(F.transform(ordered, span))

    def read(span: Column) -> Column:
        # one by one, as a slice of an array walks over all that lies before it
        parts = F.transform(F.sequence(span["start"], span["stop"]), lambda i: F.get(tokens, i))
        return F.struct((span["start"] - 1).alias("at"), F.get(tokens, span["start"]).alias("kind"), F.array_join(parts, "").alias("value"))

    brackets = _present(F.transform(tokens, bracket))
    ordered = let(brackets, lambda b: F.sort_array(F.concat(placed(b, True), placed(b, False))))
    return F.transform(let(ordered, spans), read)


def json_values(c: ColumnOrName, words: Sequence[str]) -> Column:
    """Values of all keys that contain one of the words, at any depth and in document order.

    An array of (at, kind, value): the place of the key among the tokens, the value's first character, and the unescaped text of a
    string, the JSON text of an object or array, the digits of a number, NULL for null. Keys are compared without case; what only
    looks like a key inside a text is not one. An object or array that is never closed is left out.
    """
    return let(json_tokens(c), lambda tokens: values_in(tokens, words))


def values_in(tokens: ColumnOrName, words: Sequence[str]) -> Column:
    """`json_values` over the tokens of a record."""
    tokens = col(tokens)
    return F.sort_array(F.concat(_scalars(tokens, words), _containers(tokens, words)))


def json_find(c: ColumnOrName, words: Sequence[str]) -> Column:
    """First non-blank text, number or truth value, in document order, whose key contains one of the words."""
    return let(json_tokens(c), lambda tokens: find_in(tokens, words))


def find_in(tokens: ColumnOrName, words: Sequence[str]) -> Column:
    """`json_find` over the tokens of a record."""
    kept = F.filter(_scalars(col(tokens), words), lambda v: v["value"].isNotNull() & (strip(v["value"]) != ""))
    return F.try_element_at(kept, F.lit(1))["value"]


def _names(kind: Column, value: Column, names: Sequence[str]) -> Column:
    """A text, the name of an object, or the texts and names of the objects in an array (arrays inside it are passed over)."""
    def one(item: Column) -> Column:
        text = F.get_json_object(F.concat(F.lit('{"v":'), item, F.lit("}")), "$.v")
        return F.when(F.startswith(item, F.lit("{")), json_first(item, *[f"$.{n}" for n in names])).when(
            F.startswith(item, F.lit('"')), text)

    items = F.transform(F.from_json(F.when(kind == "[", value), "array<variant>"), lambda v: F.to_json(v))
    single = F.when(kind == "{", json_first(value, *[f"$.{n}" for n in names])).when(kind == '"', value)
    return F.filter(F.when(kind == "[", F.transform(items, one)).otherwise(F.array(single)), lambda n: n.isNotNull())


def json_collect(c: ColumnOrName, words: Sequence[str], names: Sequence[str] = SKILL_NAMES) -> Column:
    """Every text of a key containing one of the words: its own, or those in its array; objects give their name."""
    return let(json_tokens(c), lambda tokens: collect_in(tokens, words, names))


def collect_in(tokens: ColumnOrName, words: Sequence[str], names: Sequence[str] = SKILL_NAMES) -> Column:
    """`json_collect` over the tokens of a record."""
    return F.flatten(F.transform(values_in(tokens, words), lambda v: _names(v["kind"], v["value"], names)))


def json_names(c: ColumnOrName, path: str, names: Sequence[str], lists_only: bool = True) -> Column:
    """Texts and names of the array at a path; with ``lists_only`` off of a text or object there as well."""
    def named(value: Column) -> Column:
        kind = F.substr(value, F.lit(1), F.lit(1))
        kind = F.when(kind.isin("[", "{"), kind).otherwise(F.lit('"'))
        return F.when((kind == "[") | F.lit(not lists_only), _names(kind, value, names))

    return F.coalesce(let(json_text(c, path), named), F.array().cast("array<string>"))


def json_plain_texts(c: ColumnOrName, path: str) -> Column:
    """The texts of the array at a path as they are; other items are left out."""
    items = F.transform(F.from_json(json_text(c, path), "array<variant>"), lambda v: F.to_json(v))
    texts = F.filter(items, lambda i: F.startswith(i, F.lit('"')))
    return F.coalesce(F.transform(texts, lambda i: F.get_json_object(F.concat(F.lit('{"v":'), i, F.lit("}")), "$.v")),
                      F.array().cast("array<string>"))


# --- pages -----------------------------------------------------------------------------

# The usable types and the script block of JSON-LD.
LD_TYPES = ["Course", "Product", "WebPage"]
_LD_BLOCK = r"(?is)<script[^>]*type\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>(.*?)</script>"


def json_ld(html: ColumnOrName) -> Column:
    """The first usable JSON-LD object of a page, as JSON text.

    A block that is an array gives its first Course or Product; a block of another type
    is skipped.
    """
    blocks = F.regexp_extract_all(col(html), F.lit(_LD_BLOCK), F.lit(1))

    def candidate(block: Column) -> Column:
        text = strip(block)
        elements = F.from_json(F.when(F.startswith(text, F.lit("[")), text), "array<variant>")
        objects = F.transform(elements, lambda v: F.to_json(v))
        member = F.try_element_at(
            F.filter(objects, lambda o: json_text(o, "$['@type']").isin("Course", "Product")), F.lit(1)
        )
        valid = F.when(F.try_parse_json(text).isNotNull(), text)
        return F.when(F.startswith(text, F.lit("[")), member).otherwise(valid)

    found = F.transform(blocks, candidate)
    typed = F.filter(found, lambda o: o.isNotNull() & json_text(o, "$['@type']").isin(LD_TYPES))
    return F.try_element_at(typed, F.lit(1))


def offer_price(offer: ColumnOrName) -> Column:
    """Price text of an offer: its number with currency, else its category, else ``Free``."""
    raw = json_text(offer, "$.price")
    number = raw.try_cast("double")
    currency = F.coalesce(json_text(offer, "$.priceCurrency"), F.lit("USD"))
    digits = F.format_string("%.2f", number)
    priced = (
        F.when(number == 0, "Free")
        .when(number.isNotNull(), F.when(currency == "USD", F.concat(F.lit("$"), digits))
              .otherwise(F.concat(digits, F.lit(" "), currency)))
        .otherwise(raw)
    )
    category = strip(json_text(offer, "$.category"))
    folded = F.lower(category)
    by_category = (
        F.when(folded == "free", "Free")
        .when(F.contains(folded, F.lit("partially")) | F.contains(folded, F.lit("freemium")), fixed.DEFAULT_PRICE)
        .when(folded.isin("paid", "premium"), fixed.PAID_PRICE)
        .when(folded != "", category)
        .otherwise("Free")
    )
    return F.when(~F.coalesce(strip(raw).isin("", "0"), F.lit(True)), priced).otherwise(by_category)


# What is read from a JSON-LD object. Offers may be an object or an array.
LD_SCHEMA = (
    "description string, aggregateRating struct<ratingValue: string, ratingCount: string, reviewCount: string>, "
    "offers string, dateModified string, datePublished string, timeRequired string, educationalLevel string"
)


def parse_json_ld(ld: ColumnOrName) -> Column:
    """A JSON-LD object parsed once, for :func:`page_json_ld_fields`."""
    return F.from_json(col(ld), LD_SCHEMA)


def page_json_ld_fields(ld: str) -> dict[str, Column]:
    """Rating, price, date, duration and level out of a parsed JSON-LD column."""
    rating = F.col(f"{ld}.aggregateRating.ratingValue").try_cast("double")
    counts = [whole_number(f"{ld}.aggregateRating.{k}", "long") for k in ("ratingCount", "reviewCount")]
    offers = F.col(f"{ld}.offers")
    first_offer = F.when(
        F.startswith(offers, F.lit("[")), json_text(offers, "$[0]")
    ).otherwise(F.when(F.startswith(offers, F.lit("{")), offers))
    changed = first_non_blank(f"{ld}.dateModified", f"{ld}.datePublished")
    return {
        "description": blank_to_null(f"{ld}.description"),
        "avg_rating": F.nullif(rating, F.lit(0.0)),
        "rating_count": F.coalesce(*[F.nullif(n, F.lit(0)) for n in counts]),
        "price": F.when(first_offer.isNotNull(), offer_price(first_offer)),
        "last_update": parse_page_date(changed),
        "duration": iso_duration_words(blank_to_null(f"{ld}.timeRequired")),
        "level": blank_to_null(f"{ld}.educationalLevel"),
    }


def embedded_text(html: ColumnOrName, key: str) -> Column:
    """Text of ``"key": "..."`` anywhere in the page source, escapes decoded."""
    raw = blank_to_null(F.regexp_extract(col(html), rf'"{key}":\s*"([^"]+)"', 1))
    return F.coalesce(F.get_json_object(F.concat(F.lit('{"v":"'), raw, F.lit('"}')), "$.v"), raw)


def embedded_state_fields(html: ColumnOrName) -> dict[str, Column]:
    """Rating count, duration and last update out of the state embedded in a page."""
    c = col(html)
    total = blank_to_null(F.regexp_extract(c, r'"totalDuration":\s*"(PT[^"]+)"', 1))
    return {
        "rating_count": blank_to_null(F.regexp_extract(c, r'"ratingCount":\s*([0-9]+)', 1)).try_cast("long"),
        "duration": F.coalesce(embedded_text(c, "estimatedWorkload"), iso_duration_words(total)),
        "last_update": F.coalesce(
            *[
                parse_page_date(blank_to_null(F.regexp_extract(c, rf'"{key}":\s*"([^"]+)"', 1)))
                for key in ("contentLastRefreshed", "updatedAt", "launchedAt")
            ]
        ),
    }


# Patterns for an audience size, tried in this order.
AUDIENCE_PATTERNS = [
    r"(?i)([0-9,]+)\s+(?:already\s+)?enroll",
    r"(?i)([0-9,]+)\s+student",
    r"(?i)([0-9,]+)\s+learner",
]


def enrolment_count(html: ColumnOrName) -> Column:
    """``1,234 already enrolled`` (or students, learners) in the visible text, as a number."""
    def first_count(text: Column) -> Column:
        return F.coalesce(*[
            F.replace(F.regexp_extract(text, p, 1), F.lit(","), F.lit("")).try_cast("long")
            for p in AUDIENCE_PATTERNS
        ])

    return let(visible_text(html), first_count)


# --- vocabularies of pages ------------------------------------------------------------

def page_level(c: ColumnOrName) -> Column:
    """Level by the first known word the text contains, else ``Unknown``."""
    text = F.lower(strip(c))
    named = [F.when(F.contains(text, F.lit(word)), F.lit(name)) for word, name in fixed.PAGE_LEVELS.items()]
    return F.coalesce(*named, F.lit("Unknown"))


def course_type(c: ColumnOrName) -> Column:
    return F.coalesce(lookup(F.lower(strip(c)), fixed.COURSE_TYPES), F.lit("Course"))


def page_language(c: ColumnOrName) -> Column:
    """Two-letter code to a name; other codes are capitalized, missing ones ``''``."""
    code = F.coalesce(col(c), F.lit(""))
    other = F.concat(F.upper(F.substr(code, F.lit(1), F.lit(1))), F.lower(F.substr(code, F.lit(2))))
    return F.coalesce(lookup(code, fixed.PAGE_LANGUAGES), other)


def page_price(c: ColumnOrName) -> Column:
    """Price text, with the most common price model where it is missing."""
    return F.coalesce(blank_to_null(c), F.lit(fixed.DEFAULT_PRICE))


def as_columns(fields: Mapping[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in fields.items()]
