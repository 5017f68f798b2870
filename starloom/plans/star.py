"""Dimensions with surrogate keys and the offerings fact."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.keys import date_key
from ..functions.times import date_parts
from ..operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, hot_keys, lookup_join
from ..operators.numbering import number_rows
from ..operators.staging_area import stage
from .rules import DEFAULT, Rules

# --- fixed values: names of the unknown members ----------------------------------------
UNKNOWN_NAMES = {
    "platform": "Unknown", "domain": "Unknown", "level": "Unknown", "language": "Unknown Language",
    "instructor": "Unknown Instructor", "offering_type": "Unknown",
}
# Source column, key and name column of every plain dimension.
DIMENSIONS = {
    "platform": ("platform", "platform_id", "platform_name"),
    "domain": ("domain_name", "domain_id", "domain_name"),
    "level": ("level", "level_id", "level_name"),
    "language": ("language", "language_id", "language_name"),
    "instructor": ("instructor", "instructor_id", "instructor_name"),
    "offering_type": ("offering_type", "offering_type_id", "offering_type"),
}
# Dimensions that hold their unknown member even without the -1 rule.
_NAMED_UNKNOWN = ("instructor", "offering_type")
FACT_METRICS = [
    "price", "rating", "review_count", "enrolled_students", "duration_hours", "popularity_score",
    "engagement_rate_pct", "weighted_rating", "cost_per_hour", "estimated_total_cost", "value_score",
]


def add_member(df: DataFrame, **values) -> DataFrame:
    """Union one static row; columns not named are NULL."""
    row = df.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row)


def keyed_dimension(df: DataFrame, column: str, key: str, name: str, unknown: str | None = None) -> DataFrame:
    """Distinct known values numbered 1..n by name, and the unknown member as -1.

    Without ``unknown`` NULL is a value like any other, numbered last.
    """
    values = df.select(F.col(column).alias(name))
    if unknown is not None:
        values = values.filter(F.col(name).isNotNull() & (F.col(name) != unknown))
    dim = number_rows(values.distinct(), [name], key).select(key, name)
    return add_member(dim, **{key: fixed.UNKNOWN_KEY, name: unknown}) if unknown is not None else dim


def keyed_dimension_with_gap(df: DataFrame, column: str, key: str, name: str, unknown: str) -> DataFrame:
    """As :func:`keyed_dimension`, but the unknown member keeps its place in the numbering.

    It is numbered with the others and then renamed to -1, which leaves a gap; it is there
    only if the data hold it (as NULL or by name).
    """
    values = df.select(F.coalesce(F.col(column), F.lit(unknown)).alias(name)).distinct()
    return _with_gap(number_rows(values, [name], key), key, name, unknown)


def _with_gap(dim: DataFrame, key: str, name: str, unknown: str) -> DataFrame:
    unknown_key = F.lit(fixed.UNKNOWN_KEY).cast("long")
    return dim.select(F.when(F.col(name) == unknown, unknown_key).otherwise(F.col(key)).alias(key), name)


def build_dimensions(df: DataFrame, rules: Rules = DEFAULT) -> tuple[dict[str, DataFrame], dict[str, tuple[int, int]]]:
    """The six plain dimensions out of one pass, and the (rows, bytes of names) of each.

    All (dimension, value) pairs are made distinct, numbered and written together; a dimension is a slice of that table.
    """
    items = []
    for which, (column, _, _) in DIMENSIONS.items():
        value, unknown = F.col(column).cast("string"), UNKNOWN_NAMES[which]
        if rules.unknown_member:
            value = F.when(value != unknown, value)
        elif which in _NAMED_UNKNOWN:
            value = F.coalesce(value, F.lit(unknown))
        items.append(F.struct(F.lit(which).alias("which"), value.alias("name")))
    pairs = df.select(F.inline(F.array(*items))).distinct()
    if rules.unknown_member:
        pairs = pairs.filter("name is not null")
    numbered = stage(number_rows(pairs, ["which", "name"], "place"), "dims")
    sizes = numbered.groupBy("which").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"),
                                          F.sum(F.octet_length("name")).alias("bytes")).collect()  # six rows at most
    found = {r["which"]: r for r in sizes}
    dims, counts = {}, {}
    for which, (_, key, name) in DIMENSIONS.items():
        first, unknown = (found[which]["first"] if which in found else 1), UNKNOWN_NAMES[which]
        dim = numbered.filter(F.col("which") == which).select((F.col("place") - first + 1).alias(key), F.col("name").alias(name))
        if rules.unknown_member:
            dim = add_member(dim, **{key: fixed.UNKNOWN_KEY, name: unknown})
        elif which in _NAMED_UNKNOWN:
            dim = _with_gap(dim, key, name, unknown)
        dims[which] = dim
        counts[which] = (found[which]["n"] + 1, found[which]["bytes"] or 0) if which in found else (1, 0)
    return dims, counts


def build_dimension(df: DataFrame, which: str, rules: Rules = DEFAULT) -> DataFrame:
    """One of the six plain dimensions from standardized courses."""
    column, key, name = DIMENSIONS[which]
    if rules.unknown_member:
        return keyed_dimension(df, column, key, name, UNKNOWN_NAMES[which])
    if which in _NAMED_UNKNOWN:
        return keyed_dimension_with_gap(df, column, key, name, UNKNOWN_NAMES[which])
    return keyed_dimension(df, column, key, name)


def date_dimension(df: DataFrame, column: str = "last_updated") -> DataFrame:
    """Observed dates with their parts, keyed ``yyyymmdd``, and the unknown date -1."""
    dates = df.select(F.col(column).cast("date").alias("full_date")).filter("full_date is not null").distinct()
    dim = dates.select(date_key("full_date").alias("date_id"), "full_date", *date_parts("full_date"))
    return add_member(dim, date_id=fixed.UNKNOWN_KEY)


def offering_dimension(history: DataFrame, key: tuple[str, ...] = ("course_id", "platform")) -> DataFrame:
    """Every version of every offering, numbered by id and start of validity."""
    rows = history.select(
        F.col(key[0]).alias("offering_id"), *key[1:], "title", "description", "skills", "course_url",
        F.col("valid_from").alias("effective_from"), F.col("valid_to").alias("effective_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )
    numbered = number_rows(rows, ["offering_id", "effective_from", *key[1:]], "offering_sk")
    return numbered.select("offering_sk", *rows.columns)


def build_fact(
    df: DataFrame, dimensions: dict[str, DataFrame], dates: DataFrame | None = None,
    offerings: DataFrame | None = None, rules: Rules = DEFAULT, key: tuple[str, ...] = ("course_id", "platform"),
    sizes: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """One row per standardized course with a foreign key per given dimension and its metrics.

    ``sizes`` gives (rows, bytes) of the dimensions by name, ``date`` and ``offering`` included; without it they are counted. They
    decide between broadcast and salted joins. Hot keys of large dimensions are found on ``df``, before any
    join. Only the columns the fact needs are carried.
    """
    sizes = sizes or {}

    def size(which: str, table: DataFrame, names: list[str]) -> tuple[int, int]:
        if which in sizes:
            return sizes[which]
        row = table.agg(F.count(F.lit(1)), F.sum(sum((F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0)) for n in names), F.lit(0)))).first()
        return row[0], row[1] or 0

    def joined(fact: DataFrame, right: DataFrame, keys: dict[str, Column], rows: int, width: int) -> DataFrame:
        """``fact`` with the keys as columns, joined; ``keys`` maps join columns to values of a course."""
        hot = None
        if rows > BROADCAST_ROWS or width > BROADCAST_BYTES:
            hot = hot_keys(df.select(*[c.alias(n) for n, c in keys.items()]).dropna(), list(keys))
        return lookup_join(fact.withColumns(keys), right, list(keys), rows, width, hot)

    sources = [DIMENSIONS[w][0] for w in dimensions]
    sources += ["last_updated"] if dates is not None else []
    sources += list(key) if offerings is not None else []
    bands = ["price_category", "duration_category"]
    fact = df.select(*dict.fromkeys([*sources, *bands, *FACT_METRICS]))
    unknown = F.lit(fixed.UNKNOWN_KEY)
    keys = []
    if offerings is not None:
        current = offerings.filter("is_current").select(
            F.col("offering_id").alias(key[0]), *key[1:], F.col("offering_sk").alias("__offering")
        )
        fact = joined(fact, current, {k: F.col(k) for k in key}, *size("offering", current, list(key)))
        found = F.col("__offering")
        keys.append((F.coalesce(found, unknown.cast("long")) if rules.unknown_key else found).alias("offering_sk"))
    for which, dim in dimensions.items():
        column, key_column, name = DIMENSIONS[which]
        named_unknown = which in _NAMED_UNKNOWN
        source = F.col(column)
        if named_unknown:
            # The unknown member is always -1: its rows need no partner to be found.
            source = F.when(F.coalesce(source, F.lit(UNKNOWN_NAMES[which])) != UNKNOWN_NAMES[which], source)
        lookup = dim.select(F.col(name).alias("__name"), F.col(key_column).alias(f"__{which}"))
        fact = joined(fact, lookup, {"__name": source}, *size(which, lookup, ["__name"])).drop("__name")
        found = F.col(f"__{which}")
        always = rules.unknown_key or named_unknown
        keys.append((F.coalesce(found, unknown.cast("long")) if always else found).alias(key_column))
    if dates is not None:
        day = dates.select(F.col("date_id").alias("__date"), F.lit(True).alias("__dated"))
        fact = joined(fact, day, {"__date": date_key("last_updated")}, *size("date", day, []))
        dated = F.when(F.col("__dated"), F.col("__date"))
        keys.append(F.coalesce(dated, unknown).alias("date_id"))
    return fact.select(*keys, *FACT_METRICS, *bands)


def build_star(
    courses: DataFrame, history: DataFrame, rules: Rules = DEFAULT, key: tuple[str, ...] = ("course_id", "platform"),
) -> dict[str, DataFrame]:
    """All dimensions (written) and the fact over standardized courses and their history.

    ``courses`` is read once for the plain dimensions, once for the dates and once for the fact: pass a written table.
    """
    # The three jobs do not depend on each other: they share the cluster.
    jobs = {
        "dims": partial(build_dimensions, courses, rules), "date": lambda: stage(date_dimension(courses), "dim-date"),
        "offering": lambda: stage(offering_dimension(history, key), "dim-offering"),
    }
    with ThreadPoolExecutor(len(jobs)) as pool:
        built = dict(zip(jobs, pool.map(lambda w: jobs[w](), jobs)))
    dims, sizes = built["dims"]
    dates, offerings = built["date"], built["offering"]
    tables = {f"dim_{w}": d for w, d in dims.items()}
    tables |= {"dim_date": dates, "dim_offering": offerings}
    tables["fact_offerings"] = build_fact(courses, dims, dates, offerings, rules, key, sizes)
    return tables
