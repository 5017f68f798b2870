"""Projection and reshaping of whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from .aggregate import join_groups
from .numbering import number_rows


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


# --- projection -----------------------------------------------------------------------

def star(
    df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "",
    rename: Mapping[str, str] | None = None, alias: str | None = None,
) -> list[Column]:
    """All columns but the excluded ones (case ignored), renamed or with prefix and suffix.

    ``alias`` qualifies the columns with a DataFrame alias, for use after a join.
    """
    rename = rename or {}
    dropped = {e.lower() for e in exclude}
    out = []
    for name in df.columns:
        if name.lower() in dropped:
            continue
        c = F.col(f"{alias}.`{name}`") if alias else _quoted(name)
        out.append(c.alias(rename.get(name, f"{prefix}{name}{suffix}")))
    return out


def align_schema(
    df: DataFrame, rename: Mapping[str, str] | None = None, defaults: Mapping[str, object] | None = None,
    drop_prefix: str | None = "Unnamed",
) -> DataFrame:
    """Drop index-like columns, add missing ones with a default, then rename.

    Where a rename meets an added default of the same name, the renamed data wins.
    """
    rename, defaults = dict(rename or {}), dict(defaults or {})
    names = [c for c in df.columns if not (drop_prefix and c.startswith(drop_prefix))]
    targets = {rename.get(c, c) for c in names}
    columns = [_quoted(c).alias(rename.get(c, c)) for c in names]
    columns += [
        (v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in defaults.items() if n not in targets
    ]
    return df.select(*columns)


def nullcheck(df: DataFrame) -> DataFrame:
    """``''`` becomes NULL in every string column."""
    return df.select(*[
        F.nullif(_quoted(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else _quoted(f.name)
        for f in df.schema.fields
    ])


# --- pivot and unpivot ------------------------------------------------------------------

def slugify(text: str) -> str:
    """A name as an identifier: lower case, blanks and dashes to ``_``, nothing else kept."""
    words = re.sub("[ -]+", "_", text.lower())
    slug = "".join(ch for ch in words if ch == "_" or ch.isascii() and ch.isalnum())
    return f"_{slug}" if slug[:1].isdigit() else slug


COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b, "!=": lambda a, b: a != b, "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
}


def pivot(
    column: str, values: Sequence, alias: bool = True, agg: str = "sum", cmp: str = "=", prefix: str = "",
    suffix: str = "", then_value=1, else_value=0, quote_identifiers: bool = True, distinct: bool = False,
) -> list[Column]:
    """One aggregate per value, for ``groupBy(...).agg(*pivot(...))``.

    ``then_value`` and ``else_value`` may be columns. All aggregates run in one pass.
    """
    compare = COMPARISONS[cmp]
    out = []
    for value in values:
        cell = F.when(compare(F.col(column), F.lit(value)), then_value).otherwise(else_value)
        if distinct:
            result = {"sum": F.sum_distinct, "count": F.count_distinct}[agg](cell)
        else:
            result = getattr(F, agg)(cell)
        name = f"{prefix}{value}{suffix}"
        out.append(result.alias(name if quote_identifiers else slugify(name)) if alias else result)
    return out


def pivot_map(
    df: DataFrame, group_by: Sequence[str], column: str, values: DataFrame | None = None, agg: str = "sum", then_value=1, name: str = "cells",
) -> DataFrame:
    """Pivot by a table of values: one row per group with a map from value to aggregate, in the order of the values.

    ``values`` has a column ``value`` (e.g. :func:`column_values`) and may be of any size: it is numbered and joined, nothing goes
    through a list on the driver. Without it all values of the column are taken, in ascending order. A map holds the values that
    occur in its group; one that is not in it has the aggregate of no rows (0 for a sum or a count). Groups with none of the values have
    an empty map; repeated and NULL values count once and not at all.
    """
    keys = [_quoted(g) for g in group_by]
    cell = then_value if isinstance(then_value, Column) else F.lit(then_value)
    rows = df.select(*keys, _quoted(column).alias("__value"), cell.alias("__cell"))
    counted = rows.filter(F.col("__value").isNotNull()).groupBy(*keys, "__value").agg(getattr(F, agg)("__cell").alias("__cell"))
    if values is None:
        placed = counted.withColumn("__place", F.lit(0).cast("long"))  # in ascending order by the value itself
    else:
        wanted = values.select(F.col("value").alias("__value")).withColumn("__row", F.monotonically_increasing_id())
        wanted = number_rows(wanted.filter(F.col("__value").isNotNull()), ["__row"], "__place").groupBy("__value").agg(F.min("__place").alias("__place"))
        placed = counted.join(wanted, "__value")
    entries = F.sort_array(F.collect_list(F.struct("__place", "__value", "__cell")))
    cells = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["__value"], e["__cell"])))
    empty = rows.select(*keys).distinct()
    maps = placed.groupBy(*keys).agg(cells.alias(name))
    nothing = F.map_from_arrays(F.array().cast(T.ArrayType(counted.schema["__value"].dataType)),
                                F.array().cast(T.ArrayType(counted.schema["__cell"].dataType)))
    return join_groups(empty, maps, list(group_by), "left").withColumn(name, F.coalesce(name, nothing))


def unpivot(
    df: DataFrame, cast_to: str = "string", exclude: Sequence[str] = (), remove: Sequence[str] = (),
    field_name: str = "field_name", value_name: str = "value",
) -> DataFrame:
    """Columns to rows: ``exclude`` columns are kept on every row, ``remove`` ones dropped.

    NULL values are kept; all values are cast to one type.
    """
    kept = {c.lower() for c in exclude}
    skipped = kept | {c.lower() for c in remove}
    melted = [c for c in df.columns if c.lower() not in skipped]
    ids = [c for c in exclude]
    typed = df.select(*[_quoted(c) for c in ids], *[_quoted(c).cast(cast_to).alias(c) for c in melted])
    return typed.unpivot([_quoted(c) for c in ids], [_quoted(c) for c in melted], field_name, value_name)


# --- union ----------------------------------------------------------------------------

def union_relations(
    relations: Mapping[str, DataFrame], column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (), exclude: Sequence[str] = (),
    source_column: str | None = fixed.SOURCE_COLUMN, where: str | None = None,
) -> DataFrame:
    """UNION ALL over the superset of columns, missing ones NULL, with a provenance column.

    A column takes the type of the first relation that has it, unless overridden.
    ``where`` filters every relation before the union.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    override = dict(column_override or {})
    wanted = {c.lower() for c in include}
    unwanted = {c.lower() for c in exclude}
    types: dict[str, T.DataType | str] = {}
    for df in relations.values():
        for f in df.schema.fields:
            low = f.name.lower()
            if (wanted and low not in wanted) or low in unwanted:
                continue
            types.setdefault(f.name, override.get(f.name, f.dataType))
    if not types:
        raise ValueError(f"no columns to union for {', '.join(relations)}")

    def aligned(name: str, df: DataFrame) -> DataFrame:
        rows = df.filter(where) if where else df
        present = set(df.columns)
        columns = [F.lit(name).alias(source_column)] if source_column else []
        columns += [
            (_quoted(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in types.items()
        ]
        return rows.select(*columns)

    return reduce(DataFrame.unionAll, [aligned(n, df) for n, df in relations.items()])


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- values and single results ------------------------------------------------------------

MOST_LISTED = 100_000  # rows that come to the driver without a bound by the caller


def column_values(
    df: DataFrame, column: str, order_by: Sequence[Column] | None = None, max_records: int | None = None,
    where: str | None = None, aggregates: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Distinct values of a column as ``value``, most frequent first, ties by value.

    ``order_by`` may use ``value``, ``__n`` (its rows) and the names of ``aggregates``, which are taken per value over any column.
    """
    rows = df.filter(where) if where else df
    extra = [a.alias(name) for name, a in (aggregates or {}).items()]
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("__n"), *extra)
    ordered = counted.orderBy(*(order_by or [F.col("__n").desc(), F.col("value").asc_nulls_last()]))
    return (ordered.limit(max_records) if max_records is not None else ordered).select("value")


def column_value_list(df: DataFrame | None, column: str, default: list | None = None, **options) -> list:
    """:func:`column_values` as a Python list, e.g. for :func:`pivot`.

    The list comes to the driver: bound it by ``max_records``, or use :func:`column_values` and :func:`pivot_map` where there may
    be many. Without it, more than MOST_LISTED values are refused. With no table, or no rows, the default is returned.
    """
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    return [r[0] for r in _listed(column_values(df, column, **options), options.get("max_records"))] or (default if default is not None else [])


def _listed(df: DataFrame, max_records: int | None) -> list:
    """Rows on the driver; without a bound no more than MOST_LISTED, of which one more is asked for to know."""
    rows = df.collect() if max_records is not None else df.limit(MOST_LISTED + 1).collect()
    if max_records is None and len(rows) > MOST_LISTED:
        raise ValueError(f"more than {MOST_LISTED} rows for the driver: give max_records")
    return rows


def single_value(df: DataFrame, default=None):
    """First column of the first row, or the default when there is no row."""
    rows = df.take(1)
    return rows[0][0] if rows else default


def results_as_dict(df: DataFrame, max_records: int | None = None) -> dict[str, tuple]:
    """A result as ``{column: values}`` on the driver: at most the first ``max_records`` rows, or MOST_LISTED, beyond which it refuses."""
    rows = _listed(df if max_records is None else df.limit(max_records), max_records)
    return {c: tuple(r[i] for r in rows) for i, c in enumerate(df.columns)}


# --- one row per key ----------------------------------------------------------------------

def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key in the given order; rows holding NULLs are kept.

    Spark keeps one candidate per key and map task before the shuffle, so a hot key moves
    as many rows as there are tasks. Give a unique order for reproducible rows.
    """
    w = Window.partitionBy(*[_quoted(c) for c in partition_by]).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def gathered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows dealt out by a hash of the keys, in pieces of Spark's advisory size; a piece that a hot key makes larger is split.

    Put before :func:`deduplicate` where many narrow rows share few keys: a piece is sorted in memory however large the files'
    splits are, and keeps one candidate per key.
    """
    slot = F.xxhash64(*[_quoted(k) for k in keys])
    return df.withColumn("__slot", slot).hint("rebalance", "__slot").drop("__slot")


def keep_first(df: DataFrame, keys: Sequence[str], ingest_order: Column) -> DataFrame:
    """First row per key in ingestion order."""
    return deduplicate(df, keys, [ingest_order.asc()])


def keep_last(df: DataFrame, keys: Sequence[str], ingest_order: Column) -> DataFrame:
    """Last row per key in ingestion order."""
    return deduplicate(df, keys, [ingest_order.desc()])


def dedupe_by_slug(df: DataFrame, slug: str, record: str, ingest_order: Column) -> DataFrame:
    """First row per slug; rows without one are compared by the whole record."""
    key = F.coalesce(_quoted(slug), _quoted(record))
    return keep_first(df.withColumn("__key", key), ["__key"], ingest_order).drop("__key")
