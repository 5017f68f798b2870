"""Aggregates that stay distributed for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import let
from .staging_area import stage


def group_by_first(df: DataFrame, n: int):
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


def count_if(condition: Column) -> Column:
    """Rows for which a condition holds (NULL does not)."""
    return F.count(F.when(condition, 1))


def null_profile(df: DataFrame, columns: Sequence[str], prefix: str = "null_") -> DataFrame:
    """One row: the row count and the number of NULLs per column."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in columns],
    )


def _stack(df: DataFrame, group_by: Sequence[str], columns: dict[str, str], dtype: str | None = None) -> DataFrame:
    """One row per (row, named column), NULL values included so that no group is lost; the columns share a type."""
    items = [
        F.struct(F.lit(name).alias("name"), (F.col(c).cast(dtype) if dtype else F.col(c)).alias("value"))
        for name, c in columns.items()
    ]
    return df.select(*group_by, F.explode(F.array(*items)).alias("__item")).select(*group_by, "__item.name", "__item.value")


def modes(df: DataFrame, group_by: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Most frequent non-NULL value per group, NULL where there is none; ties go to the smallest value.

    ``columns`` maps result names to columns of one type. Values are counted per
    (group, value) first, so a hot group reaches the last step as distinct values only.
    """
    counted = (
        _stack(df, group_by, columns)
        .groupBy(*group_by, "name", "value").agg(F.count(F.lit(1)).alias("__n"))
    )
    best = F.struct((-F.col("__n")).alias("n"), F.col("value"))
    return counted.groupBy(*group_by).agg(
        *[F.min_by("value", F.when((F.col("name") == name) & F.col("value").isNotNull(), best)).alias(name) for name in columns]
    )


# Distinct values of a group that one task sorts; a group with more is narrowed down first, to about a thirtieth at a time.
MOST_VALUES = 100_000
SPLITS = 32


def medians(df: DataFrame, group_by: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Exact median per group (mean of the two middle values), as double; NULL where a group has no value.

    Values are counted per (group, value) before they meet. A group of many distinct values is narrowed down: one aggregation gives
    splitters, another the counts between them, and only the values between the splitters around the middle are
    looked at further. What is sorted at the end is MOST_VALUES values of a group at most, whatever the size of the group.
    """
    keys, order = list(group_by), [*group_by, "name"]
    # NULL counts nothing: it only keeps its group
    counted = stage(_stack(df, keys, columns, "double").groupBy(*order, "value").agg(F.count("value").alias("__n")), "values")
    spans = counted.groupBy(*order).agg(F.sum("__n").alias("__total"), F.count("value").alias("__distinct")).select(
        *order, F.expr("(__total + 1) div 2").alias("__low"), F.expr("(__total + 2) div 2").alias("__high"), "__distinct",
        F.lit(None).cast("double").alias("__from"), F.lit(None).cast("double").alias("__to"), F.lit(0).cast("long").alias("__before"))
    spans = stage(spans, "spans")
    while not (wide := spans.filter(F.col("__distinct") > MOST_VALUES)).isEmpty():
        narrowed = _narrowed(_inside(counted, wide, order), wide, order)
        spans = stage(spans.filter(F.col("__distinct") <= MOST_VALUES).unionByName(narrowed), "spans")
    upto = F.col("__before") + F.sum("__n").over(Window.partitionBy(*order).orderBy("value"))
    picked = _inside(counted, spans, order).withColumn("__upto", upto).groupBy(*order).agg(
        F.min(F.when(F.col("__upto") >= F.col("__low"), F.col("value"))).alias("__lower"),
        F.min(F.when(F.col("__upto") >= F.col("__high"), F.col("value"))).alias("__upper"))
    middle = (F.col("__lower") + F.col("__upper")) / 2
    return join_groups(spans.select(*order), picked, order, "left").groupBy(*keys).agg(
        *[F.max(F.when(F.col("name") == name, middle)).alias(name) for name in columns])


def _inside(counted: DataFrame, spans: DataFrame, order: Sequence[str]) -> DataFrame:
    """The counted values within the span of their group."""
    value = F.col("value")
    within = (F.col("__from").isNull() | (value >= F.col("__from"))) & (F.col("__to").isNull() | (value <= F.col("__to")))
    return join_groups(counted.filter(value.isNotNull()), spans, order, "inner").filter(within)


def _narrowed(inside: DataFrame, spans: DataFrame, order: Sequence[str]) -> DataFrame:
    """Spans cut down to the values between the splitters next to the middle."""
    places = [k / SPLITS for k in range(1, SPLITS)]
    cuts = inside.groupBy(*order).agg(F.percentile_approx("value", places, 50 * SPLITS).alias("__cuts"))
    part = F.size(F.filter("__cuts", lambda c: c <= F.col("value"))).alias("__part")
    parts = join_groups(inside, cuts, order, "inner").groupBy(*order, part).agg(
        F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__values"), F.min("value").alias("__least"), F.max("value").alias("__most"))
    running = Window.partitionBy(*order).orderBy("__part")  # SPLITS rows of a group
    placed = join_groups(parts, spans, order, "inner").withColumn("__upto", F.col("__before") + F.sum("__n").over(running))
    start = F.col("__upto") - F.col("__n")
    holds = [(start < F.col(rank)) & (F.col("__upto") >= F.col(rank)) for rank in ("__low", "__high")]
    return placed.filter(holds[0] | holds[1]).groupBy(*order).agg(
        F.max("__low").alias("__low"), F.max("__high").alias("__high"), F.sum("__values").alias("__distinct"),
        F.min("__least").alias("__from"), F.max("__most").alias("__to"), F.min(start).alias("__before"))


def distinct_text(df: DataFrame, group_by: Sequence[str], columns: dict[str, str], separator: str = ", ") -> DataFrame:
    """Sorted distinct values of a column per group, joined to one text.

    Repeats are removed before the values of a group meet; the text of a group holds all of them, so it is as long as they are.
    NULL where a group has no value.
    """
    values = _stack(df, group_by, columns).distinct()
    return values.groupBy(*group_by).agg(
        *[
            let(
                F.collect_list(F.when(F.col("name") == name, F.col("value"))),
                lambda listed: F.when(F.size(listed) > 0, F.array_join(F.sort_array(listed), separator)),
            ).alias(name)
            for name in columns
        ]
    )


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join two per-group results on keys that may be NULL."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        condition = equal if condition is None else condition & equal
    joined = left.join(renamed, condition, how) if keys else left.crossJoin(renamed)
    kept = [F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) if how == "full" else F.col(k) for k in keys]
    values = [F.col(c) for c in left.columns if c not in keys]
    values += [F.col(c) for c in right.columns if c not in keys]
    return joined.select(*kept, *values)


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage of a whole, NULL for an empty one."""
    return F.round(part * 100.0 / F.nullif(whole, F.lit(0)), digits)
