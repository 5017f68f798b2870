"""Global numbering and neighbours without a single-task window.

A window without ``PARTITION BY`` moves every row to one task, and one partitioned by a
hot key moves that key's rows to one task. Here the rows are range-partitioned on the
whole order instead, written once with their place inside the partition, and the
per-partition counts (one row per partition) supply the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging_area import stage

_SLICE, _POS, _SOURCE = "__slice", "__pos", "__source"
_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits

# A group of more rows than this is cut into slices, any other is one task's window.
HOT_ROWS = 1_000_000


def _ascending(order_by: Sequence[Column | str]) -> list[Column]:
    """Strings mean ascending with NULLs last; columns are taken as given."""
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]


def ordered_slices(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """``df`` staged in global order with its slice number and place in the slice.

    Rows that agree on the whole order are spread by the partition they came from, so a
    value shared by a third of all rows does not end up in one task.
    """
    order = _ascending(order_by)
    placed = df.withColumn(_SOURCE, F.spark_partition_id())
    tie = F.col(_SOURCE).asc()
    placed = placed.repartitionByRange(*order, tie).sortWithinPartitions(*order, tie).drop(_SOURCE)
    serial = F.monotonically_increasing_id()
    placed = placed.withColumn(_POS, serial)
    staged = stage(placed, "ordered")
    return staged.withColumn(_SLICE, F.shiftright(_POS, _POSITION_BITS)).withColumn(
        _POS, F.col(_POS).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )


def _offsets(slices: DataFrame) -> DataFrame:
    counts = slices.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("__n"))
    running = Window.orderBy(_SLICE)  # one row per slice
    whole = Window.partitionBy()
    return counts.select(
        _SLICE,
        (F.sum("__n").over(running) - F.col("__n")).alias("__start"),
        F.sum("__n").over(whole).alias("__total"),
    )


def number_rows(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "row_number", total: str | None = None
) -> DataFrame:
    """Add the 1-based position of every row in a global order, at any size.

    Give a unique order for reproducible numbers. ``total`` names an optional column
    with the overall row count.
    """
    slices = ordered_slices(df, order_by)
    numbered = slices.join(F.broadcast(_offsets(slices)), _SLICE)  # one row per slice
    columns = [F.col(f"`{c}`") for c in df.columns]
    columns.append((F.col("__start") + F.col(_POS) + 1).alias(name))
    if total is not None:
        columns.append(F.col("__total").alias(total))
    return numbered.select(*columns)


def ntile(row_number: Column | str, total: Column | str, buckets: int) -> Column:
    """Bucket of a row from its number: the first ``total % buckets`` hold one row more."""
    rn = F.col(row_number) if isinstance(row_number, str) else row_number
    n = F.col(total) if isinstance(total, str) else total
    size = F.floor(n / F.lit(buckets)).cast("long")
    longer = n % buckets
    edge = longer * (size + 1)
    in_longer = F.floor((rn - 1) / (size + 1)) + 1
    in_rest = longer + F.floor((rn - 1 - edge) / F.greatest(size, F.lit(1))) + 1
    return F.when(rn <= edge, in_longer).otherwise(in_rest).cast("long")


def with_neighbours(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[Column | str],
    previous: dict[str, str] | None = None, following: dict[str, str] | None = None,
) -> DataFrame:
    """Add values of the previous and the following row of the same group.

    ``previous`` and ``following`` map new column names to existing columns. Groups of up to ``HOT_ROWS`` rows go through one
    window, so the rows are shuffled once; larger ones, and the whole table where there are no groups, through slices.
    """
    previous, following = previous or {}, following or {}
    if not group_by:
        return _neighbours_in_slices(df, group_by, order_by, previous, following)
    hot = df.groupBy(*[F.col(f"`{g}`") for g in group_by]).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > HOT_ROWS)
    if hot.isEmpty():
        return _neighbours_in_windows(df, group_by, order_by, previous, following)
    marked = stage(hot, "hot-groups").select(*[F.col(f"`{g}`").alias(f"__hot_{g}") for g in group_by])
    same = None
    for g in group_by:
        equal = F.col(f"`{g}`").eqNullSafe(F.col(f"`__hot_{g}`"))
        same = equal if same is None else same & equal
    return _neighbours_in_windows(df.join(marked, same, "left_anti"), group_by, order_by, previous, following).unionByName(
        _neighbours_in_slices(df.join(marked, same, "left_semi"), group_by, order_by, previous, following))


def _neighbours_in_windows(df, group_by, order_by, previous, following) -> DataFrame:
    w = Window.partitionBy(*[F.col(f"`{g}`") for g in group_by]).orderBy(*_ascending(order_by))
    columns = [F.lag(c).over(w).alias(n) for n, c in previous.items()] + [F.lead(c).over(w).alias(n) for n, c in following.items()]
    return df.select("*", *columns)


def _neighbours_in_slices(df, group_by, order_by, previous, following) -> DataFrame:
    slices = ordered_slices(df, [*group_by, *order_by])
    carried = list(dict.fromkeys([*group_by, *previous.values(), *following.values()]))
    record = F.struct(*[F.col(c) for c in carried])
    inside = Window.partitionBy(_SLICE).orderBy(_POS)
    across = Window.orderBy(_SLICE)  # one row per slice
    # The outermost rows of every slice: two per slice, found by position.
    sizes = slices.groupBy(_SLICE).agg(F.max(_POS).alias("__end"))
    outer = slices.join(F.broadcast(sizes), _SLICE).filter((F.col(_POS) == 0) | (F.col(_POS) == F.col("__end")))
    edges = (
        outer.groupBy(_SLICE)
        .agg(
            F.first(F.when(F.col(_POS) == 0, record), ignorenulls=True).alias("__first"),
            F.first(F.when(F.col(_POS) == F.col("__end"), record), ignorenulls=True).alias("__last"),
        )
        .select(
            _SLICE,
            F.lag("__last").over(across).alias("__before"),
            F.lead("__first").over(across).alias("__after"),
        )
    )
    near = (
        slices.select("*", F.lag(record).over(inside).alias("__lag"), F.lead(record).over(inside).alias("__lead"))
        .join(F.broadcast(edges), _SLICE)  # one row per slice
        .withColumn("__lag", F.coalesce("__lag", "__before"))
        .withColumn("__lead", F.coalesce("__lead", "__after"))
    )

    def same_group(side: str) -> Column:
        same = F.col(side).isNotNull()
        for g in group_by:
            same = same & F.col(f"{side}.{g}").eqNullSafe(F.col(g))
        return same

    columns = [F.col(c) for c in df.columns]
    columns += [F.when(same_group("__lag"), F.col(f"__lag.{c}")).alias(n) for n, c in previous.items()]
    columns += [F.when(same_group("__lead"), F.col(f"__lead.{c}")).alias(n) for n, c in following.items()]
    return near.select(*columns)


def running_count(df: DataFrame, order_by: Sequence[Column | str], weight: str, name: str) -> DataFrame:
    """Add the inclusive running sum of an integer column in a global order."""
    slices = ordered_slices(df, order_by)
    sums = slices.groupBy(_SLICE).agg(F.sum(weight).alias("__n"))
    across = Window.orderBy(_SLICE)  # one row per slice
    offsets = sums.select(_SLICE, (F.sum("__n").over(across) - F.col("__n")).alias("__start"))
    inside = Window.partitionBy(_SLICE).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    return slices.join(F.broadcast(offsets), _SLICE).select(  # one row per slice
        *[F.col(c) for c in df.columns],
        (F.col("__start") + F.sum(weight).over(inside)).alias(name),
    )
