"""Data-quality tests. Each returns the failing rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import rows_frame
from .joins import orphans
from .numbering import with_neighbours


def _rows() -> Column:
    return F.count(F.lit(1))


def _bound(value) -> Column:
    return value if isinstance(value, Column) else F.expr(value) if isinstance(value, str) else F.lit(value)


# --- row conditions ---------------------------------------------------------------------

def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Rows outside a range; NULL passes. Bounds are values or SQL expressions."""
    c = F.col(column)
    failing = F.lit(False)
    if min_value is not None:
        low = _bound(min_value)
        failing = failing | ~(c >= low if inclusive else c > low)
    if max_value is not None:
        high = _bound(max_value)
        failing = failing | ~(c <= high if inclusive else c < high)
    return df.filter(failing)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows for which an expression is false; NULL passes. With a column it completes it."""
    condition = f"`{column}` {expression}" if column else expression
    return df.filter(f"not ({condition})")


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    c = F.trim(column) if trim_whitespace else F.col(column)
    return df.select(c.alias(column)).filter(F.col(column) == "")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows in which two columns differ; a NULL on either side passes."""
    return df.filter(F.col(actual) != F.col(expected))


# --- values -------------------------------------------------------------------------------

def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside a list, with their row counts; NULL passes."""
    counted = df.groupBy(F.col(column).alias("value_field")).agg(_rows().alias("n_records"))
    return counted.filter(~F.col("value_field").isin(list(values)))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Forbidden values that occur."""
    return df.select(F.col(column).alias("value_field")).distinct().filter(F.col("value_field").isin(list(values)))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(_rows().alias("n_records")).filter("n_records > 1")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once."""
    counted = df.groupBy(*columns).agg(_rows().alias("__n"))
    return counted.filter("__n > 1").select(*columns)


# --- aggregates, optionally per group ----------------------------------------------------

def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) without a single non-NULL value."""
    rows = df.select(*group_by, column) if group_by else df.select(column).filter(F.col(column).isNotNull()).limit(1)
    return rows.groupBy(*group_by).agg(F.count(column).alias("filler_column")).filter("filler_column = 0")


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) with exactly one distinct non-NULL value.

    Smallest and largest value decide it, so nothing is collected per group.
    """
    both = df.groupBy(*group_by).agg(F.min(column).alias("__min"), F.max(column).alias("__max"))
    return both.filter(F.col("__min") == F.col("__max")).select(
        *group_by, F.lit(1).cast("long").alias("filler_column")
    )


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) whose share of non-NULL values lies outside the limits."""
    share = F.count(column).cast("double") / F.nullif(_rows(), F.lit(0))
    counted = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    return counted.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame, field: str, datepart: str, interval: int, now: str, ignore_time: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups (or the table) whose latest value is older than ``interval`` dateparts, or NULL.

    ``now`` is a SQL timestamp expression; it is passed in so that reruns agree.
    """
    latest = F.max(field)
    threshold = F.expr(f"timestampadd({datepart.upper()}, {-interval}, {now})")
    kind = "date" if ignore_time else df.schema[field].dataType
    checked = df.groupBy(*group_by).agg(latest.cast(kind).alias("most_recent"))
    checked = checked.withColumn("threshold", threshold.cast(kind))
    return checked.filter(F.col("most_recent").isNull() | (F.col("most_recent") < F.col("threshold")))


# --- two tables ------------------------------------------------------------------------------

def _side_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """Row counts of two tables side by side: per group, joined on the group columns.

    Only one row per group meets in the join. NULL groups do not match, as in SQL.
    """
    left = a.groupBy(*[F.col(c).alias(f"{c}_a") for c in group_by]).agg(_rows().alias(names[0]))
    right = b.groupBy(*[F.col(c).alias(f"{c}_b") for c in group_by]).agg(_rows().alias(names[1]))
    if not group_by:
        return left.crossJoin(right)  # one row each
    condition = reduce(and_, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in group_by])
    pairs = [n for c in group_by for n in (f"{c}_a", f"{c}_b")]
    return left.join(right, condition, "full").select(*pairs, *names)


def _strict(df: DataFrame, names: tuple[str, str], strict_groups: bool) -> DataFrame:
    return df.fillna(0, list(names)) if strict_groups else df


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = (), strict_groups: bool = False) -> DataFrame:
    """Row counts of both tables and their difference; the test fails if these add up to > 0.

    A group found on one side only has a NULL difference and passes, unless
    ``strict_groups`` counts the missing side as 0.
    """
    names = ("count_a", "count_b")
    counts = _strict(_side_counts(a, b, group_by, names), names, strict_groups)
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = (), strict_groups: bool = False) -> DataFrame:
    """Row counts and by how many rows ``a`` exceeds ``b``; equal counts are 1 too many."""
    names = ("count_our_model", "count_comparison_model")
    counts = _strict(_side_counts(a, b, group_by, names), names, strict_groups)
    ours, theirs = (F.col(n) for n in names)
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return counts.withColumn("row_count_delta", delta.cast("long"))


def _set_difference(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows found on one side only, tagged; NULLs compare equal.

    One grouping serves both directions and combines copies before the shuffle.
    """
    sides = a.select("*", F.lit(1).alias("__in_a"), F.lit(0).alias("__in_b")).unionAll(
        b.select("*", F.lit(0).alias("__in_a"), F.lit(1).alias("__in_b"))
    )
    merged = sides.groupBy(*columns).agg(F.max("__in_a").alias("__in_a"), F.max("__in_b").alias("__in_b"))
    tag = F.when(F.col("__in_a") == 1, "a_minus_b").otherwise("b_minus_a")
    return merged.filter("__in_a <> __in_b").select(tag.alias("which_diff"), *columns)


# Rows are summed up by their hashes in so many buckets before any of them is moved.
BUCKETS = 4096


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.withColumn("__side", F.lit(1)).unionAll(b.withColumn("__side", F.lit(-1)))


def differing_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """(__bucket): the buckets of row hashes in which two tables with the same columns do not hold the same rows equally often.

    Per bucket the number of rows and the sums of two 64-bit hashes, in halves, of one side are taken from those of the
    other: an order-free fingerprint of 128 bits and the count. Equal tables move one row per bucket and task. Rows that differ in a
    bucket go unnoticed only if both hash sums and the counts agree, a chance of about 2**-128 per bucket.
    """
    columns = [c for c in a.columns]
    rows = _sides(a, b)
    half = F.lit((1 << 32) - 1)
    halves = []
    for seed in (1, 2):
        h = _row_hash(columns, seed)
        halves += [h.bitwiseAND(half), F.shiftrightunsigned(h, 32)]
    sums = [F.sum(part * F.col("__side")).alias(f"__s{i}") for i, part in enumerate(halves)]
    summed = rows.groupBy(_bucket(columns).alias("__bucket")).agg(F.sum("__side").alias("__rows"), *sums)
    unequal = reduce(or_, [F.col(c) != 0 for c in summed.columns if c != "__bucket"])
    return summed.filter(unequal).select("__bucket")


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    # a NULL leaves a hash as it is, so it counts by its place
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(f"`{c}`"), F.isnull(F.col(f"`{c}`")))])


def _bucket(columns: Sequence[str]) -> Column:
    return F.pmod(_row_hash(columns, 3), F.lit(BUCKETS))


def _difference_of_buckets(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`_set_difference` of the rows in buckets that differ; rows of equal buckets are not moved."""
    a, b = a.select(*[F.col(f"`{c}`") for c in columns]), b.select(*[F.col(f"`{c}`") for c in columns])
    unequal = F.broadcast(differing_buckets(a, b))  # BUCKETS rows at most

    def some(df: DataFrame) -> DataFrame:
        return df.withColumn("__bucket", _bucket(columns)).join(unequal, "__bucket", "left_semi").drop("__bucket")

    return _set_difference(some(a), some(b), columns)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` not in ``b`` and the reverse, distinct, tagged in ``which_diff``."""
    return _difference_of_buckets(a, b.toDF(*a.columns), a.columns)


def equality(
    a: DataFrame, b: DataFrame, compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None, precision: int | None = None,
) -> DataFrame:
    """Tagged rows by which two tables differ as sets, over all or some columns.

    ``precision`` rounds numeric columns first.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give either compare_columns or exclude_columns, not both")
    excluded = {c.lower() for c in exclude_columns or ()}
    if compare_columns:
        columns = list(compare_columns)
    else:
        columns = [c for c in a.columns if c.lower() not in excluded]
        others = {c.lower() for c in b.columns} - excluded
        if {c.lower() for c in columns} != others:
            raise ValueError("the tables have different columns; compare or exclude some")

    def chosen(df: DataFrame) -> DataFrame:
        if precision is None:
            return df.select(*columns)
        numeric = {f.name.lower() for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
        return df.select(*[
            F.round(F.col(c).cast("decimal(38,10)"), precision).alias(c) if c.lower() in numeric else F.col(c)
            for c in columns
        ])

    return _difference_of_buckets(chosen(a), chosen(b), columns)


def equality_metric(differences: DataFrame) -> DataFrame:
    """Failure count of :func:`equality`: rows plus the imbalance between the sides."""
    left = F.count(F.when(F.col("which_diff") == "a_minus_b", 1))
    right = F.count(F.when(F.col("which_diff") == "b_minus_a", 1))
    return differences.agg((_rows() + F.abs(left - right)).alias("failures"))


def cardinality_equality(a: DataFrame, column: str, b: DataFrame, field: str) -> DataFrame:
    """Values whose number of rows differs between two tables, with the count of either side."""
    def counted(df: DataFrame, c: str) -> DataFrame:
        return df.groupBy(F.col(c).alias(column)).agg(_rows().alias("num_rows"))

    return _set_difference(counted(a, column), counted(b, field), [column, "num_rows"]).drop("which_diff")


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child values without a parent, one row each."""
    return orphans(child.select(F.col(column).alias("from_field")), "from_field", parent, field)


def relationships_where(
    child: DataFrame, column: str, parent: DataFrame, field: str,
    from_condition: str = "1 = 1", to_condition: str = "1 = 1",
) -> DataFrame:
    """As :func:`relationships`, with a condition on either table."""
    lost = relationships(child.filter(from_condition), column, parent.filter(to_condition), field)
    nothing = F.lit(None).cast(parent.schema[field].dataType)
    return lost.select(F.col("from_field").alias("id"), nothing.alias("right_id"))


# --- order within groups ------------------------------------------------------------------------

def sequential_values(
    df: DataFrame, column: str, interval: int = 1, datepart: str | None = None, group_by: Sequence[str] = (),
) -> DataFrame:
    """Rows that do not follow their predecessor by ``interval`` (dateparts); first rows pass."""
    previous = f"previous_{column}"
    rows = df.select(*group_by, column)
    walked = with_neighbours(rows, group_by, [column], previous={previous: column})
    if datepart:
        expected = F.expr(f"timestampadd({datepart.upper()}, {interval}, `{previous}`)")
    else:
        expected = F.col(previous) + interval
    return walked.filter(~(F.col(column) == expected))


GAPS: dict[str, Callable[[Column, Column], Column]] = {
    "not_allowed": lambda upper, following: upper == following,
    "allowed": lambda upper, following: upper <= following,
    "required": lambda upper, following: upper < following,
}


def mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, partition_by: str | None = None, gaps: str = "allowed",
    zero_length: bool = False,
) -> DataFrame:
    """Ranges that are empty, reversed, unbounded or overlap the next one of their partition."""
    if gaps not in GAPS:
        raise ValueError(f"gaps must be one of {list(GAPS)}, got {gaps!r}")
    groups = ["partition_by_col"] if partition_by else []
    rows = df.select(
        *([F.col(partition_by).alias("partition_by_col")] if partition_by else []),
        F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"),
    )
    walked = with_neighbours(
        rows, groups, ["lower_bound", "upper_bound"], following={"next_lower_bound": "lower_bound"}
    )
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    last = following.isNull() & low.isNotNull()
    ordered = F.coalesce(low <= high if zero_length else low < high, F.lit(False))
    separate = F.coalesce(GAPS[gaps](high, following), last)
    return walked.withColumn("is_last_record", last).filter(~(ordered & separate))


# --- table shape -----------------------------------------------------------------------------------

def columns_match_set(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Column names missing from or surplus in a table, case folded."""
    actual, wanted = {c.lower() for c in df.columns}, {c.lower() for c in expected}
    rows = [(c, "missing") for c in sorted(wanted - actual)] + [(c, "unexpected") for c in sorted(actual - wanted)]
    return rows_frame(df.sparkSession, rows, "column_name string, problem string")


# --- running tests ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """One declared test: a function of the table giving failing rows, and how to judge them.

    ``fail_calc`` is the SQL aggregate over the failing rows; ``error_if`` and ``warn_if``
    complete it to a condition. Severity ``warn`` never errors.
    """

    name: str
    test: Callable[[DataFrame], DataFrame]
    where: str | None = None
    severity: str = "error"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    fail_calc: str = "count(*)"


def run_check(df: DataFrame, check: Check) -> DataFrame:
    """One row: test name, number of failures and status (``pass``, ``warn`` or ``error``)."""
    failing = check.test(df.filter(check.where) if check.where else df)
    counted = failing.agg(F.expr(f"cast(coalesce({check.fail_calc}, 0) as bigint)").alias("failures"))
    warn = F.when(F.expr(f"failures {check.warn_if}"), "warn").otherwise("pass")
    status = warn if check.severity == "warn" else F.when(F.expr(f"failures {check.error_if}"), "error").otherwise(warn)
    return counted.select(F.lit(check.name).alias("test"), "failures", status.alias("status"))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Status rows of several tests over one table."""
    return reduce(DataFrame.unionAll, [run_check(df, c) for c in checks])
