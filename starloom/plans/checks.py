"""The declared tests of the warehouse, and a way to run those of a table in few passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.core import rows_frame
from ..operators.joins import orphans


@dataclass(frozen=True)
class TableChecks:
    """Tests of one table. A range is (column, lowest, highest, severity), a key one column or several together."""

    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = None
    ranges: Sequence[tuple[str, float | None, float | None, str]] = ()
    keys: Sequence[tuple[str, ...]] = ()
    relationships: Mapping[str, tuple[str, str]] = None


# --- fixed values: the declared tests ---------------------------------------------------------

def _staged(platform: str) -> TableChecks:
    return TableChecks(
        not_null=["course_id", "platform", "title"],
        accepted={"platform": [platform]},
        ranges=[
            ("duration_hours", 0, None, "warn"), ("rating", 0, 5, "warn"), ("price", 0, None, "warn"), ("enrolled_students", 0, None, "warn"),
        ],
        keys=[("course_id",)],
    )


def _dimension(key: str) -> TableChecks:
    return TableChecks(not_null=[key], keys=[(key,)])


PLATFORMS = ["Coursera", "Udacity", "Udemy"]
DIMENSION_KEYS = {
    "dim_platform": "platform_id",
    "dim_domain": "domain_id",
    "dim_level": "level_id",
    "dim_language": "language_id",
    "dim_instructor": "instructor_id",
    "dim_offering_type": "offering_type_id",
    "dim_date": "date_id",
}
WAREHOUSE_CHECKS: dict[str, TableChecks] = {
    "stg_coursera": _staged("Coursera"),
    "stg_udacity": _staged("Udacity"),
    "stg_udemy": _staged("Udemy"),
    "combined": TableChecks(
        not_null=["course_id", "platform", "title"], accepted={"platform": PLATFORMS}, keys=[("course_id", "platform")],
    ),
    "courses": TableChecks(
        not_null=["course_id", "platform"],
        accepted={
            "platform": PLATFORMS,
            "level": ["Beginner", "Intermediate", "Advanced", "All Levels", "Unknown"],
            "price_category": ["Free", "Cheap", "Medium", "Expensive", "Premium", "Unknown"],
            "duration_category": ["Short", "Medium", "Long", "Extensive", "Unknown"],
        },
        ranges=[("rating", 0, 5, "warn")],
        keys=[("course_id", "platform")],
    ),
    **{table: _dimension(key) for table, key in DIMENSION_KEYS.items()},
    "dim_offering": TableChecks(not_null=["offering_sk", "offering_id"], keys=[("offering_sk",)]),
    "fact_offerings": TableChecks(
        not_null=["offering_sk", *DIMENSION_KEYS.values()],
        relationships={"offering_sk": ("dim_offering", "offering_sk"), **{k: (t, k) for t, k in DIMENSION_KEYS.items()}},
    ),
    "platform_performance": TableChecks(
        not_null=["platform", "total_courses"], ranges=[("avg_rating", 0, 5, "error")], keys=[("platform",)],
    ),
    "domain_trends": TableChecks(not_null=["domain_name", "total_courses"], keys=[("domain_name",)]),
    "instructor_rankings": TableChecks(
        not_null=["instructor", "overall_rank", "composite_score"], keys=[("instructor",), ("overall_rank",)],
    ),
    "pricing_analysis": TableChecks(not_null=["price_category", "course_count"], keys=[("price_category",)]),
    "quality_tiers": TableChecks(
        not_null=["quality_tier", "course_count"], accepted={"quality_tier": ["Premium", "High", "Medium", "Low", "Unrated"]},
    ),
}


# --- running them ---------------------------------------------------------------------------------

def _outside(column: str, low: float | None, high: float | None) -> Column:
    failing = F.lit(False)
    if low is not None:
        failing = failing | (F.col(column) < low)
    if high is not None:
        failing = failing | (F.col(column) > high)
    return failing


def _row_tests(checks: TableChecks) -> list[tuple[str, Column, str]]:
    """Name, failing condition and severity of the tests that look at one row."""
    tests = [(f"{c} is not null", F.col(c).isNull(), "error") for c in checks.not_null]
    tests += [(f"{c} is accepted", ~F.col(c).isin(list(v)), "error") for c, v in (checks.accepted or {}).items()]
    return tests + [(f"{c} is in range", _outside(c, low, high), severity) for c, low, high, severity in checks.ranges]


def _counts(tests: Sequence[tuple[str, Column, str]]) -> list[Column]:
    return [F.count(F.when(failing, 1)).alias(f"t{i}") for i, (_, failing, _) in enumerate(tests)]


class Observer:
    """Counts the failures of row tests while tables are written, so that testing them asks for no scan of its own."""

    def __init__(self, declared: Mapping[str, TableChecks] | None = None):
        self.declared = WAREHOUSE_CHECKS if declared is None else declared
        self.watched: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        """The table, its row tests counted by the next job that goes through all its rows; write it next, once.

        The counts are taken in the tasks that write, of which every finished one counts once, whatever is run again.
        """
        tests = _row_tests(self.declared[name]) if name in self.declared else []
        if not tests:
            return df
        self.watched[name] = Observation(f"checks of {name}")
        return df.observe(self.watched[name], *_counts(tests))

    def failures(self, name: str) -> list[int] | None:
        """Failures of the table's row tests in their order; None for a table that was not watched. Waits for its job."""
        if name not in self.watched:
            return None
        found = self.watched[name].get
        return [found[f"t{i}"] for i in range(len(found))]


def run_table_checks(
    name: str, tables: Mapping[str, DataFrame], checks: TableChecks, counted: Sequence[int] | None = None,
) -> DataFrame:
    """(test, failures, status) of one table: one pass for all row tests, one grouping per key, one join per relationship.

    Failures are rows, for keys values that occur more than once. NULL passes ranges, accepted values and
    relationships; rows with a NULL in a key of one column are not counted for it. ``counted`` gives the failures of the row tests where
    they are known (:class:`Observer`); the table is not read for them then.
    """
    df = tables[name]
    results = []
    tests = _row_tests(checks)
    if tests and counted is not None:
        known = [(f"{name}: {test}", n, severity) for (test, _, severity), n in zip(tests, counted, strict=True)]
        results.append(rows_frame(df.sparkSession, known, "test string, failures bigint, severity string"))
    elif tests:
        counted = df.agg(*_counts(tests))
        each = [F.struct(F.lit(f"{name}: {test}").alias("test"), F.col(f"t{i}").alias("failures"), F.lit(severity).alias("severity"))
                for i, (test, _, severity) in enumerate(tests)]
        results.append(counted.select(F.inline(F.array(*each))))
    for key in checks.keys:
        rows = df.dropna(subset=list(key)) if len(key) == 1 else df
        repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        results.append(repeated.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(f"{name}: {', '.join(key)} is unique").alias("test"), "failures", F.lit("error").alias("severity")))
    for column, (parent, field) in (checks.relationships or {}).items():
        lost = orphans(df.select(column), column, tables[parent].select(field), field)
        results.append(lost.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(f"{name}: {column} is in {parent}").alias("test"), "failures", F.lit("error").alias("severity")))
    together = reduce(DataFrame.unionAll, results)
    return together.select("test", "failures", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")).alias("status"))


def run_warehouse_checks(
    tables: Mapping[str, DataFrame], declared: Mapping[str, TableChecks] = WAREHOUSE_CHECKS, observer: Observer | None = None,
) -> DataFrame:
    """(test, failures, status) of all declared tests of the tables that are given. Pass written tables."""
    seen = {name: observer.failures(name) if observer else None for name in declared if name in tables}
    return reduce(DataFrame.unionAll, [run_table_checks(name, tables, declared[name], counts) for name, counts in seen.items()])
