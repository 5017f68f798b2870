"""The whole warehouse in one call, in the order its parts depend on each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from ..operators.staging_area import stage
from . import semantic
from .checks import Observer, run_warehouse_checks
from .history import first_snapshot, merge_snapshot
from .rules import DEFAULT, Rules
from .staging import FEEDS, Complete, combine_feeds, stage_feed
from .standardize import standardize_courses
from .star import build_star

REPORTS = {
    "platform_performance": semantic.platform_performance,
    "domain_trends": semantic.domain_trends,
    "instructor_rankings": semantic.instructor_rankings,
    "pricing_analysis": semantic.pricing_analysis,
    "quality_tiers": semantic.quality_tiers,
}


def build_warehouse(
    raw: Mapping[str, DataFrame], as_of, history: DataFrame | None = None, rules: Rules = DEFAULT,
    tiebreak: Sequence[Column] | None = None, complete: Mapping[str, Complete] | None = None,
) -> dict[str, DataFrame]:
    """All tables by name from raw feeds by name (``coursera``, ``udacity``, ``udemy``), and ``checks``, the declared tests' results.

    Feeds are staged and combined, courses standardized, the snapshot of ``as_of`` merged into ``history``
    (the first one without), the star and the reports built, and all of it tested: what looks at single rows while they are written. Tables are written to the staging
    area and read back; write what is to stay elsewhere, then ``release`` them. ``tiebreak`` and ``complete`` (by feed) as in ``stage_feed``.
    """
    observer = Observer()

    def written(df: DataFrame, name: str) -> DataFrame:
        return stage(observer.watch(df, name), name.replace("_", "-"))

    staged = {name: stage_feed(df, FEEDS[name], rules, tiebreak, (complete or {}).get(name)) for name, df in raw.items()}
    tables = {f"stg_{name}": written(df, f"stg_{name}") for name, df in staged.items()}
    tables["combined"] = combine_feeds(*tables.values())
    # the combined feeds are counted on their way into the courses
    courses = written(standardize_courses(observer.watch(tables["combined"], "combined"), rules), "courses")
    versions = first_snapshot(courses, as_of) if history is None else merge_snapshot(history, courses, as_of)
    tables |= {"courses": courses, "history": stage(versions, "history")}
    star = build_star(courses, tables["history"], rules)
    star["fact_offerings"] = written(star["fact_offerings"], "fact_offerings")
    tables |= star
    tables |= {name: written(report(courses), name) for name, report in REPORTS.items()}
    tables["checks"] = run_warehouse_checks(tables, observer=observer)
    return tables
