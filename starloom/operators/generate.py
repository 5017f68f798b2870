"""Generated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATEPARTS = ["year", "quarter", "month", "week", "day", "hour", "minute", "second"]


def series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """The numbers 1 to ``upper_bound`` as ``generated_number``."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).toDF("generated_number")


def _stepped(unit: str, first: str) -> str:
    """``first`` plus ``id`` units: whole days and the rest, as one step count may not fit 32 bits."""
    per_day = {"HOUR": 24, "MINUTE": 1440, "SECOND": 86_400}.get(unit)
    if per_day is None:
        return f"timestampadd({unit}, cast(id as int), {first})"
    return f"timestampadd({unit}, cast(id % {per_day} as int), timestampadd(DAY, cast(id div {per_day} as int), {first}))"


def date_spine(spark: SparkSession, datepart: str, start: str, end: str) -> DataFrame:
    """Every ``datepart`` step from ``start`` on, ``end`` excluded, as ``date_<datepart>``.

    ``start`` and ``end`` are SQL timestamp expressions. The number of steps is the
    count of period borders between them, as the usual ``datediff`` gives.
    """
    if datepart not in DATEPARTS:
        raise ValueError(f"unknown datepart {datepart!r}")
    unit = datepart.upper()
    first, last = f"cast({start} as timestamp_ntz)", f"cast({end} as timestamp_ntz)"
    count = f"timestampdiff({unit}, date_trunc('{unit}', {first}), date_trunc('{unit}', {last}))"
    steps = spark.sql(f"select cast({count} as bigint)").first()[0]  # one number, no table involved
    if steps <= 0:
        raise ValueError("upper bound must be positive")
    stepped = spark.range(steps).selectExpr(
        f"cast({_stepped(unit, first)} as timestamp_ntz) as date_{datepart}"
    )
    return stepped.filter(f"date_{datepart} <= {last}")
