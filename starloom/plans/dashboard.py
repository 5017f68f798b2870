"""Report visuals: cards, charts, slicers and the top-n table, as queries on the star."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import exact_avg


def cards(fact: DataFrame) -> DataFrame:
    """One row of headline figures. Measures are averages of the fact column of that name."""
    return fact.agg(
        F.sum(F.col("enrolled_students").cast("long")).alias("total_enrolled"),
        F.round(exact_avg("rating"), 4).alias("avg_rating"),
        F.round(exact_avg("weighted_rating"), 4).alias("weighted_rating"),
        F.round(exact_avg("cost_per_hour"), 4).alias("cost_per_hour"),
    )


def chart(fact: DataFrame, dim: DataFrame, key: str, label: str, measure: Column, name: str) -> DataFrame:
    """A measure per dimension member, largest first.

    The fact is aggregated by its key before the member names are joined.
    """
    per_key = fact.groupBy(key).agg(measure.alias(name))
    return (
        per_key.join(dim.select(key, label), key, "inner")
        .select(label, name)
        .orderBy(F.desc_nulls_last(name), F.asc_nulls_last(label))
    )


def enrolled_by(fact: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    return chart(fact, dim, key, label, F.sum(F.col("enrolled_students").cast("long")), "enrolled_students")


def popularity_by(fact: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    return chart(fact, dim, key, label, F.round(exact_avg("popularity_score"), 4), "popularity_score")


def slicer(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], chosen: Mapping[str, Sequence]) -> DataFrame:
    """Fact rows whose attributes are among the chosen values.

    ``dims`` maps attribute names to (dimension, key); attributes not listed are columns of
    the fact. Dimensions are filtered first, so only the chosen keys are joined.
    """
    rows = fact
    for attribute, values in chosen.items():
        if attribute in dims:
            dim, key = dims[attribute]
            rows = rows.join(dim.filter(F.col(attribute).isin(list(values))).select(key), key, "left_semi")
        else:
            rows = rows.filter(F.col(attribute).isin(list(values)))
    return rows


def count_by_member(fact: DataFrame, dim: DataFrame, key: str, label: str, top: int) -> DataFrame:
    """Number of facts per member, the most frequent first."""
    return chart(fact, dim, key, label, F.count(F.lit(1)), "courses").limit(top)


def top_rows(df: DataFrame, measure: str, tiebreak: Sequence[str], top: int = 10) -> DataFrame:
    """The rows with the largest measure."""
    return df.filter(F.col(measure).isNotNull()).orderBy(
        F.desc(measure), *[F.asc_nulls_last(c) for c in tiebreak]
    ).limit(top)


def top_titles(offers: DataFrame, title: str, measure: Column, top: int = 3) -> DataFrame:
    """The titles with the largest measure, ties by title."""
    ranked = offers.groupBy(title).agg(measure.alias("__measure"))
    return ranked.orderBy(F.desc_nulls_last("__measure"), F.asc_nulls_last(title)).limit(top).select(title)


def top_n_filter(offers: DataFrame, title: str, measure: Column, top: int = 3) -> DataFrame:
    """Rows of the top titles only."""
    chosen = F.broadcast(top_titles(offers, title, measure, top))  # ``top`` rows
    return offers.join(chosen, title, "left_semi")


def top_n_table(offers: DataFrame, columns: Sequence[str], sort: Sequence[str], measure: Column, top: int = 3) -> DataFrame:
    """Details of the top titles."""
    return top_n_filter(offers, columns[0], measure, top).select(*columns).orderBy(
        *[F.asc_nulls_last(c) for c in sort]
    )
