"""Report tables over standardized courses.

Some reports read their input twice: pass a written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.core import exact_avg
from ..functions.standard import quality_tier, rank_in
from ..operators.aggregate import count_if, distinct_text, join_groups, medians, modes, share_pct
from ..operators.numbering import ntile, number_rows
from ..operators.staging_area import stage


def _avg(column: str, digits: int = 2) -> Column:
    return F.round(exact_avg(column), digits)


def _total(column: str) -> Column:
    return F.sum(F.col(column).cast("long"))


def platform_performance(courses: DataFrame, group_by: str = "platform") -> DataFrame:
    """Counts, averages, exact medians and shares per platform."""
    rated = F.col("rating") >= 4.5
    stats = courses.groupBy(group_by).agg(
        F.count(F.lit(1)).alias("total_courses"),
        _avg("rating").alias("avg_rating"),
        _total("enrolled_students").alias("total_enrolled"),
        _avg("enrolled_students", 0).alias("avg_enrolled_per_course"),
        _avg("price").alias("avg_price"),
        _avg("duration_hours", 1).alias("avg_duration_hours"),
        _avg("review_count", 0).alias("avg_reviews"),
        _avg("engagement_rate_pct").alias("avg_engagement_pct"),
        _avg("value_score").alias("avg_value_score"),
        _avg("weighted_rating").alias("avg_weighted_rating"),
        _avg("cost_per_hour").alias("avg_cost_per_hour"),
        count_if((F.col("price") == 0) | F.col("price").isNull()).alias("free_courses"),
        count_if(rated).alias("high_rated_courses"),
        share_pct(count_if(rated), F.count(F.lit(1))).alias("pct_high_rated"),
    )
    middles = medians(courses, [group_by], {"median_rating": "rating", "median_price": "price"}).select(
        group_by, F.round("median_rating", 2).alias("median_rating"), F.round("median_price", 2).alias("median_price")
    )
    return join_groups(stats, middles, [group_by], "left")


def domain_trends(courses: DataFrame) -> DataFrame:
    """Course statistics and most common values per domain, largest audience first."""
    rated = F.col("rating") >= 4.0
    stats = courses.groupBy("domain_name").agg(
        F.count(F.lit(1)).alias("total_courses"),
        F.count_distinct("platform").alias("platforms_offering"),
        _avg("rating").alias("avg_rating"),
        _total("enrolled_students").alias("total_enrolled"),
        _avg("price").alias("avg_price"),
        _avg("duration_hours", 1).alias("avg_duration_hours"),
        _avg("engagement_rate_pct").alias("avg_engagement_pct"),
        _avg("value_score").alias("avg_value_score"),
        count_if(rated).alias("courses_rated_4_plus"),
        share_pct(count_if(rated), F.count(F.lit(1))).alias("pct_rated_4_plus"),
    )
    common = modes(
        courses, ["domain_name"],
        {"most_common_level": "level", "most_common_price_category": "price_category"},
    )
    return join_groups(stats, common, ["domain_name"], "left").orderBy(
        F.desc_nulls_last("total_enrolled"), F.asc_nulls_last("domain_name")
    )


def instructor_rankings(courses: DataFrame, min_courses: int = 2, buckets: int = 10) -> DataFrame:
    """Instructors with several courses, ranked by a weighted score, with deciles.

    Equal scores are ordered by name.
    """
    named = courses.filter(F.trim("instructor") != "")
    score = (
        F.coalesce(exact_avg("rating"), F.lit(0.0)) * 0.4
        + F.log(F.coalesce(_total("enrolled_students"), F.lit(0)) + 1) * 0.3
        + F.coalesce(exact_avg("engagement_rate_pct"), F.lit(0.0)) * 0.3
    )
    stats = named.groupBy("instructor").agg(
        F.count(F.lit(1)).alias("course_count"),
        F.count_distinct("platform").alias("platforms_count"),
        _avg("rating").alias("avg_rating"),
        _total("enrolled_students").alias("total_students"),
        _avg("enrolled_students", 0).alias("avg_students_per_course"),
        _total("review_count").alias("total_reviews"),
        _avg("engagement_rate_pct").alias("avg_engagement_pct"),
        _avg("value_score").alias("avg_value_score"),
        _avg("weighted_rating").alias("avg_weighted_rating"),
        F.round(score, 2).alias("composite_score"),
    ).filter(F.col("course_count") >= min_courses)
    lists = distinct_text(named, ["instructor"], {"platforms": "platform", "domains": "domain_name"})
    ranked = number_rows(
        stats, [F.desc_nulls_last("composite_score"), F.asc_nulls_last("instructor")], "overall_rank", "__total"
    )
    decile = ntile("overall_rank", "__total", buckets)
    return join_groups(
        ranked.withColumn("decile", decile).drop("__total"), lists, ["instructor"], "left"
    )


def pricing_analysis(courses: DataFrame) -> DataFrame:
    """Statistics per price band with its share of all courses, in business order."""
    bands = courses.groupBy("price_category").agg(
        F.count(F.lit(1)).alias("course_count"),
        _avg("rating").alias("avg_rating"),
        _avg("price").alias("avg_price"),
        F.round(F.min("price"), 2).alias("min_price"),
        F.round(F.max("price"), 2).alias("max_price"),
        _total("enrolled_students").alias("total_enrolled"),
        _avg("enrolled_students", 0).alias("avg_enrolled"),
        _avg("duration_hours", 1).alias("avg_duration_hours"),
        _avg("cost_per_hour").alias("avg_cost_per_hour"),
        _avg("value_score").alias("avg_value_score"),
        _avg("engagement_rate_pct").alias("avg_engagement_pct"),
        count_if(F.col("price_model") == "Subscription").alias("subscription_count"),
        count_if(F.col("price_model") == "One Time").alias("one_time_count"),
    )
    shared = share_of_total(bands, "course_count", "pct_of_total")
    return shared.orderBy(rank_in("price_category", fixed.PRICE_BAND_ORDER))


def share_of_total(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Percentage of the column total, which is joined as a single row.

    ``df`` holds aggregated rows; they are written once, so that whatever they come from is
    not computed for the rows and again for the total.
    """
    df = stage(df, "shares")
    whole = df.agg(F.sum(measure).alias("__whole"))
    return (
        df.crossJoin(F.broadcast(whole))  # one row
        .withColumn(name, share_pct(F.col(measure), F.col("__whole")))
        .drop("__whole")
    )


def share_of_group(df: DataFrame, measure: str, group_by: str, name: str) -> DataFrame:
    """Percentage of the column total of its group, for already aggregated rows.

    The rows are written once. The totals are aggregated and joined, so that a group with
    most of the rows is not one window partition.
    """
    df = stage(df, "shares")
    totals = df.groupBy(group_by).agg(F.sum(measure).alias("__whole"))
    shared = join_groups(df, totals, [group_by], "left")
    return shared.withColumn(name, share_pct(F.col(measure), F.col("__whole"))).drop("__whole")


def quality_tiers(courses: DataFrame) -> DataFrame:
    """Statistics per (tier, platform, domain) with the share of the platform's courses."""
    tier = quality_tier("rating", "enrolled_students", "engagement_rate_pct")
    summary = courses.withColumn("quality_tier", tier).groupBy("quality_tier", "platform", "domain_name").agg(
        F.count(F.lit(1)).alias("course_count"),
        _avg("rating").alias("avg_rating"),
        _avg("price").alias("avg_price"),
        _total("enrolled_students").alias("total_enrolled"),
        _avg("engagement_rate_pct").alias("avg_engagement_pct"),
        _avg("value_score").alias("avg_value_score"),
        _avg("duration_hours", 1).alias("avg_duration_hours"),
        _avg("cost_per_hour").alias("avg_cost_per_hour"),
    )
    return share_of_group(summary, "course_count", "platform", "pct_of_platform").orderBy(
        F.asc_nulls_last("platform"),
        rank_in("quality_tier", fixed.TIER_ORDER),
        F.desc_nulls_last("total_enrolled"),
        F.asc_nulls_last("domain_name"),
    )
