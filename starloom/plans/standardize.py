"""Canonical rows to standardized rows: names, bands and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores, standard
from .rules import DEFAULT, Rules


def standardize_courses(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Standard vocabulary, price and duration bands, and the six course metrics.

    Popularity and weighted rating are computed from the rating as delivered; the value
    score from the rating as kept.
    """
    rating = standard.clamp_to_null("rating", 0, 5) if rules.clamp_rating else F.col("rating")
    enriched = df.select(
        "course_id", "platform", "title", "course_url", "description", "skills", "instructor",
        "language", "domain_name",
        standard.standardize_level("level").alias("level"),
        rating.alias("rating"),
        "review_count", "enrolled_students", "price",
        standard.standardize_price_model("price_model").alias("price_model"),
        "duration_hours", "duration_raw",
        standard.price_band("price").alias("price_category"),
        standard.duration_band("duration_hours").alias("duration_category"),
        scores.popularity_score("rating", "enrolled_students", rules.null_enrolled_is_zero)
        .alias("popularity_score"),
        scores.engagement_rate_pct("review_count", "enrolled_students", rules.null_reviews_is_zero)
        .alias("engagement_rate_pct"),
        scores.weighted_rating("rating", "review_count").alias("weighted_rating"),
        scores.cost_per_hour("price", "duration_hours").alias("cost_per_hour"),
        F.coalesce("offering_type", F.lit("Unknown")).alias("offering_type"),
        scores.estimated_total_cost("price", "duration_hours", "price_model", rules.cost_needs_hours)
        .alias("estimated_total_cost"),
        "last_updated",
    )
    return enriched.withColumn(
        "value_score",
        scores.value_score(
            "rating", "enrolled_students", "estimated_total_cost",
            rules.null_enrolled_is_zero, rules.positive_cost_only,
        ),
    )
