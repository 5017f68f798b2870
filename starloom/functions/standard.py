"""Vocabulary standardization, bands and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .core import ColumnOrName, col, lookup, text_array


def standardize_language(c: ColumnOrName) -> Column:
    """Language name or locale code to the English language name.

    Case is ignored, blanks are not: ``' en '`` is unknown. NULL stays NULL.
    """
    codes = {code: name for name, codes in fixed.LANGUAGES.items() for code in codes}
    known = F.coalesce(lookup(F.lower(col(c)), codes), F.lit(fixed.OTHER_LANGUAGE))
    return F.when(col(c).isNotNull(), known)


def standardize_level(c: ColumnOrName) -> Column:
    """Trimmed, case-folded level to one of four names, else ``Unknown``."""
    words = {word: name for name, words in fixed.LEVELS.items() for word in words}
    return F.coalesce(lookup(F.lower(F.trim(col(c))), words), F.lit("Unknown"))


def is_subscription(c: ColumnOrName) -> Column:
    return F.lower(col(c)).isin(fixed.SUBSCRIPTION_MODELS)


def is_one_time(c: ColumnOrName) -> Column:
    return F.lower(col(c)) == fixed.ONE_TIME_MODEL


def standardize_price_model(c: ColumnOrName) -> Column:
    """``Subscription``, ``One Time`` or ``Unknown``; the text is not trimmed."""
    return (
        F.when(is_subscription(c), "Subscription")
        .when(is_one_time(c), "One Time")
        .otherwise("Unknown")
    )


def _band(value: Column, edges: list[tuple[int, str]], top: str, start: Column) -> Column:
    for upper, name in edges:
        start = start.when(value < upper, name)
    return start.otherwise(top)


def price_band(c: ColumnOrName) -> Column:
    """Free, Cheap, Medium, Expensive, Premium or Unknown. Negative prices are Cheap."""
    price = col(c)
    start = F.when(price.isNull(), "Unknown").when(price == 0, "Free")
    return _band(price, fixed.PRICE_BANDS, fixed.PRICE_BAND_TOP, start)


def duration_band(c: ColumnOrName) -> Column:
    """Short, Medium, Long, Extensive or Unknown."""
    hours = col(c)
    start = F.when(hours.isNull(), "Unknown")
    return _band(hours, fixed.DURATION_BANDS, fixed.DURATION_BAND_TOP, start)


def clamp_to_null(c: ColumnOrName, low: float, high: float) -> Column:
    """Values outside ``[low, high]`` become NULL."""
    return F.when(col(c).between(low, high), col(c))


def quality_tier(rating: ColumnOrName, enrolled: ColumnOrName, engagement: ColumnOrName) -> Column:
    """Unrated, Premium, High, Medium or Low. A NULL measure never reaches its tier."""
    rating, enrolled, engagement = col(rating), col(enrolled), col(engagement)
    tier = F.when(rating.isNull(), fixed.UNRATED_TIER)
    for name, *least in fixed.QUALITY_TIERS:
        reached = F.lit(True)
        for measure, bound in zip((rating, enrolled, engagement), least):
            reached = reached if bound is None else reached & (measure >= bound)
        tier = tier.when(reached, name)
    return tier.otherwise(fixed.LOWEST_TIER)


def rank_in(c: ColumnOrName, order: list[str]) -> Column:
    """1-based place of a value in a business order; unlisted values come last."""
    place = F.array_position(text_array(order), col(c))
    return F.when(place > 0, place).otherwise(len(order) + 1)
