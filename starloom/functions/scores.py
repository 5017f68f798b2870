"""Course metrics. Logarithms are natural; every score is rounded to two digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import ColumnOrName, col
from .standard import is_one_time, is_subscription

HOURS_PER_BILLING_PERIOD = 40.0


def _zero(c: Column, as_zero: bool) -> Column:
    return F.coalesce(c, F.lit(0)) if as_zero else c


def popularity_score(
    rating: ColumnOrName, enrolled: ColumnOrName, null_enrolled_is_zero: bool = False
) -> Column:
    """``rating * ln(enrolled + 1)``; NULL when either is NULL (or enrolled counts as 0)."""
    count = _zero(col(enrolled), null_enrolled_is_zero)
    return F.round(col(rating) * F.log(count + 1), 2)


def engagement_rate_pct(
    reviews: ColumnOrName, enrolled: ColumnOrName, null_reviews_is_zero: bool = True
) -> Column:
    """Reviews per hundred enrolled; NULL when nobody enrolled."""
    count = _zero(col(reviews), null_reviews_is_zero).cast("double")
    return F.round(count / F.nullif(col(enrolled), F.lit(0)) * 100, 2)


def weighted_rating(rating: ColumnOrName, reviews: ColumnOrName) -> Column:
    """``rating * ln(reviews + 1)`` with missing reviews taken as none."""
    return F.round(col(rating) * F.log(_zero(col(reviews), True) + 1), 2)


def cost_per_hour(price: ColumnOrName, hours: ColumnOrName) -> Column:
    return F.round(col(price) / F.nullif(col(hours), F.lit(0.0)), 2)


def estimated_total_cost(
    price: ColumnOrName,
    hours: ColumnOrName,
    price_model: ColumnOrName,
    needs_hours: bool = True,
) -> Column:
    """Price of finishing: subscriptions are billed per started 40 hours.

    ``needs_hours`` makes the cost NULL whenever the hours are unknown; without it
    only subscriptions depend on them.
    """
    price, hours = col(price), col(hours)
    periods = F.ceil(hours / HOURS_PER_BILLING_PERIOD).cast("double")
    cost = F.when(
        ~F.coalesce(is_one_time(price_model), F.lit(False)) & is_subscription(price_model),
        F.round(price * periods, 2),
    ).otherwise(price)
    return F.when(hours.isNotNull(), cost) if needs_hours else cost


def value_score(
    rating: ColumnOrName,
    enrolled: ColumnOrName,
    total_cost: ColumnOrName,
    null_enrolled_is_zero: bool = False,
    positive_cost_only: bool = True,
) -> Column:
    """Popularity per unit of total cost; NULL when the cost is 0 (or negative)."""
    cost = col(total_cost)
    usable = F.when(cost > 0, cost) if positive_cost_only else F.nullif(cost, F.lit(0.0))
    count = _zero(col(enrolled), null_enrolled_is_zero)
    return F.round(col(rating) * F.log(count + 1) / usable, 2)
