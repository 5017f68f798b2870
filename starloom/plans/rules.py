"""Rule sets for NULLs, unknowns and dirty values.

The two published forms of the warehouse disagree on these; ``DEFAULT`` takes one
reading of each.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    leading_number_only: bool  # durations: only a number at the start of the text counts
    drop_null_ids: bool  # rows without a course_id are dropped from the first feed
    lenient_dates: bool  # unreadable month/day/year dates become NULL instead of failing
    clamp_rating: bool  # ratings outside 0..5 are NULL in the row (scores see the raw one)
    null_enrolled_is_zero: bool  # in the popularity and value scores
    null_reviews_is_zero: bool  # in the engagement rate
    cost_needs_hours: bool  # total cost is NULL whenever the hours are
    positive_cost_only: bool  # no value score for a negative total cost
    unknown_member: bool  # every dimension has a -1 row; known members are 1..n
    unknown_key: bool  # every unmatched foreign key is -1 (else NULL for five of them)


LOCAL = Rules(
    leading_number_only=False, drop_null_ids=False, lenient_dates=False, clamp_rating=False,
    null_enrolled_is_zero=False, null_reviews_is_zero=True, cost_needs_hours=True,
    positive_cost_only=False, unknown_member=False, unknown_key=False,
)

CLOUD = Rules(
    leading_number_only=True, drop_null_ids=True, lenient_dates=True, clamp_rating=True,
    null_enrolled_is_zero=True, null_reviews_is_zero=False, cost_needs_hours=False,
    positive_cost_only=True, unknown_member=True, unknown_key=True,
)

DEFAULT = Rules(
    leading_number_only=False, drop_null_ids=True, lenient_dates=True, clamp_rating=True,
    null_enrolled_is_zero=False, null_reviews_is_zero=True, cost_needs_hours=True,
    positive_cost_only=True, unknown_member=True, unknown_key=True,
)
