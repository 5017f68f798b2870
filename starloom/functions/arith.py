"""NULL- and zero-safe arithmetic, buckets and distances."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .core import ColumnOrName, col


def _terms(columns: Sequence[ColumnOrName]) -> list[Column]:
    if isinstance(columns, (str, Column)) or not columns:
        raise ValueError("pass a non-empty list of columns")
    return [F.coalesce(col(c), F.lit(0)) for c in columns]


def safe_add(columns: Sequence[ColumnOrName]) -> Column:
    """Sum across columns with NULL as 0."""
    return reduce(add, _terms(columns))


def safe_subtract(columns: Sequence[ColumnOrName]) -> Column:
    """First column minus the others with NULL as 0."""
    return reduce(sub, _terms(columns))


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Quotient, NULL for a zero denominator."""
    return col(numerator) / F.nullif(col(denominator), F.lit(0))


def width_bucket(value: ColumnOrName, low, high, buckets: int) -> Column:
    """Standard equi-width bucket: 0 below ``low``, ``buckets + 1`` from ``high`` on."""
    return F.width_bucket(col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets))


def haversine_distance(
    lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName, unit: str = "mi"
) -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = (col(c) for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians((lat2 - lat1) / 2))
    half_lon = F.sin(F.radians((lon2 - lon1) / 2))
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    miles = F.asin(F.sqrt(chord)) * (2 * fixed.EARTH_RADIUS_MILES)
    return miles * fixed.KM_PER_MILE if unit == "km" else miles
