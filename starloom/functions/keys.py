"""Keys derived from column values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .core import ColumnOrName, col


def surrogate_key(columns: Sequence[ColumnOrName], nulls_as_empty: bool = False) -> Column:
    """md5 of the dash-joined text of the columns; NULLs hash as a reserved token."""
    token = F.lit("" if nulls_as_empty else fixed.SURROGATE_NULL)
    return F.md5(F.concat_ws("-", *[F.coalesce(col(c).cast("string"), token) for c in columns]))


def date_key(c: ColumnOrName) -> Column:
    """A date as the integer ``yyyymmdd``."""
    d = col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
