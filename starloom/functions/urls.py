"""URL parts by string surgery, so that URLs without a scheme work too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import ColumnOrName, blank_to_null, col


def _without(c: Column, *schemes: str) -> Column:
    for scheme in schemes:
        c = F.replace(c, F.lit(scheme), F.lit(""))
    return c


def _part(c: Column, delimiter: str, n: int) -> Column:
    return F.split_part(c, F.lit(delimiter), F.lit(n))


def url_host(c: ColumnOrName) -> Column:
    """Text before the first ``/`` or ``?`` once the scheme is gone."""
    bare = _without(col(c), "android-app://", "http://", "https://")
    return _part(_part(bare, "/", 1), "?", 1)


def url_path(c: ColumnOrName) -> Column:
    """Text after the first ``/`` up to ``?``.

    Without a ``/`` the text from ``?`` on is taken (which is empty); with neither,
    the whole string is returned.
    """
    bare = _without(col(c), "http://", "https://")
    slash = F.position(F.lit("/"), bare)
    cut = F.coalesce(F.nullif(slash, F.lit(0)), F.position(F.lit("?"), bare) - 1)
    rest = F.substr(bare, F.greatest(cut, F.lit(0)) + 1)
    return _part(rest, "?", 1)


def url_parameter(c: ColumnOrName, name: str) -> Column:
    """Text after the first ``name=`` up to ``&``; NULL when empty or absent.

    The match is a plain substring: ``xname=`` is found as well.
    """
    return blank_to_null(_part(_part(col(c), f"{name}=", 2), "&", 1))


def url_slug(c: ColumnOrName) -> Column:
    """Course slug: what follows ``/course/``, ``/school/`` or ``/degree/``."""
    url = col(c)

    def after(kind: str) -> Column:
        rest = _part(url, f"/{kind}/", 2)
        slug = F.regexp_replace(_part(_part(rest, "?", 1), "#", 1), "^/+|/+$", "")
        return F.when(F.contains(url, F.lit(f"/{kind}/")), slug)

    return F.coalesce(after("course"), after("school"), after("degree"))


def url_site_path(candidates: list[ColumnOrName], site: str, default: Column) -> Column:
    """First candidate that is a path (``/...``) or lies under ``site``, as a path."""
    paths = []
    for c in candidates:
        text = col(c)
        paths.append(
            F.when(F.startswith(text, F.lit(site)), F.replace(text, F.lit(site), F.lit("")))
            .when(F.startswith(text, F.lit("/")), text)
        )
    return F.coalesce(*paths, default)
