"""Tables and views by name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions import fixed
from ..operators.shape import union_relations


def materialize(
    df: DataFrame, name: str, as_table: bool = False, mode: str = "overwrite", path: str | None = None
) -> DataFrame:
    """Register as a view (recomputed when read) or save as a table (computed once)."""
    if as_table:
        writer = df.write.mode(mode)
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _like(pattern: str) -> re.Pattern:
    """A SQL LIKE pattern, case ignored."""
    wild = {"%": ".*", "_": "."}
    return re.compile("".join(wild.get(ch, re.escape(ch)) for ch in pattern), re.IGNORECASE | re.DOTALL)


def relations_by_pattern(spark: SparkSession, schema: str, pattern: str, exclude: str = "") -> dict[str, DataFrame]:
    """Tables and views whose schema and name match LIKE patterns, in name order.

    Temporary views have no schema and are listed whatever the schema pattern.
    """
    schemas = [d.name for d in spark.catalog.listDatabases() if _like(schema).fullmatch(d.name)]
    names: dict[str, str] = {}
    for database in schemas or [spark.catalog.currentDatabase()]:
        for t in spark.catalog.listTables(database):
            if not t.isTemporary and database not in schemas:
                continue
            if _like(pattern).fullmatch(t.name) and not _like(exclude).fullmatch(t.name):
                names[t.name if t.isTemporary else f"{database}.{t.name}"] = t.name
    return {full: spark.table(full) for full in sorted(names)}


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> dict[str, DataFrame]:
    """Tables and views whose name starts with a prefix."""
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def union_by_pattern(
    spark: SparkSession, schema: str, pattern: str, exclude: str = "",
    source_column: str | None = fixed.SOURCE_COLUMN, **options,
) -> DataFrame:
    """Union of all relations that match a pattern."""
    return union_relations(
        relations_by_pattern(spark, schema, pattern, exclude), source_column=source_column, **options
    )
