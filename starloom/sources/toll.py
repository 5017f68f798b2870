"""The toll job: three files side by side, one column in upper case."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.staging_area import stage


def number_lines(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of a file read in line order, without sorting them.

    A line is placed by file, split and position inside the split. Only the sizes of the
    splits are ordered (one row per split, some 128 MB of text each).
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__serial"),
    )
    staged = stage(placed, "lines")
    splits = staged.groupBy("__file", "__block").agg(
        F.min("__serial").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    in_order = Window.orderBy("__file", "__block")
    starts = splits.select(
        "__file", "__block", "__first", (F.sum("__n").over(in_order) - F.col("__n")).alias("__start")
    )
    line = F.col("__start") + F.col("__serial") - F.col("__first") + 1
    return staged.join(F.broadcast(starts), ["__file", "__block"]).select(  # one row per split
        *[F.col(f"`{c}`") for c in df.columns], line.alias(name)
    )


def consolidate(vehicles: DataFrame, plazas: DataFrame, payments: DataFrame) -> DataFrame:
    """Pair the rows of the three files line by line; shorter files are padded with NULLs.

    The tables must come straight from the readers, which know the place of every line.
    """
    parts = [number_lines(df, "__line") for df in (vehicles, plazas, payments)]
    whole = reduce(lambda a, b: a.join(b, "__line", "full"), parts)
    return whole.orderBy("__line").select(*vehicles.columns, *plazas.columns, *payments.columns)


def upper_column(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.upper(column))
