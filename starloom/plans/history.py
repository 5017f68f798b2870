"""Slowly changing history: one row per version, validity as a half-open interval."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRACKED = ["title", "description", "skills", "course_url"]
KEY = ["course_id", "platform"]


def _when(as_of) -> Column:
    stamp = as_of if isinstance(as_of, Column) else F.lit(str(as_of))
    return stamp.cast("timestamp_ntz")


def first_snapshot(incoming: DataFrame, as_of) -> DataFrame:
    """History holding every incoming row as its first, open version."""
    return incoming.select(
        "*", _when(as_of).alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to")
    )


def merge_snapshot(
    history: DataFrame, incoming: DataFrame, as_of, key: Sequence[str] = KEY, tracked: Sequence[str] = TRACKED,
) -> DataFrame:
    """History after one more snapshot.

    New keys are inserted. Where a tracked column changed (NULL counts as a value) the
    open version is closed at ``as_of`` and the new one inserted. Unchanged rows are kept
    as they were, vanished keys stay open. Repeating a merge changes nothing. A key that is
    NULL (or partly NULL) is a key like any other.

    ``incoming`` must hold one row per key: a second one stops the job. Closed versions pass
    by without a shuffle; the open ones meet the incoming rows in a single join.
    """
    closed = history.filter("valid_to is not null")
    return closed.unionByName(changed_versions(history.filter("valid_to is null"), incoming, as_of, key, tracked))


def _match_columns(key: Sequence[str], prefix: str) -> dict[str, Column]:
    """Columns that are equal just where keys are, NULLs included: the key as text, and whether it is NULL."""
    texts = {f"{prefix}{i}": F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for i, k in enumerate(key)}
    return texts | {f"{prefix}{i}_null": F.isnull(F.col(f"`{k}`")) for i, k in enumerate(key)}


def one_row_per_key(incoming: DataFrame, key: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """The rows as they are; a key held by several of them raises when it is read. ``by`` names columns that stand for the key."""
    rows = F.count(F.lit(1)).over(Window.partitionBy(*(by or key)))
    message = F.concat(F.lit("several rows for one key: "), F.to_json(F.struct(*key)))
    checked = F.when(rows == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return incoming.withColumn("__once", checked).filter("__once").drop("__once")


def changed_versions(
    open_versions: DataFrame, incoming: DataFrame, as_of, key: Sequence[str] = KEY, tracked: Sequence[str] = TRACKED,
) -> DataFrame:
    """What becomes of the open versions after one more snapshot: kept, closed and new ones."""
    now = _when(as_of)
    columns = [c for c in open_versions.columns if c not in ("valid_from", "valid_to")]
    # one exchange of the incoming rows serves the check and the join, as both go by the same columns
    ours, theirs = _match_columns(key, "__o"), _match_columns(key, "__k")
    incoming = one_row_per_key(incoming.withColumns(theirs), key, list(theirs))
    old = open_versions.select(
        F.struct(*[F.col(c) for c in columns]).alias("__old"), F.col("valid_from").alias("__since"), *[c.alias(n) for n, c in ours.items()]
    )
    new = incoming.select(F.struct(*[F.col(c) for c in columns]).alias("__new"), *theirs)
    condition = reduce(and_, [F.col(a) == F.col(b) for a, b in zip(ours, theirs)])
    pairs = old.join(new, condition, "full")
    before, after = F.col("__old"), F.col("__new")
    unchanged = F.struct(*[before[c].alias(c) for c in tracked]).eqNullSafe(
        F.struct(*[after[c].alias(c) for c in tracked])
    )
    open_end = F.lit(None).cast("timestamp_ntz")

    def version(row: Column, start: Column, end: Column) -> Column:
        return F.struct(row.alias("row"), start.alias("valid_from"), end.alias("valid_to"))

    keep = version(before, F.col("__since"), open_end)
    close = version(before, F.col("__since"), now)
    insert = version(after, now, open_end)
    versions = (
        F.when(before.isNull(), F.array(insert))
        .when(after.isNull() | unchanged, F.array(keep))
        .otherwise(F.array(close, insert))
    )
    merged = pairs.select(F.explode(versions).alias("__v")).select("__v.row.*", "__v.valid_from", "__v.valid_to")
    return merged.select(*open_versions.columns)


def versions_of_changes(
    observed: DataFrame, key: Sequence[str], order_by: str, tracked: Sequence[str],
) -> DataFrame:
    """All versions from a log of observed states at once, as repeated merges of one snapshot each would leave them.

    A row whose tracked columns equal those of the key's row before it adds nothing; every other row is a version, valid
    from its own time to the next version's.
    """
    by = Window.partitionBy(*key).orderBy(order_by)
    state = F.struct(*tracked)
    changed = observed.withColumn("__before", F.lag(state).over(by)).filter(~state.eqNullSafe(F.col("__before"))).drop("__before")
    return changed.withColumn("valid_from", F.col(order_by)).withColumn("valid_to", F.lead(order_by).over(by))


def publish_snapshot(history: DataFrame, base: str, version: str) -> DataFrame:
    """Write a history to a new folder under ``base`` and read it from there.

    A table cannot be overwritten while it is read, so every run gets its own folder;
    readers take the latest finished one.
    """
    path = f"{base.rstrip('/')}/version={version}"
    history.write.mode("errorifexists").parquet(path)
    return history.sparkSession.read.schema(history.schema).parquet(path)
