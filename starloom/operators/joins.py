"""Joins of the warehouse jobs. All are equi-joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import number_rows

# A dimension of at most this many (key, name) rows and bytes is hinted as broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20
SALTS = 32


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = 1000) -> DataFrame:
    """Keys that hold more than one ``share``-th of the rows: fewer than ``share`` of them."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(F.lit(1)).alias("__total"))
    return (
        counted.crossJoin(F.broadcast(total))  # one row
        .filter(F.col("__n") * share > F.col("__total"))
        .select(*keys)
    )


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", hot: DataFrame | None = None,
) -> DataFrame:
    """Inner or left join that spreads the left rows of hot keys over several tasks.

    The right rows of those keys are repeated once per salt; all other keys travel once.
    NULL keys match nothing and are spread as well. ``hot`` holds the hot keys if they are
    known already; by default they are counted on ``left``, which is then read twice.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    keys = list(keys)
    counted = hot_keys(left.select(*keys).dropna(), keys) if hot is None else hot
    hot = F.broadcast(counted.withColumn("__hot", F.lit(True)))  # fewer than 1,000 keys
    spread = F.pmod(F.xxhash64(*spreading(left, keys), F.spark_partition_id()), F.lit(SALTS))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    salted_left = (
        left.withColumn("__spread", spread)
        .join(hot, keys, "left")
        .withColumn("__salt", F.when(F.col("__hot") | missing, F.col("__spread")).otherwise(F.lit(0)))
        .drop("__hot", "__spread")
    )
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted_right = (
        right.join(hot, keys, "left")
        .withColumn("__salt", F.explode(F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0)))))
        .drop("__hot")
    )
    return salted_left.join(salted_right, [*keys, "__salt"], how).drop("__salt")


def spreading(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The columns beside the keys that can be hashed.

    With the source partition they spread the rows of a key that came out of a shuffle on it in one partition, and
    stay the same when a task is repeated; equal rows are spread by their partitions.
    """
    return [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in keys and "map<" not in f.dataType.simpleString()
            and "variant" not in f.dataType.simpleString()]


def lookup_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], right_rows: int | None = None, right_bytes: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join to a table with unique keys.

    With a known row count (and size, if given) the right side is broadcast up to ``BROADCAST_ROWS`` and
    ``BROADCAST_BYTES`` and the join salted beyond, by the ``hot`` keys if given. Without one Spark decides by the size it knows.
    """
    if right_rows is None:
        return left.join(right, list(keys), "left")
    if right_rows <= BROADCAST_ROWS and (right_bytes or 0) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), list(keys), "left")
    return salted_join(left, right, keys, "left", hot)


def match_rate(left: DataFrame, right: DataFrame, on: Mapping[str, str], key: str) -> DataFrame:
    """One row: joined rows in total and those that found a partner.

    Both sides are counted per join key first, so repeated keys multiply as in the plain
    join without being joined row by row.
    """
    left_keys, right_keys = list(on.keys()), list(on.values())
    a = left.groupBy(*left_keys).agg(F.count(F.lit(1)).alias("__left"))
    b = right.groupBy(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(right_keys)]).agg(
        F.count(F.lit(1)).alias("__right"), F.count(key).alias("__keys")
    )
    condition = [F.col(l) == F.col(f"__k{i}") for i, l in enumerate(left_keys)]
    joined = a.join(b, condition, "left")
    return joined.agg(
        F.sum(F.col("__left") * F.coalesce("__right", F.lit(1))).cast("long").alias("total"),
        F.sum(F.col("__left") * F.coalesce("__keys", F.lit(0))).cast("long").alias("matched"),
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL value has no parent.

    The distinct values meet the parents first, so a value held by a third of the rows
    travels once. The rows are then matched with the orphaned values, of which a sound
    table has none.
    """
    value = F.col(f"`{column}`")
    values = child.select(value.alias("__value")).filter("__value is not null").distinct()
    known = parent.select(F.col(f"`{field}`").alias("__value"))
    lost = values.join(known, "__value", "left_anti")
    return child.join(lost, value == F.col("__value"), "left_semi")


def only_new(incoming: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key has not been seen."""
    return incoming.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def patch(df: DataFrame, fixes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Overwrite columns for the keys present in ``fixes`` (unique keys), NULLs included."""
    keys = list(keys)
    renamed = fixes.select(
        *keys, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    joined = df.join(renamed, keys, "left")
    return joined.select(*[
        F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ])


def names_for_ids(
    df: DataFrame, key: str, ids: str, names: DataFrame, id_column: str, name_column: str,
    result: str, separator: str = ", ",
) -> DataFrame:
    """Replace an array of ids by the joined names, in array order; unknown ids are left out.

    ``key`` identifies the rows of ``df``. Rows without any known id get ``''``.
    """
    single = df.select(key, F.posexplode(ids).alias("__place", "__id"))
    lookup = names.select(F.col(id_column).alias("__id"), F.col(name_column).alias("__name"))
    named = (
        single.join(lookup, "__id")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("__place", "__name"))).alias("__names"))
        .select(key, F.array_join(F.col("__names.__name"), separator).alias(result))
    )
    joined = df.drop(ids).join(named, key, "left")
    return joined.withColumn(result, F.coalesce(result, F.lit("")))


def zip_rows(left: DataFrame, right: DataFrame, left_order: Sequence[Column | str], right_order: Sequence[Column | str]) -> DataFrame:
    """Pair the n-th rows of two tables; the longer one is padded with NULLs."""
    a = number_rows(left, left_order, "__line")
    b = number_rows(right, right_order, "__line")
    columns = [F.col(c) for c in left.columns] + [F.col(c) for c in right.columns]
    return a.join(b, "__line", "full").select("__line", *columns)
