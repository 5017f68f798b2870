"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import keep



def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
    ).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every end of an edge; component is the smallest id reachable.

    Each round hangs the larger neighbours of every vertex on its smallest neighbour, then the smaller ones, and
    writes the edges; it ends when a round changes nothing. Minima are taken before the shuffle and joined back, so no
    task holds a vertex with all its neighbours, and adaptive joins split a crowded one. NULL ends are left out. An
    empty table gives an empty result.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    current = keep(pairs, "edges")
    seen = _fingerprint(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # every u has edges to smaller ends only now
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        kept = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        current = keep(kept, "edges")
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    members = current.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    roots = current.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return members.unionByName(roots)
