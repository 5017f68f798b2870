"""Near-duplicate vectors by collision counting over sorted projections.

Tables t = 1..m each project the unit vectors on one random direction. In a table, two vectors collide if their projections lie
within a window centred on either, and if they lie in the same cell, cut by the signs of `bits` further directions: a window over
all rows would hold a fixed share of them, so pairs would grow with the square of the input, while a cell holds
about CELL rows at any size. Pairs that collide in at least COLLISIONS tables are verified by their cosine in double precision.

The number of tables is calibrated for recall: at the threshold a pair collides in one table with a known probability
(same signs, times the normal mass of the window), and m is the least for which COLLISIONS of m are reached with RECALL.

Equal vectors are one class, compared once. A crowded cell is dealt out in blocks, every pair of blocks to one task. A pair
is counted in the first table in which it collides, so its links are added up without pairs becoming rows: a task returns, per
vector, the number of links and one link into each component it saw.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import keep
from starloom.llm.components import connected_components

CELL = 192
COLLISIONS = 2
RECALL = 0.9995
WINDOW = 2.2  # half width of a window, in standard deviations of the projected difference at the threshold
BLOCK = 1024
COMPARED = 1 << 18
BROADCAST_CELLS = 200_000  # four numbers each
SEED = 20


def plan(n: int, threshold: float) -> tuple[int, int, float]:
    """(tables, sign bits, half width) for n vectors."""
    bits = max(0, min(40, math.floor(math.log2(max(n, 1) / CELL)))) if n > CELL else 0
    distance = math.sqrt(2 - 2 * threshold)
    same_sign = 1 - math.acos(threshold) / math.pi
    inside = 2 * NormalDist().cdf(WINDOW) - 1
    p = same_sign ** bits * inside
    tables = COLLISIONS
    while sum(math.comb(tables, k) * p ** k * (1 - p) ** (tables - k) for k in range(COLLISIONS)) > 1 - RECALL:
        tables += 1
    return tables, bits, WINDOW * distance


class Projections:
    """The directions of all tables for vectors of one length."""

    def __init__(self, size: int, tables: int, bits: int) -> None:
        rng = np.random.default_rng([SEED, size, tables, bits])
        self.tables, self.bits = tables, bits
        self.lines = rng.standard_normal((size, tables))
        self.signs = rng.standard_normal((size, tables * bits))

    def of(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells (whole numbers) and projections of unit vectors, one column per table."""
        positive = (unit @ self.signs > 0).reshape(len(unit), self.tables, self.bits)
        cells = (positive * (1 << np.arange(self.bits, dtype=np.int64))).sum(2)
        return cells.astype(np.int64), unit @ self.lines


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # no square overflows or vanishes
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def to_bytes(vector: list[float]) -> bytes:
    """A vector as bytes behind its width: 4-byte floats where they hold every component exactly, else 8-byte ones."""
    wide = np.array(vector, "<f8") + 0.0  # no negative zeros
    with np.errstate(over="ignore"):
        narrow = wide.astype("<f4")
    return b"\x04" + narrow.tobytes() if (narrow == wide).all() else b"\x08" + wide.tobytes()


def from_bytes(blobs: list[bytes]) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    return np.stack([np.frombuffer(b, f"<f{b[0]}", offset=1).astype(np.float64) for b in blobs])


def usable(column: str) -> Column:
    """Whether a vector has components, all of them finite, and not all zero."""
    return (F.col(column).isNotNull() & (F.size(column) > 0)
            & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(column, lambda x: x != 0))


def _spread(classes: DataFrame, tables: int, bits: int, cells_only: bool = False) -> DataFrame:
    """One row per class and table: table, size, cell, then id, copies, vector bytes unless `cells_only`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, Projections] = {}
        for batch in batches:
            ids, copies, blobs = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(1).to_pylist()
            sizes = np.array([(len(b) - 1) // b[0] for b in blobs])
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                for at in range(0, len(own), 512):
                    some = own[at:at + 512]
                    vectors = from_bytes([blobs[i] for i in some])
                    cells, _ = kept.setdefault(size, Projections(size, tables, bits)).of(_unit(vectors))
                    columns = [
                        pa.array(np.tile(np.arange(tables, dtype=np.int32), len(some))), pa.array(np.full(len(some) * tables, size, np.int32)),
                        pa.array(cells.ravel()), pa.array(np.repeat(ids[some], tables)), pa.array(np.repeat(copies[some], tables)),
                    ]
                    if not cells_only:
                        columns.append(pa.array([blobs[i] for i in some for _ in range(tables)], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "table int, size int, cell long, id long, copies long" + ("" if cells_only else ", vector binary")
    names = [c.split()[0] for c in schema.split(", ")]
    return classes.select("id", "vector", "copies").mapInArrow(run, schema)


def _cell_links(rows: pa.Table, threshold: float, tables: int, bits: int, half: float, made: dict) -> pa.RecordBatch | None:
    """Links counted in one block: (id, links, other), other being one vector of the component it was joined to."""
    order = np.argsort(rows.column("id").to_numpy(), kind="stable")
    ids, copies = rows.column("id").to_numpy()[order], rows.column("copies").to_numpy()[order]
    side = rows.column("side").to_numpy()[order]
    size, table = rows.column("size")[0].as_py(), rows.column("table")[0].as_py()
    l, r = rows.column("l")[0].as_py(), rows.column("r")[0].as_py()
    if len(ids) < 2:
        return None
    blobs = rows.column("vector").to_pylist()
    unit = _unit(from_bytes([blobs[i] for i in order]))
    cells, lines = made.setdefault(size, Projections(size, tables, bits)).of(unit)
    by_line = np.argsort(lines[:, table], kind="stable")
    value = lines[by_line, table]
    reach = np.searchsorted(value, value + half, "right") - np.arange(len(value)) - 1
    links, parent = np.zeros(len(ids), np.int64), np.arange(len(ids))
    starts, step = np.concatenate([[0], np.cumsum(reach)]), 0

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    while step < len(value):
        end = max(step + 1, int(np.searchsorted(starts, starts[step] + COMPARED, "right")) - 1)
        counts = reach[step:end]
        i = np.repeat(np.arange(step, min(end, len(value))), counts)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts)
        x, y = by_line[i], by_line[j]
        step = end
        if l != r:  # the two blocks of a crowded cell: pairs inside one block have their own task
            across = side[x] != side[y]
            x, y = x[across], y[across]
        hits = np.zeros(len(x), np.int32)
        first = np.ones(len(x), bool)
        for t in range(tables):
            together = (cells[x, t] == cells[y, t]) & (np.abs(lines[x, t] - lines[y, t]) <= half)
            hits += together
            if t < table:
                first &= ~together
        good = first & (hits >= COLLISIONS)
        x, y = x[good], y[good]
        close = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
        x, y = x[close], y[close]
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        for a, b in zip(x.tolist(), y.tolist()):
            p, q = top(a), top(b)
            if p != q:
                parent[max(p, q)] = min(p, q)
    found = np.flatnonzero(links)
    if not len(found):
        return None
    roots = np.array([top(i) for i in found.tolist()])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[found]), pa.array(links[found]), pa.array(ids[roots])], names=["id", "links", "other"])


def near_vectors(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    vectors needs vec_id (integer) and embedding (array of numbers); other columns are not read. n_links counts the other rows linked directly
    (cosine >= threshold, found with probability RECALL at the threshold and more above it), component_id is the smallest vec_id
    reachable, kept marks it. NULL, empty and zero vectors and those with NULL or non-finite components are linked with
    nothing, as are vectors of different lengths with each other. Repeated rows are linked with each other; rows with a NULL vec_id come out
    without links and component. An empty table gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = rows.where(F.col("vec_id").isNotNull() & usable("embedding"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [to_bytes(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["vec_id", "vector"])

    packed = keep(good.mapInArrow(pack, "vec_id long, vector binary"), "vectors")
    classes = keep(packed.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "classes")
    tables, bits, half = plan(classes.count(), threshold)
    spread = _spread(classes, tables, bits)
    cell = ["table", "size", "cell"]
    counts = _spread(classes, tables, bits, cells_only=True).groupBy(*cell).agg(F.count("*").alias("n"))
    crowded = keep(counts.where(F.col("n") > BLOCK).select(*cell, F.ceil(F.col("n") / BLOCK).cast("int").alias("cut")), "crowded")
    if crowded.count() <= BROADCAST_CELLS:
        crowded = F.broadcast(crowded)
    dealt = spread.join(crowded, cell, "left").withColumn("blocks", F.coalesce("cut", F.lit(1))).withColumn(
        "own", F.pmod(F.xxhash64("id", "table"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    work = dealt.select(*cell, "id", "copies", "vector", F.col("own").alias("side"), other.alias("o")).select(
        *cell, F.least("side", "o").alias("l"), F.greatest("side", "o").alias("r"), "side", "id", "copies", "vector")
    keys = [*cell, "l", "r"]
    work = work.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Projections] = {}
        pending: list[pa.RecordBatch] = []
        for batch in batches:
            pending.append(batch)
            whole = pa.Table.from_batches(pending).combine_chunks()
            cuts = _cuts(whole)
            for start, end in zip(cuts[:-1], cuts[1:]):
                if (one := _cell_links(whole.slice(start, end - start), threshold, tables, bits, half, made)) is not None:
                    yield one
            pending = whole.slice(cuts[-1]).to_batches() if cuts else []
        if pending and (one := _cell_links(pa.Table.from_batches(pending), threshold, tables, bits, half, made)) is not None:
            yield one

    found = keep(work.mapInArrow(run, "id long, links long, other long"), "links")
    parts = connected_components(found, "id", "other")
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    labelled = classes.join(sums, "id", "left").join(parts, "id", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    linked = packed.join(labelled, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where(~(F.col("vec_id").isNotNull() & usable("embedding"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _cuts(rows: pa.Table) -> list[int]:
    """Where each run of equal block keys starts."""
    change = np.zeros(rows.num_rows, bool)
    change[0:1] = True
    for i in range(5):
        column = rows.column(i).to_numpy()
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change).tolist()
