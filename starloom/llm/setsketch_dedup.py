"""Near-duplicate documents by SetSketch registers.

Every document is the set of its distinct word shingles. A register keeps the smallest of one exponential variate per
element, on an exponentially spaced scale cut off at both ends. Registers of a union are the maxima of the parts'
registers, and two sets agree in a register about as often as their Jaccard similarity.

1. Documents with the same set become one class (grouped by a 128-bit digest of the whole set).
2. Runs of ROWS registers are hashed to bands. In each band bucket every class is paired with one leader, taken
   by a hash, so the pairs stay in proportion to the rows however large a bucket is.
3. A pair is kept if the similarity estimated jointly from its registers (maximum likelihood, with the known set
   sizes) is within MARGIN standard errors of the threshold; then both texts are read and the full sets compared.
4. Components of the confirmed links. In buckets that still hold several components the classes outside the bucket's
   largest component are held against all its members, in blocks of bounded size: a block first estimates pairs of different
   components from the registers; only the rows of likely pairs are sent again with their texts, and the block verifies
   those pairs until their components are joined. It returns only the links found: pairs never become rows there. Components
   are taken again.

With 28 bands of 5 registers a pair of similarity 0.8 shares a bucket with probability 0.99998.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import common
from starloom.llm.components import connected_components

BANDS, ROWS = 28, 5
REGISTERS = BANDS * ROWS
B, A, Q = 1.001, 20.0, (1 << 16) - 2  # spacing, rate and register limit of the sketch
MARGIN = 4.0
LEFT_BLOCK, MEMBER_BLOCK = 256, 2048  # rows of a block in step 4
LEFT_SHINGLES, MEMBER_SHINGLES = 1 << 19, 1 << 21  # and their shingles: some 4 and 16 MB of hashes, as much again of text
COMPARED = 1 << 14  # pairs compared at once inside a task


def _multipliers(n: int) -> np.ndarray:
    return common.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


MULTIPLIERS = _multipliers(REGISTERS)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per set; an empty set has all zeros."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    sizes = [len(sets[i]) for i in full]
    elements, starts = np.concatenate([sets[i] for i in full]), np.concatenate([[0], np.cumsum(sizes[:-1])]).astype(np.int64)
    minima = np.empty((len(full), REGISTERS), np.uint64)
    scratch = np.empty_like(elements)
    for i, factor in enumerate(MULTIPLIERS):
        np.multiply(elements, factor, out=scratch)
        minima[:, i] = np.minimum.reduceat(scratch, starts)
    variates = -np.log1p(-np.minimum((minima.astype(np.float64) + 0.5) / 2.0 ** 64, 1 - 2.0 ** -53)) / A
    out[full] = np.clip(np.floor(1.0 - np.log(variates) / np.log(B)), 0, Q + 1).astype(np.uint16)
    return out


def merge(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(left, right)


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and row; keys of different bands differ."""
    parts = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(values), 1))
    for i in range(ROWS):
        keys = common.mix(keys * np.uint64(0xA24BAED4963EE407) + parts[:, :, i])
    return keys


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood estimate of the Jaccard similarity of each pair of rows.

    With shares u and v of the two sizes, a register of the left is larger with probability p(u - v J), smaller with
    p(v - u J), where p(x) = -log_b(1 - x (b - 1) / b).
    """
    return _solve((left > right).sum(1), (left < right).sum(1), n_left, n_right)


def _solve(above: np.ndarray, below: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    total = (n_left + n_right).astype(np.float64)
    u, v = n_left / total, n_right / total
    same = REGISTERS - above - below
    scale, log_b = (B - 1) / B, np.log(B)

    def slope(j: np.ndarray) -> np.ndarray:
        x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        p, q = -np.log1p(-x * scale) / log_b, -np.log1p(-y * scale) / log_b
        dp, dq = -v * scale / (1 - x * scale) / log_b, -u * scale / (1 - y * scale) / log_b
        return above * dp / p + below * dq / q - same * (dp + dq) / np.maximum(1 - p - q, 1e-12)

    low, high = np.zeros(len(u)), np.minimum(np.minimum(u / v, v / u), 1.0)
    for _ in range(30):
        middle = (low + high) / 2
        up = slope(middle) > 0
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return (low + high) / 2


def keeps(estimated: np.ndarray, threshold: float) -> np.ndarray:
    """Whether an estimate leaves a similarity of at least the threshold possible."""
    return estimated >= threshold - MARGIN * np.sqrt(threshold * (1 - threshold) / REGISTERS)


# --- step 1 ---------------------------------------------------------------------------------

SKETCH = "doc_id long, text_key long, n_shingles long, digest_a long, digest_b long, registers binary"


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, hash of the text, set size, 128-bit digest of the set, registers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in common.text_shingles(batch.column(1), words):
                values = registers(sets)
                digests = [(common.mix(s).sum(dtype=np.uint64), common.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                           for s in sets]
                both = np.array(digests, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(sets)), batch.column(2).slice(first, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array([r.tobytes() for r in values], pa.binary()),
                ], names=["doc_id", "text_key", "n_shingles", "digest_a", "digest_b", "registers"])

    return docs.select("doc_id", "text", "text_key").mapInArrow(common.tidy(run), SKETCH)


# --- steps 2 and 3 --------------------------------------------------------------------------

def _bands(classes: DataFrame) -> DataFrame:
    """(key, id): the buckets of every class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_unpack(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))],
                    names=["key", "id"])

    return classes.select("id", "registers").mapInArrow(common.tidy(run), "key long, id long")


def _unpack(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that the registers leave possible."""
    side = classes.select("id", "n_shingles", "registers")
    joined = (pairs.join(side.toDF("a", "n_a", "r_a"), "a").join(side.toDF("b", "n_b", "r_b"), "b")
              .select("a", "b", "n_a", "n_b", "r_a", "r_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = estimate(_unpack(batch.column(4)), _unpack(batch.column(5)),
                                 batch.column(2).to_numpy(), batch.column(3).to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                    pa.array(keeps(found, threshold)))

    return joined.mapInArrow(common.tidy(run), "a long, b long")


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold: 100 * intersection >= percent * union."""
    joined = (pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
              .select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = (s for _, sets in common.text_shingles(batch.column(2), words) for s in sets)
            right = (s for _, sets in common.text_shingles(batch.column(3), words) for s in sets)
            good = []
            for x, y in zip(left, right):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared) and shared > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(good, pa.bool_()))

    return joined.mapInArrow(common.tidy(run), "a long, b long")


# --- step 4 ---------------------------------------------------------------------------------

BLOCK_COLUMNS = ["key", "l", "r", "id", "component", "is_left"]
BLOCK_SCHEMA = "key long, l int, r int, id long, component long, is_left boolean"


def _open_links(buckets: DataFrame, mates: DataFrame, texts: DataFrame, parts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between components that share a bucket of more than two members; a link more than is needed is left out.

    A block holds about LEFT_BLOCK and MEMBER_BLOCK rows at most, and fewer where they are large: LEFT_SHINGLES and MEMBER_SHINGLES.
    """
    placed = buckets.join(parts, "id", "left").join(mates.select("id", "n_shingles"), "id").select(
        "key", "id", F.coalesce("component", "id").alias("component"), "n_shingles")
    placed = common.keep(placed, "placed")
    groups = placed.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))

    def blocks(rows, shingles, most_rows, most_shingles):
        return F.ceil(F.greatest(rows / most_rows, shingles / most_shingles, F.lit(1.0))).cast("int")

    open_ = groups.groupBy("key").agg(
        F.count("*").alias("parts"), F.sum("n").alias("members"), F.sum("size").alias("shingles"),
        F.max_by(F.struct("component", "n", "size"), F.struct("n", "component")).alias("main"),
    ).where("parts > 1 and members > 2").select(
        "key", F.col("main.component").alias("main"),
        blocks(F.col("members") - F.col("main.n"), F.col("shingles") - F.col("main.size"), LEFT_BLOCK, LEFT_SHINGLES).alias("lefts"),
        blocks(F.col("members"), F.col("shingles"), MEMBER_BLOCK, MEMBER_SHINGLES).alias("rights"))
    rows = placed.drop("n_shingles").join(open_, "key")
    spread = F.xxhash64("id", "key")
    left = rows.where("component <> main").select(
        "key", F.pmod(spread, "lefts").cast("int").alias("l"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("r"),
        "id", "component", F.lit(True).alias("is_left"))
    right = rows.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("l"), F.pmod(spread, "rights").cast("int").alias("r"),
        "id", "component", F.lit(False).alias("is_left"))
    work = left.unionByName(right)

    def dealt(rows: DataFrame, more: DataFrame, columns: list[str]) -> DataFrame:
        whole = rows.join(more, "id").select(*BLOCK_COLUMNS, *columns)
        return whole.repartition("key", "l", "r").sortWithinPartitions("key", "l", "r")

    def likely_rows(rows: pa.Table) -> pa.RecordBatch:
        _, _, _, x, y, _ = _likely_pairs(rows, percent)
        return _one_batch(rows.select(BLOCK_COLUMNS).take(pa.array(np.union1d(x, y))))

    # registers first: only rows that may have a link in their block are sent again, with their texts
    some = common.keep(dealt(work, mates, ["n_shingles", "registers"]).mapInArrow(
        common.tidy(lambda batches: _by_block(batches, likely_rows)), BLOCK_SCHEMA), "likely")
    with_texts = mates.join(texts, "id")
    return dealt(some, with_texts, ["n_shingles", "registers", "text"]).mapInArrow(
        common.tidy(lambda batches: _by_block(batches, lambda rows: _block_links(rows, words, percent))), "a long, b long")


def _one_batch(rows: pa.Table) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in rows.columns], names=rows.column_names)


def _by_block(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """work(rows) of every run of equal (key, l, r); the parts of a run are put together once, at its end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = _cuts(batch, held[-1] if held else None)
        for start, end in zip([0, *cuts], cuts):
            if start < end:
                held.append(batch.slice(start, end - start))
            if held:
                yield work(pa.Table.from_batches(held).combine_chunks())
            held = []
        held.append(batch.slice(cuts[-1] if cuts else 0))
    if held:
        yield work(pa.Table.from_batches(held).combine_chunks())


def _cuts(rows: pa.RecordBatch, before: pa.RecordBatch | None) -> list[int]:
    """Where runs of equal (key, l, r) begin that do not go on from the row before; with no row before the first one does not count."""
    keys = [rows.column(i).to_numpy() for i in range(3)]
    change = np.zeros(rows.num_rows, bool)
    if before is not None:
        change[0] = any(k[0] != before.column(i)[-1].as_py() for i, k in enumerate(keys))
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change).tolist()


def _likely_pairs(rows: pa.Table, percent: int) -> tuple[np.ndarray, ...]:
    """ids, components, set sizes, then places and estimates of the likely pairs that have their first common bucket here."""
    ids, parts = rows.column("id").to_numpy(), rows.column("component").to_numpy()
    sizes, is_left = rows.column("n_shingles").to_numpy(), rows.column("is_left").to_numpy()
    values, key = _unpack(rows.column("registers")), rows.column("key")[0].as_py()
    x, y, likely = _candidates(values, sizes, parts, is_left.astype(bool), percent / 100)
    if len(x):  # a pair is taken up in the first bucket that it shares
        first = (values[x] == values[y]).reshape(-1, BANDS, ROWS).all(2).argmax(1)
        own = band_keys(values).view(np.int64)[x, first] == key
        x, y, likely = x[own], y[own], likely[own]
    return ids, parts, sizes, x, y, likely


def _block_links(rows: pa.Table, words: int, percent: int) -> pa.RecordBatch:
    """Confirmed links of one block, the likeliest pairs first; pairs whose components are joined by then are passed over."""
    ids, parts, _, x, y, likely = _likely_pairs(rows, percent)
    order = np.argsort(-likely, kind="stable")
    x, y = x[order], y[order]
    parent: dict[int, int] = {}

    def top(part: int) -> int:
        while (above := parent.get(part, part)) != part:
            parent[part] = parent.get(above, above)
            part = above
        return part

    texts = rows.column("text")
    sets: dict[int, np.ndarray] = {}

    def elements(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = next(common.text_shingles(pa.array([texts[i].as_py()]), words))[1][0]
        return sets[i]

    links = []
    for i, j in zip(x.tolist(), y.tolist()):
        p, q = top(int(parts[i])), top(int(parts[j]))
        if p != q:
            shared = len(np.intersect1d(elements(i), elements(j), assume_unique=True))
            if 100 * shared >= percent * (len(elements(i)) + len(elements(j)) - shared):
                parent[max(p, q)] = min(p, q)
                links.append((ids[i], ids[j]))
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())],
                                      names=["a", "b"])


def _candidates(values: np.ndarray, sizes: np.ndarray, parts: np.ndarray, is_left: np.ndarray, threshold: float
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and estimates of the likely pairs of a left and a right row of different components."""
    lefts, rights = np.flatnonzero(is_left), np.flatnonzero(~is_left)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
    step = max(1, COMPARED // max(1, len(rights)))
    for at in range(0, len(lefts), step):
        some = lefts[at:at + step]
        x, y = np.repeat(some, len(rights)), np.tile(rights, len(some))
        apart = parts[x] != parts[y]
        x, y = x[apart], y[apart]
        if len(x):
            likely = estimate(values[x], values[y], sizes[x], sizes[y])
            good = keeps(likely, threshold)
            found.append((x[good], y[good], likely[good]))
    x, y, likely = (np.concatenate(c) for c in zip(*found))
    return x, y, likely


# --- the operator ---------------------------------------------------------------------------

def _assign(sketched: DataFrame, classes: DataFrame, parts: DataFrame) -> DataFrame:
    """The component of every document, through its class."""
    labelled = classes.join(parts, "id", "left").select(
        "digest_a", "digest_b", "n_shingles", F.coalesce("component", "id").alias("component"))
    members = sketched.select("doc_id", "n_shingles", "text_key", "digest_a", "digest_b").join(
        labelled, ["digest_a", "digest_b", "n_shingles"], "left")
    component = F.coalesce("component", "doc_id")
    return members.select("doc_id", "n_shingles", component.alias("component_id"),
                          (F.col("doc_id") == component).alias("kept"), "text_key")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document id: doc_id, n_shingles, component_id, kept.

    docs needs doc_id (integer) and text; other columns are not read. Links: 100 * |intersection| >= percent * |union| of the
    distinct shingles of `words` words. component_id is the smallest doc_id reachable, kept marks that document.
    NULL, empty and blank texts have no shingles and are linked with nothing; rows with a NULL doc_id are left out; rows
    that repeat a doc_id come out once, judged by the text with the most shingles (ties: by its hashes). An empty table
    gives an empty result.
    """
    return _judged(docs, words, percent).drop("text_key")


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, that stay when one document of each group of near copies is kept.

    Rows that repeat a doc_id with other texts are judged one by one: each is a document of its own here. Of rows that repeat both
    doc_id and text one stays. Rows with a NULL doc_id stay as they are; an empty table stays empty.
    """
    ident, key, unit = (common.free_name(docs, name) for name in ("own_id", "own_key", "own_unit"))
    rows = docs.where("doc_id is not null").withColumns({ident: F.col("doc_id").cast("long"), key: F.xxhash64("text")})
    several = rows.groupBy(ident).agg(F.min(key).alias("first"), F.max(key).alias("last")).where("first <> last")
    several = common.keep(several.select(F.col(ident).alias("id"), "first"), "several")
    rows = rows.alias("d").join(several.alias("s"), F.col(f"d.{ident}") == F.col("s.id"), "left")
    # the first text of an id keeps it, the others take a number from id and text
    other = F.col("s.first").isNotNull() & (F.col("s.first") != F.col(f"d.{key}"))
    rows = rows.select("d.*", F.when(other, F.xxhash64(f"d.{ident}", f"d.{key}")).otherwise(F.col(f"d.{ident}")).alias(unit))
    kept = _judged(rows.select(F.col(unit).alias("doc_id"), "text"), words, percent).where("kept").select(F.col("doc_id").alias("kept_unit"))
    one = rows.alias("d").join(kept.alias("k"), F.col(f"d.{unit}") == F.col("k.kept_unit"), "left_semi").dropDuplicates([unit])
    return one.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def _judged(docs: DataFrame, words: int, percent: int) -> DataFrame:
    threshold = percent / 100
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
                       ).where("doc_id is not null")
    columns = ["n_shingles", "text_key", "digest_a", "digest_b", "registers"]
    sketched = sketch(docs, words).groupBy("doc_id").agg(F.max(F.struct(*columns)).alias("s")).select("doc_id", "s.*")
    sketched = common.keep(sketched, "sketch")
    classes = (sketched.where("n_shingles > 0").groupBy("digest_a", "digest_b", "n_shingles")
               .agg(F.min(F.struct("doc_id", "text_key", "registers")).alias("m"))
               .select(F.col("m.doc_id").alias("id"), "m.text_key", "n_shingles", "m.registers", "digest_a", "digest_b"))
    classes = common.keep(classes, "classes")
    bands = _bands(classes)
    leaders = bands.groupBy("key").agg(
        F.min_by("id", F.xxhash64("id", "key")).alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    crowded = common.keep(bands.join(leaders, "key"), "buckets")
    pairs = common.keep(crowded.where("id <> leader").select(
        F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct(), "pairs")
    mates = classes.select("id", "text_key", "n_shingles", "registers").join(crowded.select("id").distinct(), "id", "left_semi")
    texts = docs.select(F.col("doc_id").alias("id"), "text_key", "text").join(mates.select("id", "text_key"), ["id", "text_key"], "left_semi")
    texts = common.keep(texts.select("id", "text").dropDuplicates(["id"]), "texts")
    links = common.keep(_confirm(_likely(pairs, classes, threshold), texts, words, percent), "links")
    found = _open_links(crowded.select("key", "id"), mates.select("id", "n_shingles", "registers"), texts, connected_components(links),
                        words, percent)
    return _assign(sketched, classes, connected_components(links.unionByName(found)))
