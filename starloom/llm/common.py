"""What the corpus operators share: tables, the training split, text as byte arrays, word hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.operators.staging_area import stage

CHUNK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared staging area and read it back; adaptive execution decides how many files a shuffle leaves."""
    return stage(df, label)


Batches = Iterator[pa.RecordBatch]


def release_memory() -> None:
    """Hand memory that this Python worker has freed back to the system; workers live on, idle or for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function for mapInArrow that releases memory at the end of each partition."""
    def whole(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return whole


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str | Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text, modulo 4, is 2. False for NULL ids."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


BROADCAST_CLASSES = 100_000  # a label and a number each


def sample_per_class(rows: DataFrame, label: str, ident: str, n: int) -> DataFrame:
    """At most n rows of each label, those with the smallest hashes of `ident`, with their `place` in that order.

    Rows are counted per label first, and only those whose hash is low enough for a place (with room to spare) are ranked, so
    a label with many rows sends about 4 n of them to the task that ranks it. NULL labels are left out.
    """
    top = 1 << 31
    counts = keep(rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("__rows")), "classes")
    if counts.count() <= BROADCAST_CLASSES:
        counts = F.broadcast(counts)
    hashed = rows.join(counts, label).withColumn("__hash", F.pmod(F.xxhash64(ident), F.lit(top)))
    low = hashed.where(F.col("__hash").cast("double") * F.col("__rows") <= F.lit(float(top) * (4 * n + 64)))
    order = W.partitionBy(label).orderBy("__hash", ident)
    return low.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("__hash", "__rows")


# --- texts as bytes ---------------------------------------------------------------------------

def byte_groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole rows of about CHUNK_BYTES: (first row, end row, bytes, row offsets).

    NULL is an empty text. A longer text makes a run of its own.
    """
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


# --- hashes of words and shingles --------------------------------------------------------------

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    kept = _powers.get(name)
    if kept is None or len(kept) < n:
        size = max(n, CHUNK_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        kept = np.cumprod(steps)
        if size <= 4 * CHUNK_BYTES:
            _powers[name] = kept
    return kept[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _block_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of the words of a run of bytes; no word crosses a break."""
    inside = ~SPACE[data]
    before = np.empty(len(data), bool)
    before[0:1] = False
    before[1:] = inside[:-1]
    before[breaks[breaks < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    inner = breaks[(breaks > 0) & (breaks <= len(data))]
    after[inner - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * _power_table("up", BASE, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power_table("down", INVERSE, len(data) + 1)[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Start, end and hash of all words of a run of rows; a long row comes in pieces cut at white space.

    Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return; A-Z count as
    a-z in the hash.
    """
    if len(offsets) > 2 or len(data) <= 2 * CHUNK_BYTES:
        if len(data):
            yield _block_words(data, offsets)
        return
    at = 0
    while at < len(data):
        end = at + CHUNK_BYTES
        while end < len(data):
            gap = np.flatnonzero(SPACE[data[end:end + CHUNK_BYTES]])
            if len(gap):
                end += int(gap[0])
                break
            end += CHUNK_BYTES
        end = min(end, len(data))
        starts, ends, hashes = _block_words(data[at:end], np.zeros(1, np.int64))
        yield starts + at, ends + at, hashes
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a run of rows, and the place of each row's first word (one more at the end)."""
    blocks = list(word_blocks(data, offsets))
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    hashes = np.concatenate([b[2] for b in blocks])
    return hashes, np.searchsorted(np.concatenate([b[0] for b in blocks]), offsets)


def shingle_sets(words: np.ndarray, rows: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of k words of each row; a shorter row is one run; a row without words has none."""
    factor = np.uint64(0xA24BAED4963EE407)
    running = np.zeros(len(words), np.uint64)
    by_length = {}
    for length in range(1, k + 1):
        usable = max(0, len(words) - length + 1)
        running = running[:usable] * factor + words[length - 1:length - 1 + usable]
        by_length[length] = running
    long = mix(by_length[k] + np.uint64(k))
    out = []
    for start, end in zip(rows[:-1].tolist(), rows[1:].tolist()):
        n = end - start
        if n >= k:
            out.append(np.unique(long[start:end - k + 1]))
        elif n:
            out.append(mix(by_length[n][start:start + 1] + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_shingles(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and shingle sets of each run of rows."""
    for first, _, data, offsets in byte_groups(column):
        yield first, shingle_sets(*word_hashes(data, offsets), k)
