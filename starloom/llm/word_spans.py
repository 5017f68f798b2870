"""Places and fingerprints of words in byte arrays, and bounded bit filters over fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import CHUNK_BYTES, LOWER, byte_groups, mix

BASE = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2**64
_tables: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; tables of up to 2 * CHUNK_BYTES are kept by the worker (two of 8 MB)."""
    kept = _tables.get(base)
    if kept is None or len(kept) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        kept = np.cumprod(steps)
        if len(kept) <= 2 * CHUNK_BYTES + 2:
            _tables[base] = kept
    return kept[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix polynomials: place i holds the sum of values[j] * BASE**j over j < i."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    return sums


def fingerprints(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp values of the runs [starts, ends), the same wherever a run stands (not mixed, without the length)."""
    return (sums[ends] - sums[starts]) * powers(pow(BASE, -1, 1 << 64), len(sums))[starts]


def word_places(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of bytes for which inside[byte] holds; no run crosses a row offset."""
    held = inside[data]
    before = np.zeros(len(data), bool)
    before[1:] = held[:-1]
    before[offsets[offsets < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = held[1:]
    after[offsets[(offsets > 0) & (offsets <= len(data))] - 1] = False
    return np.flatnonzero(held & ~before), np.flatnonzero(held & ~after) + 1


class Run(NamedTuple):
    """Whole rows of a text column, one after the other, with all their words."""

    first: int  # row of the batch at which the run begins
    data: np.ndarray  # bytes
    offsets: np.ndarray  # first byte of each row, one more at the end
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    hashes: np.ndarray  # of the words
    words: np.ndarray  # first word of each row, one more at the end

    def rows(self) -> np.ndarray:
        """The row (within the run) of every word."""
        return np.repeat(np.arange(len(self.words) - 1), np.diff(self.words))


def text_runs(column: pa.Array, inside: np.ndarray, lower: bool) -> Iterator[Run]:
    """The rows of a text column in runs of about CHUNK_BYTES; a longer row is a run of its own, hashed in pieces.

    Words are runs of bytes for which inside[byte] holds. With `lower` the bytes A-Z count as a-z. NULL is an empty text.
    """
    for first, _, data, offsets in byte_groups(column):
        data = LOWER[data] if lower else data
        starts, ends = word_places(data, offsets, inside)
        hashes = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):  # pieces of whole words: the tables of powers stay small
            base = int(starts[at])
            end = max(at + 1, int(np.searchsorted(ends, base + 2 * CHUNK_BYTES, "right")))
            piece = data[base:int(ends[end - 1])].astype(np.uint64) + np.uint64(1)
            a, b = starts[at:end] - base, ends[at:end] - base
            hashes[at:end] = mix(fingerprints(prefix_sums(piece), a, b) + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            at = end
        yield Run(first, data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))


# --- bounded filters --------------------------------------------------------------------------

BUCKET_BITS = 1 << 15  # of Spark's bitmap aggregate
MOST_BITS = 28  # 32 MB at most go through the driver and to the tasks, however many fingerprints there are


def bit_filter(found: DataFrame, column: str) -> np.ndarray:
    """Bits for the 64-bit values of a column, by their low bits: 32 times as many bits as values, 2**28 at most.

    A value that was put in always passes; others pass as often as bits are set. Beyond 2**28 / 32 values more of the others
    pass, which costs rows, never results: every user of the filter counts exactly afterwards.
    """
    n = found.count()
    size = 1 << min(MOST_BITS, max(18, (32 * n).bit_length()))
    place = F.pmod(F.col(column), F.lit(size))
    parts = found.select(place.alias("p")).groupBy(F.floor(F.col("p") / BUCKET_BITS).alias("k")).agg(
        F.bitmap_construct_agg(F.col("p") % BUCKET_BITS).alias("bits")).collect()  # at most 8,192 rows of 4 KB
    out = np.zeros(size // 8, np.uint8)
    for k, bits in parts:
        out[k * BUCKET_BITS // 8:(k + 1) * BUCKET_BITS // 8] = np.frombuffer(bits, np.uint8)
    return out


def passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each 64-bit value may be among those of the filter."""
    place = values & np.uint64(len(bits) * 8 - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
