"""Passages of many words that occur more than once, found by suffix trees over parts of the suffixes.

A window is `width` consecutive words of a document. Every word that a window covers goes if the words of that window also start
anywhere else. The suffixes of all documents are never in one place:

1. Anchors. Of the runs of GRAM words inside a window the one with the smallest hash is the window's anchor. Equal windows have
   their anchor at the same place, so a window can only repeat if its anchor does, and one word in about fourteen is an
   anchor. Anchor hashes are counted; those met once drop out. What is left is the list of prefixes.
2. Groups. The suffix that begins at an anchor goes to the group of its prefix, the anchor's GRAM words, with the words on its left
   that a window can reach. A prefix with more than MOST suffixes is made longer: its windows are suffixes of their own there and
   go by a prefix of all `width` words, counted before and after the shuffle, so that no task ever holds a group of unbounded size.
3. Subtrees. Inside a task the suffixes of a group are sorted by their words; the common lengths of neighbours (LCP) are the depths
   of the inner nodes of the subtree. The same is done with the words on the left, read backwards. Two suffixes that share a node of
   depth r on the right and one of depth l on the left lie in a repeat of l + r words: with l + r = width the window l words
   before the anchor is repeated. Words are compared as texts, not as hashes.
4. Each repeat becomes one interval of word places of its text; equal texts have equal intervals. Documents are joined with the
   intervals of their text and written without the covered words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import SPACE, mix, tidy
from starloom.llm.word_spans import Run, bit_filter, fingerprints, passes, prefix_sums, text_runs
from starloom.operators.staging_area import stage

INSIDE = ~SPACE
GRAM = 8  # words of an anchor
MOST = 1 << 15  # suffixes of a group that a task may hold: some 13 MB of words and 50 MB of numbers
TOGETHER = 8192  # suffixes whose groups are worked on at once
SLICE = 1 << 17  # windows looked at at once
LONG_WORD = 64  # bytes; a longer word stands as the 128-bit digest of its bytes


def _least(values: np.ndarray, span: int, best) -> np.ndarray:
    """best (minimum or maximum) of each `span` values in a row, by doubling."""
    reach, out = 1, values
    while reach < span:
        step = min(reach, span - reach)
        out = best(out[:-step], out[step:])
        reach += step
    return out


def window_minima(run: Run, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each GRAM words, smallest of them in each window); windows that leave their row have 0, no hash is 0."""
    n = len(run.starts)
    grams, low = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if n >= width:
        parts = []
        for a in range(0, n - GRAM + 1, SLICE):
            b = min(a + SLICE + GRAM - 1, n)
            first = np.arange(b - a - GRAM + 1)
            parts.append(mix(fingerprints(prefix_sums(run.hashes[a:b]), first, first + GRAM)) | np.uint64(1))
        grams = np.concatenate(parts)
        low = _least(grams, width - GRAM + 1, np.minimum)
        rows = run.rows()
        low[rows[:n - width + 1] != rows[width - 1:]] = 0
    return grams, low


def anchors(grams: np.ndarray, low: np.ndarray, width: int) -> np.ndarray:
    """Places of the runs that are the smallest of some window (ties: all of them)."""
    if not len(low):
        return np.zeros(0, np.int64)
    reach = width - GRAM
    padded = np.concatenate([np.zeros(reach, np.uint64), low, np.zeros(reach, np.uint64)])
    return np.flatnonzero(_least(padded, reach + 1, np.maximum) == grams)


def _repeated_prefixes(docs: DataFrame, width: int) -> DataFrame:
    """(prefix, n) of the anchors that stand at more than one place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_runs(batch.column(0), INSIDE, False):
                grams, low = window_minima(part, width)
                values, n = np.unique(grams[anchors(grams, low, width)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["prefix", "n"])

    counted = docs.select("text").mapInArrow(tidy(run), "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
    return stage(counted.where("n > 1"), "prefixes")


# --- texts of words ---------------------------------------------------------------------------

class Words:
    """The words of a run of rows, joined by one space within each row, so that any words in a row are one slice of bytes."""

    def __init__(self, run: Run):
        lengths = run.ends - run.starts
        if len(lengths) and lengths.max() > LONG_WORD:
            short = [_short(run.data[a:b].tobytes()) for a, b in zip(run.starts.tolist(), run.ends.tolist())]
            self.bytes, lengths = b" ".join(short), np.array([len(w) for w in short])
        else:
            self.bytes = _joined(run, np.ones(len(run.starts), bool), np.arange(len(run.starts)) < len(run.starts) - 1)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths

    def slices(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The words from first up to and including last, for each pair."""
        return [self.bytes[a:b] for a, b in zip(self.starts[first].tolist(), self.ends[last].tolist())]


def _short(word: bytes) -> bytes:
    """A word for comparison: itself, or a mark that no word holds and the digest of a long one."""
    return word if len(word) <= LONG_WORD else b"\r" + hashlib.blake2b(word, digest_size=16).hexdigest().encode()


def _joined(run: Run, kept: np.ndarray, spaced: np.ndarray) -> bytes:
    """The kept words, one after the other, with a space after those that are `spaced`."""
    # the byte behind a word is white space or, at a row's end, the next row's first byte; a copy of the bytes takes a space there
    lengths = (run.ends - run.starts)[kept]
    out_lengths = lengths + spaced[kept]
    ends = np.cumsum(out_lengths)
    total = int(ends[-1]) if len(ends) else 0
    place = np.repeat(run.starts[kept] - (ends - out_lengths), out_lengths) + np.arange(total)
    out = run.data[np.minimum(place, max(len(run.data) - 1, 0))] if total else np.zeros(0, np.uint8)
    out[ends[spaced[kept]] - 1] = 32
    return out.tobytes()


# --- suffixes and windows ---------------------------------------------------------------------

TEXT_KEY = "text_a long, text_b long"
SUFFIXES = f"prefix long, {TEXT_KEY}, place long, n_left int, words binary"
WINDOWS = f"words binary, {TEXT_KEY}, place long"


def keyed(docs: DataFrame) -> DataFrame:
    """`docs` with a 128-bit key of the text."""
    return docs.withColumn("text_a", F.xxhash64("text")).withColumn("text_b", F.xxhash64(F.lit(35), "text"))


def _suffixes(docs: DataFrame, width: int, repeated, crowded) -> DataFrame:
    """SUFFIXES: the suffixes at repeated anchors with the words that their windows reach, without those of crowded prefixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_runs(batch.column(0), INSIDE, False):
                grams, low = window_minima(part, width)
                at = anchors(grams, low, width)
                at = at[passes(repeated.value, grams[at]) & ~passes(crowded.value, grams[at])]
                if not len(at):
                    continue
                row = np.searchsorted(part.words, at, "right") - 1
                left = np.minimum(at - part.words[row], width - GRAM)
                last = np.minimum(at + width, part.words[row + 1]) - 1
                words = Words(part).slices(at - left, last)
                source = pa.array(part.first + row)
                for k in range(0, len(at), 1 << 14):
                    cut = slice(k, k + (1 << 14))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(grams[at[cut]].view(np.int64)), *(batch.column(c).take(source[cut]) for c in (1, 2)),
                        pa.array((at - part.words[row])[cut]), pa.array(left[cut].astype(np.int32)), pa.array(words[cut], pa.binary()),
                    ], names=[c.split()[0] for c in SUFFIXES.split(", ")])

    return docs.select("text", "text_a", "text_b").mapInArrow(tidy(run), SUFFIXES)


def _windows(docs: DataFrame, width: int, crowded) -> DataFrame:
    """WINDOWS: the windows whose anchor is a crowded prefix, keyed by all their words (their 128-bit digest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_runs(batch.column(0), INSIDE, False):
                _, low = window_minima(part, width)
                at = np.flatnonzero((low != 0) & passes(crowded.value, low))
                if not len(at):
                    continue
                row = np.searchsorted(part.words, at, "right") - 1
                keys = [hashlib.blake2b(w, digest_size=16).digest() for w in Words(part).slices(at, at + width - 1)]
                source = pa.array(part.first + row)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.binary()), *(batch.column(c).take(source) for c in (1, 2)), pa.array(at - part.words[row]),
                ], names=[c.split()[0] for c in WINDOWS.split(", ")])

    return docs.select("text", "text_a", "text_b").mapInArrow(tidy(run), WINDOWS)


# --- subtrees ---------------------------------------------------------------------------------

class Subtree:
    """Leaves sorted by their words, and the length of the common beginning of each with the one before it.

    The inner nodes of depth d are the runs of neighbours that have d words in common.
    """

    def __init__(self, groups: np.ndarray, words: np.ndarray):
        self.order = np.lexsort([*words.T[::-1], groups])
        leaves, group = words[self.order], groups[self.order]
        unequal = leaves[1:] != leaves[:-1]
        common = np.where(unequal.any(1), unequal.argmax(1), words.shape[1])
        self.common = np.where(group[1:] == group[:-1], common, -1)

    def nodes(self, depth: int) -> np.ndarray:
        """For every leaf, in the order in which they were given, the number of its node of this depth."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.concatenate([[0], np.cumsum(self.common < depth)])[:len(self.order)]
        return out


def repeats(groups: np.ndarray, left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) number of words by which a repeated window of each suffix begins before its anchor; -1 for none.

    `left` and `right` hold numbers of words, nearest first; numbers below zero stand for no word and are all different.
    """
    forward, back = Subtree(groups, right), Subtree(groups, left)
    low, high = np.full(len(groups), -1), np.full(len(groups), -1)
    for before in range(left.shape[1] + 1):
        pair = back.nodes(before) * len(groups) + forward.nodes(width - before)
        _, which, n = np.unique(pair, return_inverse=True, return_counts=True)
        again = n[which] > 1
        low[again & (low < 0)] = before
        high[again] = before
    return low, high


def _word_matrices(words: pa.Array, n_left: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words left of the anchors (nearest first) and from the anchors on, one row per suffix."""
    lists = pc.split_pattern(words.cast(pa.large_string()), " ")
    numbers = lists.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy())
    starts = np.concatenate([[0], ends[:-1]])
    none = -1 - np.arange(len(starts))[:, None]
    at = (starts + n_left)[:, None] + np.arange(width)
    right = np.where(at < ends[:, None], numbers[np.minimum(at, len(numbers) - 1)], none)
    at = (starts + n_left)[:, None] - 1 - np.arange(width - GRAM)
    left = np.where(at >= starts[:, None], numbers[np.maximum(at, 0)], none)
    return left, right


INTERVALS = f"{TEXT_KEY}, start long, stop long"


def _intervals_of_groups(suffixes: DataFrame, width: int) -> DataFrame:
    """INTERVALS of the repeats of all groups; the rows of a prefix are in one task, a few groups of them in memory."""
    def found(rows: pa.RecordBatch) -> pa.RecordBatch:
        n_left = rows.column(4).to_numpy().astype(np.int64)
        left, right = _word_matrices(rows.column(5), n_left, width)
        low, high = repeats(rows.column(0).to_numpy(), left, right, width)
        place = rows.column(3).to_numpy()
        return pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), pa.array(place - high), pa.array(place - low + width)],
                                          names=[c.split()[0] for c in INTERVALS.split(", ")]).filter(pa.array(low >= 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0  # rows from the beginning of a group on
        for batch in batches:
            prefixes = batch.column(0).to_numpy()
            new = np.flatnonzero(prefixes[1:] != prefixes[:-1]) + 1
            if held and len(prefixes) and held[-1].column(0)[-1].as_py() != prefixes[0]:
                new = np.concatenate([[0], new])
            begun = 0
            for cut in new.tolist():  # a place between two groups
                if n + cut - begun >= TOGETHER or cut == new[-1] and n + cut - begun >= TOGETHER // 2:
                    yield found(_one([*held, batch.slice(begun, cut - begun)]))
                    held, n, begun = [], 0, cut
            if begun < len(prefixes):
                held.append(batch.slice(begun))
                n += len(prefixes) - begun
        if n:
            yield found(_one(held))

    dealt = suffixes.repartition("prefix").sortWithinPartitions("prefix")
    return dealt.mapInArrow(tidy(run), INTERVALS)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def repeated_intervals(docs: DataFrame, width: int = 35) -> DataFrame:
    """(text_a, text_b, intervals): for every text with repeated windows the word places [start, stop) that they cover. Staged."""
    context = docs.sparkSession.sparkContext
    texts = keyed(docs.select("text"))
    prefixes = _repeated_prefixes(texts, width)
    crowded = prefixes.where(F.col("n") > MOST)
    repeated, hot = context.broadcast(bit_filter(prefixes, "prefix")), context.broadcast(bit_filter(crowded, "prefix"))
    found = _intervals_of_groups(_suffixes(texts, width, repeated, hot), width)
    if not crowded.isEmpty():
        windows = stage(_windows(texts, width, hot), "windows")
        again = windows.groupBy("words").agg(F.count("*").alias("n")).where("n > 1").select("words")
        found = found.unionByName(windows.join(again, "words", "left_semi").select(
            "text_a", "text_b", F.col("place").alias("start"), (F.col("place") + width).alias("stop")))
    # intervals that meet become one: a text has few of them then, however many of its windows are repeated
    text = W.partitionBy("text_a", "text_b").orderBy("start", "stop")
    before = F.max("stop").over(text.rowsBetween(W.unboundedPreceding, -1))
    apart = found.distinct().withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1))
    islands = apart.withColumn("island", F.sum("new").over(text.rowsBetween(W.unboundedPreceding, 0)))
    merged = islands.groupBy("text_a", "text_b", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return stage(merged.groupBy("text_a", "text_b").agg(F.collect_list(F.struct("start", "stop")).alias("intervals")), "intervals")


# --- documents --------------------------------------------------------------------------------

def _covered(run: Run, intervals: pa.Array) -> np.ndarray:
    """Whether each word of a run lies in an interval of its row; `intervals` is a list of (start, stop) per row or NULL."""
    change = np.zeros(len(run.starts) + 1, np.int64)
    items = intervals.flatten()
    first = np.repeat(run.words[:-1], pc.fill_null(pc.list_value_length(intervals), 0).to_numpy())
    if len(items):
        starts, stops = items.field(0).to_numpy(), items.field(1).to_numpy()
        np.add.at(change, first + starts, 1)
        np.add.at(change, first + stops, -1)
    return np.cumsum(change[:-1]) > 0


REPORT = "n_words long, n_removed long, kept string"


def without_repeats(docs: DataFrame, width: int = 35) -> DataFrame:
    """doc_id and REPORT of every document: its words without those covered by a window of `width` words that starts elsewhere too.

    Words are runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return, compared as they are.
    `kept` joins the words that stay by one space. Windows are judged on the input. NULL and empty texts and those of fewer
    than `width` words lose nothing. A window that starts twice in one text is repeated, so a text of one word again and again goes as
    a whole, and so do texts of at least `width` words in rows that repeat them, whether or not they share a doc_id. Columns other than doc_id and
    text are not read, whatever their names. An empty table gives no rows. A long text is one run of memory of about ten times its bytes.
    """
    cover = repeated_intervals(docs, width)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_runs(batch.column(1), INSIDE, False):
                m = len(part.offsets) - 1
                gone = _covered(part, batch.column(2).slice(part.first, m))
                n_words = np.diff(part.words)
                before = np.concatenate([[0], np.cumsum(gone)])
                n_gone = before[part.words[1:]] - before[part.words[:-1]]
                stays, rows = np.flatnonzero(~gone), part.rows()
                spaced = np.zeros(len(gone), bool)  # a later word of the row stays
                spaced[stays[:-1]] = rows[stays[:-1]] == rows[stays[1:]]
                whole = _joined(part, ~gone, spaced)
                sizes = np.zeros(m, np.int64)
                np.add.at(sizes, rows[stays], (part.ends - part.starts + spaced)[stays])
                ends = np.cumsum(sizes)
                kept = [whole[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.first, m), pa.array(n_words.astype(np.int64)), pa.array(n_gone.astype(np.int64)),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ], names=["doc_id", *(c.split()[0] for c in REPORT.split(", "))])

    joined = keyed(docs.select("doc_id", "text")).join(cover, ["text_a", "text_b"], "left").select("doc_id", "text", "intervals")
    return joined.mapInArrow(tidy(run), f"doc_id {kind}, {REPORT}")
