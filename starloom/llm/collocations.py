"""Phrases whose words meet more often than by chance, found by fingerprints of all n-grams.

Texts are lower-cased (A-Z), cut into pieces at marks and line ends, and the pieces into words. Counts are per language.

1. Prefix polynomials (Rabin-Karp) over the word hashes give the 64-bit fingerprint of every run of words inside a piece, salted
   with language and length, in numpy. Words and pairs are counted per fingerprint, first inside the task, then by Spark.
2. Runs of three and more words are counted only where all their pairs are frequent: a run cannot occur more often than a part
   of it. The frequent fingerprints travel as a bounded bit filter, which lets a few others through and never loses one.
3. The texts are read once more. Fingerprints that pass the filter are looked at in the text: the words of every occurrence are compared with
   those of the first one of its block, occurrences that differ are told apart, and text, count and the first occurrence
   (doc_id, place of the first word) are shuffled. Counts per text are exact, whatever collided on the way.
4. Candidates are cut after each word; the cut with the lowest score counts. Phrases inside an equally frequent longer one go.
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

from starloom.llm.common import mix, tidy
from starloom.llm.word_spans import Run, bit_filter, fingerprints, passes, prefix_sums, text_runs
from starloom.operators.staging_area import stage

LONGEST = 5  # words of a phrase
GAPS, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"  # fixed values: what parts words, and what parts pieces as well
BREAK = np.zeros(256, bool)
BREAK[list(BREAKS)] = True
INSIDE = ~BREAK
INSIDE[list(GAPS)] = False
SLICE = 1 << 17  # words hashed at once
HELD = 1 << 21  # fingerprints of a task that are put together before they are handed over
BROADCAST_LANGUAGES = 100_000  # a label and a number each


def _salts(langs: list[str | None]) -> np.ndarray:
    """A 64-bit number per row from its language."""
    numbers = {x: int.from_bytes(hashlib.blake2b((x or "und").encode(), digest_size=8).digest(), "little") for x in set(langs)}
    return np.array([numbers[x] for x in langs], np.uint64)


def _pieces(run: Run) -> np.ndarray:
    """The piece of every word: a number that changes at each mark, line end and row."""
    return np.cumsum(BREAK[run.data])[run.starts] + run.rows()


def _grams(run: Run, salts: np.ndarray, sizes: range) -> Iterator[tuple[int, dict[int, tuple[np.ndarray, np.ndarray]]]]:
    """Slices of the words: (first word, {size: (fingerprints, whether the words are in one piece)}) for the runs that begin there."""
    pieces, own = _pieces(run), salts[run.rows()]
    for a in range(0, len(run.starts), SLICE):
        b = min(a + SLICE + LONGEST - 1, len(run.starts))
        sums, piece = prefix_sums(run.hashes[a:b]), pieces[a:b]
        out = {}
        for k in sizes:
            n = max(0, min(b - k + 1, a + SLICE) - a)
            first = np.arange(n)
            value = fingerprints(sums, first, first + k) + own[a:a + n] + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
            out[k] = mix(value), piece[:n] == piece[k - 1:k - 1 + n]
        yield a, out


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    values, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["print", "n"])


def _frequent(docs: DataFrame, least: int, bits: np.ndarray | None) -> DataFrame:
    """(print, n) of the frequent words and pairs; with the filter of those, of the frequent longer runs."""
    shared = None if bits is None else docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            salts = _salts(batch.column(1).to_pylist())
            for part in text_runs(batch.column(0), INSIDE, True):
                for _, grams in _grams(part, salts[part.first:], range(1, 3) if shared is None else range(2, LONGEST + 1)):
                    if shared is None:
                        found = [values[whole] for values, whole in grams.values()]
                    else:
                        found = _extended(grams, shared.value)
                    held += found
                    n += sum(map(len, found))
                    if n >= HELD:
                        yield _counted(held)
                        held, n = [], 0
        if n:
            yield _counted(held)

    counted = docs.select("text", "lang").mapInArrow(tidy(run), "print long, n long").groupBy("print").agg(F.sum("n").alias("n"))
    return stage(counted.where(F.col("n") >= least), "frequent")


def _extended(grams: dict, bits: np.ndarray) -> list[np.ndarray]:
    """Fingerprints of the runs of three and more words all of whose pairs pass the filter."""
    values, whole = grams[2]
    good = whole & passes(bits, values)
    out = []
    for k in range(3, LONGEST + 1):
        values, whole = grams[k]
        good = good[:len(values)] & _shifted(good, len(values))
        out.append(values[good & whole])
    return out


def _shifted(good: np.ndarray, n: int) -> np.ndarray:
    """What holds one place later; False past the end."""
    out = np.zeros(n, bool)
    later = good[1:n + 1]
    out[:len(later)] = later
    return out


# --- texts of the frequent fingerprints -------------------------------------------------------

def _word_numbers(run: Run) -> np.ndarray:
    """Equal numbers for equal words, compared byte by byte: a word whose bytes differ from the first one with its hash gets its own."""
    _, first, number = np.unique(run.hashes, return_index=True, return_inverse=True)
    lengths = run.ends - run.starts
    same = lengths == lengths[first][number]
    at = np.flatnonzero(same)
    place = np.arange(int(lengths[at].sum())) - np.repeat(np.cumsum(lengths[at]) - lengths[at], lengths[at])
    own, model = np.repeat(run.starts[at], lengths[at]), np.repeat(run.starts[first][number[at]], lengths[at])
    unequal = np.flatnonzero(run.data[own + place] != run.data[model + place])
    if len(unequal) or not same.all():
        same[np.repeat(at, lengths[at])[unequal]] = False
        known: dict[bytes, int] = {}
        for i in np.flatnonzero(~same):
            word = run.data[run.starts[i]:run.ends[i]].tobytes()
            number[i] = known.setdefault(word, len(first) + len(known))
    return number


def _phrase_texts(run: Run, at: np.ndarray, k: int) -> pa.Array:
    """The k words from each of the given words on, joined by one space."""
    last = at + k - 1
    plain = run.ends[last] - run.starts[at] == sum(run.ends[at + j] - run.starts[at + j] for j in range(k)) + k - 1
    for j in range(k - 1):
        plain &= run.data[np.minimum(run.ends[at + j], len(run.data) - 1)] == 32
    lengths = run.ends[last] - run.starts[at]
    if plain.all():
        ends = np.cumsum(lengths)
        place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        raw = run.data[np.repeat(run.starts[at], lengths) + place]
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())).cast(pa.string())
    words = [[run.data[run.starts[i + j]:run.ends[i + j]].tobytes() for j in range(k)] for i in at.tolist()]
    return pa.array([b" ".join(w).decode() for w in words], pa.string())


def _told_apart(numbers: np.ndarray, at: np.ndarray, values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and count of every different run of k words among the places `at`, whose fingerprints are given."""
    _, first, group, n = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
    same = np.ones(len(at), bool)
    for j in range(k):
        same &= numbers[at + j] == numbers[at[first] + j][group]
    if same.all():
        return at[first], n
    _, first, n = np.unique(np.stack([numbers[at + j] for j in range(k)], 1), axis=0, return_index=True, return_counts=True)
    return at[first], n


TEXTS = "lang string, k int, phrase string, n long, place long"


def _texts(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """TEXTS and doc_id: counts of the runs that pass the filter, block by block; k = 0 has the number of all words."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = pc.fill_null(batch.column(1), "und")
            salts = _salts(langs.to_pylist())
            for part in text_runs(batch.column(0), INSIDE, True):
                if not len(part.starts):
                    continue
                numbers, rows = _word_numbers(part), part.rows()

                def found(at: np.ndarray, k: int, n: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
                    row = pa.array(part.first + rows[at])
                    return pa.RecordBatch.from_arrays([
                        langs.take(row), pa.array(np.full(len(at), k, np.int32)), texts, pa.array(n.astype(np.int64)),
                        pa.array(at - part.words[rows[at]]), batch.column(2).take(row),
                    ], names=["lang", "k", "phrase", "n", "place", "doc_id"])

                filled = np.flatnonzero(np.diff(part.words))
                yield found(part.words[filled], 0, np.diff(part.words)[filled], pa.array([""] * len(filled)))
                for a, grams in _grams(part, salts[part.first:], range(1, LONGEST + 1)):
                    good = None
                    for k, (values, whole) in grams.items():
                        parts = True if good is None else good[:len(values)] & _shifted(good, len(values))
                        good = whole & passes(shared.value, values) & parts
                        at = np.flatnonzero(good)
                        if len(at):
                            at, n = _told_apart(numbers, a + at, values[at], k)
                            yield found(at, k, n, _phrase_texts(part, at, k))

    return docs.select("text", "lang", "doc_id").mapInArrow(tidy(run), f"{TEXTS}, doc_id {kind}")


def phrase_counts(docs: DataFrame, least: int = 100) -> DataFrame:
    """(lang, k, phrase, n, first): exact counts of all runs of 1 to 5 words that occur `least` times or more in a language.

    `first` holds the smallest (doc_id, place of the first word) of an occurrence. The row with k = 0 and an empty phrase has the number
    of words of the language. The result is staged.
    """
    docs = docs.select("doc_id", "text", "lang")
    short = _frequent(docs, least, None)
    long = _frequent(docs, least, bit_filter(short, "print"))
    texts = _texts(docs, bit_filter(short.unionByName(long), "print"))
    counted = texts.groupBy("lang", "k", "phrase").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "place")).alias("first"))
    return stage(counted.where((F.col("k") == 0) | (F.col("n") >= least)), "phrases")


# --- scores -----------------------------------------------------------------------------------

def collocations(docs: DataFrame, least: int = 100, top: int | None = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, first_doc_id, first_place: the best phrases of each language (all of them without `top`).

    `docs` has doc_id, text and lang; other columns are not read, whatever their names. NULL texts are empty, a NULL language counts as
    `und`. Rows that repeat a doc_id or a text count as rows of their own. Ties of the score go by count, then by phrase; of equally low
    cuts the earliest counts. An empty table gives no rows. A long text is one run of memory about five times its bytes.
    """
    counts = phrase_counts(docs, least)
    total = counts.where("k = 0").select("lang", F.col("n").alias("words"))
    if total.count() <= BROADCAST_LANGUAGES:
        total = F.broadcast(total)
    known = counts.where("k > 0").select("lang", "k", "phrase", "n")
    phrases = counts.where("k > 1").withColumn("w", F.split("phrase", " "))

    def joined(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = phrases.select("lang", "k", "phrase", F.col("n").alias("a"), "w", F.explode(F.expr("sequence(1, k - 1)")).alias("cut")).select(
        "lang", "phrase", "a", "cut", joined(F.lit(1), F.col("cut")).alias("left"),
        joined(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    side = known.select("lang", "phrase", "n")
    cuts = cuts.join(side.toDF("lang", "left", "l"), ["lang", "left"]).join(side.toDF("lang", "right", "r"), ["lang", "right"])
    exact = "decimal(19,0)"
    score = F.expr(f"cast(1000 * a as {exact}) * cast(words as {exact}) div (cast(l as {exact}) * cast(r as {exact}))")
    lowest = cuts.join(total, "lang").withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r", F.col("words").alias("n"), "a")).alias("best")).select("lang", "phrase", "best.*")

    inner = F.expr("""flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> array_join(slice(w, s, m), ' '))))""")
    longer = phrases.where("k > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "n").groupBy("lang", "phrase").agg(
        F.max("n").alias("within"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where("within is null or 100 * within < 100 * a")
    pointers = counts.where("k > 1").select("lang", "phrase", F.col("first.doc_id").alias("first_doc_id"),
                                            F.col("first.place").alias("first_place"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.join(pointers, ["lang", "phrase"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc_id", "first_place")
