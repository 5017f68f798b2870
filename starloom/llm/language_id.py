"""Language of texts by bit-sliced Bloom filters over character n-grams.

One array of bit masks stands for the Bloom filters of all languages: slot s holds one bit per language. An n-gram has PROBES
slots; the AND of their masks has the bit of every language whose n-grams contain it (and, rarely, of one that does not).
The bits of all n-grams of a text are counted per language, the counts are corrected for the false positives each filter
gives by how full it is, and the largest decides. There are at least eight slots for each n-gram of the language with most.

A language's n-grams are those that make up at least RATE of its training text, from at most SAMPLE_PER_LANGUAGE documents per
language taken by a hash of doc_id; n-grams found in every language tell nothing and are left out. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import common

SIZES = (2, 3, 4)
PROBES, SLOTS_PER_GRAM, LEAST_SLOT_BITS, MOST_SLOT_BITS = 3, 8, 18, 21  # three probes of 21 bits of a 64-bit hash
SAMPLE_PER_LANGUAGE = 600
RATE = 2e-5  # so a language has at most 50,000 n-grams of each size
BROADCAST_ROWS = 200_000
UNKNOWN = "und"
PIECE = 1 << 18

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter, from the character database."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def codes(text: str) -> np.ndarray:
    """Lower-cased code points, with every run of other than letters as one blank, and a blank at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kept = letters()[points]
    points = np.where(kept, points, np.uint32(32))
    wanted = kept.copy()
    wanted[1:] |= kept[:-1]
    out = points[wanted]
    blank = np.array([32], np.uint32)
    if len(out) and out[0] == 32:
        out = out[1:]
    return np.concatenate([blank, out, blank] if len(out) and out[-1] != 32 else [blank, out])


def grams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of all n-grams, one array per size."""
    running = np.zeros(len(points), np.uint64)
    for n in range(1, max(SIZES) + 1):
        usable = max(0, len(points) - n + 1)
        running = running[:usable] * np.uint64(0x100000001B3) + points[n - 1:n - 1 + usable]
        if n in SIZES:
            yield common.mix(running * np.uint64(16) + np.uint64(n))


def _pieces(text: str) -> Iterator[str]:
    """A long text in parts that overlap by what an n-gram needs; short ones whole."""
    if len(text) <= PIECE:
        yield text
        return
    for at in range(0, len(text), PIECE):
        yield text[max(0, at - max(SIZES) + 1):at + PIECE]


def _places(hashes: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    """The PROBES slots of each n-gram."""
    bits = slots.bit_length() - 1
    for p in range(PROBES):
        yield ((hashes >> np.uint64(p * bits)) & np.uint64(slots - 1)).astype(np.int64)


@dataclass(frozen=True)
class Filters:
    """masks: slots x words of 64 languages; false_rate: share of absent n-grams that a language's filter lets through."""

    languages: tuple[str, ...]
    masks: np.ndarray
    false_rate: np.ndarray

    def containing(self, hashes: np.ndarray) -> np.ndarray:
        """Masks of the languages that hold each n-gram."""
        places = _places(hashes, len(self.masks))
        found = self.masks[next(places)]
        for place in places:
            found = found & self.masks[place]
        return found

    def counts(self, text: str) -> tuple[int, np.ndarray]:
        """N-grams of a text, and how many each language holds."""
        total, held = 0, np.zeros(len(self.languages), np.int64)
        for piece in _pieces(text):
            for hashes in grams(codes(piece)):
                found = self.containing(hashes)
                total += len(hashes)
                for k in range(len(self.languages)):
                    held[k] += int(((found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).sum())
        return total, held

    def decide(self, text: str | None) -> tuple[str, float]:
        """Language and score of a text; `und` and 0 for NULL, for a text without a letter, and without languages."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        total, held = self.counts(text)
        true = np.maximum(0.0, (held - total * self.false_rate) / np.maximum(1 - self.false_rate, 1e-9))
        best = int(np.argmax(true))  # ties: the first name
        rest = np.delete(true, best)
        second = float(rest.max()) if len(rest) else 0.0
        top = float(true[best])
        return self.languages[best], (top + 1) / (top + second + 2)


def build(languages: tuple[str, ...], hashes: dict[str, np.ndarray]) -> Filters:
    """Filters from the n-gram hashes of each language."""
    words = max(1, -(-len(languages) // 64))
    most = max((len(hashes[name]) for name in languages), default=0)
    masks = np.zeros((1 << min(MOST_SLOT_BITS, max(LEAST_SLOT_BITS, (SLOTS_PER_GRAM * most - 1).bit_length())), words), np.uint64)
    filled = np.zeros(len(languages))
    for k, name in enumerate(languages):
        bit = np.uint64(1) << np.uint64(k % 64)
        for place in _places(hashes[name], len(masks)):
            masks[place, k // 64] |= bit
        filled[k] = ((masks[:, k // 64] & bit) != 0).mean()
    return Filters(languages, masks, filled ** PROBES)


def fit(docs: DataFrame) -> Filters:
    """Learn from text and non-NULL lang of the documents (doc_id, text, lang) that are not held out."""
    train = docs.where(F.col("lang").isNotNull() & ~common.held_out("doc_id"))
    chosen = common.sample_per_class(train.select("doc_id", "lang").distinct(), "lang", "doc_id", SAMPLE_PER_LANGUAGE)
    chosen = common.keep(chosen.select("doc_id", "lang"), "chosen")
    languages = tuple(sorted(r.lang for r in chosen.select("lang").distinct().collect()))
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    texts = train.join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, piece in ((n.as_py(), p) for n, t in zip(*batch.columns) for p in _pieces(t.as_py() or "")):
                for size, hashes in zip(SIZES, grams(codes(piece))):
                    values, counts = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(values)), pa.array([size] * len(values), pa.int32()),
                         pa.array(values.view(np.int64)), pa.array(counts)], names=["lang", "size", "gram", "n"])

    counted = texts.mapInArrow(run, "lang string, size int, gram long, n long").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    counted = common.keep(counted, "grams")
    totals = counted.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    frequent = counted.join(F.broadcast(totals), ["lang", "size"]).where(F.col("n") >= F.greatest(F.lit(2), RATE * F.col("total")))
    spread = frequent.groupBy("gram").agg(F.count("*").alias("in_languages"))
    got = frequent.join(spread, "gram").where((F.col("in_languages") < len(languages)) | F.lit(len(languages) == 1)).select("lang", "gram").toArrow()
    names, hashes = np.array(got.column("lang").to_pylist(), object), got.column("gram").to_numpy().view(np.uint64)
    return build(languages, {name: hashes[names == name] for name in languages})


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """docs, all columns, with lang_pred and score added (columns of these names are replaced).

    Texts of any length are read whole. NULL and empty texts and those without a letter are `und` with score 0; of equally
    likely languages the first name is taken. Rows that repeat a doc_id or have none are judged each by its own text, equal
    texts alike; an empty table stays empty.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.decide(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return docs.mapInArrow(common.tidy(run), schema)
