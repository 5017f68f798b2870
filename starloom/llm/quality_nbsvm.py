"""Quality scores by a naive-Bayes-scaled support vector machine.

Features are indicators of hashed n-grams: runs of three bytes, and runs of one to three word shapes (case, digits, marks,
length, whether the word repeats the one before). Each indicator is scaled by the log ratio of its smoothed class
frequencies; a linear hinge-loss model is fitted on the scaled, length-normalized rows by dual coordinate descent. A
logistic curve through margins of held-back folds turns margins into scores.

The model is fitted on at most SAMPLE_PER_CLASS labelled documents per class of up to SAMPLE_CHARS characters and SAMPLE_LONG longer
ones, taken by a hash of doc_id and read whole. Every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm import common

BITS = 18
SAMPLE_PER_CLASS, SAMPLE_CHARS, SAMPLE_LONG = 2500, 20_000, 40  # documents; the length beyond which one is long; long ones besides
SMOOTHING, COST, EPOCHS, FOLDS = 1.0, 1.0, 20, 3
ACCEPT = 0.7
SEED = 7


def _shapes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A small code for every word's shape, and the place of each row's first word."""
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    inside = ~common.SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    length = np.add.reduceat(inside.astype(np.int32), starts)
    upper = np.add.reduceat(((data >= 65) & (data <= 90)).astype(np.int32), starts)
    digit = np.add.reduceat(((data >= 48) & (data <= 57)).astype(np.int32), starts)
    letter = (((data | 32) >= 97) & ((data | 32) <= 122)) | (data >= 128)
    marks = length - digit - np.add.reduceat(letter.astype(np.int32), starts)
    case = np.where(upper == 0, 0, np.where(upper == 1, 1, np.where(2 * upper >= length, 3, 2)))
    marked = np.minimum(marks, 3)
    digits = np.where(digit == 0, 0, np.where(digit == length, 2, 1))
    size = np.searchsorted([2, 4, 8, 16, 32], length)
    value = np.add.reduceat(np.where(inside, common.mix(data.astype(np.uint64)), np.uint64(0)), starts)
    repeats = np.zeros(len(starts), np.int64)
    repeats[1:] = (value[1:] == value[:-1]) & (length[1:] == length[:-1])
    rows = np.searchsorted(starts, offsets)
    heads = rows[:-1][rows[:-1] < len(starts)]
    repeats[heads] = 0
    return (((((case * 4 + marked) * 3 + digits) * 6 + size) * 2) + repeats).astype(np.uint32) + np.uint32(1), rows


def features(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and distinct feature numbers of each run of rows."""
    shift = np.uint32(32 - BITS)
    stamp = np.zeros(1 << BITS, np.int64)
    for first, _, data, offsets in common.byte_groups(column):
        d = data.astype(np.uint32)
        grams = np.zeros(0, np.uint32)
        if len(d) > 2:
            grams = ((d[:-2] << np.uint32(16) | d[1:-1] << np.uint32(8) | d[2:]) * np.uint32(2654435761)) >> shift
        shapes, rows = _shapes(data, offsets)
        runs, running = [], np.zeros(len(shapes), np.uint32)
        for n in range(1, 4):
            usable = max(0, len(shapes) - n + 1)
            running = running[:usable] * np.uint32(1000003) + shapes[n - 1:n - 1 + usable]
            runs.append(((running + np.uint32(n * 7919)) * np.uint32(2246822519)) >> shift)
        out = []
        for i in range(len(offsets) - 1):
            a, b, x, y = offsets[i], offsets[i + 1], rows[i], rows[i + 1]
            parts = [grams[a:max(a, b - 2)]]
            parts += [run[x:max(x, y - n)] for n, run in enumerate(runs)]
            every = np.concatenate(parts)
            place = np.arange(len(every))
            stamp[every] = place
            out.append(every[stamp[every] == place].astype(np.int32))
        yield first, out


# --- the model ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """weights: hinge weights times log-count ratios; slope and middle: the logistic curve."""

    weights: np.ndarray
    bias: float
    slope: float
    middle: float

    def margin(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum() / np.sqrt(max(1, len(found))) + self.bias)

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.middle, -500, 500)))


def log_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed class frequencies of every feature."""
    counts = np.full((2, 1 << BITS), SMOOTHING)
    for found, label in zip(rows, good):
        counts[int(label), found] += 1
    shares = counts / counts.sum(1, keepdims=True)
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], scale: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a hinge-loss model by dual coordinate descent; classes weigh the same in total.

    The value of a feature in a row is its scale by the square root of the row's number of features.
    """
    rng = np.random.default_rng(SEED)
    signs = np.where(good, 1.0, -1.0)
    share = np.where(good, (~good).sum(), good.sum()) / len(good) * 2
    upper = COST * share
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(1 << BITS), 0.0
    lengths = np.sqrt([max(1, len(r)) for r in rows])
    squares = np.array([np.square(scale[r]).sum() for r in rows]) / lengths ** 2 + 1.0
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            values = scale[rows[i]] / lengths[i]
            slope = signs[i] * (weights[rows[i]] @ values + bias) - 1
            new = min(max(alpha[i] - slope / squares[i], 0.0), upper[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                weights[rows[i]] += step * values
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights, bias


def _logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve that fits the labels best, by Newton steps on smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    design = np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ [a, b], -30, 30)))
        gradient = design.T @ (p - target)
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2) * 1e-3
        step = np.linalg.solve(curve, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-6), float(b)


def fit_rows(rows: list[np.ndarray], good: np.ndarray) -> Model:
    """Fit on feature rows; with labels of one class only (or none) the score is that class's share, or 0.5."""
    if good.all() or not good.any():
        share = 0.5 if not len(good) else (len(good) + 1) / (len(good) + 2) if good.all() else 1 / (len(good) + 2)
        return Model(np.zeros(1 << BITS), 0.0, 1.0, float(np.log(share / (1 - share))))

    def one(pick: np.ndarray) -> tuple[np.ndarray, float]:
        own = [rows[i] for i in pick]
        ratio = log_ratios(own, good[pick])
        weights, bias = descend(own, ratio, good[pick])
        return weights * ratio, bias

    fold = np.random.default_rng(SEED).permutation(len(rows)) % FOLDS
    margins = np.zeros(len(rows))
    for k in range(FOLDS):
        inside = np.flatnonzero(fold != k)
        if good[inside].all() or not good[inside].any():
            inside = np.arange(len(rows))
        weights, bias = one(inside)
        for i in np.flatnonzero(fold == k):
            margins[i] = Model(weights, bias, 1, 0).margin(rows[i])
    weights, bias = one(np.arange(len(rows)))
    return Model(weights, bias, *_logistic(margins, good))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on documents (doc_id, text) with labels (doc_id, quality 0 or 1) that are not held out.

    Documents with disagreeing labels, NULL labels and NULL ids are not used; repeated labels count once, and of rows that repeat a
    doc_id one text, taken by its hash. At most `per_class` documents of up to SAMPLE_CHARS characters and SAMPLE_LONG longer ones are
    read of each class, taken by a hash of doc_id and read whole.
    """
    agreed = (labels.where("quality in (0, 1) and doc_id is not null").where(~common.held_out("doc_id"))
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
              .where("quality = other").select("doc_id", "quality"))
    lengths = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(F.length("text")) > SAMPLE_CHARS).alias("long"))
    parts = agreed.join(lengths, "doc_id").withColumn("part", F.struct("quality", F.coalesce("long", F.lit(False)).alias("long")))
    chosen = common.sample_per_class(parts, "part", "doc_id", per_class).where(~F.col("part.long") | (F.col("place") <= SAMPLE_LONG))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(F.broadcast(chosen.select("doc_id", "quality")), "doc_id")  # four times per_class ids at most
    again = W.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    sample = found.withColumn("n", F.row_number().over(again)).where("n = 1").select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in features(batch.column(2)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(rows)), batch.column(1).slice(first, len(rows)),
                    pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "quality", "features"])

    got = sample.mapInArrow(common.tidy(run), "doc_id long, quality int, features binary").toArrow().sort_by("doc_id")
    return fit_rows([np.frombuffer(b, np.int32) for b in got.column("features").to_pylist()],
                    got.column("quality").to_numpy() == 1)


def score(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """All columns of docs with score (0 to 1) and predicted (1 if score >= accept, else 0) added.

    NULL and empty texts are scored as texts without features, texts of any length as a whole. Columns of docs named score or predicted
    are replaced. Rows that repeat a doc_id are scored each by its own text, equal texts alike; an empty table stays empty.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias, model.slope, model.middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = _scores(own, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= accept).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"])

    schema = docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return docs.mapInArrow(common.tidy(run), schema)


def accepted(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """The rows of docs, all columns as they are, with a score of `accept` or more."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias, model.slope, model.middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array(_scores(own, batch.column("text")) >= accept))

    return docs.mapInArrow(common.tidy(run), docs.schema)


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    margins = np.zeros(len(texts))
    for first, rows in features(texts):
        margins[first:first + len(rows)] = [model.margin(r) for r in rows]
    return model.score(margins)
