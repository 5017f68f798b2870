"""Document rates that bring the token totals of domains to target shares.

A multinomial model over hashed byte trigrams, learned from a labelled table (doc_id, domain), gives every document a posterior
over domains; its tokens count for each domain in that proportion. Rates w solve

    minimize  1/(2 * TIGHTNESS) * r' M^-1 r + 1/2 * sum(n * (w - 1)^2) / T   subject to  w >= lowest
    r = sum(n * w * p) / T - wanted,   M = sum(n * p p') / T

by projected gradient: least squares on the domain totals, held near the present mixture. The gradient depends on a document
only through its posterior p and one number per domain, g = M^-1 r / TIGHTNESS, and a document's rate is the projected step
max(lowest, 1 - g'p). Each step is one aggregation over the documents grouped by posterior (rounded to 1/LEVELS): it returns
the totals at g and the moments of the documents that are free to move (those above `lowest`), by which the step is scaled. A
step that does not bring the totals nearer is halved. The descent ends when the totals agree with g; if it does not, the
job stops. Nothing but those numbers is kept from step to step.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm import common

BITS = 16
# the classifier's sample: documents of a domain, the length beyond which one counts as long, and how many long ones are read besides
SAMPLE_PER_DOMAIN, SAMPLE_CHARS, SAMPLE_LONG = 800, 20_000, 50
BROADCAST_ROWS = 200_000  # a doc_id, a domain and a number each
LEVELS = 200
TIGHTNESS = 0.01
STEPS, ENOUGH = 200, 1e-9  # steps before the job stops, and the distance (share of all tokens) at which the totals count as reached
MOST_GROWTH = 10.0  # times the present tokens that rates of 1 or more may ask for
OFF_TARGET = 0.02  # share by which a domain may miss its target before a warning says so


# --- domain posteriors ----------------------------------------------------------------------

@dataclass(frozen=True)
class DomainModel:
    """Log frequencies per trigram and domain, log shares of the domains, and the sharpness of the posteriors."""

    domains: tuple[str, ...]
    logs: np.ndarray
    sharpness: float

    def posteriors(self, means: np.ndarray) -> np.ndarray:
        """Rows of posteriors from rows of mean log frequencies."""
        if not self.domains:
            return means
        z = means * self.sharpness
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _grams(data: np.ndarray) -> np.ndarray:
    d = common.LOWER[data].astype(np.uint32)
    if len(d) < 3:
        return np.zeros(0, np.uint32)
    return ((d[:-2] << np.uint32(16) | d[1:-1] << np.uint32(8) | d[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def _means(logs: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean log frequencies of the trigrams of every row; zeros for rows with none."""
    out = np.zeros((len(offsets) - 1, logs.shape[1]))
    grams = _grams(data)
    if not len(grams):
        return out
    ends = np.maximum(offsets[1:] - 2, offsets[:-1])
    n = ends - offsets[:-1]
    for k in range(logs.shape[1]):
        sums = np.concatenate([[0.0], np.cumsum(logs[:, k][grams])])
        out[:, k] = (sums[np.minimum(ends, len(grams))] - sums[np.minimum(offsets[:-1], len(grams))]) / np.maximum(n, 1)
    return out


def fit_domains(docs: DataFrame, labels: DataFrame, per_domain: int = SAMPLE_PER_DOMAIN) -> DomainModel:
    """Learn from documents (doc_id, text) and labels (doc_id, domain as text).

    NULL domains and ids are not used; a document with several labels counts for each. Without labels there are no
    domains. At most `per_domain` documents of up to SAMPLE_CHARS characters and SAMPLE_LONG longer ones are read of each domain, taken
    by a hash of doc_id and read whole; of rows that repeat a doc_id one text, taken by its hash.
    """
    named = labels.where("doc_id is not null and domain is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("domain").cast("string").alias("domain")).distinct()
    lengths = docs.where("length(text) > 0").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.max(F.length("text")) > SAMPLE_CHARS).alias("long"))
    chosen = common.sample_per_class(named.join(lengths, "doc_id").withColumn("part", F.struct("domain", "long")), "part", "doc_id", per_domain)
    chosen = chosen.where(~F.col("long") | (F.col("place") <= SAMPLE_LONG)).select(
        "doc_id", "domain", F.when(F.col("long"), F.col("place") + per_domain).otherwise(F.col("place")).alias("place"))
    chosen = common.keep(chosen, "chosen")
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("length(text) > 0")
    again = W.partitionBy("domain", "doc_id").orderBy(F.xxhash64("text"))
    sample = texts.join(chosen, "doc_id").withColumn("n", F.row_number().over(again)).where("n = 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(_grams(np.frombuffer(t.as_py().encode(), np.uint8)), return_counts=True) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([v.tobytes() for v, _ in found], pa.binary()),
                pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary())], names=["domain", "place", "grams", "n"])

    sample = sample.select("domain", "place", "text").mapInArrow(common.tidy(run), "domain string, place int, grams binary, n binary")
    sample = sample.toArrow().sort_by([("domain", "ascending"), ("place", "ascending")])
    domains = tuple(sorted(set(sample.column("domain").to_pylist())))
    if not domains:
        return DomainModel((), np.zeros((1 << BITS, 0)), 1.0)
    number = {d: k for k, d in enumerate(domains)}
    truth = np.array([number[d] for d in sample.column("domain").to_pylist()])
    rows = [(np.frombuffer(g, np.uint32), np.frombuffer(n, np.int32)) for g, n in zip(sample.column("grams").to_pylist(),
                                                                                     sample.column("n").to_pylist())]

    def count(pick: np.ndarray) -> np.ndarray:
        counts = np.full((1 << BITS, len(domains)), 0.5)
        for i in pick:
            counts[rows[i][0], truth[i]] += rows[i][1]
        return np.log(counts / counts.sum(0))

    every = np.arange(len(rows))
    logs = count(every[every % 2 == 0])
    rest = [i for i in every if i % 2 and len(rows[i][0])]
    sharpness = 1.0
    if rest:
        means = np.array([np.average(logs[rows[i][0]], axis=0, weights=rows[i][1]) for i in rest])
        grid = 2.0 ** np.arange(-1, 9)
        losses = [-np.log(np.maximum(DomainModel(domains, logs, s).posteriors(means)[np.arange(len(rest)), truth[rest]], 1e-12)).mean()
                  for s in grid]
        sharpness = float(grid[int(np.argmin(losses))])
    return DomainModel(domains, count(every), sharpness)


def with_posteriors(docs: DataFrame, model: DomainModel, tokens: str = "n_tokens", posterior: str = "posterior") -> DataFrame:
    """docs, all columns, with n_tokens (runs of non-blank bytes) and posterior (whole numbers of 1/LEVELS, adding up to LEVELS)."""
    docs = docs.drop(tokens, posterior)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            counts, levels = [], []
            for _, _, data, offsets in common.byte_groups(batch.column("text")):
                inside = ~common.SPACE[data]
                first = inside.copy()
                first[1:] &= ~inside[:-1]
                cuts = offsets[:-1][offsets[:-1] < len(data)]
                first[cuts] = inside[cuts]
                sums = np.concatenate([[0], np.cumsum(first)])
                counts.append(sums[offsets[1:]] - sums[offsets[:-1]])
                levels.append(rounded(own.posteriors(_means(own.logs, data, offsets))))
            flat = np.concatenate(levels) if levels else np.zeros((0, len(own.domains)), np.int32)
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32()), pa.array(flat.ravel(), pa.int32())),
            ], names=[*batch.schema.names, tokens, posterior])

    schema = docs.select("*", F.lit(0).cast("long").alias(tokens), F.array(F.lit(0)).alias(posterior)).schema
    return docs.mapInArrow(common.tidy(run), schema)


def rounded(posteriors: np.ndarray) -> np.ndarray:
    """Rows in whole numbers of 1/LEVELS with the same sum: the largest remainders are rounded up."""
    scaled = posteriors * LEVELS
    low = np.floor(scaled).astype(np.int32)
    rank = np.argsort(np.argsort(-(scaled - low), 1, kind="stable"), 1)
    return low + (rank < (LEVELS - low.sum(1))[:, None])


# --- rates ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rates:
    """Where the descent ended; `of` gives the rate that belongs to a posterior. Totals are shares of the present tokens."""

    lowest: float
    pull: tuple[float, ...]
    wanted: tuple[float, ...]
    reached: tuple[float, ...]
    steps: int

    def of(self, posterior: str = "posterior") -> Column:
        """Rate of a posterior column."""
        if not self.pull:
            return F.lit(max(1.0, self.lowest))
        pull = F.array(*(F.lit(x) for x in self.pull))
        along = F.aggregate(F.zip_with(F.col(posterior), pull, lambda p, g: p * g / LEVELS), F.lit(0.0), lambda s, x: s + x)
        return F.greatest(F.lit(float(self.lowest)), 1 - along)


def _totals(groups: DataFrame, pull: np.ndarray, lowest: float) -> tuple[np.ndarray, np.ndarray]:
    """(tokens per domain at the rates of `pull`, moments of the posteriors of the documents above the lowest rate)."""
    k = len(pull)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k + 1, k))  # one task's, whatever its number of groups
        for batch in batches:
            p = batch.column(0).flatten().to_numpy().reshape(-1, k) / LEVELS
            n = batch.column(1).to_numpy()
            rate = 1 - p @ pull
            sums[0] += (n * np.maximum(rate, lowest)) @ p
            sums[1:] += (p * (n * (rate > lowest))[:, None]).T @ p
        i, j = np.indices(sums.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(sums.ravel())], names=["i", "j", "v"])

    found = groups.select("posterior", "n").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    sums = np.zeros((k + 1, k))
    for r in found.collect():  # k + 1 times k rows
        sums[r.i, r.j] = r.v
    return sums[0], sums[1:]


def fit_rates(documents: DataFrame, domains: tuple[str, ...], targets: Mapping[str, float], lowest: float = 0.0,
              most_growth: float = MOST_GROWTH) -> Rates:
    """Rates for documents (n_tokens, posterior) so that expected domain totals match targets.

    targets are shares of tokens by domain; they are scaled to add up to 1 over the domains that have tokens, and a domain
    without a target keeps its present share. With lowest = 0 the total stays as it is as far as the targets can be reached. With
    lowest = 1 no document is thinned out: the total grows until the domain most above its target fits. ValueError where that asks for
    more than `most_growth` times the present tokens (a target of or near 0 for a domain that has tokens); a warning where
    the documents cannot reach the targets, as every one of them also counts for other domains; ArithmeticError where the
    descent does not end. Without tokens or domains all rates are 1.
    """
    groups = common.keep(documents.groupBy("posterior").agg(F.sum("n_tokens").cast("double").alias("n")).where("n > 0"), "posteriors")
    k = len(domains)
    if not k:
        return Rates(lowest, (), (), (), 0)
    totals, moment = _totals(groups, np.zeros(k), min(lowest, 0.0))
    tokens = totals.sum()
    if not tokens:
        return Rates(lowest, (), (), (), 0)
    moment, present = moment / tokens, totals / tokens
    wanted = np.array([targets.get(d, present[i]) if present[i] > 0 else 0.0 for i, d in enumerate(domains)])
    if not wanted.sum() > 0 or (wanted < 0).any():
        raise ValueError("targets are shares of 0 or more, and one of them must be of a domain that has tokens")
    wanted = wanted / wanted.sum()
    if lowest >= 1:
        growth = lowest * float(np.max(present / np.maximum(wanted, 1e-300)))
        if growth > most_growth:
            worst = domains[int(np.argmax(present / np.maximum(wanted, 1e-300)))]
            raise ValueError(f"the target of {worst!r} asks for {growth:.3g} times the present tokens, as no document may be left out")
        wanted = wanted * growth
    inverse = np.linalg.pinv(moment, rcond=1e-9, hermitian=True)
    whole = inverse @ moment  # the identity on what the posteriors span

    def at(pull: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        totals, free = _totals(groups, pull, lowest)
        missing = inverse @ (totals / tokens - wanted) - TIGHTNESS * pull
        return totals / tokens, free / tokens, missing, float(np.abs(moment @ missing).sum())

    pull = np.zeros(k)
    reached, free, missing, distance = at(pull)
    for step in range(1, STEPS + 1):
        if distance <= ENOUGH * max(1.0, wanted.sum()):
            break
        move, size = np.linalg.lstsq(TIGHTNESS * whole + inverse @ free, missing, rcond=None)[0], 1.0
        while True:
            new = at(pull + size * move)
            if new[3] < (1 - size / 4) * distance or size < 1e-6:
                break
            size /= 2
        if new[3] >= distance:
            raise ArithmeticError(f"rates do not settle: totals stay {distance:.3g} away after {step} steps")
        pull = pull + size * move
        reached, free, missing, distance = new
    else:
        raise ArithmeticError(f"rates do not settle: totals are {distance:.3g} away after {STEPS} steps")
    off = np.abs(reached / reached.sum() - wanted / wanted.sum())
    if off.max() > OFF_TARGET:
        missed = ", ".join(f"{d}: {r:.3f} for {w:.3f}" for d, r, w in zip(domains, reached / reached.sum(), wanted / wanted.sum()))
        warnings.warn(f"these documents cannot reach the targets ({missed})", stacklevel=2)
    return Rates(lowest, tuple(map(float, pull)), tuple(wanted), tuple(reached), step - 1)


def mixed(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], lowest: float = 0.0) -> DataFrame:
    """docs, all columns, with n_tokens, posterior, domain (likeliest, NULL without domains) and rate added.

    NULL and empty texts have no tokens and an even posterior. Columns of docs with these names are replaced. Rows that repeat a doc_id
    or a text are rows of their own, of equal posterior and rate where the texts are equal. An empty table stays empty.
    """
    model = fit_domains(docs, labels)
    placed = with_posteriors(docs.drop("domain", "rate"), model)
    rates = fit_rates(placed.select("n_tokens", "posterior"), model.domains, targets, lowest)
    names = F.array(*(F.lit(d) for d in model.domains)).cast("array<string>")
    likeliest = F.get(names, (F.array_position("posterior", F.array_max("posterior")) - 1).cast("int"))
    return placed.withColumns({"domain": likeliest, "rate": rates.of()})


def repeated(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], lowest: float = 1.0) -> DataFrame:
    """The rows of docs, all columns as they are, each as often as its rate says.

    The whole part of a rate counts fully, the rest is the chance of one more copy, drawn by a hash of doc_id and text, so rows that
    repeat both are repeated alike. NULL and empty texts have no tokens and an even posterior. No column is replaced, whatever its
    name. An empty table stays empty; without labels every row comes once.
    """
    model = fit_domains(docs, labels)
    tokens, posterior, rate, copies, copy = (common.free_name(docs, name) for name in ("n_tokens", "posterior", "rate", "copies", "copy"))
    placed = with_posteriors(docs, model, tokens, posterior)
    totals = placed.select(F.col(tokens).alias("n_tokens"), F.col(posterior).alias("posterior"))
    found = fit_rates(totals, model.domains, targets, lowest).of(posterior)
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003.0
    whole = (F.floor(rate) + (chance < F.col(rate) - F.floor(rate)).cast("int")).cast("int")
    placed = placed.withColumn(rate, found).withColumn(copies, whole).where(F.col(copies) >= 1)
    return placed.withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)
