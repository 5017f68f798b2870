"""Personal data in texts: base patterns, and a linear-chain conditional random field that adds what they miss.

The base patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers. The random field labels words (runs
of other than white space) as outside, or as begin or inside of one of these kinds, from their shapes, affixes, lengths, checks
(Luhn, octets) and the shapes next to them. It is trained on a small labelled table by gradient ascent on the log-likelihood
(forward-backward), and decoded by Viterbi over batches of word runs in numpy. Runs are the words within CONTEXT of a word with
a digit or @; the four kinds cannot occur elsewhere. Spans of the field that overlap no base span are added.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
CONTEXT = 4
FEATURE_BITS = 13
SAMPLE_DOCS, SAMPLE_CHARS = 400, 4000  # documents of the labelled sample, and their greatest length
PASSES, STEP, PENALTY = 80, 0.5, 1e-4
BATCH_WORDS = 50_000

# The base patterns.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Labelled lines; the text between [kind: and ] is personal data.
EXAMPLES = (
    "Call me at [phone:(988) 555-2485] before noon.",
    "My number is [phone:988-555-2485], ask for Ann.",
    "Phone: [phone:020 7946 0958] or come by.",
    "tel. [phone:030 901820] in the morning",
    "Fax [phone:555.010.7788] is out of order.",
    "ring [phone:+44 20 7946 0958] today",
    "mobile [phone:+1 (212) 555-0143] after six",
    "Write to [email:jo.doe@localhost] for the key.",
    "mail [email:root@server] about it",
    "Send it to [email:ann_b@mail.example.org] please.",
    "contact <[email:sales@shop.example.com]> now",
    "The host [ip:10.0.0.7] answered.",
    "ping [ip:192.168.1.254] first",
    "server at [ip:172.16.4.1]:8080 is up",
    "Paid with [card:4111 1111 1111 1111] yesterday.",
    "card [card:5500-0000-0000-0004] expires soon",
    "Visa [card:4012888888881881] was used.",
    "Order 4111111111111112 was shipped.",
    "Section 3.2.1.999 of the manual.",
    "Version 1.2.3 of 2019-04-01 is out.",
    "On 12.05.2020 at 10:45 we met.",
    "Room 101, floor 3, building 7.",
    "It cost 1,299.00 dollars in 2021.",
    "Call 911 in an emergency.",
    "License version 3, 29 June 2007.",
    "The key is 7f3a9c0d21b84e6f and the id 000123456789.",
    "see @home and @work for more",
    "price @ 3.50 each, 24 in a box",
    "isbn 978-3-16-148410-0 is in print",
    "pages 120-135, vol. 12, no. 4",
)


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their @: what stands before it is a run of LOCAL characters back to the last match."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            free = found.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the base patterns, ordered by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    ips = [m for run in _digit_runs(text) for m in IP.finditer(text, *run)]
    out += [("ip", *m.span()) for m in ips if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def _digit_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of digits and dots with three dots or more: an address lies within one."""
    for m in re.finditer(r"[0-9][0-9.]+", text):
        if text.count(".", m.start(), m.end()) >= 3:
            yield m.span()


def joined(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by kind as listed, then start, joined by commas."""
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


# --- words and features ---------------------------------------------------------------------

WORD = re.compile(r"\S+")
HOT = re.compile(r"[0-9@]")
TRIM_LEFT, TRIM_RIGHT = "\"'<[{,;:.!?)", "\"'>]},;:.!?("


def runs_of_words(text: str) -> list[list[tuple[int, int]]]:
    """Runs of word spans within CONTEXT words of one with a digit or @."""
    if not HOT.search(text):
        return []
    words = [m.span() for m in WORD.finditer(text)]
    hot = [i for i, (a, b) in enumerate(words) if HOT.search(text, a, b)]
    out: list[list[tuple[int, int]]] = []
    end = -1
    for i in hot:
        low, high = max(0, i - CONTEXT), min(len(words), i + CONTEXT + 1)
        if out and low <= end:
            out[-1] += words[end:high]
        else:
            out.append(words[low:high])
        end = high
    return out


def shape(word: str) -> str:
    """The word with letters as a or A and digits as 9, runs cut to three."""
    kinds = re.sub(r"[^\W\d_]", "a", re.sub(r"[A-Z]", "A", re.sub(r"[0-9]", "9", word)).replace("A", "\x00"))
    return re.sub(r"(.)\1{3,}", r"\1\1\1", kinds.replace("\x00", "A"))


def _checks(word: str) -> str:
    digits = _digits(word)
    parts = word.strip(TRIM_LEFT + TRIM_RIGHT).split(".")
    four = len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts)
    octets = four and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return f"{min(len(digits), 20)}|{13 <= len(digits) <= 19 and luhn(digits)}|{four}|{octets}"


def features(text: str, run: list[tuple[int, int]]) -> np.ndarray:
    """Feature numbers of every word of a run, one row per word."""
    words = [text[a:b] for a, b in run]
    shapes = ["^", *map(shape, words), "$"]
    rows = []
    for i, word in enumerate(words):
        before, own, after = shapes[i:i + 3]
        low = word.lower()
        names = (
            "bias", f"s={own}", f"p={before}", f"n={after}", f"ps={before[:6]}/{own[:6]}", f"sn={own[:6]}/{after[:6]}",
            f"c={_checks(word)}", f"l={min(len(word), 24)}", f"h={low[:3]}", f"t={low[-3:]}",
            f"w={words[i - 1].lower() if i else '^'}", f"@={'@' in word}{word[:1] == '+'}{word.count('.') > 1}{word[:1] == '('}")
        rows.append([zlib.crc32(n.encode()) & ((1 << FEATURE_BITS) - 1) for n in names])
    return np.array(rows, np.int32).reshape(len(words), -1)


# --- the random field -----------------------------------------------------------------------

@dataclass(frozen=True)
class Field:
    """Weights of features by label, of label pairs, and of first labels."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray


def _legal() -> tuple[np.ndarray, np.ndarray]:
    """Penalties that keep an inside label behind a begin or inside of its kind."""
    move, start = np.zeros((LABELS, LABELS)), np.zeros(LABELS)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        move[:, inside] = -1e4
        move[[inside - 1, inside], inside] = 0
        start[inside] = -1e4
    return move, start


def _padded(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = max(len(r) for r in runs)
    out = np.zeros((len(runs), length, runs[0].shape[1]), np.int32)
    for i, r in enumerate(runs):
        out[i, :len(r)] = r
    return out, np.array([len(r) for r in runs])


def viterbi(field: Field, runs: list[np.ndarray]) -> list[np.ndarray]:
    """The likeliest labels of every run; runs are decoded together in batches of like length."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
    order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
    at = 0
    while at < len(order):
        end, longest = at, 0
        while end < len(order) and (end == at or len(runs[order[end]]) * (end - at + 1) <= BATCH_WORDS):
            longest, end = len(runs[order[end]]), end + 1
        some = order[at:end]
        numbers, sizes = _padded([runs[i] for i in some])
        scores = field.emit[numbers].sum(2)
        best = scores[:, 0] + field.start
        back = np.zeros((longest, len(some), LABELS), np.int8)
        for t in range(1, longest):
            ways = best[:, :, None] + field.move
            back[t] = ways.argmax(1)
            on = (t < sizes)[:, None]
            best = np.where(on, ways.max(1) + scores[:, t], best)
            back[t] = np.where(on, back[t], np.arange(LABELS))
        label = best.argmax(1)
        path = np.zeros((len(some), longest), np.int64)
        rows = np.arange(len(some))
        for t in range(longest - 1, -1, -1):
            path[:, t] = label
            label = back[t][rows, label] if t else label
        for i, labels, n in zip(some, path, sizes):
            out[i] = labels[:n]
        at = end
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(runs: list[np.ndarray], labels: list[np.ndarray]) -> Field:
    """Fit by gradient ascent with per-weight step sizes; without runs every word is outside."""
    illegal_move, illegal_start = _legal()
    emit, move, start = np.zeros((1 << FEATURE_BITS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)
    if not runs:
        start[0] = 1.0
        return Field(emit, move + illegal_move, start + illegal_start)
    numbers, sizes = _padded(runs)
    n, length, width = numbers.shape
    truth = np.zeros((n, length), np.int64)
    for i, own in enumerate(labels):
        truth[i, :len(own)] = own
    on = np.arange(length) < sizes[:, None]
    speed = [np.full_like(w, 1e-8) for w in (emit, move, start)]
    seen_emit, seen_move = np.zeros_like(emit), np.zeros_like(move)
    true_rows = np.eye(LABELS)[truth] * on[:, :, None]
    for f in range(width):
        np.add.at(seen_emit, numbers[:, :, f][on], true_rows[on])
    pairs = on[:, 1:]
    np.add.at(seen_move, (truth[:, :-1][pairs], truth[:, 1:][pairs]), 1)
    seen_start = true_rows[:, 0].sum(0)
    for _ in range(PASSES):
        scores, moves = emit[numbers].sum(2), move + illegal_move
        ahead = np.zeros((length, n, LABELS))
        ahead[0] = scores[:, 0] + start + illegal_start
        for t in range(1, length):
            step = _log_sum(ahead[t - 1][:, :, None] + moves, 1) + scores[:, t]
            ahead[t] = np.where(on[:, t, None], step, ahead[t - 1])
        whole = _log_sum(ahead[-1], 1)
        behind = np.zeros((length, n, LABELS))
        expected_move = np.zeros_like(move)
        for t in range(length - 2, -1, -1):
            ways = moves + (scores[:, t + 1] + behind[t + 1])[:, None, :]
            behind[t] = np.where(on[:, t + 1, None], _log_sum(ways, 2), 0)
            joint = np.exp(np.minimum(ahead[t][:, :, None] + ways - whole[:, None, None], 0)) * on[:, t + 1, None, None]
            expected_move += joint.sum(0)
        marginal = np.exp(np.minimum(ahead.transpose(1, 0, 2) + behind.transpose(1, 0, 2) - whole[:, None, None], 0)) * on[:, :, None]
        expected_emit = np.zeros_like(emit)
        for f in range(width):
            np.add.at(expected_emit, numbers[:, :, f][on], marginal[on])
        gradients = ((seen_emit - expected_emit) / n - PENALTY * emit, (seen_move - expected_move) / n - PENALTY * move,
                     (seen_start - marginal[:, 0].sum(0)) / n)
        for weight, gradient, square in zip((emit, move, start), gradients, speed):
            square += gradient ** 2
            weight += STEP * gradient / np.sqrt(square)
    return Field(emit, move + illegal_move, start + illegal_start)


def labels_of(run: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> np.ndarray:
    """Labels of the words of a run under known spans; a word belongs to the first span that it overlaps."""
    out, last = [], None
    for a, b in run:
        own = next((s for s in spans if s[1] < b and a < s[2]), None)
        out.append(0 if own is None else 1 + 2 * KINDS.index(own[0]) + (own == last))
        last = own
    return np.array(out, np.int64)


def parse_example(line: str) -> tuple[str, list[tuple[str, int, int]]]:
    """Text and spans of a marked line."""
    text, spans, at = "", [], 0
    for m in re.finditer(r"\[(email|ip|card|phone):([^\]]+)\]", line):
        text += line[at:m.start()]
        spans.append((m.group(1), len(text), len(text) + len(m.group(2))))
        text, at = text + m.group(2), m.end()
    return text + line[at:], spans


def labelled_sample(docs: DataFrame) -> DataFrame:
    """A small labelled table (text, spans): documents with personal data by the base patterns, and marked lines.

    At most SAMPLE_DOCS documents of at most SAMPLE_CHARS characters that hold a digit or @, taken by a hash of doc_id and text.
    """
    some = docs.where((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]")).select("doc_id", "text").orderBy(
        F.xxhash64("doc_id", "text"), "doc_id", "text").limit(SAMPLE_DOCS).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([joined(base_spans(t.as_py())) for t in batch.column(0)], pa.string())], names=["text", "spans"])

    marked = docs.sparkSession.createDataFrame([(t, joined(s)) for t, s in map(parse_example, EXAMPLES)], "text string, spans string")
    return some.mapInArrow(run, "text string, spans string").unionByName(marked)


def fit(labelled: DataFrame) -> Field:
    """Train on a small table (text, spans as kind:start:end joined by commas). NULL texts and spans count as empty."""
    runs, labels = [], []
    for row in labelled.select("text", "spans").toLocalIterator():
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in (row.spans or "").split(",") if s)]
        for run in runs_of_words(row.text or ""):
            runs.append(features(row.text, run))
            labels.append(labels_of(run, spans))
    return train(runs, labels)


def _field_spans(text: str, run: list[tuple[int, int]], labels: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """Spans of a labelled run, without quotes, brackets and stops at their ends, if they hold what their kind needs."""
    i = 0
    while i < len(run):
        if labels[i] == 0:
            i += 1
            continue
        kind, end = (labels[i] - 1) // 2, i + 1
        while end < len(run) and labels[end] == 2 + 2 * kind:
            end += 1
        a, b = run[i][0], run[end - 1][1]
        while a < b and text[a] in TRIM_LEFT:
            a += 1
        while b > a and text[b - 1] in TRIM_RIGHT:
            b -= 1
        held = text[a:b]
        if "@" in held if KINDS[kind] == "email" else HOT.search(held.replace("@", "")):
            yield KINDS[kind], a, b
        i = end


def all_spans(texts: list[str], field: Field) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """Base spans and added spans of each text."""
    base = [base_spans(t) if HOT.search(t) else [] for t in texts]
    placed = [(i, run) for i, t in enumerate(texts) for run in runs_of_words(t)]
    decoded = viterbi(field, [features(texts[i], run) for i, run in placed])
    added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for (i, run), labels in zip(placed, decoded):
        if labels.any():
            low, high = run[0][0], run[-1][1]
            near = [s for s in base[i] if s[1] < high and low < s[2]]
            added[i] += [s for s in _field_spans(texts[i], run, labels) if not any(s[1] < c and b < s[2] for _, b, c in near)]
    return list(zip(base, added))


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find(docs: DataFrame, field: Field) -> DataFrame:
    """One row per row of docs (doc_id, text): base counts, hash of the base spans, all spans, and how many the field added.

    NULL text is empty and holds nothing; NULL doc_id stays NULL; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids = batch.column(0).slice(at, 256)
                found = all_spans([t.as_py() or "" for t in batch.column(1).slice(at, 256)], shared.value)
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
                hashes = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays([
                    ids, *counts, pa.array(hashes, pa.string()), pa.array([joined(base + more) for base, more in found], pa.string()),
                    pa.array([len(more) for _, more in found], pa.int64()),
                ], names=[c.split()[0] for c in RESULT.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)
