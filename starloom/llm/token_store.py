"""Token ids in compressed binary blocks with access to single documents.

Documents are put in ascending doc_id order by a range shuffle, encoded, and written as blocks. A block holds whole
documents; every document is one zstandard frame of its own, compressed with one dictionary that all blocks share. The
dictionary is trained on the serialized id arrays of a bounded sample, and each block carries its hash.

Block layout, little-endian: magic ``TOKB``, version u16, bytes per id u16 (2 or 4), dictionary SHA-256 (32 bytes),
documents u32, then per document doc_id i64, flag u8 (1: the id is NULL) and tokens u64, then documents + 1 frame offsets u64, then
the frames. Blocks are rows of a parquet table (written by Spark, so any store works and a lost task leaves no half file):
part, block, first_doc_id, last_doc_id, n_docs, start_in_part, n_tokens, payload. The dictionary is a table next to it.

Encoding: no token of the vocabulary's pre-tokenizer crosses ASCII white space, so the pieces between it are encoded
once and remembered, at most MEMO_PIECES and MEMO_IDS ids at a time. A worker keeps that for its next partition, and lets it go
when none comes within IDLE seconds, so that stages after this one have the memory.
"""

from __future__ import annotations

import hashlib
import os
import struct
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm import common

MAGIC, VERSION = b"TOKB", 1
HEAD = struct.Struct("<4sHH32sI")
BLOCK_DOCS, BLOCK_BYTES = 1024, 4 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS, SAMPLE_CHARS = 1000, 8192  # the dictionary's sample: documents, and their greatest length
SPECIAL = b"<|"
MEMO_PIECES, MEMO_IDS, SLOTS = 500_000, 4_000_000, 1 << 20  # of the memo: pieces, their ids, and places to find them by
IDLE = 2.0  # seconds
LEARNED = 20_000  # pieces encoded at once: the tokenizer's own account of them is larger than they are
TASK_BYTES = 32 << 20  # of text that a task encodes: enough for what it learns to be of use, little enough to sort in memory
STOPS = b".,;:!?"
STOP = np.zeros(256, bool)
STOP[list(STOPS)] = True
HEAD_CHARS = 256  # of a text, by which rows that repeat a doc_id are ordered
LATIN = bytes(range(0xC9))  # UTF-8 bytes of code points below U+0240: those letters are composed, and lower-cased one by one
LEVEL = 3
BLOCK_SCHEMA = ("part int, block long, first_doc_id long, last_doc_id long, n_docs long, start_in_part long, n_tokens long, "
                "payload binary")

class Numbers:
    """Whole numbers by 64-bit hash, found and put in by arrays (open addressing in SLOTS slots)."""

    def __init__(self) -> None:
        self.keys, self.values, self.n = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32), 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for unknown ones."""
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        at = self.keys[slot]
        out = np.where(at == hashes, self.values[slot], -1)
        left = np.flatnonzero((at != hashes) & (at != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (SLOTS - 1)
            at = self.keys[slot[left]]
            hit = at == hashes[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (at != 0)]
        return out

    def put(self, hashes: np.ndarray, first: int) -> None:
        """Number unknown, distinct hashes from `first` on."""
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = hashes[free]  # of several for one slot the last stays
            won = self.keys[slot[left]] == hashes[left]
            self.values[slot[left[won]]] = first + left[won]
            left = left[~won]
            slot[left] = (slot[left] + 1) & (SLOTS - 1)
        self.n += len(hashes)


class Sequences:
    """Numbered id sequences in flat arrays."""

    def __init__(self) -> None:
        self.ids, self.starts, self.n, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0, 0

    def add(self, sizes: np.ndarray, flat: np.ndarray) -> None:
        need, last = self.used + len(flat), self.n + len(sizes)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need - len(self.ids), len(self.ids) // 2), np.uint32)])
        if last + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(max(last + 1 - len(self.starts), len(self.starts) // 2), np.int64)])
        self.ids[self.used:need] = flat
        self.starts[self.n + 1:last + 1] = self.used + np.cumsum(sizes)
        self.n, self.used = last, need

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these sequences in a row, and the size of each."""
        begins = self.starts[numbers]
        sizes = self.starts[numbers + 1] - begins
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes


def _ascii_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[str], list[int]]:
    """The pieces of up to 200 letters a-z with or without stops behind them: their numbers, their words (letters, then stops), first words."""
    lengths = ends - starts
    begins = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
    flat = data[np.repeat(starts, lengths) + inside]
    letter = (flat >= 97) & (flat <= 122)
    n_letters = np.add.reduceat(letter, begins, dtype=np.int64)
    # letters first, then nothing but stops
    fits = np.logical_and.reduceat(np.where(inside < np.repeat(n_letters, lengths), letter, STOP[flat]), begins)
    at = np.flatnonzero(fits & (n_letters > 0) & (n_letters <= 200))
    if not len(at):
        return at, [], []
    n, k = lengths[at], n_letters[at]
    parts = 1 + (n > k)
    sizes = n + parts  # a blank behind the letters and behind the stops
    base = np.cumsum(sizes) - sizes
    kept = np.repeat(fits & (n_letters > 0) & (n_letters <= 200), lengths)
    place = inside[kept]
    out = np.full(int(sizes.sum()), 32, np.uint8)
    out[np.repeat(base, n) + place + (place >= np.repeat(k, n))] = flat[kept]
    return at, out.tobytes().decode().split(), (np.cumsum(parts) - parts).tolist()


class Encoder:
    """Ids of texts, piece by piece; pieces are known by a 64-bit hash of their lower-cased bytes.

    A piece of Latin letters, with stops behind it or not, is one or two words to the vocabulary's pre-tokenizer, so its
    lower-cased letters and its stops go to the model as they are. Every other piece goes through the whole tokenizer, as does
    every text that may spell out a special token (case matters there).
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.by_words = self._splits_like_words()
        self._clear()

    def _splits_like_words(self) -> bool:
        """Whether the vocabulary treats texts as `pieces` and `plain` expect; otherwise every text is encoded whole."""
        kinds = [type(x).__name__ for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model)]
        if kinds != ["Sequence", "Sequence", "BPE"]:
            return False
        probe = ["Probe", "\u00c9t\u00e9", "word.", "WORD,!", " a\tb\n"]
        parts = [["probe"], ["\u00e9t\u00e9"], ["word", "."], ["word", ",!"], ["a", "b"]]
        return [self._whole(t).tolist() for t in probe] == [
            self.plain.encode(w, is_pretokenized=True, add_special_tokens=False).ids for w in parts]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _clear(self) -> None:
        self.known, self.sequences = Numbers(), Sequences()

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        ascii_at, words, firsts = _ascii_words(data, starts, ends)
        plain_at: list[int] = []  # other plain pieces; words and firsts hold their words, and the place of each piece's first
        other_at: list[int] = []
        left = np.setdiff1d(np.arange(len(starts)), ascii_at, assume_unique=True)
        pieces = [data[a:b].tobytes() for a, b in zip(starts[left].tolist(), ends[left].tolist())]
        for i, piece in zip(left.tolist(), pieces):
            letters = piece.rstrip(STOPS)
            if letters.isalpha():
                text = piece.decode()
            elif letters and not letters.translate(None, LATIN) and (text := piece.decode().lower()).rstrip(STOPS.decode()).isalpha():
                letters = text.rstrip(STOPS.decode()).encode()
            else:
                other_at.append(i)
                continue
            if len(letters) > 200:
                other_at.append(i)
                continue
            plain_at.append(i)
            firsts.append(len(words))
            n = len(letters.decode())
            words.append(text[:n])
            if n < len(text):
                words.append(text[n:])
        order = np.concatenate([ascii_at, np.array(plain_at + other_at, np.int64)])
        first = self.known.n
        if words:
            found = self.plain.encode(words, is_pretokenized=True, add_special_tokens=False)
            sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))
            self.sequences.add(np.add.reduceat(sizes, firsts), np.array(found.ids, np.uint32))
        if other_at:
            texts = [data[starts[i]:ends[i]].tobytes().decode() for i in other_at]
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.sequences.add(sizes, np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())))
        self.known.put(hashes[order], first)

    def _ids_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of at most half as many pieces as are remembered, and how many each has."""
        where = self.known.find(hashes)
        missing = where < 0
        if missing.any():
            fresh, place = np.unique(hashes[missing], return_index=True)
            place = np.flatnonzero(missing)[place]
            if self.known.n + len(fresh) > MEMO_PIECES or self.sequences.used > MEMO_IDS:
                self._clear()
                fresh, place = np.unique(hashes, return_index=True)
                missing[:] = True
            for at in range(0, len(fresh), LEARNED):
                some = place[at:at + LEARNED]
                self._learn(fresh[at:at + LEARNED], data, starts[some], ends[some])
            where[missing] = self.known.find(hashes[missing])
        return self.sequences.joined(where)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each row of a run of rows."""
        raw = data.tobytes()
        if not self.by_words:
            return [self._whole(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        data = common.LOWER[data]
        parts, sizes, begins = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
        for starts, ends, hashes in common.word_blocks(data, offsets):
            for at in range(0, len(starts), MEMO_PIECES // 2):
                some = slice(at, at + MEMO_PIECES // 2)
                ids, counts = self._ids_of(data, starts[some], ends[some], hashes[some])
                parts.append(ids)
                sizes.append(counts)
            begins.append(starts)
        cuts = np.cumsum(np.concatenate(sizes))[np.searchsorted(np.concatenate(begins), offsets)]
        flat = np.concatenate(parts)
        out = [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        if SPECIAL in raw:
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                if SPECIAL in raw[a:b]:
                    out[i] = self._whole(raw[a:b].decode())
        return out


_kept: dict[str, Encoder] = {}
_idle: list[threading.Timer] = []


@contextmanager
def kept_encoder(path: str) -> Iterator[Encoder]:
    """The worker's encoder for a vocabulary file; it is dropped when it has not been asked for again for IDLE seconds."""
    while _idle:
        _idle.pop().cancel()
    own = _kept.pop(path, None) or Encoder(path)
    try:
        yield own
    finally:
        _kept.clear()
        _kept[path] = own
        timer = threading.Timer(IDLE, _let_go)
        timer.daemon = True
        _idle.append(timer)
        timer.start()


def _let_go() -> None:
    _kept.clear()
    common.release_memory()


def encoded(column: pa.Array, encoder: Encoder, end_id: int | None) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and id arrays of each run of rows."""
    tail = np.array([] if end_id is None else [end_id], np.uint32)
    for first, _, data, offsets in common.byte_groups(column):
        yield first, [np.concatenate([ids, tail]) for ids in encoder.encode(data, offsets)]


# --- dictionary -----------------------------------------------------------------------------

def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from serialized id arrays; raw samples where there are too few to train on; empty without any."""
    samples = [s for s in samples if s]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = None
    if dictionary:
        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


# --- blocks ---------------------------------------------------------------------------------

def pack_block(rows: list[tuple[int | None, int, bytes]], width: int, digest: bytes) -> bytes:
    """A block from (doc_id, tokens, frame)."""
    head = HEAD.pack(MAGIC, VERSION, width, digest, len(rows))
    ids = np.array([0 if r[0] is None else r[0] for r in rows], "<i8").tobytes()
    nulls = np.array([r[0] is None for r in rows], np.uint8).tobytes()
    counts = np.array([r[1] for r in rows], "<u8").tobytes()
    offsets = np.concatenate([[0], np.cumsum([len(r[2]) for r in rows])]).astype("<u8").tobytes()
    return b"".join([head, ids, nulls, counts, offsets, *(r[2] for r in rows)])


class Block:
    """A packed block, read through its offset index."""

    def __init__(self, payload: bytes, dictionary: bytes) -> None:
        magic, version, self.width, digest, n = HEAD.unpack_from(payload)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token block of this version")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        at = HEAD.size
        self.payload, self.n = payload, n
        self.doc_ids = np.frombuffer(payload, "<i8", n, at)
        self.nulls = np.frombuffer(payload, np.uint8, n, at + 8 * n).astype(bool)
        self.counts = np.frombuffer(payload, "<u8", n, at + 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(payload, "<u8", n + 1, at + 17 * n).astype(np.int64) + at + 17 * n + 8 * (n + 1)
        self.reader = _decompressor(dictionary)

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document; no other frame is touched."""
        raw = self.reader.decompress(self.payload[self.offsets[i]:self.offsets[i + 1]],
                                     max_output_size=int(self.counts[i]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int | None = 1, partitions: int | None = None, task_bytes: int = TASK_BYTES,
) -> None:
    """Encode docs (doc_id, text) and write them under path, in ascending doc_id order.

    NULL texts are empty; rows with a NULL doc_id come first; rows that repeat a doc_id all stay, ordered by the first HEAD_CHARS
    characters of their text, then by its hash.
    An empty table gives a store without documents. Other columns are not read. Without `partitions` there are as many as the texts have
    ``task_bytes``, at least one for every core.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept_encoder(vocabulary) as encoder:
            for batch in batches:
                for _, lists in encoded(batch.column(0), encoder, end_id):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_serial(x, width) for x in lists], pa.binary())], names=["ids"])

    width = _id_width(vocabulary, end_id)
    sample = (docs.where(F.length("text").between(1, SAMPLE_CHARS))
              .orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(SAMPLE_DOCS).select("text"))
    dictionary = train_dictionary([r.ids for r in sample.mapInArrow(common.tidy(serialize), "ids binary").collect()])
    spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    digest = hashlib.sha256(dictionary).digest()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept_encoder(vocabulary) as encoder:
            yield from blocks_of(batches, encoder)

    def blocks_of(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[pa.RecordBatch]:
        part, block, start = 0, 0, 0
        squeeze = _compressor(dictionary)
        rows: list[tuple[int | None, int, bytes]] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal block, start
            n = sum(r[1] for r in rows)
            one = [part, block, rows[0][0], rows[-1][0], len(rows), start, n, pack_block(rows, width, digest)]
            block, start = block + 1, start + n
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(one, [pa.int32(), *[pa.int64()] * 6, pa.binary()])],
                names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            names = batch.column(0).to_pylist()
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            for first, lists in encoded(batch.column(1), encoder, end_id):
                for i, ids in enumerate(lists):
                    frame = squeeze.compress(_serial(ids, width))
                    rows.append((names[first + i], len(ids), frame))
                    held += len(frame)
                    if len(rows) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                        yield close()
                        rows, held = [], 0
        if rows:
            yield close()

    # rows of one doc_id (or of none) may be many: they are dealt by their text, and equal texts by where they came from
    docs = docs.withColumns({"head": F.left("text", F.lit(HEAD_CHARS)), "key": F.xxhash64("text"), "source": F.spark_partition_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("head"), F.col("key"), F.col("source")]
    if not partitions:
        size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
        partitions = max(spark.sparkContext.defaultParallelism, -(-size // task_bytes))
    dealt = docs.repartitionByRange(partitions, *order)
    ordered = dealt.sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("part"))
    ordered.mapInArrow(common.tidy(blocks), BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def _serial(ids: np.ndarray, width: int) -> bytes:
    return ids.astype(f"<u{width}").tobytes()


def _id_width(vocabulary: str, end_id: int | None) -> int:
    return 2 if max(Encoder(vocabulary).tokenizer.get_vocab_size(), end_id or 0) < 1 << 16 else 4


def _dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids are little-endian u32 bytes, start counts the ids of all documents before."""
    dictionary = _dictionary(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row per written partition
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block = Block(payload, dictionary)
                starts = start + np.concatenate([[0], np.cumsum(block.counts)[:-1]]).astype(np.int64)
                for at in range(0, block.n, 64):
                    end = min(at + 64, block.n)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(block.doc_ids[at:end], pa.int64(), mask=block.nulls[at:end]), pa.array(starts[at:end]),
                        pa.array(block.counts[at:end]), pa.array([block.ids(i).tobytes() for i in range(at, end)], pa.binary()),
                    ], names=["doc_id", "start", "n_tokens", "ids"])

    placed = blocks.join(F.broadcast(parts), "part").select(
        (F.col("before") + F.col("start_in_part")).alias("start"), "payload")
    return placed.mapInArrow(common.tidy(unpack), "doc_id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document, from its frame alone; one list per row that had this doc_id."""
    dictionary = _dictionary(spark, path)
    rows = spark.read.parquet(f"{path}/blocks").where(
        (F.coalesce("first_doc_id", F.lit(-(1 << 63))) <= doc_id) & (F.col("last_doc_id") >= doc_id)).orderBy("part", "block").select("payload")
    found = []
    for row in rows.toLocalIterator():
        block = Block(bytes(row.payload), dictionary)
        found += [block.ids(i).tolist() for i in np.flatnonzero((block.doc_ids == doc_id) & ~block.nulls)]
    return found
