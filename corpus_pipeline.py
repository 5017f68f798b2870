"""From raw documents to token ids in five stages, each on all that the one before kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame; all but the last return the columns of documents. Its result is
written as Parquet and read again as the next one's docs.

Every stage takes any rows: whole texts of any length; columns of other names and types beside those it reads, which come back as they
are; an empty table, which stays empty. Where rows repeat, or lack an id or a text, each stage says what becomes of them.

Texts go to Python in Arrow batches of BATCH_BYTES at most (or one longer text), which every stage sets for the session: an executor holds a
batch several times, once more while it grows, in its own memory and in a worker's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontaminate, mixing, quality_nbsvm, setsketch_dedup, token_store
from starloom.llm.common import table
from starloom.llm.queries import TARGETS, language_labels
from starloom.operators.staging_area import stage, staged_path
from starloom.queries.registry import Query

Step = Callable[[SparkSession, DataFrame, str], DataFrame]
BATCH_BYTES = 4 << 20
TASK_BYTES = 8 << 20  # of text that a task of the token stage sorts and encodes


def small_batches(step: Step) -> Step:
    """The stage with Arrow batches of at most BATCH_BYTES, from its first job to the write of its result."""
    @wraps(step)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return step(spark, docs, sf_dir)

    return bounded


@small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.7 or more).

    Every row is judged by its own text: rows that repeat a doc_id or have none too; a NULL text as an empty one.
    """
    model = quality_nbsvm.fit(docs, table(spark, sf_dir, "labels"))
    return quality_nbsvm.accepted(docs, model)


@small_batches
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8 or more, smallest doc_id.

    Rows that repeat a doc_id with another text are documents of their own; of rows that repeat both, one stays. Rows without a doc_id all
    stay, and a text without words is near to nothing.
    """
    return setsketch_dedup.without_near_duplicates(docs, words=5, percent=80)


@small_batches
def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages. Every row is judged by its own text; a NULL or empty text holds no passage."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


@small_batches
def target_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated until the languages' token totals match TARGETS; none is left out (rates are 1 or more).

    Rows that repeat doc_id and text are repeated alike; a NULL or empty text has no tokens, and its row comes by its even posterior. Targets
    that would need more than ten times the tokens stop the job.
    """
    labels = language_labels(docs, table(spark, sf_dir, "labels"))
    return mixing.repeated(docs, labels, TARGETS, lowest=1.0)


@small_batches
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary blocks, read back: doc_id, start, n_tokens, ids_crc32.

    Every row is a document, in ascending order of doc_id, those without one first and rows that repeat one in the order of their
    text; a NULL or empty text has the end id alone.
    """
    path = staged_path(spark, "tokens")
    token_store.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1, task_bytes=TASK_BYTES)
    return token_store.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", no_benchmark),
    ("mixing sources to target weights", target_mixture),
    ("token-ID output", token_ids),
]

# Trained models and a tokenizer decide; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs


PIPELINE = {"pipeline": Query(run, ORACLE_SQL)}
