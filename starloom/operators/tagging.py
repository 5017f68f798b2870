"""Keywords of a vocabulary table found as whole words in texts, for vocabularies of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import let
from ..functions.text import WORD
from .joins import BROADCAST_BYTES, BROADCAST_ROWS
from .staging_area import stage

MAP_BITS, MOST_MAPS = 1 << 15, 128  # of the filter that travels with the plan: 512 KB at most


def _runs(text: Column) -> Column:
    """The runs of word characters and of others that a text consists of, in order."""
    return F.regexp_extract_all(text, F.lit(f"(?s){WORD}+|(?:(?!{WORD}).)+"), F.lit(0))


def _filter(vocabulary: DataFrame, n: int) -> tuple[bytes, int]:
    """A bitmap of the phrases' hashes, 16 bits for each, and its number of bits; of fixed size beyond MOST_MAPS * MAP_BITS."""
    maps = min(MOST_MAPS, max(1, -(-16 * n // MAP_BITS)))
    place = F.pmod(F.xxhash64("phrase"), F.lit(maps * MAP_BITS))
    parts = vocabulary.select(place.alias("p")).groupBy(F.floor(F.col("p") / MAP_BITS).alias("k")).agg(
        F.bitmap_construct_agg(F.col("p") % MAP_BITS).alias("bits")).collect()
    found = {r.k: bytes(r.bits) for r in parts}
    return b"".join(found.get(k, bytes(MAP_BITS // 8)) for k in range(maps)), maps * MAP_BITS


def _may_be_known(phrase: Column, bits: bytes, size: int) -> Column:
    place = F.pmod(F.xxhash64(phrase), F.lit(size))
    byte = F.conv(F.hex(F.substring(F.lit(bits), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.get(F.array(*[F.lit(1 << i) for i in range(8)]), (place % 8).cast("int")).bitwiseAND(byte) != 0


def _phrases(text: Column, lengths: Sequence[int], bits: bytes, size: int) -> Column:
    """The distinct phrases of a text that may be keywords: runs in a row that begin with a word, in the lengths that keywords have.

    A boundary stands between word and other characters, so a keyword covers whole runs; one that ends in other
    characters counts only before a word.
    """
    def beginning(runs: Column, first: Column, i: Column) -> Column:
        def phrase(n: int) -> Column:
            last = F.size(runs) if n % 2 else F.size(runs) - 1
            parts = F.transform(F.sequence(i, i + n - 1), lambda k: F.get(runs, k))
            return F.when(i + n <= last, F.array_join(parts, ""))

        whole = F.array(*[phrase(n) for n in lengths])
        return F.when(F.rlike(first, F.lit(f"^{WORD}")), F.filter(whole, lambda p: p.isNotNull() & _may_be_known(p, bits, size)))

    def all_of(runs: Column) -> Column:
        each = F.transform(runs, lambda first, i: beginning(runs, first, i))
        return F.array_distinct(F.flatten(F.filter(each, lambda p: p.isNotNull())))

    return let(_runs(text), all_of)


def vocabulary_tags(
    df: DataFrame, key: Sequence[str], text: str, vocabulary: DataFrame, keyword: str = "keyword", order: str | None = None, name: str = "tags",
) -> DataFrame:
    """The key columns and ``name``: the keywords that occur in the text as whole words, case ignored, in the order of the vocabulary.

    The rule is that of :func:`starloom.functions.text.keyword_tags`, whose list of keywords travels as one pattern; here they are a
    table: the phrases of a text that pass a filter of bounded size are joined with it by hash and text. ``key`` identifies the
    rows of ``df``; NULL and blank texts have no tags. Of keywords that differ in case the first counts, by ``order`` or
    else by the keyword. Keywords that are NULL or do not begin with a word character are never found.
    """
    spelled = F.col(f"`{keyword}`").cast("string")
    rank = F.col(f"`{order}`") if order else spelled
    entries = vocabulary.select(F.lower(spelled).alias("phrase"), F.struct(rank.alias("rank"), spelled.alias("keyword")).alias("entry"))
    entries = entries.filter(F.rlike("phrase", F.lit(f"^{WORD}"))).groupBy("phrase").agg(F.min("entry").alias("entry"))
    entries = stage(entries.withColumn("runs", F.size(_runs(F.col("phrase")))), "vocabulary")
    known = entries.agg(F.count("*").alias("n"), F.sum(F.octet_length("phrase")).alias("bytes"), F.collect_set("runs").alias("lengths")).first()
    keys = [F.col(f"`{k}`") for k in key]
    if not known.n:
        return df.select(*keys, F.array().cast("array<string>").alias(name))
    bits, size = _filter(entries, known.n)
    phrases = _phrases(F.lower(F.col(f"`{text}`")), sorted(known.lengths), bits, size)
    found = df.select(*keys, F.explode_outer(phrases).alias("phrase"))
    # rows without a phrase keep their place by the left join, dealt by their key; a NULL entry is no tag
    found = found.withColumn("hash", F.when(F.col("phrase").isNotNull(), F.xxhash64("phrase")).otherwise(F.xxhash64(*keys)))
    side = entries.select("phrase", "entry", F.xxhash64("phrase").alias("hash"))
    if known.n <= BROADCAST_ROWS and 3 * known.bytes <= BROADCAST_BYTES:
        side = F.broadcast(side)
    tagged = found.join(side, ["hash", "phrase"], "left").groupBy(*keys).agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    return tagged.select(*keys, F.transform("entries", lambda e: e["keyword"]).alias(name))
