"""Benchmark passages in documents, found by spaced-seed hashes; DataFrame operations only.

Two aligned windows of SPAN words overlap if they differ in at most `allowed(SPAN)` places by substitution. Mask r (0, 1, 2) looks
at the positions r, r + 3, r + 6, ... of a window and ignores the others: up to two substitutions leave at least one mask
untouched, so the seeds lose no overlap. Items shorter than SPAN words are one window of their own length, with fewer
substitutions allowed.

1. Every window of every item, and every window of every document, is hashed under the three masks.
2. Document hashes are joined with item hashes: by broadcast while the item hashes are few (counted), else by a shuffle.
3. Each distinct (document, item, offset) of a hit is verified on the words themselves: every window of the item along
   this offset is compared, and the words covered by a passing window are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import keep


SPAN = 13
MASKS = 3
BROADCAST_HASHES = 2_000_000  # 16 bytes each
BROADCAST_HITS = 500_000  # four numbers each
BROADCAST_FOUND = 200_000


def allowed(width: int) -> int:
    """Substitutions allowed in a window: two from 12 words on, one from 6, else none."""
    return min(2, width // 6)


def words_of(text: str | Column) -> Column:
    """Lower-cased runs of letters and digits; NULL text has none."""
    parts = F.split(F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _seeds(hashes: Column, widths: list[int]) -> Column:
    """Array of (hash, place) of all windows of these widths under all masks."""
    def of(width: int, mask: int, array: Column) -> Column:
        return F.transform(
            F.when(F.size(array) >= width, F.sequence(F.lit(0), F.size(array) - width)).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(
                F.xxhash64(F.lit(width * MASKS + mask), *(F.get(array, i + p) for p in range(mask, width, MASKS))).alias("seed"),
                i.alias("place")))

    masks = [(w, m) for w in widths for m in range(min(MASKS, w))]
    # the outer transform binds the array once; a plain reference would be computed again for every window
    return F.flatten(F.transform(F.array(hashes), lambda h: F.concat(*(of(w, m, h) for w, m in masks))))


def _exploded(rows: DataFrame, key: list[str], widths: list[int]) -> DataFrame:
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    return rows.select(*key, F.explode(_seeds(hashes, widths)).alias("s")).select(*key, "s.*")


def _covered(doc_words: Column, item_words: Column, shift: Column, width: Column, spare: Column) -> Column:
    """Words of the item inside a passing window when the item starts at `shift` of the document."""
    low, high = F.greatest(F.lit(0), -shift), F.least(F.size(item_words), F.size(doc_words) - shift)
    same = F.transform(F.sequence(low, high - 1), lambda p: F.when(F.get(item_words, p) == F.get(doc_words, p + shift), 1).otherwise(0))
    passing = F.transform(F.array(same), lambda flags: F.filter(
        F.sequence(F.lit(0), F.size(flags) - width),
        lambda s: F.aggregate(F.slice(flags, s + 1, width), F.lit(0), lambda total, x: total + x) >= width - spare))[0]
    # union of the runs [s, s + width): a step adds what lies beyond the end so far
    total = F.aggregate(
        passing, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda state, s: F.struct((state["n"] + s + width - F.greatest(s, state["end"])).alias("n"), (s + width).alias("end")))
    return F.when(high - low >= width, total["n"]).otherwise(0)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, words): items found in a document, with the item's words covered at the best offset.

    docs needs doc_id and text, benchmark item_id and text; rows are told apart by doc_id and a hash of the text.
    """
    items = (benchmark.where("item_id is not null").select("item_id", words_of("text").alias("words"))
             .where(F.size("words") > 0).distinct())
    width = F.least(F.size("words"), F.lit(SPAN))
    items = keep(items.select("item_id", "words", width.alias("width")), "items")
    # at most SPAN different widths
    widths = sorted(r.width for r in items.select("width").distinct().collect())
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    keyed = docs.select("doc_id", "text_key", words_of("text").alias("words"))
    if not widths:
        return keyed.limit(0).select("doc_id", "text_key", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"),
                                     F.lit(0).alias("words"))
    item_seeds = None
    for w in widths:
        part = _exploded(items.where(F.col("width") == w), ["item_id"], [w])
        item_seeds = part if item_seeds is None else item_seeds.unionByName(part)
    item_seeds = keep(item_seeds.select("seed", F.col("place").alias("item_place"), "item_id").distinct(), "seeds")
    small = item_seeds.count() <= BROADCAST_HASHES
    doc_seeds = _exploded(keyed, ["doc_id", "text_key"], widths)
    hits = doc_seeds.join(F.broadcast(item_seeds) if small else item_seeds, "seed").select(
        "doc_id", "text_key", "item_id", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    hits = keep(hits, "hits")
    few = hits.count() <= BROADCAST_HITS
    named = hits.toDF("__doc", "__key", "item_id", "shift")
    joined = docs.join(
        F.broadcast(named) if few else named, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key"))
    ).select("doc_id", "text_key", words_of("text").alias("doc_words"), "item_id", "shift")
    items = items.select(F.col("item_id"), F.col("words").alias("item_words"), "width")
    spare = F.least(F.lit(2), F.floor(F.col("width") / 6).cast("int"))
    checked = joined.join(F.broadcast(items) if small else items, "item_id").select(
        "doc_id", "text_key", "item_id",
        _covered(F.col("doc_words"), F.col("item_words"), F.col("shift"), F.col("width"), spare).alias("words"))
    return checked.where("words > 0").groupBy("doc_id", "text_key", "item_id").agg(F.max("words").alias("words"))


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(__doc, __key, n_items, item_ids, n_words) of the rows that hold items; marked for broadcast while they are few."""
    found = overlaps(docs, benchmark).groupBy(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")).agg(
        F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("item_ids"), F.sum("words").alias("n_words"))
    found = keep(found, "found")
    return F.broadcast(found) if found.count() <= BROADCAST_FOUND else found


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, contaminated, n_items, item_ids (ascending), n_words (item words covered, over all items).

    NULL and empty texts hold nothing, items without words are found nowhere; equal rows get equal answers; rows with a NULL
    doc_id are kept, items with a NULL item_id are not looked for. Other columns of both tables are not read.
    """
    found = _judged(docs, benchmark)
    left = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key"))
    return left.join(found, same, "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("item_ids", F.array().cast(found.schema["item_ids"].dataType)).alias("item_ids"),
        F.coalesce("n_words", F.lit(0).cast("long")).alias("n_words"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark passage."""
    found = _judged(docs, benchmark)
    same = F.col("d.doc_id").eqNullSafe(F.col("f.__doc")) & (F.xxhash64("d.text") == F.col("f.__key"))
    return docs.alias("d").join(found.alias("f"), same, "left_anti").select("d.*")
