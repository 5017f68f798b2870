"""Secrets in texts: candidates by pattern, false positives removed by a random forest; DataFrame operations only.

A candidate is a run of LEAST or more characters of keys and tokens (letters, digits, + / _ -) that holds a digit, or changes case
inside; a run of a known format, whatever its length and characters; or a value of LEAST_ASSIGNED or more characters behind a
key word and = or :, up to its quote or white space. The forest sees its length, its character classes and their changes, how usual its character transitions are, how much
of it dictionary words cover, the path of its document, and the words beside it. It is trained on a table of labelled
findings (`labelled_findings`: marked lines with secrets and hard negatives), of which a bounded sample of each class is taken;
transitions and dictionary are counted over all documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.core import let, rows_frame
from starloom.llm import marked_findings
from starloom.llm.common import keep, sample_per_class

LEAST, LEAST_ASSIGNED = 16, 4
SAMPLE_DOCS, SAMPLE_CHARS = 4000, 20_000  # of sample_docs only
SAMPLE_FINDINGS = 20_000  # labelled findings the forest is trained on, half of them of each class
DICTIONARY_WORDS = 400
TREES, DEPTH, SEED = 40, 9, 11
ACCEPT = 0.5
CONTEXT, PART = 48, 1024  # characters beside a candidate, and of the parts in which a text is looked up

# Formats of well-known keys, words beside secrets, and words beside other long values.
KNOWN = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^xox[abprs]-|^sk_(live|test)_|^AIza[A-Za-z0-9_\-]{30,}$|^ey[A-Za-z0-9_\-]{20,}$"
KEY_WORDS = r"(?i)(passw|passwd|pwd|secret|token|api_?key|apikey|access_?key|private|auth|credential|bearer|\bkey\b)"
OTHER_WORDS = r"(?i)(sha|md5|commit|checksum|hash|digest|uuid|guid|order|invoice|isbn|serial|card|account|\bid\b|\bref\b|build|version)"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
CODES = len(ALPHABET) + 1
PIECE = r"[^A-Za-z0-9+/_\-]"
HELD = r"[A-Za-z0-9+/_\-]"
CLASSES = "[0-9]|[a-z][A-Z]|[A-Z]{2,}[a-z]"
SHORT_FORMATS = r"(xox[abprs]-|sk_(live|test)_)"  # beginnings in KNOWN that ask for no length
# maximal runs that may be candidates: long ones, and short ones of such a beginning
RUN = f"(?<!{HELD})(?:{HELD}{{{LEAST},}}+|(?:xox|sk_){HELD}*+)"
STAND_INS = r"(?i)example|sample|dummy|fake|placeholder|change_?me|replace|insert|your[_-]|here|todo|test|xxxx|0000|1234|null|none|^\$?[<{*(]"
# a key word, the rest of its name, = or :, and the opening quote; the value (group 2) is only looked at, so that pairs inside it are found too
ASSIGNED = (r"(?=[psatcbkPSATCBK])" + KEY_WORDS + r"""[A-Za-z0-9_\-]{0,32}[\\"'\])]{0,4}[ \t]{0,4}[=:]{1,2}[ \t]{0,4}(?:\\?["'`])?(?=("""
            r"""(?<=\\["'])[^"'\\\r\n]++|(?<=`)[^`\r\n]++(?=`)"""
            r"""|(?<=")[^"\\\r\n]*+(?:\\.[^"\\\r\n]*+){0,50}+(?=")|(?<=')[^'\\\r\n]*+(?:\\.[^'\\\r\n]*+){0,50}+(?=')"""
            r"""|[^\s"'`]++(?:["'`](?=[^\s"'`,;:)\]}>])[^\s"'`]++){0,20}+))""")
AFTER = ".,;:)]}>"  # marks behind a value without quotes, not part of it
PLACEHOLDER = r"[\s()\[\]{}<]|^\$[A-Za-z_]"  # phrases, calls and names of variables
NEAR = r"(\S+\s+){0,3}\S*\s*$"  # the last words before a value


def _held(pattern: str, column: Column) -> Column:
    return F.length(F.regexp_replace(column, pattern, "")).cast("double")


def _before(lengths: Column) -> Column:
    """The sum of all that stands before each element: by blocks of about the root of their number, so the work grows with its power 1.5."""
    def sums(parts: Column) -> Column:
        return F.aggregate(parts, F.lit(0), lambda n, x: n + x)

    def by_block(a: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(a))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / size).cast("int")), lambda b: F.slice(a, b * size + 1, size))
        return let(blocks, lambda every: let(F.transform(every, sums), lambda totals: F.flatten(F.transform(
            every, lambda block, b: let(sums(F.slice(totals, F.lit(1), b)), lambda start: F.transform(
                block, lambda _, j: start + sums(F.slice(block, F.lit(1), j))))))))

    return let(lengths, lambda a: F.when(F.size(a) > 0, by_block(a)).otherwise(F.array().cast("array<int>")))


def candidates(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, path, start, end, value, left, right): candidates with their place in code points and up to CONTEXT characters beside them.

    NULL and empty texts have none; `path` names a column of docs, NULL and absent paths are empty.
    """
    docs = docs.select("doc_id", "text", (F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")).alias("path"))
    text = F.col("text")
    docs = docs.where(text.rlike(f"[A-Za-z0-9+/_\\-]{{{LEAST},}}") | text.rlike(SHORT_FORMATS) | text.rlike(ASSIGNED))

    def is_run(s: Column) -> Column:
        short = (s.startswith("xox") | s.startswith("sk_")) & s.rlike(KNOWN) & ~s.rlike(f"^{SHORT_FORMATS}$")
        return F.when(F.length(s) >= LEAST, s.rlike(CLASSES) | s.rlike(KNOWN)).otherwise(short)

    def found(m: Column) -> Column:
        lengths = F.transform(m["runs"], lambda s, i: F.length(s) + F.length(F.get(m["between"], i)))
        return let(_before(lengths), lambda before: F.filter(
            F.transform(m["runs"], lambda s, i: F.struct(s.alias("value"), (F.get(before, i) + F.length(F.get(m["between"], i))).alias("start"))),
            lambda x: is_run(x["value"])))

    def assigned(m: Column) -> Column:
        def length(i: Column) -> Column:
            return F.length(F.get(m["heads"], i)) + F.length(F.get(m["between"], i))

        lengths = F.transform(m["heads"], lambda _, i: length(i))
        marked = let(_before(lengths), lambda before: F.transform(m["values"], lambda v, i: F.struct(
            F.when(F.get(m["heads"], i).rlike("[\"'`]$"), v).otherwise(F.rtrim(v, F.lit(AFTER))).alias("value"),
            (F.get(before, i) + length(i)).alias("start"))))
        # a value that is a run as a whole has been found as one
        return F.filter(marked, lambda x: (F.length(x["value"]) >= LEAST_ASSIGNED) & ~(is_run(x["value"]) & ~x["value"].rlike(PIECE)))

    pattern = F.lit(ASSIGNED)
    pairs = F.struct(F.split("text", ASSIGNED, -1).alias("between"), F.regexp_extract_all("text", pattern, F.lit(0)).alias("heads"),
                     F.regexp_extract_all("text", pattern, F.lit(2)).alias("values"))
    # the outer transforms bind the parts once
    runs = F.struct(F.split("text", RUN, -1).alias("between"), F.regexp_extract_all("text", F.lit(RUN), F.lit(0)).alias("runs"))
    runs = F.flatten(F.transform(F.array(runs), found))
    every = F.when(text.rlike(ASSIGNED), F.concat(runs, F.flatten(F.transform(F.array(pairs), assigned)))).otherwise(runs)

    def beside(m: Column, parts: Column) -> Column:
        """The candidate with what stands beside it, out of the parts of the text around its ends."""
        start, end = m["start"], m["start"] + F.length(m["value"])
        low, first, last = F.greatest(F.lit(0), start - CONTEXT), F.floor(start / PART).cast("int"), F.floor(end / PART).cast("int")

        def two(k: Column) -> Column:
            return F.concat(F.coalesce(F.get(parts, k), F.lit("")), F.coalesce(F.get(parts, k + 1), F.lit("")))

        left = F.substring(two(first - 1), low - F.greatest(first - 1, F.lit(0)) * PART + 1, start - low)
        return F.struct(start.alias("start"), end.alias("end"), m["value"].alias("value"), left.alias("left"),
                        F.substring(two(last), end - last * PART + 1, F.lit(CONTEXT)).alias("right"))

    # all of it inside the row: a text that is carried along with each of its candidates is copied for each
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))
    whole = let(parts, lambda p: F.transform(every, lambda m: beside(m, p)))
    return docs.select("doc_id", "path", F.explode(whole).alias("m")).select("doc_id", "path", "m.*")


# --- features -------------------------------------------------------------------------------

FEATURES = ["length", "digits", "upper", "lower", "marks", "hex", "distinct", "changes", "usual", "covered", "known", "assigned", "quoted",
            "key_word", "other_word", "plain_left", "plain_right", "path_depth", "path_test", "stand_in", "repeated", "near_other"]


@dataclass(frozen=True)
class Model:
    """The forest (None: every finding scores `share`), the transition table and the dictionary."""

    forest: RandomForestClassificationModel | None
    share: float
    transitions: tuple[float, ...]
    dictionary: tuple[str, ...]


def _code(value: Column, i: Column) -> Column:
    return F.call_function("instr", F.lit(ALPHABET), F.substring(value, i, F.lit(1)))


def with_features(found: DataFrame, transitions: tuple[float, ...], dictionary: tuple[str, ...]) -> DataFrame:
    """Candidates with `features`, an array of doubles in the order of FEATURES."""
    value, n = F.col("value"), F.length("value").cast("double")
    low = F.lower(value)
    classes = value
    for pattern, one in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "9")):
        classes = F.regexp_replace(classes, pattern, one)
    table = F.array(*(F.lit(float(x)) for x in transitions))
    steps = F.transform(F.sequence(F.lit(1), F.length("value") - 1),
                        lambda i: F.get(table, (_code(low, i) * CODES + _code(low, i + 1)).cast("int")))
    words = "|".join(dictionary) or "(?!)"
    beside = F.regexp_replace(F.col("left"), r"\s+$", "")
    before_quote = F.regexp_replace(beside, r"\\?[\"'`]$", "")
    near = F.regexp_extract(F.col("left"), NEAR, 0)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    columns = {
        "length": n, "digits": _held("[^0-9]", value) / n, "upper": _held("[^A-Z]", value) / n, "lower": _held("[^a-z]", value) / n,
        "marks": _held("[A-Za-z0-9]", value) / n, "hex": _held("[^0-9a-fA-F]", value) / n,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n, "changes": F.length(classes) / n,
        "usual": F.aggregate(steps, F.lit(0.0), lambda s, x: s + x) / (n - 1),
        "covered": 1 - F.length(F.regexp_replace(low, words, "")) / n,
        "known": flag(value.rlike(KNOWN)), "assigned": flag(before_quote.rlike(r"[=:]\s*$")),
        "quoted": flag(beside.rlike("[\"'`]$")), "key_word": flag(near.rlike(KEY_WORDS)), "other_word": flag(near.rlike(OTHER_WORDS)),
        "plain_left": flag(F.col("left").rlike(r"[a-z]+[.,]?\s+$")), "plain_right": flag(F.col("right").rlike(r"^[.,\"']?\s+[A-Za-z]+")),
        "path_depth": F.length(F.regexp_replace("path", "[^/]", "")).cast("double"),
        "path_test": flag(F.col("path").rlike("(?i)test|example|sample|fixture|doc")),
        "stand_in": flag(value.rlike(STAND_INS)), "repeated": F.length(F.regexp_replace(low, r"(.{1,4}?)\1+", "$1")) / n,
        "near_other": flag(F.regexp_extract(F.col("left"), r"\S*\s*$", 0).rlike(OTHER_WORDS)),
    }
    return found.withColumn("features", F.array(*(columns[name].cast("double") for name in FEATURES)))


# --- training -------------------------------------------------------------------------------

def labelled_findings(spark: SparkSession, held_out: bool | None = None) -> DataFrame:
    """Candidates of the marked lines with `label`: 1.0 for those that lie in a marked secret, else 0.0; doc_id is the line's number.

    With `held_out` only the lines of every fourth form (True) or of the others (False), so that no form is in both.
    """
    marked = [(i, x.text, x.path, x.start, x.end, x.secret) for i, x in enumerate(marked_findings.lines())
              if held_out is None or (x.form % 4 == 2) == held_out]
    rows = rows_frame(spark, marked, "doc_id bigint, text string, path string, first int, last int, secret boolean")
    places = rows.select("doc_id", "first", "last", "secret")
    inside = F.col("secret") & (F.col("start") < F.col("last")) & (F.col("end") > F.col("first"))
    found = candidates(rows, "path").join(F.broadcast(places), "doc_id")  # a few thousand lines
    return found.select("doc_id", "path", "start", "end", "value", "left", "right", inside.cast("double").alias("label"))


def label_by_rules(found: DataFrame) -> DataFrame:
    """Findings labelled without a table of marked ones: 1 for values of a known format or assigned to a key word, else 0.

    A forest trained on these can do no more than repeat the rule.

    An assigned value that is no run of LEAST characters must mix letters, digits or marks for a 1. Words and numbers alone are 0
    behind a colon (as in prose), and undecided (NULL) behind = or a quote.
    """
    value, left = F.col("value"), F.col("left")
    near = F.regexp_extract(left, NEAR, 0)
    assigned = left.rlike(r"[=:]\s*(\\?[\"'`])?$") & near.rlike(KEY_WORDS)
    run = (F.length(value) >= LEAST) & ~value.rlike(PIECE) & value.rlike(CLASSES)
    mixed = value.rlike("[0-9].*[A-Za-z]|[A-Za-z].*[0-9]") | (value.rlike("[!@#$%^&*+=~?]") & value.rlike("[A-Za-z0-9]"))
    plain = ~mixed & ~value.rlike(PLACEHOLDER) & ~left.rlike(r":\s*$")
    label = (F.when(value.rlike(KNOWN) | (assigned & (run | (mixed & ~value.rlike(PLACEHOLDER)))), 1.0)
             .when(assigned & plain, F.lit(None)).otherwise(0.0))
    return found.withColumn("label", label.cast("double"))


def sample_docs(docs: DataFrame) -> DataFrame:
    """At most SAMPLE_DOCS documents of at most SAMPLE_CHARS characters that hold a long run, by a hash of doc_id and text.

    For trials on few documents: rare keys are not in it, so a model for a whole table is fitted on all of its findings.
    """
    some = docs.where((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike(r"[A-Za-z0-9+/_\-]{16,}"))
    return keep(some.orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(SAMPLE_DOCS), "sample")


def fit(labelled: DataFrame, docs: DataFrame) -> Model:
    """Train on labelled findings (candidates with label 0.0 or 1.0), at most SAMPLE_FINDINGS / 2 of each label by a hash.

    Both labels weigh the same in total, however rare one is. docs (doc_id, text) gives character transitions and dictionary
    words, all of it. With one class only the score is 0.0 or 1.0, without any finding 0.5; findings with a NULL label are not
    used, and findings that are the same in every column count once.
    """
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("w")).where("length(w) between 2 and 64")
    words = keep(words.groupBy("w").agg(F.count("*").alias("n")), "words")
    pairs = words.select("n", F.explode(F.sequence(F.lit(1), F.length("w") - 1)).alias("i"), "w").groupBy(
        (_code(F.col("w"), F.col("i")) * CODES + _code(F.col("w"), F.col("i") + 1)).alias("pair")).agg(F.sum("n").alias("n"))
    counts = {r.pair: r.n for r in pairs.collect()}  # at most CODES squared
    total = sum(counts.values()) + CODES * CODES
    transitions = tuple(math.log((counts.get(i, 0) + 1) / total) for i in range(CODES * CODES))
    usual = words.where("w rlike '^[a-z]{4,}$'").orderBy(F.desc("n"), "w").limit(DICTIONARY_WORDS).collect()
    dictionary = tuple(sorted((r.w for r in usual), key=lambda w: (-len(w), w)))
    labelled = keep(labelled.where("label is not null").distinct(), "labelled")
    every = labelled.withColumn("__id", F.struct(*labelled.columns))
    rows = with_features(sample_per_class(every, "label", "__id", SAMPLE_FINDINGS // 2), transitions, dictionary)
    order = [F.xxhash64("value", "left", "right"), F.col("value"), F.col("left"), F.col("right"), F.col("label")]
    rows = rows.orderBy(*order).limit(SAMPLE_FINDINGS).select("label", "features")
    rows = keep(rows.coalesce(1), "findings")
    share = rows.agg(F.avg("label").alias("s")).first().s
    if share is None or share in (0.0, 1.0):
        return Model(None, 0.5 if share is None else share, transitions, dictionary)
    trees = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    weight = F.when(F.col("label") == 1, 0.5 / share).otherwise(0.5 / (1 - share))
    forest = trees.setWeightCol("weight").fit(rows.select("label", weight.alias("weight"), array_to_vector("features").alias("vector")))
    return Model(forest, share, transitions, dictionary)


# --- scanning -------------------------------------------------------------------------------

def scored(found: DataFrame, model: Model) -> DataFrame:
    """Candidates, all columns but those of the forest, with `score`."""
    rows = with_features(found, model.transitions, model.dictionary)
    if model.forest is None:
        return rows.withColumn("score", F.lit(float(model.share))).drop("features")
    score = F.get(vector_to_array("probability"), F.lit(1))
    return model.forest.transform(rows.withColumn("vector", array_to_vector("features"))).withColumn("score", score).select(
        *found.columns, "score")


def scan(docs: DataFrame, model: Model, path: str | None = None) -> DataFrame:
    """One row per candidate: doc_id, start, end, value_sha256, score, is_secret (score of ACCEPT or more).

    The values themselves are not returned. NULL and empty texts give no rows; repeated rows of docs repeat their findings; a NULL
    doc_id stays NULL.
    """
    rows = scored(candidates(docs, path), model).withColumn("value_sha256", F.sha2("value", 256))
    return rows.select("doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "value_sha256",
                         "score", (F.col("score") >= ACCEPT).alias("is_secret"))
