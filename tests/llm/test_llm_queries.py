"""The corpus queries and the pipeline on the smallest tables, against SQL or a plain version."""

import glob
import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from starloom.llm import decontaminate, pii_crf
from starloom.llm.common import table
from starloom.llm.queries import LLM, TARGETS
from starloom.operators.staging_area import stage
from test_llm_small import plain_base, plain_components, plain_overlap, plain_set

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.fixture(scope="module")
def texts(database):
    return dict(database.execute("select doc_id, text from documents").fetchall())


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("name", sorted(n for n, q in LLM.items() if q.sql))
def test_against_sql(spark, database, name):
    got, want = LLM[name].run(spark, FOLDER).toArrow(), database.execute(LLM[name].sql).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    listed = [sorted(zip(*[t.column(c).to_pylist() for c in columns]), key=repr) for t in (got, want)]
    assert listed[0] == listed[1]


def test_all_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])


def test_languages_of_held_out_documents(spark, database):
    truth = dict(database.execute("select doc_id, lang from documents").fetchall())
    got = LLM["op1_language_bloom"].run(spark, FOLDER).collect()
    assert len(got) == len(truth) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out and truth[r.doc_id]]
    assert sum(right) >= 0.95 * len(right)


def test_mixture_reaches_its_targets(spark):
    got = LLM["op2_soft_mixing"].run(spark, FOLDER).collect()
    totals = np.zeros(len(got[0].posterior.split(",")))
    for r in got:
        totals += np.array([int(x) for x in r.posterior.split(",")]) * r.n_tokens * r.rate
        assert r.rate >= 0
    wanted = [TARGETS[d] for d in sorted(TARGETS)]
    assert np.abs(totals / totals.sum() - wanted).max() < 0.03


def test_personal_data(spark, texts):
    got = {r.doc_id: r for r in LLM["op3_pii_random_field"].run(spark, FOLDER).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        base = plain_base(text or "")
        assert got[i].base_sha256 == hashlib.sha256(pii_crf.joined(base).encode()).hexdigest()
        counts = Counter(kind for kind, _, _ in base)
        assert [counts[k] for k in pii_crf.KINDS] == [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone]
        assert set(pii_crf.joined(base).split(",")) - {""} <= set(got[i].spans.split(","))


def tokens_of(rows):
    """(doc_id, start, n_tokens, ids_crc32) of (doc_id, text) in order."""
    encoder, start, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_ids(spark, texts):
    got = LLM["op4_token_store"].run(spark, FOLDER)
    assert sorted(tuple(r) for r in got.collect()) == tokens_of(texts.items())


def test_turns_render_to_legal_conversations(spark, database):
    want = dict(database.execute("select conv_id, count(*) from conversations group by 1").fetchall())
    got = {}
    for r in LLM["op6_role_repair"].run(spark, FOLDER).collect():
        got.setdefault(r.conv_id, []).append(r)
    assert {c: len(r) for c, r in got.items()} == want
    for turns in got.values():
        text = "".join(r.rendered for r in sorted(turns, key=lambda r: r.position))
        assert re.fullmatch(r"s?(ua)*u?", "".join(x[0] for x in re.findall(r"<\|(system|user|assistant)\|>", text)))


def test_quality_of_held_out_documents(spark, database):
    labels = dict(database.execute("select doc_id, quality from labels").fetchall())
    got = LLM["op7_quality_nbsvm"].run(spark, FOLDER).collect()
    assert all(r.predicted == int(r.score >= 0.7) and r.held_out == held(r.doc_id) for r in got)
    right = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert sum(right) >= 0.85 * len(right)


def test_secrets(spark, texts):
    rules = re.compile(r"(?:password=|token = \")([0-9a-f]{16,})|(AKIA[A-Z0-9]{16})")
    want = {(i, m.start(k), m.end(k)) for i, t in texts.items() for m in rules.finditer(t or "") for k in (1, 2) if m.group(k)}
    got = {(r.doc_id, r.start, r.end) for r in LLM["op10_secret_forest"].run(spark, FOLDER).where("is_secret").collect()}
    assert want <= got
    assert all(re.fullmatch(r"[A-Za-z0-9+/_\-]{16,}", texts[i][a:b]) for i, a, b in got)


def test_pipeline_stage_by_stage(spark, database):
    """Every stage against a plain version of it on the same input."""
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
                           "token-ID output"]
    labels = dict(database.execute("select doc_id, quality from labels").fetchall())
    good, unique, clean, mixed, tokens = steps.values()

    before = {r.doc_id: r.text for r in docs.collect()}
    docs = stage(good(spark, docs, FOLDER), "good")
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert docs.columns == columns
    judged = [i for i in before if i in labels]
    assert sum((i in kept) == (labels[i] == 1) for i in judged) >= 0.95 * len(judged)

    sets = {i: plain_set(t, 5) for i, t in kept.items()}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    parts = plain_components(links, ids)
    docs = stage(unique(spark, docs, FOLDER), "unique")
    assert docs.columns == columns and sorted(r.doc_id for r in docs.collect()) == [i for i in ids if parts[i] == i]

    items = [t for (t,) in database.execute("select text from benchmark").fetchall()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    shared = {w for t in items for w in re.findall(r"[^\W_]+", t.lower())}
    leaks = set()
    for i, text in rows.items():
        if len(set(re.findall(r"[^\W_]+", (text or "").lower())) & shared) >= 4:
            leaks |= {i} if any(plain_overlap(text, t) for t in items if _meet(text, t)) else set()
    docs = stage(clean(spark, docs, FOLDER), "clean")
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == rows.keys() - leaks

    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    docs = stage(mixed(spark, docs, FOLDER), "mixed")
    copies = Counter(tuple(r) for r in docs.collect())
    assert docs.columns == columns and copies.keys() == set(rows.values())  # every document stays
    totals = Counter()
    for row, n in copies.items():
        totals[row[columns.index("lang")]] += n * len((row[1] or "").split())
    share = {k: v / sum(totals.values()) for k, v in totals.items()}
    assert max(abs(share[k] - TARGETS[k]) for k in TARGETS) < 0.1  # small tables: whole copies

    got = tokens(spark, docs, FOLDER)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == tokens_of([(r.doc_id, r.text) for r in docs.collect()])


def _meet(doc, item):
    """Whether any third of a window can agree: a cheap test before all windows are compared."""
    d, b = (re.findall(r"[^\W_]+", t.lower()) for t in (doc or "", item))
    width = min(decontaminate.SPAN, len(b))
    seeds = {(m, tuple(b[s + m:s + width:3])) for s in range(len(b) - width + 1) for m in range(min(3, width))}
    return any((m, tuple(d[s + m:s + width:3])) in seeds for s in range(len(d) - width + 1) for m in range(min(3, width)))


def test_pipeline_query(spark):
    got = entry.queries()["pipeline"](spark, FOLDER)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    ends = got.agg(F.max(F.col("start") + F.col("n_tokens")), F.sum("n_tokens")).first()
    assert ends[0] == ends[1] > 0


@pytest.mark.parametrize("step", range(len(corpus_pipeline.STAGES)))
def test_stages_take_any_rows(spark, frame, step):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, __key string, rate int"
    rows = [(None, None, None, None, None, None, None, None), (None, "some words here", "en", "s", 1, "x", "y", 2), (3, "", None, None, 0, "x", "y", 2),
            (4, "a b c d e f g", "en", "s", 9, "x", "y", 2), (4, "a b c d e f g", "en", "s", 9, "x", "y", 2), (5, "word " * 300_000, "en", "s", 9, "x", "y", 2)]
    function = corpus_pipeline.STAGES[step][1]
    for docs in (frame(rows, schema), frame([], schema)):
        got = function(spark, docs, FOLDER)
        assert got.columns == docs.columns if step < 4 else got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert got.count() <= 3 * docs.count()
