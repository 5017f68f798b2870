"""Phrase collocations, repeated passages and whitening on small tables, against plain versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import collocations, substring_dedup, whitening, word_spans
from starloom.llm.queries import LLM

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- shared parts ---------------------------------------------------------------------------

def test_fingerprints_do_not_depend_on_the_place():
    values = np.arange(1, 2000, dtype=np.uint64) % np.uint64(17)
    sums = word_spans.prefix_sums(values)
    at = np.array([3, 3 + 17, 3 + 170, 4])
    got = word_spans.fingerprints(sums, at, at + 9)
    assert got[0] == got[1] == got[2] != got[3]


def test_words_of_long_rows_hash_as_those_of_short_ones(monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abAB") for _ in range(rng.randint(1, 30))) for _ in range(3000))
    inside = substring_dedup.INSIDE
    whole = next(word_spans.text_runs(pa.array([text]), inside, True)).hashes
    monkeypatch.setattr(word_spans, "CHUNK_BYTES", 64)
    assert np.array_equal(next(word_spans.text_runs(pa.array([text]), inside, True)).hashes, whole)
    split = [r.hashes for r in word_spans.text_runs(pa.array(text.lower().split()), inside, False)]
    assert np.array_equal(np.concatenate(split), whole)


def test_bit_filter_passes_what_it_holds(frame):
    values = [int(v) for v in np.random.default_rng(2).integers(-1 << 63, (1 << 63) - 1, 5000)]
    bits = word_spans.bit_filter(frame([(v,) for v in values], "p long"), "p")
    assert word_spans.passes(bits, np.array(values).view(np.uint64)).all()
    others = np.random.default_rng(3).integers(0, (1 << 63) - 1, 5000, dtype=np.uint64)
    assert word_spans.passes(bits, others).mean() < 0.05
    assert not word_spans.passes(word_spans.bit_filter(frame([], "p long"), "p"), others).any()


# --- 11: phrases ----------------------------------------------------------------------------

def plain_counts(rows):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 6):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return counts, totals


def plain_collocations(rows, least, top):
    counts, totals = plain_counts(rows)
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        within = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    within[p[s:s + m]] = max(within[p[s:s + m]], a)
        ranked = []
        for p, a in found.items():
            score, cut = min((1000 * a * totals[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            if 100 * within[p] < 100 * a:
                ranked.append((-score, -a, " ".join(p).encode(), c[p[:cut]], c[p[cut:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], totals[lang], -x[0]) for i, x in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def listed(found):
    return sorted(tuple(r)[:8] for r in found.collect())


def some_texts(n, seed, vocabulary="a b c dé D, e. f; G\th  i\nj"):
    rng = random.Random(seed)
    parts = vocabulary.split(" ")
    return ["".join(rng.choice(parts) + rng.choice([" ", " ", "  ", "\t"]) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("least,top", [(2, 10_000), (12, 7)])
def test_phrases_are_those_of_a_plain_count(frame, least, top):
    rows = [(i, t, ("en", "fr", None, "und")[i % 4]) for i, t in enumerate(some_texts(150, 1))]
    rows += [(None, None, "en"), (7, "", None), (7, rows[7][1], rows[7][2]), (900, "!?.,", "de"), (901, "a b " * 400, "en")]
    got = collocations.collocations(frame([(*r, "mine", 1, 2) for r in rows], DOCS + ", phrase string, rank int, score int"), least, top)
    assert listed(got) == plain_collocations([(t, x) for _, t, x in rows], least, top)


def test_pointers_lead_to_the_phrase(frame):
    rows = [(i, t, "en") for i, t in enumerate(some_texts(60, 2))]
    texts = {i: re.split(r"[\s.,;:!?]+", t.lower().strip(" \t\n.,;:!?")) for i, t, _ in rows}
    for r in collocations.collocations(frame(rows, DOCS), 5, None).collect():
        w = r.phrase.split(" ")
        assert texts[r.first_doc_id][r.first_place:r.first_place + len(w)] == w


def test_colliding_words_and_phrases_are_told_apart(frame, monkeypatch):
    """With hashes of a few bits nearly everything collides; the counts stay exact."""
    rows = [(i, t, "en") for i, t in enumerate(some_texts(50, 3))]
    docs = frame(rows, DOCS)
    want = plain_collocations([(t, x) for _, t, x in rows], 10, 500)
    real = collocations.mix
    few = np.uint64(0xF)
    part = next(collocations.text_runs(pa.array([t for _, t, _ in rows]), collocations.INSIDE, True))
    numbers = collocations._word_numbers(part._replace(hashes=part.hashes & few))
    words = [part.data[a:b].tobytes() for a, b in zip(part.starts, part.ends)]
    assert len(set(zip(numbers.tolist(), words))) == len(set(words)) == len(set(numbers.tolist()))
    at = np.arange(len(words) - 1)
    first, n = collocations._told_apart(numbers, at, real(part.hashes[:-1]) & few, 2)
    assert Counter({(words[i], words[i + 1]): c for i, c in zip(first.tolist(), n.tolist())}) == Counter(zip(words, words[1:]))
    assert listed(collocations.collocations(docs, 10, 500)) == want


def test_slices_of_words_and_handed_over_parts_change_nothing(frame, monkeypatch):
    rows = [(0, " ".join(some_texts(30, 5)), "en"), (1, "x", "en")]
    want = plain_collocations([(t, x) for _, t, x in rows], 3, 500)
    monkeypatch.setattr(collocations, "SLICE", 7)  # read where tasks are made: the workers hold the module's own value
    part = next(collocations.text_runs(pa.array([rows[0][1]]), collocations.INSIDE, True))
    got = [Counter() for _ in range(6)]
    for _, grams in collocations._grams(part, np.zeros(1, np.uint64), range(1, 6)):
        for k, (values, whole) in grams.items():
            got[k].update(values[whole].tolist())
    counts, _ = plain_counts([(rows[0][1], "en")])
    for k in range(1, 6):
        assert sorted(got[k].values()) == sorted(c for p, c in counts["en"].items() if len(p) == k)
    assert listed(collocations.collocations(frame(rows, DOCS), 3, 500)) == want


def test_scores_beyond_64_bits(spark):
    a, n, l, r = 10 ** 14 + 7, 10 ** 17 + 3, 10 ** 15 + 1, 10 ** 14 + 9
    exact = "decimal(19,0)"
    got = spark.range(1).selectExpr(
        f"cast(1000 * {a}L as {exact}) * cast({n}L as {exact}) div (cast({l}L as {exact}) * cast({r}L as {exact})) as s").first().s
    assert got == 1000 * a * n // (l * r)


def test_no_phrases_in_an_empty_table(frame):
    assert collocations.collocations(frame([], DOCS)).collect() == []
    assert collocations.collocations(frame([(1, None, None), (2, "a b", "en")], DOCS)).collect() == []


# --- 12: passages ---------------------------------------------------------------------------

def plain_passages(texts, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    windows = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if windows[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), kept))
    return out


def passages(seed, n=80):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "b", "ccc", "é", "x" * 70, "x" * 69 + "y"]
    some = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    shared = [some(rng.randint(8, 60)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [some(rng.randint(0, 30)) if rng.random() < 0.6 else rng.choice(shared) for _ in range(rng.randint(0, 5))]
        texts.append("".join(w + rng.choice([" ", "\n", "\t  ", "\r\n"]) for p in parts for w in p))
    return texts


@pytest.mark.parametrize("width,most", [(35, None), (9, None), (12, 2), (35, 1)])
def test_passages_are_those_of_a_plain_comparison(frame, monkeypatch, width, most):
    if most is not None:  # nearly all prefixes are crowded
        monkeypatch.setattr(substring_dedup, "MOST", most)
    texts = [None, "", " \n", "one", *passages(width), *passages(width + 1, 40), "again " * 500, "a b " * 300, *passages(99, 5) * 3]
    ids = [None, 5, 5, *range(10, 7 + len(texts))]
    got = substring_dedup.without_repeats(
        frame([(i, t, "mine", 3) for i, t in zip(ids, texts)], "doc_id long, text string, kept string, n_words int"), width).collect()
    want = plain_passages(texts, width)
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr((i, *w)) for i, w in zip(ids, want))


def test_no_passages_in_an_empty_table(frame):
    assert substring_dedup.without_repeats(frame([], "doc_id long, text string")).collect() == []


def test_windows_have_an_anchor_and_equal_windows_the_same_one():
    texts = passages(1, 60)
    run = next(word_spans.text_runs(pa.array(texts), substring_dedup.INSIDE, False))
    grams, low = substring_dedup.window_minima(run, 12)
    at = set(substring_dedup.anchors(grams, low, 12).tolist())
    words = [run.data[a:b].tobytes() for a, b in zip(run.starts, run.ends)]
    seen = {}
    for i in np.flatnonzero(low).tolist():
        inside = tuple(j for j in range(5) if i + j in at and grams[i + j] == low[i])
        assert inside and seen.setdefault(tuple(words[i:i + 12]), inside) == inside


def test_depths_of_a_subtree():
    words = np.array([[1, 2, 3], [1, 2, 4], [1, 5, 6], [1, 2, 3], [7, -1, -1], [7, -2, -2]])
    tree = substring_dedup.Subtree(np.array([0, 0, 0, 0, 0, 0]), words)
    same = lambda d: {frozenset(np.flatnonzero(tree.nodes(d) == x).tolist()) for x in tree.nodes(d)}
    assert same(1) == {frozenset({0, 1, 2, 3}), frozenset({4, 5})}
    assert same(2) == {frozenset({0, 1, 3}), frozenset({2}), frozenset({4}), frozenset({5})}
    assert same(3) == {frozenset({0, 3}), *(frozenset({i}) for i in (1, 2, 4, 5))}
    assert substring_dedup.Subtree(np.array([0, 1]), words[[0, 0]]).nodes(0).tolist() == [0, 1]  # groups stay apart


def test_groups_are_not_torn_between_batches(frame, monkeypatch):
    """Batches of three rows, groups handed on from batch to batch."""
    texts = passages(7, 60)
    session = frame([(1,)], "a int").sparkSession
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = substring_dedup.without_repeats(frame(list(enumerate(texts)), "doc_id long, text string"), 12).collect()
    finally:
        session.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(r) for r in got) == [(i, *w) for i, w in enumerate(plain_passages(texts, 12))]


# --- 13: whitening --------------------------------------------------------------------------

def plain_whitening(vectors):
    """Eigenvalues and eigenvectors by another method, over the distinct vectors of longs."""
    x = np.unique(np.array(vectors), axis=0)
    centred = x - x.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    return len(x), x.sum(0), values[::-1], axes[:, ::-1]


def longs(v):
    return np.floor(64 * np.asarray(v, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000


def test_whitened_values(frame):
    rng = np.random.default_rng(5)
    spread = rng.normal(size=(20, 20)) * np.linspace(4, 0.5, 20)
    vectors = (rng.normal(size=(400, 20)) @ spread).astype(np.float32).tolist()
    odd = [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [float("inf")] + [0.0] * 19), (905, [1.0, 2.0])]
    rows = [*enumerate(vectors), *odd, *[(500 + i, vectors[3]) for i in range(30)], (None, vectors[5]), (7, vectors[9])]
    got = whitening.whiten(frame([(*r, "mine", 4) for r in rows], "vec_id long, embedding array<float>, x string, n int")).collect()
    used = [(i, longs(v)) for i, v in rows if v and len(v) == 20 and all(c is not None and np.isfinite(c) for c in v)]
    n, sums, values, axes = plain_whitening([x for _, x in used])
    assert n == 400 and len(got) == 16 * len(used)
    projected = {(i, tuple(x)): ((x - sums / n) @ axes[:, :16]) / np.sqrt(values[:16]) for i, x in used}
    by_id = defaultdict(list)
    for (i, x), p in projected.items():
        by_id[i].append((sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums)), p))
    for r in got:
        assert any(r.deviation == d and abs(abs(p[r.component - 1]) - abs(r.whitened)) < 1e-8 for d, p in by_id[r.vec_id])
        assert r.n == n and abs(r.explained * values.sum() / values[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    assert Counter(r.component for r in got) == {c: len(used) for c in range(1, 17)}


def test_as_many_components_as_the_rank(frame):
    rng = np.random.default_rng(6)
    flat = (rng.integers(-50, 50, size=(60, 3)) @ rng.integers(-3, 3, size=(3, 9))).astype(float).tolist()
    schema = "vec_id long, embedding array<double>"
    got = whitening.whiten(frame(list(enumerate(flat)), schema)).collect()
    assert {r.component for r in got} == {1, 2, 3} and abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-9
    assert max(r.identity_error for r in got) < 1e-9
    assert whitening.whiten(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []  # no spread, no component
    assert whitening.whiten(frame([], schema)).collect() == []
    assert whitening.whiten(frame([(1, None), (2, [])], schema)).collect() == []


def test_the_more_frequent_length_counts(frame):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [1.0, 2.0, 3.0]), (4, [0.0, 0.0, 9.0])]
    assert {r.vec_id for r in whitening.whiten(frame(rows, "vec_id long, embedding array<float>")).collect()} == {1, 2}


def test_factor_and_rotations():
    rng = np.random.default_rng(7)
    for d, rank in ((1, 1), (5, 5), (12, 4), (64, 64)):
        part = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-3, 3, rank)
        v = part @ part.T
        factor = whitening.pivoted_cholesky(v)
        assert factor.shape[1] <= rank and np.abs(factor @ factor.T - v).max() <= 1e-12 * np.abs(v).max()
        pivots = [int(np.flatnonzero(factor[:, k] == np.abs(factor[:, k]).max())[0]) for k in range(factor.shape[1])]
        assert not np.triu(factor[pivots], 1).any()  # triangular once the rows are in the order of the pivots
        values, axes = whitening.one_sided_jacobi(factor)
        assert (np.diff(values) <= 0).all() and np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13
        assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:len(values)], rtol=1e-6, atol=1e-12 * np.trace(v))


def test_every_pair_of_columns_meets_once():
    for n in (1, 2, 3, 6, 7):
        met = [frozenset(p) for a, b in whitening._rounds(n) for p in zip(a.tolist(), b.tolist())]
        assert len(met) == len(set(met)) == n * (n - 1) // 2


def test_deviations_beyond_64_bits():
    model = whitening.Whitening(3, np.array([5, -7]), 1.0, np.ones(1), np.ones((2, 1)), 0.0)
    x = np.array([[1 << 40, 3], [4, -2], [1 << 20, 1 << 21]])
    assert whitening.deviations(x, model) == [None, *[sum((3 * int(v) - s) ** 2 for v, s in zip(row, (5, -7))) for row in x[1:]]]


def test_query_of_all_embeddings(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    got = LLM["op13_cholesky_jacobi_whitening"].run(spark, FOLDER).collect()
    used = {r.vec_id: longs(r.embedding) for r in rows if r.embedding and all(c is not None and np.isfinite(c) for c in r.embedding)}
    n, sums, values, axes = plain_whitening(list(used.values()))
    assert len(got) == 16 * len(used) and got[0].n == n
    for r in got:
        want = float((used[r.vec_id] - sums / n) @ axes[:, r.component - 1] / np.sqrt(values[r.component - 1]))
        assert abs(abs(want) - abs(r.whitened)) < 1e-7
        assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(used[r.vec_id], sums))
        assert abs(r.explained * values.sum() / values[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
