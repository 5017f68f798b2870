"""The corpus operators as queries on whole tables, with SQL twins where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    collocations, decontaminate, language_id, mixing, pii_crf, quality_nbsvm, role_repair, secret_forest, setsketch_dedup, substring_dedup,
    token_store, vector_neardup, whitening,
)
from starloom.llm.common import held_out, table
from starloom.operators.staging_area import staged_path
from starloom.queries.registry import Query

LLM: dict[str, Query] = {}


def _add(name: str, sql: str | None = None):
    def put(run):
        LLM[name] = Query(run, sql)
        return run

    return put


@_add("op1_language_bloom")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.fit(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


# Shares of tokens by language, and the labelled rows that teach the classifier.
TARGETS = {"en": 0.50, "fr": 0.18, "de": 0.17, "es": 0.15}


def language_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the language of the documents that have labels."""
    return docs.select("doc_id", F.col("lang").alias("domain")).join(labels.select("doc_id"), "doc_id", "left_semi")


@_add("op2_soft_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of documents under which languages reach target shares of the tokens."""
    docs = table(spark, sf_dir, "documents")
    found = mixing.mixed(docs.select("doc_id", "text"), language_labels(docs, table(spark, sf_dir, "labels")), TARGETS)
    return found.select("doc_id", "n_tokens", "domain", F.array_join(F.col("posterior").cast("array<string>"), ",").alias("posterior"),
                        "rate")


@_add("op3_pii_random_field")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_crf.find(docs, pii_crf.fit(pii_crf.labelled_sample(docs)))


@_add("op4_token_store")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of documents, written and read back."""
    path = staged_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_store.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


OP5_SQL = """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select x.vec_id as a, y.vec_id as b from v x join v y on x.vec_id <> y.vec_id and len(x.e) = len(y.e)
  where list_cosine_similarity(x.e, y.e) >= 0.95),
reach(vec_id, r) as (select vec_id, vec_id from embeddings union select b, r from reach join links on a = reach.vec_id),
found as (select vec_id, min(r) as component_id from reach group by vec_id),
counts as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept from found left join counts on a = vec_id
"""


@_add("op5_collision_counting", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of vectors."""
    return vector_neardup.near_vectors(table(spark, sf_dir, "embeddings"), 0.95)


@_add("op6_role_repair")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired and rendered turns of all conversations."""
    return role_repair.repair(table(spark, sf_dir, "conversations"))


@_add("op7_quality_nbsvm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_nbsvm.score(docs, quality_nbsvm.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


OP8_SQL = r"""
with d as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as w from documents),
b as (select item_id, w, least(13, len(w)) as width, least(2, least(13, len(w)) // 6) as spare from (
  select item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as w from benchmark) where len(w) > 0),
masks as (select distinct width, unnest(generate_series(0, least(3, width) - 1)) as mask from b),
dp as (select doc_id, w, width, mask, unnest(generate_series(1, len(w) - width + 1)) as p from d, masks where len(w) >= width),
ds as (select doc_id, p, width, mask, array_to_string(list_slice(w, p + mask, p + width - 1, 3), ' ') as seed from dp),
bp as (select item_id, w, width, unnest(generate_series(1, len(w) - width + 1)) as p from b),
bs as (select item_id, p, bp.width, mask, array_to_string(list_slice(w, p + mask, p + bp.width - 1, 3), ' ') as seed
  from bp join masks on masks.width = bp.width),
hits as (select distinct doc_id, item_id, ds.p - bs.p as shift from ds join bs using (width, mask, seed)),
flags as (select doc_id, item_id, shift, i, width, spare, coalesce(d.w[i + shift] = b.w[i], false)::int as same
  from hits join d using (doc_id) join (select *, unnest(generate_series(1, len(w))) as i from b) b using (item_id)
  where i + shift between 1 and len(d.w)),
windows as (select *, sum(same) over (partition by doc_id, item_id, shift order by i rows between current row and 12 following) as long_sum,
  sum(same) over (partition by doc_id, item_id, shift) as full_sum,
  count(*) over (partition by doc_id, item_id, shift order by i rows between current row and 12 following) as reach,
  count(*) over (partition by doc_id, item_id, shift) as present from flags),
passing as (select doc_id, item_id, shift, i, width from windows where
  (width = 13 and reach = 13 and long_sum >= 11) or (width < 13 and present = width and full_sum >= width - spare)),
covered as (select p.doc_id, p.item_id, p.shift, count(distinct f.i) as n from passing p join flags f
  on p.doc_id = f.doc_id and p.item_id = f.item_id and p.shift = f.shift and
    ((p.width = 13 and f.i between p.i and p.i + 12) or p.width < 13) group by all),
best as (select doc_id, item_id, max(n) as n from covered group by all),
found as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id) as item_ids, sum(n) as n_words
  from best group by all)
select documents.doc_id, found.doc_id is not null as contaminated, coalesce(n_items, 0) as n_items,
  coalesce(item_ids, '') as item_ids, coalesce(n_words, 0)::bigint as n_words
from documents left join found using (doc_id)
"""


@_add("op8_spaced_seed_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("item_ids", F.array_join(F.col("item_ids").cast("array<string>"), ","))


OP9_SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [w]
    else list_transform(generate_series(1, len(w) - 3), lambda i: w[i:i + 3]) end) as s from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select x.doc_id as a, y.doc_id as b, count(*) as c from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id
  group by 1, 2),
links as (select a, b from shared join sizes p on a = p.doc_id join sizes q on b = q.doc_id
  where 100 * c >= 80 * (p.n + q.n - c)),
sides as (select a, b from links union all select b, a from links),
reach(doc_id, r) as (
  select doc_id, doc_id from words
  union select s.b, reach.r from reach join sides s on s.a = reach.doc_id),
found as (select doc_id, min(r) as component_id from reach group by doc_id)
select found.doc_id, coalesce(n, 0) as n_shingles, component_id, found.doc_id = component_id as kept
from found left join sizes on sizes.doc_id = found.doc_id
"""


@_add("op9_setsketch_near_duplicates", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of documents by 4-word shingles."""
    return setsketch_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@_add("op10_secret_forest")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in every document, each with the forest's score."""
    docs = table(spark, sf_dir, "documents")
    model = secret_forest.fit(secret_forest.labelled_findings(spark), docs)
    return secret_forest.scan(docs, model, "source")


OP11_SQL = r"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
words as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
runs as (select lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) as phrase
  from words, (select unnest(generate_series(1, 5)) as k) where len(w) >= k),
counts as (select lang, k, phrase, count(*) as c, string_split(phrase, ' ') as w from runs group by lang, k, phrase having count(*) >= 100),
cuts as (select lang, k, phrase, c as a, w, unnest(generate_series(1, k - 1)) as cut from counts where k > 1),
scored as (select x.lang, x.phrase, x.a, x.cut, p.c as l, q.c as r, t.n, (1000::hugeint * x.a * t.n) // (p.c::hugeint * q.c) as score
  from cuts x join totals t using (lang)
  join counts p on p.lang = x.lang and p.phrase = array_to_string(list_slice(x.w, 1, x.cut), ' ')
  join counts q on q.lang = x.lang and q.phrase = array_to_string(list_slice(x.w, x.cut + 1, x.k), ' ')),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_runs as (select lang, c, w, k, m, unnest(generate_series(1, k - m + 1)) as s
  from counts, (select unnest(generate_series(2, 4)) as m) where k > m),
within as (select lang, array_to_string(list_slice(w, s, s + m - 1), ' ') as phrase, max(c) as c from inner_runs group by all),
kept as (select lowest.* from lowest left join within using (lang, phrase) where within.c is null or 100 * within.c < 100 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from kept qualify rank <= 2000
"""


@_add("op11_phrase_collocations", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language."""
    found = collocations.collocations(table(spark, sf_dir, "documents"), least=100, top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
with texts as (select row_number() over () as t, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
places as (select t, w, unnest(generate_series(1, len(w))) as i from texts),
windows as (select t, i, w[i] as word, case when i + 34 <= len(w) then array_to_string(list_slice(w, i, i + 34), ' ') end as passage from places),
marked as (select t, i, word, case when passage is not null and count(*) over (partition by passage) > 1 then 1 else 0 end as again from windows),
covered as (select t, i, word, max(again) over (partition by t order by i rows between 34 preceding and current row) = 1 as gone from marked),
kept as (select t, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept from covered group by t)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join kept using (t)
"""


@_add("op12_prefix_suffix_trees", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that stand elsewhere too."""
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"), width=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_add("op13_cholesky_jacobi_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)
