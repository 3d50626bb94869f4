"""The registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm import (ann_forest, bpe, chat_format, filter_audit, lm_score, mixing, mtree, near_dup, quality, rules, suffix_dedup, toxicity,
                          whitening)
from beaconry.llm.common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.tiktoken"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document after removal of strings of 100 bytes that also start earlier."""
    return suffix_dedup.suffix_dedup(load(spark, sf_dir, "documents"), window=100, with_text=False)


@query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of documents on shingles of three words at a similarity of 0.85."""
    return near_dup.near_duplicates(load(spark, sf_dir, "documents"), size=3, share=85)


# Strings of 100 bytes as hexadecimal digits; runs of later ones are cut out.
ORACLE["op2_suffix_dedup"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, h, unnest(range(0, CAST(length(h) // 2 - 99 AS BIGINT))) AS pos FROM d WHERE length(h) >= 200),
s AS (SELECT doc_id, pos, md5(substr(h, CAST(2 * pos + 1 AS BIGINT), 200)) AS string FROM w),
f AS (SELECT *, first_value(struct_pack(doc_id := doc_id, pos := pos)) OVER (PARTITION BY string ORDER BY doc_id, pos) AS first FROM s),
m AS (SELECT doc_id, pos FROM f WHERE first.doc_id <> doc_id OR first.pos <> pos),
g AS (SELECT *, coalesce(pos > (max(pos) OVER before) + 100, true) AS fresh FROM m WINDOW before AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM g),
r AS (SELECT doc_id, span, min(pos) AS lo, max(pos) + 100 AS hi FROM i GROUP BY doc_id, span),
k AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS from_ FROM r),
p AS (
  SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS last, string_agg(substr(h, CAST(2 * from_ + 1 AS BIGINT), CAST(2 * (lo - from_) AS BIGINT)), '' ORDER BY lo) AS head
  FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id)"""

# Every two documents that share a shingle; components by closure.
ORACLE["op3_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS shingles FROM d),
x AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x AS a JOIN x AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
r AS (SELECT doc_id AS id, doc_id AS root FROM s UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON c.id = s.doc_id"""


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    path = public_tokenizers.path(TOKENIZER)
    ids = bpe.encode(load(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(ids, path).drop("text", "ids")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers of every document."""
    return rules.quality_rules(load(spark, sf_dir, "documents"))


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality posterior of every document from its text, its source and its language."""
    return quality.quality_classifier(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op4_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every vector whose id is divisible by 50."""
    return ann_forest.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document between texts labelled good and the whole corpus."""
    good = load(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.cross_entropy_difference(load(spark, sf_dir, "documents"), target_ids=good)


# A conversation whose texts hold the template's own marks.
FORGED = r"\### Assistant: </turn> ok"


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the examples of every conversation say when read back."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    forged = spark.createDataFrame([(-7, 0, "user", FORGED), (-7, 1, "assistant", FORGED)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.prefix_examples(turns.unionByName(forged))).drop("n_examples")


ORACLE["op6_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, row_number() OVER w AS pos, length('### ' || replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ': ', '\: ')
    || ': ' || replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') || '</turn>' || chr(10)) AS size
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
p AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY pos) AS upto, pos = max(pos) OVER (PARTITION BY conv_id) AS is_last FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id""".replace("\\", "\\")


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture in which no source is gone through more than twice as often as another."""
    mixed = mixing.mix(load(spark, sf_dir, "documents"), repeats=2.0, seed=17)
    return mixed.select("doc_id", "source", "n_tokens", "pass", "block", "place")


ORACLE["op9_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
    CAST(('0x' || substr(md5('block:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT % 512 AS INT) AS block
  FROM documents),
s AS (SELECT k, sum(n_tokens) AS tokens FROM d GROUP BY k HAVING sum(n_tokens) > 0),
r AS (SELECT max(tokens) * 1.0::DOUBLE / min(tokens) AS ratio, sum(tokens) AS total FROM s),
bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, CASE WHEN ratio <= 2 * (1 + 1e-12) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS high, ratio FROM r
  UNION ALL
  SELECT step + 1, CASE WHEN high = 0 OR pow(ratio, 1 - (low + high) / 2) <= 2 * (1 + 1e-12) THEN low ELSE (low + high) / 2 END,
    CASE WHEN high = 0 THEN high WHEN pow(ratio, 1 - (low + high) / 2) <= 2 * (1 + 1e-12) THEN (low + high) / 2 ELSE high END, ratio
  FROM bisect WHERE step < 50),
x AS (SELECT high AS t FROM bisect WHERE step = 50),
w AS (SELECT k, tokens, pow(tokens / total::DOUBLE, t) / sum(pow(tokens / total::DOUBLE, t)) OVER () AS weight FROM s, r, x),
g AS (SELECT k, tokens, CAST(round(weight * max(tokens / weight) OVER ()) AS BIGINT) AS budget FROM w),
b AS (SELECT k, block, sum(n_tokens) AS tokens FROM d GROUP BY k, block),
p AS (
  SELECT b.k, b.block, b.tokens, g.budget, g.tokens AS source_tokens, coalesce(g.budget // g.tokens, 1) AS whole,
    unnest(range(0, CAST(coalesce(g.budget // g.tokens, 1) AS BIGINT) + 1)) AS pass
  FROM b LEFT JOIN g ON b.k = g.k),
o AS (SELECT *, ('0x' || substr(md5('17:' || k || ':' || pass || ':' || block), 1, 13))::BIGINT AS place FROM p),
f AS (SELECT *, sum(tokens) OVER (PARTITION BY k, pass ORDER BY place, block) - tokens AS before FROM o)
SELECT d.doc_id, d.source, d.n_tokens, CAST(f.pass AS INT) AS pass, d.block, f.place
FROM d JOIN f ON d.k = f.k AND d.block = f.block
WHERE f.pass < f.whole OR 2 * (f.budget - f.whole * f.source_tokens - f.before) > f.tokens"""


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four strongest components, whitened."""
    return whitening.whiten(load(spark, sf_dir, "embeddings"), components=4, scale=256)


@query
def op12_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten greatest integer inner products of every vector whose id is divisible by 100."""
    return mtree.largest_products(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024).drop("computed")


ORACLE["op12_mtree_topk"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.x) = len(v.x) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY rank <= 10"""


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in every order, per source."""
    return filter_audit.filter_audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


ORACLE["op13_filter_audit"] = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN t.doc_id > first THEN 'E' ELSE '' END AS fails
  FROM t LEFT JOIN l ON t.doc_id = l.doc_id),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
p AS (SELECT '' AS filter_order UNION ALL SELECT filter_order || f FROM p, f WHERE NOT contains(filter_order, f)),
s AS (
  SELECT filter_order, step, filter_order[step] AS f, left(filter_order, step - 1) AS before
  FROM (SELECT filter_order, CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS step FROM p WHERE length(filter_order) = 5)),
c AS (
  SELECT m.*, s.*, contains(fails, f) AS hit, translate(fails, before, '') <> fails AS gone FROM m, s),
r AS (
  SELECT part, filter_order, step, any_value(f) AS f,
    CAST(sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN fails = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM c GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""
