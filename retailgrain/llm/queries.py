"""The operators as named queries over the given tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgrain.llm import ann, conversations, covertree, hardneg, htmltext, jaccard, kneser, langid, lines, mixing, packing, sharding, toxicity
from retailgrain.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SHARDS = 40


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op10_weighted_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS)


@query
def op3_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents"))


@query
def op8_naive_bayes_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op4_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


@query
def op9_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(spark, table(spark, sf_dir, "documents"))


@query
def op1_simhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(spark, docs, bands=lines.BANDS)


@query
def op2_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(spark, rows, rows.where("vec_id % 20 = 0"))


@query
def op6_cover_tree_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.dedup(spark, table(spark, sf_dir, "embeddings"))


@query
def op5_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser.perplexities(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), quantile=0.95, folds=2)


@query
def op7_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query
def op11_hilbert_zone_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.mine(spark, table(spark, sf_dir, "embeddings"))


@query
def op12_banded_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversations.repair(spark, conversations.damaged(given), given.select("conv_id"))


@query
def op13_byte_convolution_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    read = langid.predict(docs.select("doc_id", "text"), langid.fit(spark, docs))
    return read.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


_REACHED = """
both_ways AS (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (SELECT DISTINCT x, x FROM both_ways UNION SELECT r.node, l.y FROM reach r JOIN both_ways l ON r.other = l.x),
found AS (SELECT node, min(other) AS component FROM reach GROUP BY 1)"""

SQL["op6_cover_tree_pairs"] = f"""
WITH RECURSIVE able AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM able p JOIN able q ON p.label = q.label AND p.vec_id < q.vec_id
  WHERE list_cosine_similarity(p.e, q.e) >= 0.98),
{_REACHED},
degree AS (SELECT x AS node, count(*) AS n FROM both_ways GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN found f ON vec_id = f.node LEFT JOIN degree d ON vec_id = d.node"""

SQL["op9_grouped_prefix_join"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT p.doc_id AS a, q.doc_id AS b FROM one p JOIN one q ON p.g = q.g AND p.doc_id < q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
{_REACHED}
SELECT doc_id, len(s) AS n_shingles, coalesce(component, doc_id) AS component_id FROM sets LEFT JOIN found ON doc_id = node"""

SQL["op11_hilbert_zone_negatives"] = """
WITH able AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
    [floor(256 * x::DOUBLE) for x in embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.l = c.l AS same, c.vec_id, list_dot_product(a.q, c.q)::BIGINT AS s
  FROM able a JOIN able c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
first AS (SELECT anchor_id, vec_id, s FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.s DESC, n.vec_id) AS rank,
  n.vec_id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM first p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s
QUALIFY rank <= 3"""
