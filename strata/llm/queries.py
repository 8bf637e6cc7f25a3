"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (ann, bpe, conversations, decontaminate, embed_dedup, langid, lm_score, merkle, minhash, pii,
               quality, toxicity, url_filter)
from .twins import CONVERSATIONS, MERKLE


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"),
                                      read_table(spark, sf_dir, "benchmark"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"))


def q_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as of good quality and not toxic; background: all documents."""
    good = read_table(spark, sf_dir, "labels").where((F.col("quality") == 1) & (F.col("toxic") == 0))
    return lm_score.cross_entropy_difference(read_table(spark, sf_dir, "documents"), good.select("doc_id"))


def q_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def q_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages", ["page_id", "url"]))


def q_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def q_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(read_table(spark, sf_dir, "documents"))


def q_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(read_table(spark, sf_dir, "conversations"))


def q_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_language_id": q_language,
    "op2_pii": q_pii,
    "op3_decontamination": q_decontamination,
    "op4_quality": q_quality,
    "op5_toxicity": q_toxicity,
    "op6_bpe": q_bpe,
    "op7_lm_score": q_lm_score,
    "op8_embedding_dedup": q_embeddings,
    "op9_url_filter": q_urls,
    "op10_minhash_near_dedup": q_minhash,
    "op11_merkle_manifest": q_merkle,
    "op12_conversation_repair": q_conversations,
    "op13_nearest_neighbours": q_nearest,
}

# Shingle sets, exact Jaccard links and their components, for small tables.
_MINHASH = r"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    ELSE [array_to_string(w, ' ')] END) AS s FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM shingles x JOIN shingles y USING (s)
  WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
reach AS (SELECT a AS node, a AS seen FROM links
  UNION SELECT links.b, reach.seen FROM reach JOIN links ON links.a = reach.node),
named AS (SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles,
  coalesce(least(min(reach.seen), d.doc_id), d.doc_id) AS component_id
  FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.node = d.doc_id GROUP BY d.doc_id)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM named"""

# Exact cosines within a label, and the components of their links.
_EMBEDDINGS = """WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
sized AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS size FROM sound),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sized a JOIN sized b ON a.label = b.label
  WHERE a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.98),
reach AS (SELECT a AS node, a AS seen FROM links
  UNION SELECT links.b, reach.seen FROM reach JOIN links ON links.a = reach.node),
least_seen AS (SELECT node, min(seen) AS seen FROM reach GROUP BY node),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(least(r.seen, e.vec_id), e.vec_id) AS component_id,
  e.vec_id = coalesce(least(r.seen, e.vec_id), e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c USING (vec_id) LEFT JOIN least_seen r ON r.node = e.vec_id"""

ORACLES = {"op8_embedding_dedup": _EMBEDDINGS, "op10_minhash_near_dedup": _MINHASH,
           "op11_merkle_manifest": MERKLE, "op12_conversation_repair": CONVERSATIONS}
