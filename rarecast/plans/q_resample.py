"""Registered queries: splits, folds, resampling, baselines.
Rows are the labelled documents; the rare label is ``toxic``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import resample as RS
from ..operators.priors import Priors
from .fixtures import DOCS_SQL, docs_labeled, hash_uniform_sql, round_doubles, table
from .registry import register

_MD5 = "md5(CAST(doc_id AS VARCHAR) || '|' || '{seed}')"
_RANKED = f"""(SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY {_MD5.format(seed=2)}) AS r,
  count(*) OVER (PARTITION BY toxic) AS n FROM {DOCS_SQL})"""
_SPLIT = f"""(SELECT *, CASE WHEN r <= floor(0.1666::DOUBLE * n + 0.5) THEN 'test' ELSE 'train' END AS split FROM {_RANKED})"""


def _split(spark, sf):
    return RS.split(docs_labeled(spark, sf), "toxic", "doc_id", 0.1666, seed=2)


@register("stratified_split", f"SELECT doc_id, toxic, split FROM {_SPLIT}")
def stratified_split(spark, sf):
    return _split(spark, sf).select("doc_id", "toxic", "split")


@register("stratified_folds", f"""
SELECT doc_id, toxic, CAST((row_number() OVER (PARTITION BY toxic ORDER BY {_MD5.format(seed=0)}) - 1) % 5 AS INTEGER) AS fold
FROM {DOCS_SQL}""")
def stratified_folds(spark, sf):
    return RS.folds(docs_labeled(spark, sf), "toxic", "doc_id", 5, seed=0).select("doc_id", "toxic", "fold")


@register("undersample_majority", f"""
SELECT doc_id, toxic FROM (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY {_MD5.format(seed=3)}) AS r FROM {DOCS_SQL})
WHERE toxic = 1 OR r <= floor((SELECT sum(toxic) FROM {DOCS_SQL}) / 0.5::DOUBLE)""")
def undersample_majority(spark, sf):
    return RS.undersample(docs_labeled(spark, sf), "toxic", "doc_id", 0.5, seed=3).select("doc_id", "toxic")


@register("imbalance_ratio", f"""
SELECT CAST(sum(toxic) AS BIGINT) AS n_pos, CAST(sum(1 - toxic) AS BIGINT) AS n_neg, round(sum(toxic) / sum(1 - toxic), 6) AS ratio,
  round(sum(toxic) / sum(1 - toxic) * 1.01, 6) AS target_1_01, round(sum(toxic) / sum(1 - toxic) * 2.01, 6) AS target_2_01
FROM {DOCS_SQL}""")
def imbalance_ratio(spark, sf):
    return round_doubles(RS.imbalance(docs_labeled(spark, sf), "toxic"))


@register("baseline_random", f"""
WITH tr AS (SELECT avg(toxic) AS prior FROM {_SPLIT} WHERE split = 'train'),
te AS (SELECT toxic AS y, CAST({hash_uniform_sql('doc_id', 5)} < (SELECT prior FROM tr) AS INTEGER) AS pred
       FROM {_SPLIT} WHERE split = 'test')
SELECT round(coalesce(sum(pred * y) / nullif(sum(pred), 0), 0), 6) AS precision,
  round(coalesce(sum(pred * y) / nullif(sum(y), 0), 0), 6) AS recall, round(sum(pred) / count(*), 6) AS predicted_share FROM te""")
def baseline_random(spark, sf):
    s = _split(spark, sf)
    return round_doubles(RS.random_baseline(s.where("split = 'train'"), s.where("split = 'test'"), "toxic",
                                            "doc_id", seed=5))


@register("baseline_priors", f"""
WITH tr AS (SELECT lang, source, sum(toxic) / count(*) AS f FROM {_SPLIT} WHERE split = 'train' GROUP BY ALL)
SELECT t.doc_id, round(coalesce(tr.f, 0.0), 6) AS prior_p, tr.f IS NULL AS prior_missing
FROM {_SPLIT} t LEFT JOIN tr USING (lang, source) WHERE t.split = 'test'""")
def baseline_priors(spark, sf):
    s = _split(spark, sf)
    m = Priors(["lang", "source"], [], "toxic", complete=False).fit(s.where("split = 'train'"))
    return round_doubles(m.transform(s.where("split = 'test'")).select("doc_id", "prior_p", "prior_missing"))


def _vec_frame(spark, sf):
    d = docs_labeled(spark, sf).select("doc_id", "toxic")
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return d.join(e, "doc_id")


# The oracle finds the k nearest by a brute-force self-join (fine for a check
# on small tables); the Spark operator never builds those pairs.
@register("smote_oversample", f"""
WITH df AS (SELECT d.doc_id, d.toxic, e.embedding FROM {DOCS_SQL} d JOIN embeddings e ON e.vec_id = d.doc_id),
par AS (SELECT m, CAST(floor(0.5 * big) AS BIGINT) - m AS need, least(5, m - 1) AS k
        FROM (SELECT count(*) FILTER (WHERE toxic = 1) AS m, count(*) FILTER (WHERE toxic <> 1) AS big FROM df)),
mino AS (SELECT CAST(doc_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS v FROM df WHERE toxic = 1),
ranked AS (SELECT id, row_number() OVER (ORDER BY md5(id || '|1'), id) - 1 AS pos FROM mino),
nbrs AS (SELECT a.id, b.id AS nb_id,
           row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS nb_rank
         FROM mino a JOIN mino b ON a.id <> b.id),
jobs AS (SELECT j, j % (SELECT m FROM par) AS pos
         FROM range((SELECT CASE WHEN m >= 2 THEN greatest(need, 0) ELSE 0 END FROM par)) t(j)),
syn AS (SELECT r.id AS source_id, n.nb_id AS neighbour_id, {hash_uniform_sql('j', '1|u')} AS u
        FROM jobs JOIN ranked r USING (pos)
        JOIN nbrs n ON n.id = r.id AND n.nb_rank = CAST(floor({hash_uniform_sql('j', '1|nb')} * (SELECT k FROM par)) AS BIGINT) + 1)
SELECT doc_id, toxic, false AS synthetic, CAST(len(embedding) AS INTEGER) AS dim,
       CAST(NULL AS VARCHAR) AS source_id, CAST(NULL AS VARCHAR) AS neighbour_id, CAST(NULL AS DOUBLE) AS u FROM df
UNION ALL
SELECT NULL, 1, true, CAST((SELECT max(len(embedding)) FROM df) AS INTEGER), source_id, neighbour_id, round(u, 6) FROM syn""")
def smote_oversample(spark, sf):
    """Synthetic minority rows until minority/majority = 0.5: each one's
    source row, its drawn exact nearest neighbour and the draw u (pytest
    also checks every synthetic point lies between the two)."""
    df = _vec_frame(spark, sf)
    out = RS.smote(df, "embedding", "toxic", "doc_id", ratio=0.5, k=5, seed=1)
    return round_doubles(out.select("doc_id", "toxic", "synthetic", F.size("embedding").alias("dim"),
                                    "source_id", "neighbour_id", "u"))
