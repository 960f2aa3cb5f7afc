"""Registered queries: text and vector features on documents
(four languages, accented letters) and embeddings."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import textfeat as TF
from .fixtures import round_doubles, table
from .registry import register

# The stop-word parameter used by the fixture queries (common
# function words of the four languages in the test corpus).
QUERY_STOP = ["the", "and", "of", "to", "in", "le", "la", "les", "de", "des", "du", "et", "un", "une",
              "der", "die", "das", "und", "el", "los", "las", "y", "en", "que"]
VOCAB_K = 1000
N_COMP = 50

_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in QUERY_STOP) + "]"
_RE = r"'[\p{L}\p{N}_]+'"
_TOK_SQL = f"""(SELECT doc_id, list_filter(regexp_extract_all(lower(text), {_RE}), lambda x: NOT list_contains({_STOP_SQL}, x)) AS t
  FROM documents)"""
_TERMS_SQL = f"""(SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(strip_accents(lower(text)), {_RE})) AS term FROM documents)
  WHERE length(term) >= 2 AND NOT list_contains({_STOP_SQL}, term) GROUP BY ALL)"""
_VOCAB_SQL = f"""(SELECT term, CAST(sum(tf) AS BIGINT) AS count, count(*) AS df FROM {_TERMS_SQL} GROUP BY term
  ORDER BY count DESC, term LIMIT {VOCAB_K})"""


def _docs(spark, sf):
    return table(spark, sf, "documents")


@register("tokenise_titles", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS text_hash FROM {_TOK_SQL}""")
def tokenise_titles(spark, sf):
    d = TX.tokenise(_docs(spark, sf), "text", QUERY_STOP, text_out="joined")
    return d.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.md5("joined").alias("text_hash"))


@register("strip_accents", "SELECT doc_id, md5(strip_accents(text)) AS text_hash FROM documents")
def strip_accents(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(TX.strip_accents("text")).alias("text_hash"))


@register("ngrams", f"""
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_grams, md5(array_to_string(g, '|')) AS grams_hash FROM (
  SELECT doc_id, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS g FROM {_TOK_SQL})""")
def ngrams(spark, sf):
    d = TX.tokenise(_docs(spark, sf), "text", QUERY_STOP)
    g = TX.ngrams("tokens", 1, 2)
    return d.select("doc_id", F.size(g).cast("long").alias("n_grams"), F.md5(F.array_join(g, "|")).alias("grams_hash"))


@register("vocabulary_top_k", f"SELECT term, count, df FROM {_VOCAB_SQL}")
def vocabulary_top_k(spark, sf):
    d = TF.with_terms(_docs(spark, sf).select("text"), "text", QUERY_STOP)
    return TF.vocabulary(d, VOCAB_K, keep=TF.kept_term(QUERY_STOP))


@register("tfidf", f"""
WITH v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM {_VOCAB_SQL}),
w AS (SELECT t.doc_id, t.term, t.tf * v.idf AS w FROM {_TERMS_SQL} t JOIN v USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def tfidf(spark, sf):
    _, weights = TF.fit_long(TF.Tfidf("doc_id", "text", VOCAB_K, stop=QUERY_STOP), _docs(spark, sf))
    return round_doubles(weights)


@register("tfidf_pca")
def tfidf_pca(spark, sf):
    """Every document's leading components and their explained variance (rows-only: SQL has no eigenvectors;
    pytest checks them against numpy)."""
    d = _docs(spark, sf).select("doc_id", "text")
    m, rows = TF.TfidfPca("doc_id", "text", VOCAB_K, N_COMP, stop=QUERY_STOP).fit_rows(d, ["doc_id"])
    share = F.array(*[F.lit(float(v)) for v in m.explained_variance])
    out = rows.select("doc_id", F.posexplode(vector_to_array("pca")).alias("component", "value"))
    return out.withColumn("explained_variance", share[F.col("component")])


@register("tfidf_pca_trace", f"""
WITH v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM {_VOCAB_SQL}),
w AS (SELECT t.doc_id, t.term, t.tf * v.idf AS w FROM {_TERMS_SQL} t JOIN v USING (term)),
x AS (SELECT term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS x FROM w),
s AS (SELECT term, sum(x * x) / (SELECT count(*) FROM documents) - (sum(x) / (SELECT count(*) FROM documents)) ^ 2 AS var
      FROM x GROUP BY term)
SELECT CAST(count(*) AS BIGINT) AS n_terms, round(sum(CASE WHEN var > 0 THEN 1.0 ELSE 0.0 END), 3) AS total_variance FROM s""")
def tfidf_pca_trace(spark, sf):
    """Total variance of all components: the trace, one for each term that varies, as the terms are standardised."""
    d = _docs(spark, sf).select("doc_id", "text")
    m, rows = TF.TfidfPca("doc_id", "text", VOCAB_K, VOCAB_K, stop=QUERY_STOP).fit_rows(d, ["doc_id"])
    variances = rows.agg(Summarizer.variance(F.col("pca")).alias("v"), F.count(F.lit(1)).alias("n"))
    v = F.aggregate(vector_to_array("v"), F.lit(0.0), lambda a, x: a + x)
    return variances.select(F.lit(len(m.parts["tfidf"].terms)).cast("long").alias("n_terms"),
                            F.round(v * (F.col("n") - 1) / F.col("n"), 3).alias("total_variance"))


@register("join_vectors", """
SELECT d.doc_id, d.lang, CAST(len(e.embedding) AS INTEGER) AS dim, CAST(i - 1 AS INTEGER) AS i, round(CAST(e.embedding[i] AS DOUBLE), 6) AS x
FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id, unnest(range(1, len(e.embedding) + 1)) t(i)""")
def join_vectors(spark, sf):
    """The joined vectors, a row for each coordinate."""
    d = _docs(spark, sf).select("doc_id", "lang")
    v = table(spark, sf, "embeddings").select("vec_id", "embedding")
    j = TF.join_vectors(d, v, "doc_id", "vec_id")
    return round_doubles(j.select("doc_id", "lang", F.size("embedding").alias("dim"),
                                  F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x")))


@register("vector_pca_variance")
def vector_pca_variance(spark, sf):
    """Every vector's components up to 80% of the variance (rows-only; see ``vector_pca_trace``)."""
    v = table(spark, sf, "embeddings").select("vec_id", "embedding")
    m = TF.VectorPca("embedding", 0.8).fit(v)
    return m.transform(v).select("vec_id", F.lit(m.k).alias("n_components"),
                                 F.posexplode(vector_to_array("vec_pca")).alias("component", "value"))


@register("vector_pca_trace", """
SELECT CAST(count(*) AS INTEGER) AS dim, round(sum(v), 6) AS total_variance FROM (
  SELECT i, var_samp(CAST(embedding[i] AS DOUBLE)) AS v FROM embeddings, unnest(range(1, len(embedding) + 1)) t(i) GROUP BY i)""")
def vector_pca_trace(spark, sf):
    """Rotating to all components keeps the total variance."""
    v = table(spark, sf, "embeddings").select("vec_id", "embedding")
    m = TF.VectorPca("embedding", 1 - 1e-12).fit(v)
    out = m.transform(v).agg(Summarizer.variance(F.col("vec_pca")).alias("v"))
    total = F.aggregate(vector_to_array("v"), F.lit(0.0), lambda a, x: a + x)
    return round_doubles(out.select(F.lit(m.k).cast("int").alias("dim"), total.alias("total_variance")))
