"""Registered queries: binned historical priors on documents +
labels (keys lang x source, equal-frequency bins of n_chars, label toxic)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import priors as PR
from .fixtures import DOCS_SQL, bin_sql, docs_labeled, edges_sql, hash_uniform_sql, round_doubles
from .registry import register

N_BINS = 5
_EDGES = edges_sql(DOCS_SQL, "n_chars", N_BINS)
_BINNED = f"(SELECT d.*, CAST({bin_sql('d.n_chars', _EDGES)} AS INTEGER) AS n_chars_bin FROM {DOCS_SQL} d)"
_TABLE = f"""(SELECT lang, source, n_chars_bin, count(*) AS total, CAST(sum(toxic) AS BIGINT) AS target,
  sum(toxic) / count(*) AS target_fraction FROM {_BINNED} GROUP BY ALL)"""
_GRID = f"""(SELECT l.lang, s.source, b.n_chars_bin FROM (SELECT DISTINCT lang FROM {DOCS_SQL}) l
  CROSS JOIN (SELECT DISTINCT source FROM {DOCS_SQL}) s
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS n_chars_bin
              FROM range((SELECT count(DISTINCT value) - 1 FROM {_EDGES}))) b)"""
_FULL = f"""(SELECT g.lang, g.source, g.n_chars_bin, coalesce(t.total, 0) AS total, coalesce(t.target, 0) AS target,
  coalesce(t.target_fraction, 0.0) AS target_fraction FROM {_GRID} g LEFT JOIN {_TABLE} t USING (lang, source, n_chars_bin))"""


def _model(spark, sf, complete=True):
    df = docs_labeled(spark, sf)
    return df, PR.Priors(["lang", "source"], ["n_chars"], "toxic", N_BINS, complete=complete).fit(df)


@register("equal_freq_edges", f"SELECT CAST(edge AS INTEGER) AS edge, round(value, 6) AS value FROM {_EDGES}")
def equal_freq_edges(spark, sf):
    edges = PR.equal_freq_edges(docs_labeled(spark, sf), "n_chars", N_BINS)
    return round_doubles(spark.createDataFrame([(i, float(v)) for i, v in enumerate(edges)], "edge int, value double"))


@register("bin_assign", f"SELECT doc_id, n_chars_bin FROM {_BINNED}")
def bin_assign(spark, sf):
    df = docs_labeled(spark, sf)
    edges = PR.equal_freq_edges(df, "n_chars", N_BINS)
    return df.select("doc_id", PR.bin_assign("n_chars", edges).alias("n_chars_bin"))


@register("prior_table", f"""
SELECT lang, source, n_chars_bin, total, target, round(target_fraction, 6) AS target_fraction FROM {_TABLE}""")
def prior_table(spark, sf):
    _, m = _model(spark, sf, complete=False)
    return round_doubles(m.table)


@register("complete_grid", f"""
SELECT lang, source, n_chars_bin, total, target, round(target_fraction, 6) AS target_fraction FROM {_FULL}""")
def complete_grid(spark, sf):
    _, m = _model(spark, sf, complete=True)
    return round_doubles(m.grid())


@register("prior_score", f"""
SELECT b.doc_id, round(coalesce(t.target_fraction, 0.0), 6) AS prior_p, round(1 - coalesce(t.target_fraction, 0.0), 6) AS prior_q,
  t.lang IS NULL AS prior_missing
FROM {_BINNED} b LEFT JOIN {_FULL} t USING (lang, source, n_chars_bin)""")
def prior_score(spark, sf):
    df, m = _model(spark, sf)
    return round_doubles(m.transform(df).select("doc_id", "prior_p", "prior_q", "prior_missing"))


@register("prior_draw", f"""
SELECT b.doc_id, CAST({hash_uniform_sql('b.doc_id', 7)} < coalesce(t.target_fraction, 0.0) AS INTEGER) AS prior_draw
FROM {_BINNED} b LEFT JOIN {_FULL} t USING (lang, source, n_chars_bin)""")
def prior_draw(spark, sf):
    df, m = _model(spark, sf)
    return PR.prior_draw(m.transform(df), "prior_p", "doc_id", seed=7).select("doc_id", "prior_draw")


def _matrix_sql():
    cols = ", ".join(f"round(max(CASE WHEN source = 'src{i}' THEN target_fraction END), 6) AS src{i}" for i in range(20))
    return f"""SELECT lang, {cols} FROM (SELECT lang, source, sum(toxic) / count(*) AS target_fraction
      FROM {DOCS_SQL} GROUP BY ALL) GROUP BY lang"""


@register("prior_matrix", _matrix_sql())
def prior_matrix(spark, sf):
    df = docs_labeled(spark, sf)
    m = PR.Priors(["lang", "source"], [], "toxic", complete=False).fit(df)
    return round_doubles(PR.prior_matrix(m.table, "lang", "source"))


@register("prior_entries", f"""
WITH t AS (SELECT lang, source, sum(toxic) / count(*) AS f FROM {DOCS_SQL} GROUP BY ALL)
SELECT (dense_rank() OVER (ORDER BY lang) - 1)::BIGINT AS row, (dense_rank() OVER (ORDER BY source) - 1)::BIGINT AS col, lang, source,
  round(f, 6) AS target_fraction FROM t""")
def prior_entries(spark, sf):
    df = docs_labeled(spark, sf)
    m = PR.Priors(["lang", "source"], [], "toxic", complete=False).fit(df)
    return round_doubles(PR.prior_entries(m.table, "lang", "source"))
