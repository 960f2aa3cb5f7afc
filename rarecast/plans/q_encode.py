"""Registered queries: encoders and engineered features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encoders as EN
from ..operators import priors as PR
from .fixtures import (DOCS_SQL, EVENT_EPOCH, EVENT_EPOCH_SQL, docs_labeled, epoch_sql, events,
                       round_doubles, table)
from .q_priors import N_BINS, _BINNED, _FULL
from .registry import register
from ..util import epoch_seconds


def _te_sql(weight: float) -> str:
    def enc(col):
        return f"""(SELECT {col} AS v, (count(*) * avg(toxic) + {weight} * (SELECT avg(toxic) FROM {DOCS_SQL}))
                    / (count(*) + {weight}) AS e FROM {DOCS_SQL} GROUP BY 1)"""
    return f"""SELECT d.doc_id, round(a.e, 6) AS lang, round(b.e, 6) AS source FROM {DOCS_SQL} d
JOIN {enc('lang')} a ON a.v = d.lang JOIN {enc('source')} b ON b.v = d.source"""


@register("target_encode", _te_sql(0.0))
def target_encode(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "lang", "source", "toxic")
    m = EN.TargetMeans(["lang", "source"], "toxic").fit(df)
    return round_doubles(m.transform(df).select("doc_id", "lang", "source"))


@register("target_encode_smooth", _te_sql(10.0))
def target_encode_smooth(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "lang", "source", "toxic")
    m = EN.TargetMeans(["lang", "source"], "toxic", weight=10.0).fit(df)
    return round_doubles(m.transform(df).select("doc_id", "lang", "source"))


@register("one_hot_binary", f"""
SELECT doc_id, CAST(lang = 'de' AS INTEGER) AS lang_de, CAST(lang = 'en' AS INTEGER) AS lang_en,
  CAST(lang = 'es' AS INTEGER) AS lang_es, CAST(lang = 'fr' AS INTEGER) AS lang_fr,
  CAST(quality = 1 AS INTEGER) AS quality_1 FROM {DOCS_SQL}""")
def one_hot_binary(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "lang", "quality")
    return EN.OneHot(["lang", "quality"]).fit(df).transform(df)


@register("encode_mixed", f"""
SELECT d.doc_id, CAST(d.quality = 1 AS INTEGER) AS quality_1, round(a.e, 6) AS lang, round(b.e, 6) AS source
FROM {DOCS_SQL} d
JOIN (SELECT lang AS v, (count(*) * avg(toxic) + (SELECT avg(toxic) FROM {DOCS_SQL})) / (count(*) + 1) AS e
      FROM {DOCS_SQL} GROUP BY 1) a ON a.v = d.lang
JOIN (SELECT source AS v, (count(*) * avg(toxic) + (SELECT avg(toxic) FROM {DOCS_SQL})) / (count(*) + 1) AS e
      FROM {DOCS_SQL} GROUP BY 1) b ON b.v = d.source""")
def encode_mixed(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "lang", "source", "quality", "toxic")
    m = EN.MixedEncoder(["quality"], ["lang", "source"], "toxic", weight=1.0).fit(df)
    return round_doubles(m.transform(df).select("doc_id", "quality_1", "lang", "source"))


@register("prior_feature", f"""
SELECT b.doc_id, round(coalesce(t.target_fraction, 0.0), 6) AS priors_predict
FROM {_BINNED} b LEFT JOIN {_FULL} t USING (lang, source, n_chars_bin)""")
def prior_feature(spark, sf):
    df = docs_labeled(spark, sf)
    m = PR.Priors(["lang", "source"], ["n_chars"], "toxic", N_BINS).fit(df)
    return round_doubles(EN.add_prior(df, m).select("doc_id", "priors_predict"))


_RATE = "greatest(value - 1, 0)"
_AGE = f"(({epoch_sql('ts')} - {epoch_sql(EVENT_EPOCH_SQL)}) / 60.0)"
_MINPOS = f"(SELECT coalesce(min(CASE WHEN {_RATE} > 0 THEN {_RATE} END), 10e5) FROM events)"


def _ev_rate(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", F.greatest(F.col("value") - 1, F.lit(0.0)).alias("rate"),
                    ((epoch_seconds("ts") - epoch_seconds(F.lit(EVENT_EPOCH).cast("timestamp_ntz"))) / 60.0)
                    .alias("age"))


@register("log_distance", f"""
SELECT event_id, round(ln({_RATE} + {_MINPOS} / 10) ^ 2 + 0.9 * ln({_AGE}) ^ 2, 6) AS log_feature FROM events""")
def log_distance(spark, sf):
    df = _ev_rate(spark, sf)
    m = EN.LogDistance("rate", "age", weight=0.9).fit(df)
    return round_doubles(m.transform(df).select("event_id", "log_feature"))


@register("log_distance_replace", f"""
SELECT event_id, round(ln(CASE WHEN {_RATE} = 0 THEN {_MINPOS} / 10 ELSE {_RATE} END) ^ 2 + 0.9 * ln({_AGE}) ^ 2, 6)
  AS log_feature FROM events""")
def log_distance_replace(spark, sf):
    df = _ev_rate(spark, sf)
    m = EN.LogDistance("rate", "age", weight=0.9, zero="replace").fit(df)
    return round_doubles(m.transform(df).select("event_id", "log_feature"))


@register("standardise", """
SELECT doc_id, round((n_chars - (SELECT avg(n_chars) FROM documents)) / (SELECT stddev_pop(n_chars) FROM documents), 6)
  AS n_chars FROM documents""")
def standardise(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return round_doubles(EN.Standardise(["n_chars"]).fit(d).transform(d))
