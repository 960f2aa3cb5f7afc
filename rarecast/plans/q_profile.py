"""Registered queries: profiling, histograms and tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as PF
from .fixtures import DOCS_SQL, docs_labeled, events, round_doubles, table
from .registry import register

_EV = "(SELECT *, CAST(event_type = 'purchase' AS INTEGER) AS label, CAST(hour(ts) AS INTEGER) AS post_hour FROM events)"


def _ev(spark, sf):
    e = events(spark, sf)
    return e.withColumns({"label": (F.col("event_type") == "purchase").cast("int"), "post_hour": F.hour("ts")})


@register("category_share", "SELECT round(avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END), 6) AS share FROM documents")
def category_share(spark, sf):
    return round_doubles(PF.share_of(table(spark, sf, "documents"), "lang", "en"))


@register("positive_rate", f"""
SELECT count(*) AS n_rows, CAST(sum(toxic) AS BIGINT) AS n_positive, round(avg(toxic) * 100, 6) AS pct_positive
FROM {DOCS_SQL}""")
def positive_rate(spark, sf):
    return round_doubles(PF.positive_rate(docs_labeled(spark, sf), "toxic"))


@register("corr_with_target", f"""
SELECT * FROM (VALUES ('n_chars', (SELECT round(corr(n_chars, toxic), 6) FROM {DOCS_SQL})),
                      ('quality', (SELECT round(corr(quality, toxic), 6) FROM {DOCS_SQL})),
                      ('doc_id', (SELECT round(corr(doc_id, toxic), 6) FROM {DOCS_SQL}))) t(feature, r)""")
def corr_with_target(spark, sf):
    return round_doubles(PF.corr_with(docs_labeled(spark, sf), ["n_chars", "quality", "doc_id"], "toxic"))


_CM_COLS = ["value", "user_id", "label"]


def _corr_matrix_sql():
    parts = [f"SELECT '{a}' AS \"row\", '{b}' AS col, round(corr({a}, {b}), 6) AS r FROM {_EV}"
             for a in _CM_COLS for b in _CM_COLS]
    return " UNION ALL ".join(parts)


@register("corr_matrix", _corr_matrix_sql())
def corr_matrix(spark, sf):
    return round_doubles(PF.corr_matrix(_ev(spark, sf), _CM_COLS))


@register("hist_fixed", """
WITH g AS (SELECT DISTINCT event_type FROM events),
c AS (SELECT event_type, CAST(least(floor(value / 25.0), 19) AS INTEGER) AS bin, count(*) AS n
      FROM events WHERE value >= 0 AND value <= 500 GROUP BY ALL)
SELECT g.event_type, b.bin, round(CAST(b.bin * 25.0 AS DOUBLE), 6) AS bin_lo, coalesce(c.n, 0) AS n
FROM g CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) b
LEFT JOIN c ON c.event_type = g.event_type AND c.bin = b.bin""")
def hist_fixed(spark, sf):
    return round_doubles(PF.hist_fixed(events(spark, sf), "value", 0.0, 500.0, 25.0, ["event_type"]))


@register("hist_integer_centred", """
WITH c AS (SELECT CAST(least(floor(l_linenumber + 0.5), 10) AS INTEGER) AS value, count(*) AS n FROM lineitem
           WHERE l_linenumber >= -0.5 AND l_linenumber <= 10.5 GROUP BY 1)
SELECT b.value, coalesce(c.n, 0) AS n FROM (SELECT CAST(range AS INTEGER) AS value FROM range(11)) b
LEFT JOIN c USING (value)""")
def hist_integer_centred(spark, sf):
    return PF.hist_integer(table(spark, sf, "lineitem"), "l_linenumber", 10)


@register("hist_equal_width", """
WITH r AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents),
c AS (SELECT CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((n_chars - r.lo) / ((r.hi - r.lo) / 10)), 9) END AS INTEGER) AS bin,
      count(*) AS n FROM documents, r GROUP BY 1)
SELECT b.bin, round(r.lo + b.bin * (r.hi - r.lo) / 10, 6) AS bin_lo, round(r.lo + (b.bin + 1) * (r.hi - r.lo) / 10, 6) AS bin_hi,
  coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(10)) b CROSS JOIN r LEFT JOIN c USING (bin)""")
def hist_equal_width(spark, sf):
    return round_doubles(PF.hist_equal(table(spark, sf, "documents"), "n_chars", 10))


def _hist_log_sql():
    lo, hi, n = -2.0, 2.7, 20
    step = (hi - lo) / n
    edges = PF.log_edges(lo, hi, n)
    arr = "[" + ", ".join(repr(e) for e in edges) + "]"
    return f"""
WITH g AS (SELECT event_type, count(*) AS total FROM events GROUP BY 1),
c AS (SELECT event_type, CAST(least(floor((log10(value) - ({lo})) / {step}), {n - 1}) AS INTEGER) AS bin, count(*) AS n
      FROM events WHERE value >= {10 ** lo} AND value <= {10 ** hi} GROUP BY ALL)
SELECT g.event_type, b.bin, round(CAST({arr}[b.bin + 1] AS DOUBLE), 6) AS bin_lo, round(CAST({arr}[b.bin + 2] AS DOUBLE), 6) AS bin_hi,
  coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / g.total, 6) AS weight
FROM g CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range({n})) b
LEFT JOIN c ON c.event_type = g.event_type AND c.bin = b.bin"""


@register("hist_log_weighted", _hist_log_sql())
def hist_log_weighted(spark, sf):
    return round_doubles(PF.hist_log(events(spark, sf), "value", -2.0, 2.7, 20, ["event_type"]))


@register("density_2d_log", f"""
SELECT label, CAST(floor((log10(CASE WHEN value = 0 THEN 0.1 ELSE value END) + 3.0) * (50 / 6.0)) AS INTEGER) AS cell_x,
  CAST(floor((log10(CASE WHEN user_id = 0 THEN 0.1 ELSE user_id END) + 3.0) * (50 / 6.0)) AS INTEGER) AS cell_y,
  count(*) AS n
FROM {_EV} WHERE value >= 0 AND user_id >= 0 GROUP BY ALL""")
def density_2d_log(spark, sf):
    return PF.density_log(_ev(spark, sf), "value", "user_id", 50, ["label"], eps=0.1)


@register("rate_by_bin_sem", f"""
WITH c AS (SELECT CAST(floor(value / 100.0 / 0.25) AS INTEGER) AS bin, count(*) AS n, avg(label) AS rate,
             stddev_samp(label) / sqrt(count(*)) AS sem
           FROM {_EV} WHERE value / 100.0 >= 0 AND value / 100.0 < 3 GROUP BY 1)
SELECT b.bin, round(CAST(b.bin * 0.25 + 0.125 AS DOUBLE), 6) AS bin_centre, coalesce(c.n, 0) AS n, round(c.rate, 6) AS rate,
  round(c.sem, 6) AS sem
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(12)) b LEFT JOIN c USING (bin)""")
def rate_by_bin_sem(spark, sf):
    e = _ev(spark, sf).withColumn("rate100", F.col("value") / 100.0)
    return round_doubles(PF.rate_by_bin(e, "rate100", "label", 0.0, 3.0, 0.25))


@register("sem_population", """
SELECT event_type, count(value) AS n, round(stddev_pop(value) / sqrt(count(value)), 6) AS sem FROM events GROUP BY 1""")
def sem_population(spark, sf):
    return round_doubles(PF.sem_pop(events(spark, sf), "value", ["event_type"]))


@register("share_by_hour", f"""
SELECT post_hour, round(count(*) / (SELECT count(*) FROM events), 6) AS share_of_rows,
  round(sum(label) / (SELECT sum(label) FROM {_EV}), 6) AS share_of_positives
FROM {_EV} GROUP BY 1""")
def share_by_hour(spark, sf):
    return round_doubles(PF.share_by(_ev(spark, sf), "post_hour", "label"))


@register("ratio_by_group", f"""
SELECT source, count(*) AS n_posts, CAST(sum(toxic) AS BIGINT) AS n_positive, round(avg(toxic), 6) AS positive_ratio
FROM {DOCS_SQL} GROUP BY 1""")
def ratio_by_group(spark, sf):
    return round_doubles(PF.ratio_by(docs_labeled(spark, sf), "source", "toxic"))


_PROFILE_SQL = f"""(SELECT 'lang' AS feature, lang AS value, count(*) AS n, CAST(sum(toxic) AS BIGINT) AS n_positive,
   avg(toxic) AS positive_fraction FROM {DOCS_SQL} GROUP BY 2
 UNION ALL SELECT 'source', source, count(*), CAST(sum(toxic) AS BIGINT), avg(toxic) FROM {DOCS_SQL} GROUP BY 2)"""


@register("category_profile", f"""
SELECT feature, value, n, n_positive, round(positive_fraction, 6) AS positive_fraction FROM {_PROFILE_SQL}""")
def category_profile(spark, sf):
    return round_doubles(PF.profile(docs_labeled(spark, sf), ["lang", "source"], "toxic"))


_CHI_SQL = f"""(SELECT feature, sum((n_positive - p * n) ^ 2 / (p * n)) AS chi2_pos, CAST(count(*) - 1 AS INTEGER) AS dof,
   any_value(p) AS p
 FROM {_PROFILE_SQL}, (SELECT avg(toxic) AS p FROM {DOCS_SQL}) GROUP BY feature)"""


@register("chi_square_rate", f"SELECT feature, round(chi2_pos, 6) AS chi2_pos, dof FROM {_CHI_SQL}")
def chi_square_rate(spark, sf):
    r = PF.chi_square(docs_labeled(spark, sf), ["lang", "source"], "toxic")
    return round_doubles(r.select("feature", "chi2_pos", "dof"))


@register("chi_square_full", f"SELECT feature, round(chi2_pos / (1 - p), 6) AS chi2_full, dof FROM {_CHI_SQL}")
def chi_square_full(spark, sf):
    r = PF.chi_square(docs_labeled(spark, sf), ["lang", "source"], "toxic")
    return round_doubles(r.select("feature", "chi2_full", "dof"))


# The oracle's tail is the lower regularised gamma as a plain series,
# Q(a, x) = 1 - sum_n exp(-x + (a + n) ln x - lgamma(a + n + 1)), a = dof / 2,
# x = stat / 2, with enough terms (8x, at least 1000) for the sum to settle.
@register("chi_square_pvalue", f"""
WITH ev AS {_EV},
prof AS (SELECT 'post_hour' AS feature, CAST(post_hour AS VARCHAR) AS value, count(*) AS n, sum(label) AS n_positive
         FROM ev GROUP BY 2
         UNION ALL SELECT 'event_type', event_type, count(*), sum(label) FROM ev GROUP BY 2),
st AS (SELECT feature, sum((n_positive - p * n) ^ 2 / (p * n)) AS chi2_pos, CAST(count(*) - 1 AS INTEGER) AS dof,
              any_value(p) AS p
       FROM prof, (SELECT avg(label) AS p FROM ev) GROUP BY feature),
x AS (SELECT feature, chi2_pos, dof, chi2_pos / (1 - p) AS chi2_full FROM st),
terms AS (SELECT feature, which,
                 sum(CASE WHEN s > 0 THEN exp(-s / 2 + (dof / 2 + n) * ln(s / 2) - lgamma(dof / 2 + n + 1)) ELSE 0 END)
                   AS lower_p
          FROM (SELECT feature, dof, 'pos' AS which, chi2_pos AS s FROM x
                UNION ALL SELECT feature, dof, 'full', chi2_full FROM x) v,
               range(0, CAST(greatest(1000, 4 * ceil(s)) AS BIGINT)) t(n)
          GROUP BY feature, which)
SELECT x.feature, round(x.chi2_pos, 6) AS chi2_pos, x.dof,
       round(greatest(1 - tp.lower_p, 0), 6) AS p_value_pos, round(greatest(1 - tf.lower_p, 0), 6) AS p_value_full
FROM x JOIN terms tp ON tp.feature = x.feature AND tp.which = 'pos'
       JOIN terms tf ON tf.feature = x.feature AND tf.which = 'full'""")
def chi_square_pvalue(spark, sf):
    """Statistic, degrees of freedom and both upper-tail p-values (pytest
    also checks the tail against known quantiles)."""
    r = PF.chi_square(_ev(spark, sf), ["post_hour", "event_type"], "label")
    return round_doubles(r.select("feature", "chi2_pos", "dof", "p_value_pos", "p_value_full"))
