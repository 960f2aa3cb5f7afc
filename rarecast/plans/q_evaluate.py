"""Registered queries: evaluation.  Scores are the exact
synthetic ``least(1, value / 500)`` on events, label ``event_type = 'purchase'``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators.profile import log_edges
from .fixtures import events, round_doubles
from .registry import register

_S = """(SELECT event_id, least(1.0::DOUBLE, value / 500.0::DOUBLE) AS score,
  CAST(event_type = 'purchase' AS INTEGER) AS y, user_id, value FROM events)"""
_C = f"""(SELECT score, pos, neg, tp, fp, tp - pos AS tp0, fp - neg AS fp0, P, N FROM
  (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp
   FROM (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM {_S} GROUP BY 1)),
  (SELECT sum(y) AS P, sum(1 - y) AS N FROM {_S}))"""


def _scored(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", "user_id", "value",
                    F.least(F.lit(1.0), F.col("value") / 500.0).alias("score"),
                    (F.col("event_type") == "purchase").cast("int").alias("y"))


@register("pr_curve", f"""
SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall FROM {_C}""")
def pr_curve(spark, sf):
    return round_doubles(EV.pr_curve(_scored(spark, sf), "score", "y"))


_LOW = _C.replace("event_type = 'purchase'", "event_type = 'purchase' AND value > 250")


@register("pr_curve_to_full_recall", f"""
SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall FROM {_LOW} WHERE tp0 < P""")
def pr_curve_to_full_recall(spark, sf):
    """Positives above a value only, so that thresholds without any lie below the last one."""
    s = _scored(spark, sf).withColumn("y", F.when(F.col("value") > 250, F.col("y")).otherwise(0))
    return round_doubles(EV.pr_curve(s, "score", "y", to_full_recall=True))


@register("roc_curve", f"SELECT score AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM {_C}")
def roc_curve(spark, sf):
    return round_doubles(EV.roc_curve(_scored(spark, sf), "score", "y"))


_AREAS = f"""(SELECT sum((fp / N - fp0 / N) * (tp / P + tp0 / P) / 2) AS roc_auc,
  sum(CASE WHEN tp0 < P THEN (tp / P - tp0 / P) * (tp / (tp + fp)
      + CASE WHEN tp0 + fp0 = 0 THEN 1.0 ELSE tp0 / (tp0 + fp0) END) / 2 END) AS pr_auc,
  sum((tp / P - tp0 / P) * (tp / (tp + fp))) AS average_precision FROM {_C})"""


@register("roc_auc", f"SELECT round(roc_auc, 6) AS roc_auc FROM {_AREAS}")
def roc_auc(spark, sf):
    return round_doubles(EV.areas(_scored(spark, sf), "score", "y").select("roc_auc"))


@register("pr_auc", f"SELECT round(pr_auc, 6) AS pr_auc FROM {_AREAS}")
def pr_auc(spark, sf):
    return round_doubles(EV.areas(_scored(spark, sf), "score", "y").select("pr_auc"))


@register("average_precision", f"SELECT round(average_precision, 6) AS average_precision FROM {_AREAS}")
def average_precision(spark, sf):
    return round_doubles(EV.average_precision(_scored(spark, sf), "score", "y"))


@register("scores_at_threshold", f"""
SELECT 0.5::DOUBLE AS threshold,
  round(coalesce(sum(CASE WHEN score > 0.5 THEN y END) / nullif(sum(CASE WHEN score > 0.5 THEN 1 ELSE 0 END), 0), 0), 6) AS precision,
  round(coalesce(sum(CASE WHEN score > 0.5 THEN y END) / nullif(sum(y), 0), 0), 6) AS recall,
  round(sum(CASE WHEN score > 0.5 THEN 1 ELSE 0 END) / count(*), 6) AS predicted_share FROM {_S}""")
def scores_at_threshold(spark, sf):
    return round_doubles(EV.scores_at(_scored(spark, sf), "score", "y", 0.5))


@register("no_skill_line", f"SELECT round(avg(y), 6) AS no_skill FROM {_S}")
def no_skill_line(spark, sf):
    return round_doubles(EV.no_skill(_scored(spark, sf), "y"))


def _thresh_sql(lo, hi, step):
    n = len(EV.thresholds(lo, hi, step))
    return f"(SELECT {lo!r}::DOUBLE + j * {step!r}::DOUBLE AS thresh FROM range({n}) t(j))"


@register("threshold_sweep", f"""
WITH c AS (SELECT T.thresh, count(s.score) AS pred, coalesce(sum(s.y), 0) AS tp
           FROM {_thresh_sql(0.05, 0.75, 0.005)} T LEFT JOIN {_S} s ON s.score >= T.thresh GROUP BY T.thresh),
tot AS (SELECT count(*) AS n, sum(y) AS P FROM {_S}),
m AS (SELECT thresh, CASE WHEN pred = 0 THEN 0.0 ELSE tp / pred END AS precision, tp / P AS recall,
        CAST(floor(pred * 1e4 / n) AS BIGINT) AS nop FROM c, tot)
SELECT round(thresh, 6) AS thresh, round(precision, 6) AS precision, round(recall, 6) AS recall,
  nop AS number_of_predictions, CAST(floor(precision * nop) AS BIGINT) AS number_of_correct_predictions FROM m""")
def threshold_sweep(spark, sf):
    return round_doubles(EV.sweep(_scored(spark, sf), "score", "y"))


@register("predicted_share_sweep", f"""
SELECT round(T.thresh, 6) AS thresh, round(count(s.score) / (SELECT count(*) FROM events), 6) AS share
FROM {_thresh_sql(0.08, 0.4, 0.01)} T LEFT JOIN {_S} s ON s.score > T.thresh GROUP BY T.thresh""")
def predicted_share_sweep(spark, sf):
    return round_doubles(EV.share_sweep(_scored(spark, sf), "score"))


@register("confusion_by_score_bin", f"""
WITH d AS (SELECT score AS s, y, CASE WHEN score > 0.5 THEN 'positive' ELSE 'negative' END AS side FROM {_S}),
r AS (SELECT side, min(s) AS lo, max(s) AS hi FROM d GROUP BY side),
a AS (SELECT side, CAST(CASE WHEN (hi - lo) / 10 = 0 THEN 0
                        ELSE greatest(0, least(ceil((s - lo) / ((hi - lo) / 10)) - 1, 9)) END AS INTEGER) AS bin,
        count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos FROM d JOIN r USING (side) GROUP BY ALL),
g AS (SELECT r.side, r.lo, r.hi, CAST(b.range AS INTEGER) AS bin, coalesce(a.n, 0) AS n, coalesce(a.n_pos, 0) AS n_pos
      FROM r CROSS JOIN range(10) b LEFT JOIN a ON a.side = r.side AND a.bin = b.range)
SELECT side, bin,
  round(((CASE WHEN bin = 0 THEN lo - (hi - lo) * 0.001::DOUBLE ELSE lo + bin * ((hi - lo) / 10) END)
         + (lo + (bin + 1) * ((hi - lo) / 10))) / 2, 6) AS centre, n,
  CASE WHEN side = 'positive' THEN n_pos END AS true_pos, CASE WHEN side = 'positive' THEN n - n_pos END AS false_pos,
  CASE WHEN side = 'negative' THEN n - n_pos END AS true_neg, CASE WHEN side = 'negative' THEN n_pos END AS false_neg
FROM g""")
def confusion_by_score_bin(spark, sf):
    return round_doubles(EV.confusion_bins(_scored(spark, sf), "score", "y", 0.5, 10))


def _score_hist_sql():
    lo, hi, n = -4.0, -0.05, 19
    step = (hi - lo) / n
    edges = log_edges(lo, hi, n)
    arr = "[" + ", ".join(repr(e) for e in edges) + "]"
    centres = [(edges[i] + edges[i + 1]) / 2 for i in range(n)]
    carr = "[" + ", ".join(repr(c) for c in centres) + "]"
    return f"""
WITH s AS {_S},
tot AS (SELECT y, count(*) AS total FROM s GROUP BY y),
c AS (SELECT y, CAST(least(floor((log10(score) - ({lo})) / {step}), {n - 1}) AS INTEGER) AS bin, count(*) AS n
      FROM s WHERE score >= {10 ** lo} AND score <= {10 ** hi} GROUP BY ALL),
w AS (SELECT c.bin, sum(CASE WHEN c.y = 0 THEN c.n / tot.total END) AS share_neg,
        sum(CASE WHEN c.y = 1 THEN c.n / tot.total END) AS share_pos FROM c JOIN tot USING (y) GROUP BY c.bin),
b AS (SELECT CAST(range AS INTEGER) AS bin, {carr}[range + 1] AS centre FROM range({n})),
p AS (SELECT b.bin, coalesce(sum(s.y) / nullif(count(s.score), 0), 0.0) AS prec FROM b LEFT JOIN s ON s.score >= b.centre GROUP BY b.bin)
SELECT b.bin, round(CAST({arr}[b.bin + 1] AS DOUBLE), 6) AS bin_lo, round(CAST({arr}[b.bin + 2] AS DOUBLE), 6) AS bin_hi,
  round(coalesce(w.share_neg, 0.0), 6) AS share_neg, round(coalesce(w.share_pos, 0.0), 6) AS share_pos,
  round(p.prec, 6) AS precision_at_centre
FROM b LEFT JOIN w USING (bin) JOIN p USING (bin)"""


@register("score_hist_by_class", _score_hist_sql())
def score_hist_by_class(spark, sf):
    return round_doubles(EV.score_hist(_scored(spark, sf), "score", "y"))


_SVO_COLS = ["score", "y", "final_upvotes", "final_num_comments"]


def _svo_sql():
    src = f"""(SELECT s.score, s.y, o.final_upvotes, o.final_num_comments FROM {_S} s JOIN
      (SELECT event_id, floor(value) AS final_upvotes, user_id AS final_num_comments FROM events) o USING (event_id))"""
    return " UNION ALL ".join(
        f"SELECT '{a}' AS \"row\", '{b}' AS col, round(corr({a}, {b}), 6) AS r FROM {src}"
        for a in _SVO_COLS for b in _SVO_COLS)


@register("score_vs_outcome", _svo_sql())
def score_vs_outcome(spark, sf):
    s = _scored(spark, sf).select("event_id", "score", "y")
    o = events(spark, sf).select("event_id", F.floor("value").alias("final_upvotes"),
                                 F.col("user_id").alias("final_num_comments"))
    return round_doubles(EV.score_vs_outcome(s, o, "event_id", _SVO_COLS))
