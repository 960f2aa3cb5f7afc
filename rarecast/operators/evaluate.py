"""Evaluation tables: PR / ROC curves, areas, average precision, threshold
reports and sweeps, confusion by score bin, class histograms of scores.

Scale: rows are first aggregated to one row per distinct score (pos, neg).
Running counts by descending score come from ``prefix_sum_by_range`` (range
buckets, no single-partition window).  Each curve point carries its own
predecessor (the counts *before* its score), so areas and average precision
are plain sums - no ``lag`` over a global order.  Sweeps map every score to
a threshold index (thresholds are a parameter-sized literal array) and sum
per index, then take suffix sums over that tiny table: no score x threshold
pairs are generated."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..util import col_of, attach_one_row, prefix_sum_by_range
from .profile import hist_log, log_edges


def _y(label):
    return col_of(label).cast("int")


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, pos, neg) per distinct score (map-side partial aggregation)."""
    y = _y(label)
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(y).cast("long").alias("pos"), F.sum(1 - y).cast("long").alias("neg"))


def cumulative(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, descending: tp / fp at or above it, the same before
    it, and the totals P and N."""
    sc = score_counts(df, score, label)
    cum = prefix_sum_by_range(sc, "score", {"tp": "pos", "fp": "neg"}, descending=True)
    # totals from the per-score table (exchange reused), not a second pass over the rows
    tot = sc.agg(F.sum("pos").cast("long").alias("P"), F.sum("neg").cast("long").alias("N"))
    return attach_one_row(cum, tot).withColumns({"tp0": F.col("tp") - F.col("pos"),
                                               "fp0": F.col("fp") - F.col("neg")})


def pr_curve(df: DataFrame, score: str, label: str, to_full_recall: bool = False) -> DataFrame:
    """Precision and recall at each distinct score threshold (``score >= t``);
    with ``to_full_recall`` up to the first threshold reaching full recall."""
    c = cumulative(df, score, label)
    return (c.where(F.col("tp0") < F.col("P")) if to_full_recall else c).select(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), F.col("P")).alias("recall"))


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """False and true positive rates at each distinct score threshold."""
    c = cumulative(df, score, label)
    return c.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))


def areas(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: ``roc_auc`` (trapezoid from (0,0)), ``pr_auc`` (trapezoid over
    recall with the (recall 0, precision 1) start) and
    ``average_precision`` (step sum of recall gains times precision)."""
    c = cumulative(df, score, label)
    tpr, tpr0 = F.col("tp") / F.col("P"), F.col("tp0") / F.col("P")
    fpr, fpr0 = F.col("fp") / F.col("N"), F.col("fp0") / F.col("N")
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    prec0 = F.when(F.col("tp0") + F.col("fp0") == 0, F.lit(1.0)).otherwise(
        F.col("tp0") / (F.col("tp0") + F.col("fp0")))
    on_curve = F.col("tp0") < F.col("P")
    return c.agg(
        F.sum((fpr - fpr0) * (tpr + tpr0) / 2).alias("roc_auc"),
        F.sum(F.when(on_curve, (tpr - tpr0) * (prec + prec0) / 2)).alias("pr_auc"),
        F.sum((tpr - tpr0) * prec).alias("average_precision"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    return areas(df, score, label).select("average_precision")


def scores_at(df: DataFrame, score: str, label: str, t: float) -> DataFrame:
    """Precision, recall and predicted share with ``score > t`` (precision 0
    when nothing is predicted)."""
    pred = (F.col(score) > F.lit(t)).cast("int")
    y = _y(label)
    row = df.agg(F.sum(pred * y).alias("tp"), F.sum(pred).alias("npred"), F.sum(y).alias("P"),
                 F.count(F.lit(1)).alias("n"))
    return row.select(F.lit(t).alias("threshold"),
                      F.coalesce(F.try_divide(F.col("tp"), F.col("npred")), F.lit(0.0)).alias("precision"),
                      F.coalesce(F.try_divide(F.col("tp"), F.col("P")), F.lit(0.0)).alias("recall"),
                      (F.col("npred") / F.col("n")).alias("predicted_share"))


def no_skill(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(_y(label).cast("double")).alias("no_skill"))


def thresholds(lo: float, hi: float, step: float) -> list[float]:
    """``lo + j * step`` for j while below ``hi`` (numpy ``arange`` values)."""
    n = int(math.ceil((hi - lo) / step))
    return [lo + j * step for j in range(n)]


def _per_threshold(df: DataFrame, score: str, label: str | None, ts: list[float], strict: bool) -> DataFrame:
    """(j, predicted, tp, __n, __P) for each threshold index j: counts of rows
    with score >= t_j (or > t_j when strict) and the row / positive totals,
    all from one pass over the rows."""
    arr = F.array(*[F.lit(t) for t in ts])
    s = F.col(score).cast("double")
    idx = F.size(F.filter(arr, (lambda t: t < s) if strict else (lambda t: t <= s)))
    y = _y(label) if label else F.lit(0)
    per = df.groupBy(idx.alias("k")).agg(F.count(F.lit(1)).alias("c"), F.sum(y).alias("p"))
    grid = df.sparkSession.range(len(ts)).select(F.col("id").cast("int").alias("j"))
    # threshold j counts rows whose index k > j: a suffix sum over <= len(ts)+1 rows
    w = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    suf = per.select("k", F.sum("c").over(w).alias("pred"), F.sum("p").over(w).alias("tp"))
    j = grid.join(suf, F.col("k") == F.col("j") + 1, "left")
    # index values with no rows leave gaps: take the nearest k above j
    wj = Window.orderBy(F.col("j").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = j.withColumns({"pred": F.coalesce(F.last("pred", ignorenulls=True).over(wj), F.lit(0)),
                       "tp": F.coalesce(F.last("tp", ignorenulls=True).over(wj), F.lit(0))})
    t_arr = F.array(*[F.lit(t) for t in ts])
    tot = per.agg(F.sum("c").alias("__n"), F.sum("p").alias("__P"))
    return attach_one_row(j.select("j", F.element_at(t_arr, F.col("j") + 1).alias("thresh"), "pred", "tp"), tot)


def sweep(df: DataFrame, score: str, label: str, lo: float = 0.05, hi: float = 0.75,
          step: float = 0.005) -> DataFrame:
    """For each threshold t (``score >= t``): precision, recall,
    floor(predictions per 10,000 rows), floor(precision x that)."""
    ts = thresholds(lo, hi, step)
    j = _per_threshold(df, score, label, ts, strict=False)
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("pred")), F.lit(0.0))
    nop = F.floor(F.col("pred") * F.lit(1e4) / F.col("__n")).cast("long")
    return j.select("thresh", prec.alias("precision"),
                    F.coalesce(F.try_divide(F.col("tp"), F.col("__P")), F.lit(0.0)).alias("recall"),
                    nop.alias("number_of_predictions"),
                    F.floor(prec * nop).cast("long").alias("number_of_correct_predictions"))


def share_sweep(df: DataFrame, score: str, lo: float = 0.08, hi: float = 0.4, step: float = 0.01) -> DataFrame:
    """Share of rows with ``score > t`` for each threshold t."""
    ts = thresholds(lo, hi, step)
    j = _per_threshold(df, score, None, ts, strict=True)
    return j.select("thresh", (F.col("pred") / F.col("__n")).alias("share"))


def confusion_bins(df: DataFrame, score: str, label: str, t: float = 0.5, n: int = 10) -> DataFrame:
    """Rows predicted positive (score > t) and negative, each cut into ``n``
    equal-width score bins over that side's own range - right-closed bins
    (a, b], the first edge lowered by 0.1 % of the range so the minimum is
    included - with every bin listed (empty ones count 0): per bin the centre
    and true/false positives (positive side) or true/false negatives
    (negative side)."""
    y = _y(label)
    d = df.select(F.col(score).cast("double").alias("s"), y.alias("y"),
                  F.when(F.col(score) > F.lit(t), F.lit("positive")).otherwise(F.lit("negative")).alias("side"))
    rng = d.groupBy("side").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    d = d.join(F.broadcast(rng), "side")   # two rows: one per side
    w = (F.col("hi") - F.col("lo")) / F.lit(n)
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.least(F.ceil((F.col("s") - F.col("lo")) / w) - 1, F.lit(n - 1)))).cast("int")
    agg = d.groupBy("side", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n_pos"))
    grid = rng.select("side", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("bin"))
    g = grid.join(agg, ["side", "bin"], "left").fillna(0, ["n", "n_pos"])
    width = (F.col("hi") - F.col("lo")) / F.lit(n)
    first_lo = F.col("lo") - (F.col("hi") - F.col("lo")) * F.lit(0.001)
    left = F.when(F.col("bin") == 0, first_lo).otherwise(F.col("lo") + F.col("bin") * width)
    right = F.col("lo") + (F.col("bin") + 1) * width
    pos_side = F.col("side") == "positive"
    return g.select("side", "bin", ((left + right) / 2).alias("centre"), F.col("n").cast("long").alias("n"),
                    F.when(pos_side, F.col("n_pos")).cast("long").alias("true_pos"),
                    F.when(pos_side, F.col("n") - F.col("n_pos")).cast("long").alias("false_pos"),
                    F.when(~pos_side, F.col("n") - F.col("n_pos")).cast("long").alias("true_neg"),
                    F.when(~pos_side, F.col("n_pos")).cast("long").alias("false_neg"))


def score_hist(df: DataFrame, score: str, label: str, lo_exp: float = -4.0, hi_exp: float = -0.05,
               n: int = 19) -> DataFrame:
    """Share of each class per log-spaced score bin (each class sums to <= 1)
    and the precision (``score >= centre``) at each bin centre."""
    h = hist_log(df.withColumn("__cls", _y(label)), score, lo_exp, hi_exp, n, ["__cls"])
    wide = h.groupBy("bin", "bin_lo", "bin_hi").agg(
        F.sum(F.when(F.col("__cls") == 0, F.col("weight"))).alias("share_neg"),
        F.sum(F.when(F.col("__cls") == 1, F.col("weight"))).alias("share_pos"))
    edges = log_edges(lo_exp, hi_exp, n)
    centres = [(edges[i] + edges[i + 1]) / 2 for i in range(n)]
    prec = _per_threshold(df, score, label, centres, strict=False).select(
        F.col("j").alias("bin"), F.coalesce(F.try_divide(F.col("tp"), F.col("pred")), F.lit(0.0))
        .alias("precision_at_centre"))
    return wide.join(prec, "bin").select("bin", "bin_lo", "bin_hi",
                                         F.coalesce("share_neg", F.lit(0.0)).alias("share_neg"),
                                         F.coalesce("share_pos", F.lit(0.0)).alias("share_pos"),
                                         "precision_at_centre")


def score_vs_outcome(scores: DataFrame, outcomes: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Join scores to outcomes by id (not by position), then the Pearson
    matrix of ``cols``."""
    from .profile import corr_matrix
    return corr_matrix(scores.join(outcomes, key), cols)
