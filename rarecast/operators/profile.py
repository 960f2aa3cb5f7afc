"""Profiling, histograms and hypothesis tests.

Every profile is one pass with a ``groupBy`` (partial aggregation map-side,
so a hot value is pre-aggregated before the shuffle).  Many features are
profiled together by ``unpivot``-ing them to (feature, value) rows first:
O(rows) instead of one scan per value.  Totals are single-row aggregates
attached as a scalar subquery.  Bin tables for empty bins come from
``sequence`` (size set by the parameters, not the data)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..util import col_of, attach_one_row


def _lbl(label) -> Column:
    return col_of(label).cast("double")


# --------------------------------------------------------------------------- shares
def share_of(df: DataFrame, col: str, value) -> DataFrame:
    """Share of rows equal to ``value`` (null is not equal)."""
    eq = F.coalesce(F.col(col) == F.lit(value), F.lit(False)).cast("double")
    return df.agg(F.avg(eq).alias("share"))


def positive_rate(df: DataFrame, label: str) -> DataFrame:
    """Rows, positives and positive percentage."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(_lbl(label)).cast("long").alias("n_positive"),
                  (F.avg(_lbl(label)) * 100).alias("pct_positive"))


def ratio_by(df: DataFrame, col: str, label: str, extra: list | None = None) -> DataFrame:
    """Positive share per group, sorted by share descending."""
    return (df.groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_posts"), F.sum(_lbl(label)).cast("long").alias("n_positive"),
                 F.avg(_lbl(label)).alias("positive_ratio"), *(extra or []))
            .orderBy(F.col("positive_ratio").desc(), F.col(col)))


def share_by(df: DataFrame, col: str, label: str) -> DataFrame:
    """Per value: share of all rows and share of all positive rows."""
    per = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.sum(_lbl(label)).alias("n_pos"))
    tot = per.agg(F.sum("n").alias("__n"), F.sum("n_pos").alias("__p"))   # from the per-value table
    j = attach_one_row(per, tot)
    return j.select(col, (F.col("n") / F.col("__n")).alias("share_of_rows"),
                    F.try_divide(F.col("n_pos"), F.col("__p")).alias("share_of_positives"))


# --------------------------------------------------------------------------- correlations
def corr_with(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Pearson r of each numeric column with the label, sorted descending."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), _lbl(label)).alias(c) for c in cols])
    stack = F.expr("stack({}, {})".format(
        len(cols), ", ".join(f"'{c}', `{c}`" for c in cols))).alias("feature", "r")
    return row.select(stack).orderBy(F.col("r").desc_nulls_last(), "feature")


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Full Pearson matrix in long form (row, col, r) from one aggregate."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}")
                   for i, (a, b) in enumerate(pairs)])
    stack = F.expr("stack({}, {})".format(
        len(pairs), ", ".join(f"'{a}', '{b}', `{i}`" for i, (a, b) in enumerate(pairs)))).alias("row", "col", "r")
    return row.select(stack)


# --------------------------------------------------------------------------- histograms
def _bins_with_zeros(counts: DataFrame, by: list[str], n_bins: int, extra_agg=None) -> DataFrame:
    """Every (group, bin) with bins 0..n-1; missing cells count 0."""
    groups = counts.select(*by).distinct() if by else None
    if groups is None:
        grid = counts.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    else:
        grid = groups.select(*by, F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    return grid.join(counts, by + ["bin"], "left")


def hist_fixed(df: DataFrame, col: str, lo: float, hi: float, width: float,
               by: list[str] | None = None) -> DataFrame:
    """Counts in bins [lo + k*w, lo + (k+1)*w); the last bin is closed on the
    right as in numpy.  Values outside [lo, hi] are not counted."""
    by = by or []
    n_bins = int(round((hi - lo) / width))
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(n_bins - 1)).cast("int")
    counts = (df.where((x >= lo) & (x <= hi)).groupBy(*by, b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    g = _bins_with_zeros(counts, by, n_bins)
    return g.select(*by, "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def hist_integer(df: DataFrame, col: str, n_max: int, by: list[str] | None = None) -> DataFrame:
    """Counts per integer 0..n_max with bins centred on the integers."""
    by = by or []
    x = F.col(col).cast("double")
    b = F.floor(x + F.lit(0.5)).cast("int")
    counts = (df.where((x >= -0.5) & (x <= n_max + 0.5)).groupBy(*by, b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    # x == n_max + 0.5 belongs to the last bin (numpy closes the last edge)
    counts = counts.withColumn("bin", F.least("bin", F.lit(n_max))).groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    g = _bins_with_zeros(counts, by, n_max + 1)
    return g.select(*by, F.col("bin").alias("value"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def hist_equal(df: DataFrame, col: str, n: int = 10, lo: float | None = None,
               hi: float | None = None) -> DataFrame:
    """``n`` equal bins between the observed min and max (or a stated range);
    the maximum falls in the last bin."""
    x = F.col(col).cast("double")
    if lo is None or hi is None:
        rng = df.agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    else:
        rng = df.sparkSession.range(1).select(F.lit(float(lo)).alias("__lo"), F.lit(float(hi)).alias("__hi"))
    d = attach_one_row(df.select(x.alias("__x")), rng).where(
        (F.col("__x") >= F.col("__lo")) & (F.col("__x") <= F.col("__hi")))
    w = (F.col("__hi") - F.col("__lo")) / F.lit(n)
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("__x") - F.col("__lo")) / w), F.lit(n - 1))).cast("int")
    counts = d.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    g = attach_one_row(_bins_with_zeros(counts, [], n), rng)
    w = (F.col("__hi") - F.col("__lo")) / F.lit(n)
    return g.select("bin", (F.col("__lo") + F.col("bin") * w).alias("bin_lo"),
                    (F.col("__lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def log_edges(lo_exp: float, hi_exp: float, n: int) -> list[float]:
    """``n`` log-spaced bins: n+1 edges 10**linspace(lo_exp, hi_exp, n+1)."""
    return [float(v) for v in np.logspace(lo_exp, hi_exp, n + 1)]


def hist_log(df: DataFrame, col: str, lo_exp: float, hi_exp: float, n: int,
             by: list[str] | None = None) -> DataFrame:
    """Log-spaced bins; each row weighs 1/size of its group, so every group's
    bins sum to (at most) 1."""
    by = by or []
    x = F.col(col).cast("double")
    step = (hi_exp - lo_exp) / n
    hi_edge = 10 ** hi_exp
    lo_edge = 10 ** lo_exp
    b = F.least(F.floor((F.log10(x) - F.lit(lo_exp)) / F.lit(step)), F.lit(n - 1)).cast("int")
    # one pass: rows outside the range get bin -1 and only count towards their group's size
    inside = (x >= lo_edge) & (x <= hi_edge)
    all_counts = df.select(*by, F.when(inside, b).otherwise(F.lit(-1)).alias("bin")) \
        .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    sizes = all_counts.groupBy(*by).agg(F.sum("n").alias("__n"))
    counts = all_counts.where(F.col("bin") >= 0)
    # one row per group: joined without a hint (Catalyst/AQE pick broadcast by size)
    counts = counts.join(sizes, by) if by else attach_one_row(counts, sizes)
    counts = counts.select(*by, "bin", "n", (F.col("n") / F.col("__n")).alias("weight"))
    g = _bins_with_zeros(counts, by, n)
    edges = F.array(*[F.lit(e) for e in log_edges(lo_exp, hi_exp, n)])
    return g.select(*by, "bin", F.element_at(edges, F.col("bin") + 1).alias("bin_lo"),
                    F.element_at(edges, F.col("bin") + 2).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                    F.coalesce("weight", F.lit(0.0)).alias("weight"))


def density_log(df: DataFrame, x: str, y: str, cells: int, by: list[str] | None = None,
                eps: float = 0.1, lo_exp: float = -3.0, hi_exp: float = 3.0) -> DataFrame:
    """2-D log-log cell counts: zeros shifted by ``eps`` first, then square
    cells of 1/``cells`` of the decade range [lo_exp, hi_exp] per axis."""
    by = by or []
    per = cells / (hi_exp - lo_exp)

    def cell(c):
        v = F.col(c).cast("double")
        v = F.when(v == 0, F.lit(eps)).otherwise(v)
        return F.floor((F.log10(v) - F.lit(lo_exp)) * F.lit(per)).cast("int")
    return (df.where((F.col(x) >= 0) & (F.col(y) >= 0))
            .groupBy(*by, cell(x).alias("cell_x"), cell(y).alias("cell_y"))
            .agg(F.count(F.lit(1)).alias("n")))


def rate_by_bin(df: DataFrame, col: str, label: str, lo: float, hi: float, width: float) -> DataFrame:
    """Per bin [lo+k*w, lo+(k+1)*w): mean label and its standard error
    (sample std / sqrt(n)); empty bins are kept with nulls."""
    n_bins = int(math.ceil((hi - lo) / width - 1e-9))
    x = F.col(col).cast("double")
    b = F.floor((x - F.lit(lo)) / F.lit(width)).cast("int")
    agg = (df.where((x >= lo) & (x < lo + n_bins * width)).groupBy(b.alias("bin"))
           .agg(F.count(F.lit(1)).alias("n"), F.avg(_lbl(label)).alias("rate"),
                (F.stddev_samp(_lbl(label)) / F.sqrt(F.count(F.lit(1)))).alias("sem")))
    g = _bins_with_zeros(agg, [], n_bins)
    return g.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width) + F.lit(width / 2)).alias("bin_centre"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n"), "rate", "sem")


def sem_pop(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Population std / sqrt(n) per group."""
    by = by or []
    x = F.col(col).cast("double")
    return df.groupBy(*by).agg(F.count(x).alias("n"),
                               (F.stddev_pop(x) / F.sqrt(F.count(x))).alias("sem"))


# --------------------------------------------------------------------------- category profiles
def _long(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(feature, value, label) rows: every feature as a string value."""
    return df.select(_lbl(label).alias("__y"), *[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot(["__y"], cols, "feature", "value")


def profile(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Per (feature, value): rows, positives, positive fraction.  Nulls form
    their own value."""
    return (_long(df, cols, label).groupBy("feature", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("__y").cast("long").alias("n_positive"),
                 F.avg("__y").alias("positive_fraction")))


@F.pandas_udf(T.DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail P(X > stat) of a chi-square with ``dof`` degrees of freedom:
    the regularised upper incomplete gamma Q(dof/2, stat/2), by series for
    x < a+1 and by continued fraction otherwise."""
    def q(x, k):
        if x is None or k is None or np.isnan(x) or np.isnan(k) or k <= 0:
            return float("nan")
        a, x = k / 2.0, x / 2.0
        if x <= 0:
            return 1.0
        lg = math.lgamma(a)
        if x < a + 1:
            term = total = 1.0 / a
            ap = a
            for _ in range(10000):
                ap += 1
                term *= x / ap
                total += term
                if abs(term) < abs(total) * 1e-15:
                    break
            return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - lg))
        b = x + 1 - a
        c = 1 / 1e-300
        d = 1 / b
        h = d
        for i in range(1, 10000):
            an = -i * (i - a)
            b += 2
            d = an * d + b
            d = 1e-300 if abs(d) < 1e-300 else d
            c = b + an / c
            c = 1e-300 if abs(c) < 1e-300 else c
            d = 1 / d
            delta = d * c
            h *= delta
            if abs(delta - 1) < 1e-15:
                break
        return math.exp(-x + a * math.log(x) - lg) * h
    return pd.Series([q(float(s), float(k)) for s, k in zip(stat, dof)], dtype="float64")


def chi_square(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Per feature, with p = overall positive rate and E = p * n_value:
    ``chi2_pos`` = sum over values of (O - E)^2 / E using the positive cells
    only (the source's statistic), ``chi2_full`` = the usual 2 x k statistic
    (= chi2_pos / (1 - p)), dof = k - 1 and the upper-tail p-values.  The
    p-value runs in a vectorised pandas UDF over one row per feature."""
    prof = (_long(df, cols, label).groupBy("feature", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("n_positive"), F.count("__y").alias("__c")))
    # overall rate from the first feature's cells (they cover every row once): no second pass
    tot = prof.where(F.col("feature") == F.lit(cols[0])).agg(
        (F.sum("n_positive") / F.sum("__c")).alias("__p"))
    j = attach_one_row(prof, tot)
    e = F.col("__p") * F.col("n")
    cell = F.try_divide((F.col("n_positive") - e) ** 2, e)
    stats = j.groupBy("feature").agg(
        F.sum(cell).alias("chi2_pos"), (F.count(F.lit(1)) - 1).alias("dof"),
        F.first("__p").alias("__p"))
    stats = stats.withColumn("chi2_full", F.try_divide(F.col("chi2_pos"), 1 - F.col("__p")))
    return stats.select("feature", "chi2_pos", "chi2_full", F.col("dof").cast("int").alias("dof"),
                        chi2_sf(F.col("chi2_pos"), F.col("dof").cast("double")).alias("p_value_pos"),
                        chi2_sf(F.col("chi2_full"), F.col("dof").cast("double")).alias("p_value_full"))
