"""Delayed outcome: attach to each snapshot what happened later.

``outcome_after`` is an as-of join with an upper bound: for each snapshot at
``t`` take the earliest outcome of the same key with time in
``[t + lo, t + hi)``.  It is built without emitting pairs:

1. Snapshots (shifted to ``t + lo``) become distinct (key, instant) rows and
   outcomes the earliest per (key, instant) - partial aggregation, so
   repeated instants collapse before any window.
2. Instants are cut into time buckets of width ``bucket`` (default one hour,
   at most the window length), so a hot key is split by time; a (key,
   bucket) group that is still larger than ``hot_rows`` is cut further into
   time slices (approximate quantiles, then equal width inside each).
3. Per (key, bucket, slice) the first outcome at or after each snapshot
   comes from a running ``min`` window over the reversed order - O(n log n),
   no pair output.
4. Snapshots with nothing left in their slice look up the next slice of the
   same key holding an outcome, from a per-(key, bucket, slice) minimum
   table (one row per slice, so no fan-out), by a second small window.
5. Answers join back to the snapshot rows by (key, instant); the match is
   kept only when it is before ``t + hi``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalise import award_count
from ..util import epoch_seconds


def outcome_fields(df: DataFrame, awards: str, ups, comments, key: str = "post_id",
                   keys: dict[str, str] | None = None) -> DataFrame:
    """silver/gold/platinum, final upvotes and comments of the later record."""
    from ..functions.normalise import AWARD_KEYS
    from ..util import col_of
    keys = keys or AWARD_KEYS
    return df.select(
        F.col(key),
        *[award_count(awards, k).alias(f"{name}_awarded") for name, k in keys.items()],
        col_of(ups).cast("int").alias("final_upvotes"),
        col_of(comments).cast("int").alias("final_num_comments"),
    )


def join_outcome(snap: DataFrame, out: DataFrame, key: str) -> DataFrame:
    """Left join by key (one outcome row per key) and flag snapshots that have
    no outcome instead of failing the batch."""
    o = out.withColumn("__has_outcome", F.lit(True))
    return (snap.join(o, key, "left")
            .withColumn("outcome_missing", F.col("__has_outcome").isNull())
            .drop("__has_outcome"))


def _seconds(interval: str) -> float:
    n, unit = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return float(n) * mult


HOT_GROUP_ROWS = 1 << 20   # (key, bucket) groups above this are split by time
HOT_QUANTILES = 64         # approximate time quantiles per hot group


def _split_hot(u: DataFrame, keys: list, t: str, hot_rows: int, n_q: int = HOT_QUANTILES,
               sizing: DataFrame | None = None) -> DataFrame:
    """Adds ``__sb``, a slice number monotone in ``t`` within each group of
    ``keys``: 0 for groups of at most ``hot_rows`` rows.  A hot group of n
    rows is cut at ``n_q`` approximate time quantiles (so a group whose
    instants crowd into part of its range is still spread), and each
    quantile interval into ceil(n / ((n_q + 1) * hot_rows)) equal-width
    pieces.  Groups are sized on ``sizing`` (default ``u``) - any frame with
    the same ``keys`` and ``t`` whose group counts bound ``u``'s, e.g. the
    raw rows before de-duplication: then sizing is a partial aggregation of
    two narrow columns straight from the scan.  Quantile sketches are built
    for rows of hot groups only.  The hot-group table has at most
    rows / hot_rows rows; its joins are left to AQE (broadcast when small,
    otherwise a sort-merge join whose skewed side AQE splits)."""
    src = u if sizing is None else sizing
    hot = (src.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(t).alias("__lo"), F.max(t).alias("__hi"))
           .where(F.col("__n") > hot_rows))
    probs = [i / (n_q + 1) for i in range(1, n_q + 1)]
    qs = (src.join(hot.select(*keys), keys, "left_semi").groupBy(*keys)
          .agg(F.percentile_approx(t, probs, max(10000, 100 * n_q)).alias("__q")))
    hot = hot.join(qs, keys).select(
        *keys, "__n", F.concat(F.array("__lo"), "__q", F.array("__hi")).alias("__e"))
    d = u.join(hot, keys, "left")
    m = F.ceil(F.col("__n") / F.lit((n_q + 1) * hot_rows))
    q = F.size(F.filter(F.slice("__e", 2, n_q), lambda b: b < F.col(t)))      # quantile interval 0..n_q
    left, right = F.element_at("__e", q + 1), F.element_at("__e", q + 2)
    piece = F.when(right <= left, F.lit(0)).otherwise(
        F.least(m - 1, F.floor((F.col(t) - left) / (right - left) * m)))
    sb = F.when(F.col("__n").isNull(), F.lit(0)).otherwise(q * m + piece)
    return d.withColumn("__sb", sb.cast("long")).drop("__n", "__e")


def outcome_after(snap: DataFrame, out: DataFrame, key: str, snap_ts: str, out_ts: str,
                  payload: list[str], lo: str = "24 hours", hi: str = "48 hours",
                  out_id: str | None = None, bucket: str | None = None,
                  prefix: str = "out_", hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Every snapshot row, plus the earliest outcome of its key in
    ``[t+lo, t+hi)`` (ties broken by ``out_id``).  Outcome columns are
    ``prefix + name`` for ``out_ts``, ``out_id`` and each ``payload`` column;
    null when there is none."""
    lo_s, hi_s = _seconds(lo), _seconds(hi)
    width = _seconds(bucket) if bucket else min(3600.0, hi_s - lo_s)
    tie = out_id or out_ts
    fields = [out_ts] + ([tie] if tie != out_ts else []) + [p for p in payload if p not in (out_ts, tie)]

    s = snap.withColumn("__t", epoch_seconds(snap_ts) + F.lit(lo_s))
    o = out.select(key, *fields).withColumn("__t", epoch_seconds(out_ts))
    o_struct = F.struct(F.col("__t"), F.col(tie).alias("__tie"),
                        *[F.col(f).alias(f"__p_{f}") for f in fields])
    o_type = o.select(o_struct.alias("x")).schema["x"].dataType

    # Instants: the answer depends only on (key, t), and of outcomes at one
    # instant only the earliest by tie matters - both collapse by partial
    # aggregation, so repeated instants of a hot key never reach a window.
    o1 = o.groupBy(key, "__t").agg(F.min(o_struct).alias("__o"))
    si = s.select(key, "__t").distinct()
    u = (si.select(key, "__t", F.lit(0).alias("__kind"), F.lit(None).cast(o_type).alias("__o"))
         .unionByName(o1.select(key, "__t", F.lit(1).alias("__kind"), "__o"))
         .withColumn("__b", F.floor(F.col("__t") / width)))
    # sized on the raw (key, time) rows: counts bound the instants', and no
    # second (key, instant) shuffle is needed for it
    raw = (s.select(key, "__t").unionByName(o.select(key, "__t"))
           .withColumn("__b", F.floor(F.col("__t") / width)))
    u = _split_hot(u, [key, "__b"], "__t", hot_rows, sizing=raw)
    part = [key, "__b", "__sb"]

    # (2) in-slice as-of, as a running min over the reversed order (a running
    # frame is O(n); a frame ending at UNBOUNDED FOLLOWING is not).  In
    # reverse, an outcome (kind 1) of the same instant comes before the
    # snapshot (kind 0), so an outcome exactly at t + lo is included.
    w = (Window.partitionBy(*part).orderBy(F.col("__t").desc(), F.col("__kind").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inst = (u.withColumn("__m", F.min("__o").over(w))
            .where(F.col("__kind") == 0).select(*part, "__t", "__m"))

    # (3) first outcome in a strictly later slice of the same key: one row per
    # (key, bucket, slice) - its earliest outcome and whether it holds
    # snapshots - and a running min over the slices before it in reverse order.
    per_slice = u.groupBy(*part).agg(F.min("__o").alias("__x"),
                                     F.max(F.col("__kind") == 0).alias("__has_snap"))
    wf = (Window.partitionBy(key).orderBy(F.col("__b").desc(), F.col("__sb").desc())
          .rowsBetween(Window.unboundedPreceding, -1))
    later = (per_slice.withColumn("__later", F.min("__x").over(wf))
             .where(F.col("__has_snap")).select(*part, "__later"))

    ans = (inst.join(later, part, "left")
           .select(key, "__t", F.coalesce(F.col("__m"), F.col("__later")).alias("__best")))
    # back to every snapshot row: many rows per (key, t) on one side, one on
    # the other (a hot key is a skewed partition that AQE splits)
    res = s.join(ans, [key, "__t"], "left")
    ok = F.col("__best.__t") < F.col("__t") + F.lit(hi_s - lo_s)
    outs = [F.when(ok, F.col(f"__best.__p_{f}")).alias(f"{prefix}{f}") for f in fields]
    return res.select(*[F.col(c) for c in snap.columns], *outs)


def outcome_gaps(snap: DataFrame, out: DataFrame, key: str | list, by: list[str]) -> DataFrame:
    """Snapshots with no outcome row for their key, counted per ``by``."""
    keys = [key] if isinstance(key, str) else list(key)
    missing = snap.join(out.select(*keys).distinct(), keys, "left_anti")
    return missing.groupBy(*by).agg(F.count(F.lit(1)).alias("n_missing"))
