"""Stratified split, folds, undersampling, SMOTE and class ratios.

All draws are deterministic: rows are ordered by ``md5(id | seed)`` within
their label (the same digest in any engine), never by ``rand()``.

Exact ranks without a per-label window.  The majority label may hold almost
all rows, so ``row_number() OVER (PARTITION BY label ...)`` would put them in
one task.  Instead the digest's first five hex digits give 2^20 ordered
buckets; bucket sizes per label are counted (partial aggregation), their
running offsets come from a window over that histogram (<= 2^20 rows per
label), and rows are ranked only inside their own (label, bucket) - about
n / 2^20 rows each.  rank = offset(bucket) + rank in bucket, exactly the rank
by digest."""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .neighbours import projected_neighbours
from ..util import attach_one_row, col_of, hash_key, hash_uniform, kept_table

BUCKET_HEX = 5   # 16^5 = 2^20 ordered buckets


def _digest_buckets(df: DataFrame, label: str, id_col: str, seed: int | str):
    """Rows with their digest and digest-prefix bucket, and the (label, bucket)
    histogram (at most 2^20 rows per label)."""
    h = hash_key(id_col, seed=seed)
    d = df.withColumns({"__h": h, "__b": F.conv(F.substring(h, 1, BUCKET_HEX), 16, 10).cast("int")})
    return d, d.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__c"))


def rank_in_label(df: DataFrame, label: str, id_col: str, seed: int | str = 0,
                  out: str = "rank") -> DataFrame:
    """Adds ``out``: 1-based rank of each row by md5(id|seed) within its
    label, plus ``n_label`` (rows of that label)."""
    d, hist = _digest_buckets(df, label, id_col, seed)
    return _rank_from(d, hist, label, id_col, out)


def _rank_from(d: DataFrame, hist: DataFrame, label: str, id_col: str, out: str) -> DataFrame:
    w = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    wl = Window.partitionBy(label)
    offs = hist.select(label, "__b", F.coalesce(F.sum("__c").over(w), F.lit(0)).alias("__off"),
                       F.sum("__c").over(wl).alias("n_label"))
    d = d.join(offs, [label, "__b"])
    wr = Window.partitionBy(label, "__b").orderBy("__h", col_of(id_col).cast("string"))
    return d.withColumn(out, F.col("__off") + F.row_number().over(wr)).drop("__h", "__b", "__off")


def held_out_count(n, frac: float):
    """Rows of a label held out: round(frac * n), half up."""
    return F.floor(F.lit(float(frac)) * n + F.lit(0.5)).cast("long")


def in_first_of_label(df: DataFrame, label: str, id_col: str, seed: int | str, wanted, out: str) -> DataFrame:
    """Adds ``out``: whether the row is among the first ``wanted(hist)`` rows of its label by digest (rows sharing the
    last one's id go with it).

    The histogram of digest buckets tells in which bucket the count is reached, and only that bucket's rows (about
    n / 2^20) are ranked.  This gives the last row taken, one for each label, kept as a small table; every other row is
    decided by comparing its digest, without a shuffle.  ``wanted`` gets the histogram frame with ``n_label`` and adds
    ``want``."""
    d, hist = _digest_buckets(df.select(label, id_col), label, id_col, seed)
    upto = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    h = wanted(hist.select(label, "__b", "__c", F.sum("__c").over(upto).alias("__to"),
                           F.sum("__c").over(Window.partitionBy(label)).alias("n_label")), hist)
    want, before = F.least("want", "n_label"), F.col("__to") - F.col("__c")
    cut = h.where((before < want) & (want <= F.col("__to"))).select(
        F.col(label).alias("__y"), F.col("__b").alias("__cut"), (want - before).alias("__left"))
    near = d.join(F.broadcast(cut), F.col(label).eqNullSafe(F.col("__y")) & (F.col("__b") == F.col("__cut")))   # a row for each label
    rank = F.row_number().over(Window.partitionBy("__y").orderBy("__h", col_of(id_col).cast("string")))
    last = (near.withColumn("__r", rank).where("__r = __left")
            .select("__y", F.col("__h").alias("__last"), col_of(id_col).cast("string").alias("__last_id")))
    last = kept_table(last, "label-limits")
    key = hash_key(id_col, seed=seed)
    inside = (key < F.col("__last")) | ((key == F.col("__last")) & (col_of(id_col).cast("string") <= F.col("__last_id")))
    return (df.join(last, F.col(label).eqNullSafe(F.col("__y")), "left")
            .withColumn(out, F.coalesce(inside, F.lit(False))).drop("__y", "__last", "__last_id"))


def split(df: DataFrame, label: str, id_col: str, frac: float = 0.1666, seed: int = 2,
          out: str = "split") -> DataFrame:
    """Adds ``out`` = 'test' for round(frac * n_label) rows of every label
    (the first by digest), 'train' for the rest."""
    r = in_first_of_label(df, label, id_col, seed,
                          lambda h, _: h.withColumn("want", held_out_count(F.col("n_label"), frac)), "__test")
    return r.withColumn(out, F.when(F.col("__test"), F.lit("test")).otherwise(F.lit("train"))).drop("__test")


def folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 0, out: str = "fold") -> DataFrame:
    """Adds ``out`` in 0..k-1: the digest rank within the label modulo k, so
    every fold holds the same share of each label (to within one row)."""
    r = rank_in_label(df, label, id_col, seed, "__r")
    return r.withColumn(out, F.pmod(F.col("__r") - 1, F.lit(k)).cast("int")).drop("__r", "n_label")


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """positives / negatives, and the 1.01x and 2.01x resampling targets."""
    y = col_of(label).cast("int")
    row = df.agg(F.sum(y).alias("n_pos"), F.sum(1 - y).alias("n_neg"))
    ratio = F.try_divide(F.col("n_pos"), F.col("n_neg"))
    return row.select("n_pos", "n_neg", ratio.alias("ratio"), (ratio * 1.01).alias("target_1_01"),
                      (ratio * 2.01).alias("target_2_01"))


def undersample(df: DataFrame, label: str, id_col: str, ratio: float, seed: int = 0,
                minority: int = 1) -> DataFrame:
    """Keep every minority row and the first floor(n_min / ratio) majority
    rows by digest, so that minority / majority = ratio."""
    y = col_of(label).cast("int")

    def wanted(h, hist):          # minority size from the (label, bucket) histogram: no second pass over the rows
        n_min = hist.agg(F.coalesce(F.sum(F.when(y == minority, F.col("__c"))), F.lit(0)).alias("m"))
        return attach_one_row(h, n_min).withColumn("want", F.when(y == minority, F.lit(0)).otherwise(
            F.floor(F.col("m") / F.lit(float(ratio)))))

    r = in_first_of_label(df, label, id_col, seed, wanted, "__keep")
    return r.where((y == minority) | F.col("__keep")).drop("__keep")


def random_baseline(train: DataFrame, test: DataFrame, label: str, id_col: str, seed: int = 0) -> DataFrame:
    """Predict positive with the training prior (md5 uniform < prior) and
    report precision, recall and predicted share on the test rows."""
    prior = train.agg(F.avg(col_of(label).cast("double")).alias("__prior"))
    t = attach_one_row(test, prior)
    pred = (hash_uniform(id_col, seed=seed) < F.col("__prior")).cast("int")
    y = col_of(label).cast("int")
    row = t.agg(F.sum(pred * y).alias("tp"), F.sum(pred).alias("npred"), F.sum(y).alias("P"),
                F.count(F.lit(1)).alias("n"))
    return row.select(F.coalesce(F.try_divide(F.col("tp"), F.col("npred")), F.lit(0.0)).alias("precision"),
                      F.coalesce(F.try_divide(F.col("tp"), F.col("P")), F.lit(0.0)).alias("recall"),
                      (F.col("npred") / F.col("n")).alias("predicted_share"))


# ----------------------------------------------------------------------------- SMOTE
KNN_BLOCK = 4096        # rows per side of one distance block (block x block distances per task)
KNN_CELL = 1024         # rows a cell has at least on average: smaller ones would multiply the copies of pass 2
KNN_HELD = 1 << 20      # distances that a task holds at once
KNN_SENT = 8192         # rows that pass 2 hands on at once


def _knn_block(k: int, qdf: pd.DataFrame, rdf: pd.DataFrame) -> pd.DataFrame:
    """k nearest reference rows (other than itself) for each query row of one
    (query chunk, reference chunk) block; ties by neighbour id.  Distances
    come from matrix products of ``KNN_HELD`` entries; the near-k candidates are re-measured as
    sqrt(sum((x - y)^2)) so the kept order does not depend on round-off."""
    empty = pd.DataFrame({"id": pd.Series([], dtype=object), "nb_id": pd.Series([], dtype=object),
                          "dist": pd.Series([], dtype="float64")})
    if qdf.empty or rdf.empty:
        return empty
    step = max(1, KNN_HELD // len(rdf))
    if len(qdf) > step:
        return pd.concat([_knn_block(k, qdf.iloc[at:at + step], rdf) for at in range(0, len(qdf), step)], ignore_index=True)
    q = np.stack(qdf["a"].to_numpy()).astype(np.float64)
    r = np.stack(rdf["b"].to_numpy()).astype(np.float64)
    qid, rid = qdf["id"].to_numpy(), rdf["nb_id"].to_numpy()
    qq, rr = (q * q).sum(1), (r * r).sum(1)
    d2 = np.maximum(qq[:, None] + rr[None, :] - 2.0 * (q @ r.T), 0.0)
    d2[qid[:, None] == rid[None, :]] = np.inf
    m = min(k, r.shape[0])
    kth = np.partition(d2, m - 1, axis=1)[:, m - 1]
    tol = 1e-9 * (qq[:, None] + rr.max()) + 1e-12      # round-off of the product form
    rows, cols = np.nonzero(np.isfinite(d2) & (d2 <= (kth[:, None] + tol)))
    if rows.size == 0:
        return empty
    dist = np.sqrt(((q[rows] - r[cols]) ** 2).sum(1))
    out = pd.DataFrame({"id": qid[rows], "nb_id": rid[cols], "dist": dist})
    return out.sort_values(["id", "dist", "nb_id"]).groupby("id", sort=False).head(k)


def _block_knn(q: DataFrame, r: DataFrame, k: int, block: int) -> DataFrame:
    """Candidates (id, nb_id, dist): k per query row and reference chunk.
    ``q`` = (cell, id, a), ``r`` = (cell, nb_id, b).  A cell's queries and
    references are cut into ceil(size / block) hash chunks; every (query
    chunk, reference chunk) pair of the cell is one cogrouped task, so a hot
    cell is spread over many tasks and no task holds more than 2 x block
    rows.  The chunk-count table has one row per cell (bounded by the pivot
    count) and is broadcast."""
    nq = q.groupBy("cell").agg(F.count(F.lit(1)).alias("nq"))
    nr = r.groupBy("cell").agg(F.count(F.lit(1)).alias("nr"))
    chunks = F.broadcast(nq.join(nr, "cell").select(
        "cell", F.ceil(F.col("nq") / block).cast("int").alias("cq"),
        F.ceil(F.col("nr") / block).cast("int").alias("cr")))
    # fresh aliases: both sides derive from one frame, and cogroup needs distinct key attributes
    qq = q.join(chunks, "cell").select(
        F.col("cell").alias("cell"), F.pmod(F.xxhash64("id"), F.col("cq")).cast("int").alias("qc"),
        F.explode(F.sequence(F.lit(0), F.col("cr") - 1)).alias("rc"), "id", "a")
    rr = r.join(chunks, "cell").select(
        F.col("cell").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("cq") - 1)).alias("qc"),
        F.pmod(F.xxhash64("nb_id"), F.col("cr")).cast("int").alias("rc"), "nb_id", "b")
    keys = ["cell", "qc", "rc"]
    return qq.groupBy(*keys).cogroup(rr.groupBy(*keys)).applyInPandas(
        partial(_knn_block, k), "id string, nb_id string, dist double")


def _keep_k(cands: DataFrame, k: int) -> DataFrame:
    rank = Window.partitionBy("id").orderBy("dist", "nb_id")
    return cands.withColumn("nb_rank", F.row_number().over(rank)).where(F.col("nb_rank") <= k)


def minority_neighbours(minority: DataFrame, id_col: str, vec: str, k: int = 5,
                        n_pivots: int | None = None, block: int = KNN_BLOCK) -> DataFrame:
    """(id, nb_id, dist, nb_rank): the exact k nearest other rows of every
    row (Euclidean; ties by neighbour id), as a nearest-neighbour search for
    SMOTE needs it, without a pairwise join.

    1. P pivots: the P rows with the smallest md5(id) (default the square
       root of n, or fewer, so that cells have some ``KNN_CELL`` rows); each row's cell is its
       nearest pivot (numpy over Arrow batches), cell radius R_j = largest
       distance of a cell's rows to its pivot.
    2. Pass 1: k nearest inside the own cell -> r(x), the k-th distance
       (infinite when the cell is too small).
    3. Pass 2: by the triangle inequality no row of cell j is nearer to x
       than d(x, p_j) - R_j, so x is sent only to the other cells with
       d(x, p_j) - R_j <= r(x); k nearest there.
    4. Merge both passes per row, keep k.  Exact: every row that could beat
       the pass-1 k-th distance is compared.
    Distance work per row is the size of the cells it must search (all of
    them in the worst case of no spatial structure); emitted rows are k per
    row and block, never all pairs."""
    v = kept_table(minority.select(col_of(id_col).cast("string").alias("id"), F.col(vec).cast("array<double>").alias("a")), "knn-rows")
    n = v.count()
    k = min(k, max(n - 1, 0))
    if k == 0:
        return v.sparkSession.createDataFrame([], "id string, nb_id string, dist double, nb_rank int")
    p = n_pivots or max(1, min(math.isqrt(n), n // KNN_CELL))
    piv = np.array([r["a"] for r in v.orderBy(F.md5("id"), "id").limit(p).collect()], dtype=np.float64)
    pp = (piv * piv).sum(1)

    def pivot_dists(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((x * x).sum(1)[:, None] + pp[None, :] - 2.0 * (x @ piv.T), 0.0))

    def assign(batches):
        for b in batches:
            if b.empty:
                continue
            d = pivot_dists(np.stack(b["a"].to_numpy()))
            c = d.argmin(1)
            yield pd.DataFrame({"id": b["id"], "a": b["a"], "cell": c.astype("int32"),
                                "d_own": d[np.arange(len(c)), c]})

    cells = kept_table(v.mapInPandas(assign, "id string, a array<double>, cell int, d_own double"), "knn-cells")
    radius = {r["cell"]: r["R"] for r in cells.groupBy("cell").agg(F.max("d_own").alias("R")).collect()}
    rad = np.array([radius.get(j, -np.inf) for j in range(len(piv))])     # empty cell: never searched

    refs = cells.select("cell", F.col("id").alias("nb_id"), F.col("a").alias("b"))
    first = kept_table(_keep_k(_block_knn(cells.select("cell", "id", "a"), refs, k, block), k), "knn-first")
    if len(piv) == 1:
        return first
    rk = first.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.max("dist").alias("rk")) \
        .select("id", F.when(F.col("c") >= k, F.col("rk")).alias("rk"))

    def fan_out(batches):
        step = max(1, KNN_SENT // len(piv))           # a row may go to every cell
        for b in (whole.iloc[at:at + step] for whole in batches for at in range(0, len(whole), step)):
            d = pivot_dists(np.stack(b["a"].to_numpy()))
            bound = b["rk"].fillna(np.inf).to_numpy()
            own = b["cell"].to_numpy()
            # prune only with a margin for round-off, so an exact tie is never cut
            slack = 1e-9 * (d + np.abs(rad)[None, :]) + 1e-12
            hit = (d - rad[None, :] <= bound[:, None] + slack) & np.isfinite(rad)[None, :]
            hit[np.arange(len(own)), own] = False
            i, j = np.nonzero(hit)
            yield pd.DataFrame({"cell": j.astype("int32"), "id": b["id"].to_numpy()[i],
                                "a": b["a"].to_numpy()[i]})

    q2 = cells.join(rk, "id", "left").select("id", "a", "cell", "rk") \
        .mapInPandas(fan_out, "cell int, id string, a array<double>")
    second = _block_knn(q2, refs, k, block)
    return _keep_k(first.select("id", "nb_id", "dist").unionByName(second), k)


def smote(df: DataFrame, vec: str, label: str, id_col: str, ratio: float, k: int = 5, seed: int = 0,
          minority: int = 1, approximate: bool = False) -> DataFrame:
    """Synthetic minority rows x + u * (neighbour - x) until minority /
    majority reaches ``ratio``.  Synthetic row j uses minority row
    (j mod n_min) in digest order, one of its k nearest minority neighbours
    and u chosen by md5(j | seed).  Returns the input plus the synthetic rows
    (``synthetic`` = true, ``synthetic_id`` = ``syn_<j>``, the source and
    neighbour ids and u kept for inspection; the id column is null).
    ``approximate`` finds the neighbours by ``projected_neighbours``: for many minority rows whose vectors have no
    spatial structure, where the exact search compares all pairs."""
    y = col_of(label).cast("int")
    counts = df.agg(F.sum((y == minority).cast("long")).alias("m"), F.sum((y != minority).cast("long")).alias("M")).first()
    n_min, n_maj = counts["m"] or 0, counts["M"] or 0
    need = int(ratio * n_maj) - n_min
    base = df.withColumn("synthetic", F.lit(False))
    if need <= 0 or n_min < 2:
        return base
    mino = df.where(y == minority).withColumn("__idk", col_of(id_col).cast("string"))
    nbrs = (projected_neighbours if approximate else minority_neighbours)(mino, "__idk", vec, k)
    ranked = rank_in_label(mino.withColumn("__one", F.lit(1)), "__one", "__idk", seed, "__r") \
        .select("__idk", (F.col("__r") - 1).alias("__pos"), F.col(vec).alias("__x"))
    spark = df.sparkSession
    # synthetic ids 0..need-1; row j belongs to base position j mod n_min
    jobs = spark.range(need).select(F.col("id").alias("j"), F.pmod(F.col("id"), F.lit(n_min)).alias("__pos"))
    jobs = jobs.join(ranked, "__pos")
    kk = nbrs.groupBy("id").agg(F.count(F.lit(1)).alias("__k"))
    jobs = jobs.join(kk, jobs["__idk"] == kk["id"]).drop("id")
    pick = (F.floor(hash_uniform("j", seed=f"{seed}|nb") * F.col("__k")) + 1).cast("int")
    jobs = jobs.withColumn("__nb_rank", pick)
    nb = nbrs.select(F.col("id").alias("__idk"), "nb_id", F.col("nb_rank").alias("__nb_rank"))
    jobs = jobs.join(nb, ["__idk", "__nb_rank"])
    xs = mino.select(F.col("__idk").alias("nb_id"), F.col(vec).alias("__nx"))
    jobs = jobs.join(xs, "nb_id")
    u = hash_uniform("j", seed=f"{seed}|u")
    new_vec = F.zip_with("__x", "__nx", lambda a, b: a + u * (b - a))
    cast_to = df.schema[vec].dataType.simpleString()
    syn = jobs.select(F.concat(F.lit("syn_"), F.col("j").cast("string")).alias("__sid"),
                      new_vec.cast(cast_to).alias(vec), F.col("__idk").alias("source_id"),
                      F.col("nb_id").alias("neighbour_id"), u.alias("u"))
    out_cols = {}
    for f in df.schema.fields:
        if f.name == vec:
            out_cols[f.name] = F.col(vec)
        elif f.name == label:
            out_cols[f.name] = F.lit(minority).cast(f.dataType)
        elif f.name == id_col:
            out_cols[f.name] = F.lit(None).cast(f.dataType)
        else:
            out_cols[f.name] = F.lit(None).cast(f.dataType)
    syn_rows = syn.select(*[c.alias(n) for n, c in out_cols.items()], F.lit(True).alias("synthetic"),
                          F.col("__sid").alias("synthetic_id"), "source_id", "neighbour_id", "u")
    base = base.withColumns({"synthetic_id": F.lit(None).cast("string"), "source_id": F.lit(None).cast("string"),
                             "neighbour_id": F.lit(None).cast("string"), "u": F.lit(None).cast("double")})
    return base.unionByName(syn_rows)
