"""The scale-oriented forms equal their naive definitions (brute force on
small fixtures), and the rows-only operators keep their invariants."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rarecast.operators import evaluate as EV
from rarecast.operators import outcome as O
from rarecast.operators import resample as RS
from rarecast.operators import textfeat as TF
from rarecast.util import prefix_sum_by_range
from tests.conftest import SF_SMALL


def test_prefix_sum_equals_global_window(spark):
    rnd = random.Random(1)
    data = [(float(rnd.randint(0, 400)), rnd.randint(0, 5)) for _ in range(2000)]
    df = spark.createDataFrame(data, "k double, v int").groupBy("k").agg(F.sum("v").alias("v"))
    got = {r["k"]: r["cum"] for r in prefix_sum_by_range(df, "k", {"cum": "v"}, descending=True, n_buckets=7).collect()}
    want = {r["k"]: r["cum"] for r in df.withColumn(
        "cum", F.sum("v").over(Window.orderBy(F.col("k").desc()))).collect()}
    assert got == want


def test_rank_in_label_equals_row_number(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    got = RS.rank_in_label(df, "y", "id", seed=3, out="r").select("id", "r")
    h = F.md5(F.concat(F.col("id").cast("string"), F.lit("|3")))
    want = df.select("id", F.row_number().over(Window.partitionBy("y").orderBy(h)).alias("r"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_split_is_disjoint_complete_and_stratified(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = RS.split(df, "y", "id", 0.2, seed=2)
    assert s.count() == 1000
    c = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert c[(1, "test")] == 20 and c[(0, "test")] == 180


def test_folds_balanced(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    f = RS.folds(df, "y", "id", 5)
    counts = [r["count"] for r in f.where("y = 1").groupBy("fold").count().collect()]
    assert sorted(counts) == [20] * 5


def test_outcome_after_equals_brute_force(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    v = e.where("event_type = 'view'").select("event_id", "user_id", "ts")
    p = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    for bucket, hot in ((None, O.HOT_GROUP_ROWS), ("6 hours", O.HOT_GROUP_ROWS), (None, 2), ("48 hours", 3)):
        got = {r["event_id"]: r["out_event_id"] for r in
               O.outcome_after(v, p, "user_id", "ts", "ts", [], out_id="event_id", bucket=bucket,
                               hot_rows=hot).collect()}
        views, buys = v.collect(), p.collect()
        want = {}
        for a in views:
            lo, hi = a["ts"] + dt.timedelta(hours=24), a["ts"] + dt.timedelta(hours=48)
            c = [(b["ts"], b["event_id"]) for b in buys if b["user_id"] == a["user_id"] and lo <= b["ts"] < hi]
            want[a["event_id"]] = min(c)[1] if c else None
        assert got == want
        assert any(x is not None for x in got.values())


def test_outcome_after_hot_key_repeated_instants(spark):
    """One key holds most rows, many at identical instants: sliced groups and
    collapsed instants give the brute-force answer (earliest, ties by id)."""
    t0 = dt.datetime(2024, 1, 1)
    snaps = [(f"s{i}", "hot", t0 + dt.timedelta(minutes=7 * (i % 40))) for i in range(200)]
    snaps += [("c1", "cold", t0)]
    outs = [(f"o{i:03d}", "hot", t0 + dt.timedelta(hours=24, minutes=5 * (i % 30))) for i in range(120)]
    outs += [("oc", "cold", t0 + dt.timedelta(hours=47, minutes=59))]
    v = spark.createDataFrame(snaps, "event_id string, user_id string, ts timestamp")
    p = spark.createDataFrame(outs, "event_id string, user_id string, ts timestamp")
    want = {}
    for e, u, t in snaps:
        c = [(b, oid) for oid, uu, b in outs if uu == u and t + dt.timedelta(hours=24) <= b < t + dt.timedelta(hours=48)]
        want[e] = min(c)[1] if c else None
    for hot in (O.HOT_GROUP_ROWS, 4):
        got = {r["event_id"]: r["out_event_id"] for r in
               O.outcome_after(v, p, "user_id", "ts", "ts", [], out_id="event_id", hot_rows=hot).collect()}
        assert got == want


def test_split_hot_spreads_crowded_group(spark):
    """A hot group whose instants crowd into one second of its hour is still
    cut into slices of about ``hot_rows``; slices are monotone in time and a
    cold group stays whole."""
    rows = [("hot", 0, 1000.0 + i / 2000.0) for i in range(1990)]
    rows += [("hot", 0, 1000.0 + 360.0 * i) for i in range(1, 11)]
    rows += [("cold", 0, 5.0 + i) for i in range(30)]
    u = spark.createDataFrame(rows, "k string, b int, t double")
    got = O._split_hot(u, ["k", "b"], "t", 50).collect()
    hot = sorted((r["t"], r["__sb"]) for r in got if r["k"] == "hot")
    assert all(a[1] <= b[1] for a, b in zip(hot, hot[1:]))          # monotone in t
    sizes = {}
    for _, sb in hot:
        sizes[sb] = sizes.get(sb, 0) + 1
    assert max(sizes.values()) <= 4 * 50
    assert {r["__sb"] for r in got if r["k"] == "cold"} == {0}


def test_sweep_equals_numpy(spark):
    rng = np.random.default_rng(3)
    s = np.round(rng.random(500), 3)
    y = (rng.random(500) < s).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    got = {round(r["thresh"], 6): r for r in EV.sweep(df, "s", "y").collect()}
    for t in EV.thresholds(0.05, 0.75, 0.005):
        pred = s >= t
        n_pred = pred.sum()
        prec = (y[pred].sum() / n_pred) if n_pred else 0.0
        nop = int(n_pred * 1e4 / len(s))
        r = got[round(t, 6)]
        assert r["precision"] == pytest.approx(prec) and r["number_of_predictions"] == nop
        assert r["recall"] == pytest.approx(y[pred].sum() / y.sum())


def test_smote_points_on_segments(spark):
    rows = []
    rnd = random.Random(5)
    for i in range(60):
        y = 1 if i < 12 else 0
        rows.append((i, y, [rnd.random() + (2.0 if y else 0.0) for _ in range(4)]))
    df = spark.createDataFrame(rows, "id long, y int, v array<double>")
    out = RS.smote(df, "v", "y", "id", ratio=0.5, k=3, seed=1)
    syn = out.where("synthetic").collect()
    assert len(syn) == int(0.5 * 48) - 12
    src = {r["id"]: np.array(r["v"]) for r in rows if r[1] == 1 for r in [dict(id=r[0], v=r[2])]}
    for r in syn:
        a, b, u = src[int(r["source_id"])], src[int(r["neighbour_id"])], r["u"]
        assert 0 <= u < 1
        assert np.allclose(np.array(r["v"]), a + u * (b - a))
        assert r["y"] == 1


def _brute_knn(pts, k):
    arr = {i: np.array(v, dtype=float) for i, v in pts}
    out = {}
    for i in arr:
        d = sorted((float(np.sqrt(((arr[i] - arr[j]) ** 2).sum())), j) for j in arr if j != i)
        out[i] = d[:k]
    return out


@pytest.mark.parametrize("n_pivots,block", [(None, 4096), (6, 7), (3, 5)])
def test_minority_neighbours_exact_vs_brute_force(spark, n_pivots, block):
    """Exact k nearest (ties by id) against a brute-force scan, with one cell
    and with several small cells and blocks (pruned pass 2, chunked cells)."""
    rnd = random.Random(2)
    pts = [(f"p{i:03d}", [rnd.random(), rnd.random(), rnd.random()]) for i in range(60)]
    pts += [(f"d{i}", [0.5, 0.5, 0.5]) for i in range(12)]        # a hot spot of duplicates
    df = spark.createDataFrame(pts, "id string, v array<double>")
    got = RS.minority_neighbours(df, "id", "v", k=4, n_pivots=n_pivots, block=block).collect()
    want = _brute_knn(pts, 4)
    assert len(got) == len(pts) * 4
    by = {}
    for r in got:
        by.setdefault(r["id"], []).append((r["nb_rank"], r["nb_id"], r["dist"]))
    for i, lst in by.items():
        lst.sort()
        assert [x[1] for x in lst] == [j for _, j in want[i]], i
        assert [x[2] for x in lst] == pytest.approx([d for d, _ in want[i]], abs=1e-12)


def test_vector_pca_share(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    m = TF.VectorPca("embedding", 0.8).fit(e)
    ev = list(m.parts["pca"].explainedVariance)
    assert sum(ev[: m.k]) >= 0.8 and (m.k == 1 or sum(ev[: m.k - 1]) < 0.8)
    assert TF.VectorPca("embedding", 1.0).fit(e).transform(e).columns == e.columns


def test_tfidf_vector_equals_long_form(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(50)
    est = TF.Tfidf("doc_id", "text", 20, stop=["the", "le", "de"])
    m, long = TF.fit_long(est, d)
    vec = m.transform(d).select("doc_id", "tfidf").collect()
    lf = {}
    for r in long.collect():
        lf.setdefault(r["doc_id"], {})[r["term"]] = r["weight"]
    for r in vec:
        dense = r["tfidf"].toArray()
        for i, t in enumerate(m.terms):
            assert dense[i] == pytest.approx(lf.get(r["doc_id"], {}).get(t, 0.0), abs=1e-9)


def test_models_run_and_score_in_unit_interval(spark, entry_mod):
    q = entry_mod.queries()
    bt = q["boosted_trees"](spark, SF_SMALL).collect()
    assert bt and all(0.0 <= r["score"] <= 1.0 for r in bt)
    fi = q["feature_importance"](spark, SF_SMALL).collect()
    assert sum(r["importance"] for r in fi) == pytest.approx(1.0)


def test_backward_selection_concurrent_equals_sequential(spark):
    """Concurrent (candidate, fold) fits pick the same feature at every step
    as one-at-a-time fits, and each step drops exactly one feature."""
    from rarecast.operators import models as MD
    rnd = random.Random(11)
    rows = []
    for i in range(120):
        a, b, c = rnd.random(), rnd.random(), rnd.random()
        rows.append((i, a, b, c, int(a + 0.3 * rnd.random() > 0.8), i % 2))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label int, fold int")

    def run(par):
        return [tuple(r) for r in MD.backward_select(
            df, ["a", "b", "c"], "label", "fold", 2,
            lambda f: MD.build_pipeline(f, MD.boosted_trees({"max_depth": 2, "n_estimators": 3})), parallelism=par).collect()]
    seq, conc = run(1), run(4)
    assert [r[:2] for r in seq] == [r[:2] for r in conc]
    assert [r[2] for r in seq] == pytest.approx([r[2] for r in conc])
    assert [r[0] for r in seq] == [3, 2, 1] and seq[0][1] == "None"


def test_chi_square_pvalue_rows(spark, entry_mod):
    r = entry_mod.queries()["chi_square_pvalue"](spark, SF_SMALL).collect()
    assert r and all(0.0 <= x["p_value_pos"] <= 1.0 for x in r)


def test_neighbour_block_takes_bounded_memory():
    """4096 x 4096 distances at once, with their temporaries, would take over 500 MB."""
    import tracemalloc

    import numpy as np
    import pandas as pd
    x = np.random.default_rng(5).random((4096, 8))
    ids = np.array([f"r{i:05d}" for i in range(len(x))], dtype=object)
    q, r = pd.DataFrame({"id": ids, "a": list(x)}), pd.DataFrame({"nb_id": ids, "b": list(x)})
    tracemalloc.start()
    got = RS._knn_block(3, q, r)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6 and len(got) == 3 * len(x)
    for i in (0, 255, 256, 4095):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        assert list(got[got.id == ids[i]].nb_id) == list(ids[np.argsort(d)[:3]])
