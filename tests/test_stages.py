"""Pipeline stages: parameters, files, samplers that act at fit only, folds that see no label of their test rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rarecast.operators import encoders as EN
from rarecast.operators import models as MD
from rarecast.operators import priors as PR
from rarecast.operators import textfeat as TF
from rarecast.operators.stages import DropColumns, PassThrough, SamplingPipeline


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(4)
    words = "red green blue fast slow new old big small".split()
    rows = []
    for i in range(240):
        y = float(rnd.random() < 0.15)
        rows.append((i, rnd.choice("abc"), rnd.choice(["x", "y"]), float(rnd.randrange(1, 400)), rnd.random() * 3 * (rnd.random() < 0.8),
                     rnd.randrange(10, 500) * 1.0, " ".join(rnd.choices(words, k=6)), [rnd.random() + y for _ in range(4)], y, i % 3))
    return spark.createDataFrame(rows, "id long, c string, b string, n double, rate double, age double, title string, "
                                       "vec array<double>, label double, fold int").cache()


def whole_pipeline(trees=3):
    return MD.build_pipeline(
        ["n", "b_y", "c", "priors_predict", "log_feature", "pca", "vec_pca"], MD.boosted_trees({"max_depth": 2, "n_estimators": trees}),
        new_features=EN.NewFeatures(["prior", "log_distance"], ["c"], ["n"], "label", rate="rate", age="age", weight=3.0),
        encoder=EN.MixedEncoder(["b"], ["c"], "label", weight=1.0), drop=["rate", "age", "not there"],
        text=TF.TfidfPca("id", "title", 6, 2), vectors=TF.VectorPca("vec", 0.8),
        over=MD.SmoteSampler("features", "label", "id", 0.4, seed=1), under=MD.UnderSampler("label", "id", 0.8, seed=2), pos_weight=2.0)


def test_all_stages_fit_save_and_load_with_equal_scores(spark, frame, tmp_path):
    train, test = frame.where("fold <> 0"), frame.where("fold = 0").drop("label")
    pipe = whole_pipeline()
    model = pipe.fit(train)
    want = {r.id: r.score for r in model.transform(test).collect()}
    assert len(want) == test.count()                                  # samplers drop and add nothing when scoring
    assert sum(isinstance(s, PassThrough) for s in model.stages) == 2
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert {r.id: r.score for r in again.transform(test).collect()} == pytest.approx(want)
    pipe.write().save(str(tmp_path / "pipe"))
    loaded = SamplingPipeline.load(str(tmp_path / "pipe"))
    assert [type(s) for s in loaded.getStages()] == [type(s) for s in pipe.getStages()]
    refit = loaded.fit(train)
    assert {r.id: r.score for r in refit.transform(test).collect()} == pytest.approx(want)


def test_samplers_change_training_rows_only(frame):
    pipe = whole_pipeline()
    rows = pipe.training_rows(frame).select("id", "label", F.size(vector_to_array("features")).alias("dim"), "weight").collect()
    pos, neg = frame.where("label = 1").count(), frame.where("label = 0").count()
    new = [r for r in rows if r.id < 0]
    assert len(new) == int(0.4 * neg) - pos > 0 and all(r.label == 1 and r.weight == 2.0 for r in new)
    assert len({r.dim for r in rows}) == 1
    assert sum(r.label == 0 for r in rows) == int((len(new) + pos) / 0.8)
    assert len({r.id for r in rows}) == len(rows)


def test_grid_reaches_every_stage_and_copies_do_not_share_values(frame):
    pipe = whole_pipeline()
    enc = MD.stage_of(pipe, EN.MixedEncoder)
    res = MD.grid_search(pipe, {(enc, "weight"): [0.0, 25.0], "max_depth": [1]}, frame, "fold", num_folds=3).collect()
    assert len(res) == 2 and {r["rank"] for r in res} <= {1, 2}
    assert all("weight=" in r["params"] and 0 <= r["mean_average_precision"] <= 1 for r in res)
    assert enc.value("weight") == 1.0
    assert pipe.copy({enc.getParam("weight"): 7.0}).getStages()[1].value("weight") == 7.0


def test_grid_prepares_the_rows_of_a_fold_once_for_all_classifiers(frame, monkeypatch):
    calls, real = [], MD.SmoteSampler.resample
    monkeypatch.setattr(MD.SmoteSampler, "resample", lambda self, df: calls.append(1) or real(self, df))
    pipe = MD.build_pipeline(["n", "c"], MD.boosted_trees({"max_depth": 1, "n_estimators": 1}),
                             encoder=EN.MixedEncoder([], ["c"], "label"), over=MD.SmoteSampler("features", "label", "id", 0.4, seed=1))
    res = MD.grid_search(pipe, {(MD.stage_of(pipe, EN.MixedEncoder), "weight"): [0.0, 9.0], "max_depth": [1, 2]}, frame, "fold", num_folds=3)
    assert len(calls) == 2 * 3
    alone = pipe.copy({pipe.getStages()[-2].maxDepth: 2, MD.stage_of(pipe, EN.MixedEncoder).weight: 9.0})
    scores = [MD._fold_score(frame, alone, "fold", "label", f) for f in range(3)]
    got = {r.params: (r.mean_average_precision, r.std_average_precision) for r in res.collect()}
    assert len(got) == 4 and got["maxDepth=2, weight=9.0"] == pytest.approx(MD._mean_std(scores))
    with pytest.raises(ValueError):
        MD.grid_search(pipe, {"max_depth": [1]}, frame, "fold", num_folds=2)


def test_later_stages_are_fitted_on_written_columns(spark, frame):
    """Texts are not tokenised again for the scaler, the samplers and the trees."""
    pipe = whole_pipeline()
    rows, fitted = pipe._run(frame, 5, onward=True)
    assert rows.columns == ["id", "label", "n", "b_y", "c", "priors_predict", "log_feature", "pca", "vec_pca"]
    assert "regexp_extract_all" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert "title" in PipelineModel(fitted).transform(frame).columns


def test_no_label_of_a_test_fold_reaches_its_training(spark):
    """One category per row: target means learned outside the fold would give every label away."""
    rnd = random.Random(9)
    df = spark.createDataFrame([(i, f"k{i}", float(rnd.random() < 0.3), i % 4) for i in range(160)], "id long, k string, label double, fold int")
    pipe = MD.build_pipeline(["k"], MD.boosted_trees({"max_depth": 2, "n_estimators": 3}), encoder=EN.MixedEncoder([], ["k"], "label"))
    mean = MD.grid_search(pipe, {"max_depth": [2]}, df, "fold", num_folds=4).first()["mean_average_precision"]
    assert mean < 0.5                                     # chance, not 1.0


def test_backward_selection_logs_the_full_set_first(frame):
    log = MD.backward_select(frame.select("id", "label", "fold", "n", "age", "rate"), ["n", "age", "rate"], "label", "fold", 2,
                             lambda f: MD.build_pipeline(f, MD.boosted_trees({"max_depth": 2, "n_estimators": 2}))).collect()
    assert [r.n_features for r in log] == [3, 2, 1] and log[0].dropped == "None"


def test_one_hot_vectors_for_100_000_categories(spark, tmp_path):
    df = spark.range(100_000).select("id", F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 2).cast("string").alias("b"))
    m = EN.OneHot(["k", "b"], layout="vector").fit(df)
    m.write().save(str(tmp_path / "m"))
    m = EN.OneHotModel.load(str(tmp_path / "m"))
    extra = spark.createDataFrame([(-1, "unseen", None), (-2, None, "1")], "id long, k string, b string")
    out = m.transform(df.unionByName(extra))
    slots = TF._sparse(out, "k_vec", ["id"])
    assert slots.count() == slots.select("index").distinct().count() == 100_000 and slots.where("id < 0").count() == 0
    assert slots.agg(F.max("index")).first()[0] == 99_999 and slots.where("value <> 1").count() == 0
    ones = TF._sparse(out, "b_vec", ["id"])
    assert ones.where("index = 0").count() == ones.count() == 50_001
    with pytest.raises(ValueError):
        EN.OneHot(["k"]).fit(df)


def test_prior_entries_and_grid_for_large_domains(spark):
    t = spark.range(30_000).select((F.col("id") % 15_000).alias("a"), (F.col("id") % 7).cast("string").alias("b"), F.lit(0.5).alias("f"))
    e = PR.prior_entries(t, "a", "b", "f")
    assert e.agg(F.max("row"), F.max("col")).first()[:] == (14_999, 6)
    g = PR.complete_grid(t.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), ["a", "b"])
    assert g.count() == 15_000 * 7 and g.agg(F.sum("n")).first()[0] == 30_000


def test_grid_enumerates_in_parallel(spark):
    t = spark.createDataFrame([("a", 1, 2), (None, 2, 5)], "k string, b int, n int")
    g = PR.complete_grid(t, ["k", "b"])
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Range (0, 4" in plan
    assert {(r.k, r.b, r.n) for r in g.collect()} == {("a", 1, 2), ("a", 2, 0), (None, 1, 0), (None, 2, 5)}


def test_prior_scoring_builds_no_grid(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 1), ("a", "y", 2.0, 0), ("b", "x", 3.0, 0)], "k string, j string, v double, y int")
    m = PR.Priors(["k", "j"], [], "y").fit(df)
    asked = spark.createDataFrame([("a", "x", 1.0, 0), ("b", "y", 1.0, 0), ("c", "x", 1.0, 0)], df.schema)
    out = m.transform(asked)
    assert "Range" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r.j): (r.prior_p, r.prior_missing) for r in out.collect()} == {
        ("a", "x"): (1.0, False), ("b", "y"): (0.0, False), ("c", "x"): (0.0, True)}


def test_drop_columns_stage(frame):
    assert DropColumns(["n", "nothing"]).transform(frame).columns == [c for c in frame.columns if c != "n"]


def test_tfidf_pca_equals_numpy(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(12)]
    df = spark.createDataFrame([(i, " ".join(rnd.choices(words, k=9))) for i in range(80)], "id long, t string")
    m = TF.TfidfPca("id", "t", 12, 12).fit(df)
    x = np.array([r[1].toArray() for r in m.parts["tfidf"].transform(df).select("id", "__v").orderBy("id").collect()])
    z = (x - x.mean(0)) / x.std(0)
    got = np.array([r[1].toArray() for r in m.transform(df).select("id", "pca").orderBy("id").collect()])
    assert np.allclose(got.mean(0), 0, atol=1e-9)
    want = np.sort(np.linalg.eigvalsh(z.T @ z / len(z)))[::-1]
    assert np.allclose(got.var(0), want, atol=1e-8) and got.var(0).sum() == pytest.approx(12)
    assert np.allclose(np.array(m.explained_variance), want / want.sum(), atol=1e-8)
    assert TF.TfidfPca("id", "t", 0, 3).fit(df).transform(df).columns == df.columns
    assert "pca" in TF.TfidfPca("id", "t", 5, 0).fit(df).transform(df).columns


@pytest.mark.parametrize("k,n_comp", [(12, 3), (12, 0), (0, 3)])
def test_fitting_and_transforming_the_same_rows_tokenises_for_the_fit_only(spark, k, n_comp):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    df = spark.createDataFrame([(i // 2, " ".join(rnd.choices(words, k=rnd.randrange(12)))) for i in range(60)], "id long, t string")
    est = TF.TfidfPca("id", "t", k, n_comp)
    model, rows = est.fit_rows(df, ["id"])
    assert "regexp_extract_all" not in rows._jdf.queryExecution().optimizedPlan().toString()
    want = est.fit(df).transform(df).drop("t")
    assert rows.columns == want.columns
    got = [sorted([r.id, *([] if k == 0 else (r.pca.toArray().round(9) + 0.0).tolist())] for r in d.collect()) for d in (rows, want)]
    assert np.allclose(got[0], got[1])


def test_projection_takes_bounded_memory():
    """As many components as terms: a row for each entry of each text and its loadings would take 1.6 GB here."""
    import tracemalloc
    rng = np.random.default_rng(3)
    index = pd.Series([np.sort(rng.choice(1000, 200, replace=False)) for _ in range(999)] + [np.array([], int)])
    value = pd.Series([rng.random(len(i)) for i in index])
    loadings, centre = rng.random((1000, 1000)), rng.random(1000)
    got = []
    tracemalloc.start()
    for block in TF._projected(index, value, loadings, centre):
        got += [r[::250] for r in block]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    want = [x @ loadings[i] - centre for i, x in zip(index, value)]
    assert np.allclose(np.array(got), np.array(want)[:, ::250])


def test_stemmer_reaches_the_fitted_vocabulary(spark):
    df = spark.createDataFrame([(1, "cats cat dogs"), (2, "dog cats")], "id long, t string")
    m = TF.Tfidf("id", "t", 5, stem=lambda w: w.rstrip("s")).fit(df)
    assert m.terms == ["cat", "dog"]
    assert {(r.id, r.term) for r in m.long(df).collect()} == {(1, "cat"), (1, "dog"), (2, "cat"), (2, "dog")}


@pytest.mark.parametrize("tracked,most", [(None, None), (4, 10_000), (4, 4)])
def test_vocabulary_is_exact_however_small_the_sketch(spark, monkeypatch, tracked, most):
    """Whole sketch, sketch that must widen, and terms counted in full."""
    import collections
    rnd = random.Random(6)
    texts = [[f"t{int(rnd.paretovariate(0.7)) % 900}" for _ in range(rnd.randrange(0, 60))] for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "__terms array<string>")
    if tracked:
        monkeypatch.setattr(TF, "TRACKED", tracked)
        monkeypatch.setattr(TF, "MOST_TRACKED", most)
        real = TF.candidates
        monkeypatch.setattr(TF, "candidates", lambda d, k, n, *a: real(d, k, n if n < 16 * k else tracked, *a))
    count = collections.Counter(t for ts in texts for t in ts)
    df_of = collections.Counter(t for ts in texts for t in set(ts))
    for k in (2, 25):
        want = sorted(((t, c, df_of[t]) for t, c in count.items()), key=lambda x: (-x[1], x[0]))[:k]
        assert sorted(tuple(r) for r in TF.vocabulary(df, k).collect()) == sorted(want)
    assert TF.vocabulary(df.limit(0), 5).collect() == []
