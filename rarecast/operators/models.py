"""Models and selection on Spark ML: boosted trees with positive-class
weights, the whole feature pipeline, grid search with k-fold cross-validation
scored by average precision, backward feature elimination and importances.

Training runs distributed inside Spark ML; the driver only loops over
parameter maps and candidate feature sets (as many iterations as the search
asks for, each a distributed fit).  Encoders, scaler and resampling are stages of
the pipeline that each fold fits, so no label of a fold's test rows reaches its training."""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encoders import MixedEncoder, NewFeatures
from .evaluate import areas
from .resample import smote, undersample
from .stages import (Configured, DropColumns, FitColumns, Sampler, SamplingPipeline, param, params_before, to_bool, to_float,
                     to_int, to_str)
from .textfeat import TfidfPca, VectorPca

# Booster parameter names -> Spark GBT parameters (the rest have no counterpart).
PARAM_MAP = {"eta": "stepSize", "max_depth": "maxDepth", "gamma": "minInfoGain",
             "min_child_weight": "minInstancesPerNode", "subsample": "subsamplingRate",
             "n_estimators": "maxIter"}


class PositiveScore(Configured, Transformer):
    """Adds ``out`` = probability of class 1 from a probability vector."""
    prob = param("prob", "probability vector", to_str)
    out = param("out", "new column", to_str)

    def __init__(self, prob: str | None = None, out: str | None = None):
        super().__init__()
        self._setDefault(prob="probability", out="score")
        self._given(prob=prob, out=out)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.value("out"), vector_to_array(self.value("prob"))[1])


class PositiveWeight(Configured, Transformer):
    """Adds the row weight: ``weight`` for positives, 1 for others and for rows without the label (the
    booster's scale_pos_weight)."""
    label = param("label", "0/1 label", to_str)
    weight = param("weight", "weight of a positive row", to_float)
    out = param("out", "new column", to_str)

    def __init__(self, label: str | None = None, weight: float | None = None, out: str | None = None):
        super().__init__()
        self._setDefault(label="label", weight=1.0, out="weight")
        self._given(label=label, weight=weight, out=out)

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.value("label") not in df.columns:
            return df.withColumn(self.value("out"), F.lit(1.0))
        return with_weight(df, self.value("label"), self.value("weight"), self.value("out"))


class UnderSampler(Sampler):
    """While fitting: minority / majority = ``ratio`` by leaving majority rows out."""
    label = param("label", "0/1 label", to_str)
    id_col = param("id_col", "row id", to_str)
    ratio = param("ratio", "minority / majority", to_float)
    seed = param("seed", "seed of the draw", to_int)

    def __init__(self, label: str | None = None, id_col: str | None = None, ratio: float | None = None, seed: int | None = None):
        super().__init__()
        self._setDefault(label="label", ratio=1.0, seed=0)
        self._given(label=label, id_col=id_col, ratio=ratio, seed=seed)

    def resample(self, df: DataFrame) -> DataFrame:
        return undersample(df, self.value("label"), self.value("id_col"), self.value("ratio"), self.value("seed"))


class SmoteSampler(Sampler):
    """While fitting: minority / majority = ``ratio`` by synthetic rows between near minority rows.  A synthetic row
    has the vector, the label and an id of its own (-1, -2, ... or ``syn_0``, ...); its other columns are null."""
    vec = param("vec", "vector column", to_str)
    label = param("label", "0/1 label", to_str)
    id_col = param("id_col", "row id", to_str)
    ratio = param("ratio", "minority / majority", to_float)
    k = param("k", "nearest minority rows drawn from", to_int)
    seed = param("seed", "seed of the draws", to_int)
    approximate = param("approximate", "whether neighbours come from projection trees", to_bool)

    def __init__(self, vec: str | None = None, label: str | None = None, id_col: str | None = None,
                 ratio: float | None = None, k: int | None = None, seed: int | None = None, approximate: bool | None = None):
        super().__init__()
        self._setDefault(vec="features", label="label", ratio=1.0, k=5, seed=0, approximate=False)
        self._given(vec=vec, label=label, id_col=id_col, ratio=ratio, k=k, seed=seed, approximate=approximate)

    def resample(self, df: DataFrame) -> DataFrame:
        vec, key = self.value("vec"), self.value("id_col")
        out = smote(df.withColumn(vec, vector_to_array(vec)), vec, self.value("label"), key, self.value("ratio"),
                    self.value("k"), self.value("seed"), approximate=self.value("approximate"))
        if "synthetic_id" in out.columns:
            kind = df.schema[key].dataType
            new = F.col("synthetic_id")
            if isinstance(kind, T.NumericType):
                new = -1 - F.regexp_extract("synthetic_id", r"(\d+)$", 1).cast("long")
            out = out.withColumn(key, F.when(F.col("synthetic"), new.cast(kind)).otherwise(F.col(key)))
        return out.withColumn(vec, array_to_vector(vec)).select(*df.columns)


class AveragePrecision(Evaluator):
    """Average precision (step sum) of ``probability[1]`` against the label,
    computed with the distributed curve code."""

    def __init__(self, label: str = "label", prob: str = "probability"):
        super().__init__()
        self.label, self.prob = label, prob

    def _evaluate(self, df: DataFrame) -> float:
        s = df.select(vector_to_array(self.prob)[1].alias("__s"), F.col(self.label).cast("int").alias("__y"))
        v = areas(s, "__s", "__y").first()["average_precision"]
        return float(v) if v is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True


def with_weight(df: DataFrame, label: str, pos_weight: float, out: str = "weight") -> DataFrame:
    """Row weight: ``pos_weight`` for positives, 1 otherwise (the booster's
    scale_pos_weight)."""
    return df.withColumn(out, F.when(F.col(label).cast("int") == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))


def boosted_trees(params: dict | None = None, label: str = "label", features: str = "features",
                  weight: str | None = "weight", seed: int = 0) -> GBTClassifier:
    """A GBT classifier from booster-style parameters."""
    gbt = GBTClassifier(labelCol=label, featuresCol=features, seed=seed)
    if weight:
        gbt.setWeightCol(weight)
    for k, v in (params or {}).items():
        name = PARAM_MAP.get(k, k)
        if gbt.hasParam(name):
            gbt.set(gbt.getParam(name), v)
    return gbt


def build_pipeline(numeric: list[str], classifier, *, new_features: NewFeatures | None = None,
                   encoder: MixedEncoder | None = None, drop: list[str] = (), text: TfidfPca | None = None,
                   vectors: VectorPca | None = None, over: SmoteSampler | None = None, under: UnderSampler | None = None,
                   pos_weight: float = 1.0, label: str = "label") -> SamplingPipeline:
    """new features -> encode -> drop -> text -> vectors -> assemble and scale -> over- and undersample (while fitting)
    -> weigh -> classify -> score, as one pipeline.  ``numeric`` names the columns and vectors that are assembled.  With
    text, vectors or samplers the columns to assemble are written once while fitting: no later stage computes them anew."""
    stages = [x for x in (new_features, encoder, DropColumns(list(drop)) if drop else None, text, vectors) if x is not None]
    if any(x is not None for x in (text, vectors, over, under)):
        ids = [x.value("id_col") for x in (over, under) if x is not None]
        stages.append(FitColumns(list(dict.fromkeys([*ids, label, *numeric]))))
    stages += [VectorAssembler(inputCols=list(numeric), outputCol="assembled", handleInvalid="keep"),
               StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True)]
    stages += [x for x in (over, under) if x is not None]
    return SamplingPipeline(stages=[*stages, PositiveWeight(label, pos_weight), classifier, PositiveScore()])


def stage_of(pipe, kind: type):
    """The stage of a pipeline that is a ``kind``."""
    return next(s for s in pipe.getStages() if isinstance(s, kind))


def classifier_of(model):
    """The fitted classifier of a fitted pipeline."""
    return next(s for s in reversed(model.stages) if hasattr(s, "featureImportances"))


def grid_search(pipe, grid: dict, df: DataFrame, fold_col: str, label: str = "label",
                num_folds: int = 5, parallelism: int = 4) -> DataFrame:
    """Every parameter combination x the folds of ``fold_col`` (0 to ``num_folds`` - 1); returns one
    row per combination with mean / std average precision and rank.  Keys of ``grid`` are ``(stage, name)`` for any
    stage of the pipeline, or a booster name for its classifier.  ``df`` is read by every fit, so it should be a written
    table.  Combinations that differ in the classifier only share a fold's prepared rows; up to ``parallelism`` (fold,
    preparation) pairs run as concurrent Spark jobs."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.util import inheritable_thread_target
    builder = ParamGridBuilder()
    classifier = [s for s in pipe.getStages() if isinstance(s, Estimator)][-1]
    for key, values in grid.items():
        stage, name = key if isinstance(key, tuple) else (classifier, key)
        builder = builder.addGrid(stage.getParam(PARAM_MAP.get(name, name)), values)
    maps = builder.build()
    sizes = {r[0]: r[1] for r in df.groupBy(fold_col).count().collect()}
    if set(sizes) - set(range(num_folds)):
        raise ValueError(f"folds must be 0 to {num_folds - 1}")
    if num_folds < 2 or len(sizes) < num_folds:
        raise ValueError("a fold has no training or no test rows")
    alike = {}                                           # maps that differ in the classifier only
    for i, m in enumerate(maps):
        alike.setdefault(params_before(classifier, m), []).append(i)

    def job(f: int, group: list[int]) -> list[tuple[int, float]]:
        models = pipe.fit_maps(df.where(F.col(fold_col) != f), [maps[i] for i in group])
        test = df.where(F.col(fold_col) == f)
        return [(i, AveragePrecision(label).evaluate(model.transform(test))) for i, model in zip(group, models)]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        run = inheritable_thread_target(df.sparkSession)(lambda t: job(*t))
        found = [x for part in pool.map(run, [(f, g) for f in range(num_folds) for g in alike.values()]) for x in part]
    rows = []
    for i, m in enumerate(maps):
        mean, std = _mean_std([v for j, v in found if j == i])
        rows.append((", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)), mean, std))
    spark = df.sparkSession
    res = spark.createDataFrame(rows, "params string, mean_average_precision double, std_average_precision double")
    return res.withColumn("rank", F.rank().over(Window.orderBy(F.col("mean_average_precision").desc())))


def _fold_score(df: DataFrame, estimator, fold_col: str, label: str, f: int) -> float:
    train = df.where(F.col(fold_col) != f)
    test = df.where(F.col(fold_col) == f)
    return AveragePrecision(label).evaluate(estimator.fit(train).transform(test))


def _mean_std(scores: list[float]) -> tuple[float, float]:
    mean = sum(scores) / len(scores)
    return mean, math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))


def backward_select(df: DataFrame, features: list[str], label: str, fold_col: str, k: int,
                    pipeline_of, min_features: int = 1, parallelism: int = 4) -> DataFrame:
    """Drop, at each step, the feature whose removal scores best (mean average
    precision over the folds), down to ``min_features``.  ``pipeline_of(features)`` gives the estimator for a
    feature set; each (candidate, fold) fits its own on the fold's training rows.  Returns the log, the set of all
    features first: n_features, dropped ('None' there), scores_mean, scores_std.  The fits of a step are independent:
    up to ``parallelism`` run as concurrent Spark jobs (as ``CrossValidator`` does); the best is then taken in
    candidate order, so the result does not depend on it."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.util import inheritable_thread_target
    base = df.persist()
    current, log = list(features), []

    def job(kept: list[str], f: int) -> float:
        return _fold_score(base, pipeline_of(kept), fold_col, label, f)

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            run = inheritable_thread_target(df.sparkSession)(lambda t: job(*t))
            candidates = [(None, current)]               # the set of all features, then each set short of one
            while True:
                scores = list(pool.map(run, [(kept, f) for _, kept in candidates for f in range(k)]))
                best = (-math.inf, None, None, None)     # start below any score
                for i, (dropped, kept) in enumerate(candidates):
                    mean, std = _mean_std(scores[i * k:(i + 1) * k])
                    if mean > best[0]:
                        best = (mean, dropped, std, kept)
                current = list(best[3])
                log.append((len(current), best[1] or "None", best[0], best[2]))
                if len(current) <= min_features:
                    break
                candidates = [(c, [x for x in current if x != c]) for c in current]
    finally:
        base.unpersist()
    return df.sparkSession.createDataFrame(
        log, "n_features int, dropped string, scores_mean double, scores_std double")


def importance(model, names: list[str], n: int = 15) -> DataFrame:
    """Feature importances with names, largest first, top ``n``."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray()
    rows = sorted(zip(names, [float(x) for x in imp]), key=lambda t: (-t[1], t[0]))[:n]
    return spark.createDataFrame(rows, "feature string, importance double")
