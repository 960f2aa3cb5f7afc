"""Registered queries: models and selection.  Trained models have no SQL form, so their scores are
rows-only; ``resampled_training`` checks in SQL which rows the pipeline's samplers train on, and pytest
checks the invariants (scores of a saved and reloaded pipeline, folds that see no label of their test rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encoders as EN
from ..operators import models as MD
from ..operators import resample as RS
from ..operators import textfeat as TF
from ..operators.stages import SamplingPipeline
from ..util import kept_table
from .fixtures import DOCS_SQL, docs_labeled, round_doubles, table
from .q_text import QUERY_STOP
from .registry import register

PARAMS = {"max_depth": 3, "eta": 0.25, "n_estimators": 50}
SEARCH_PARAMS = {"max_depth": 3, "eta": 0.25, "n_estimators": 10}
FOLDS = 5
TEXT_TERMS, TEXT_COMPONENTS = 1000, 10
CATEGORIES = ["lang", "source"]
FEATURES = ["n_chars", "quality_1", *CATEGORIES, "priors_predict", "log_feature", "pca", "vec_pca"]


def _frame(spark, sf, text: bool = False):
    """Labelled documents with title vector: split, folds, and a rate and an age for the log distance; ``text`` too, where
    a stage reads it."""
    d = docs_labeled(spark, sf).select(
        "doc_id", "n_chars", "quality", "lang", "source", "text", F.col("toxic").cast("double").alias("label"),
        (F.length("text") - F.length(F.translate("text", "\n", ""))).cast("double").alias("lines"),
        (F.col("n_chars") + 1.0).alias("age"))
    d = d if text else d.drop("text")
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    d = TF.join_vectors(d, e, "doc_id", "vec_id")
    d = RS.split(d, "label", "doc_id", 0.1666, seed=2)
    return kept_table(RS.folds(d, "label", "doc_id", FOLDS, seed=0), "model-frame")       # read by every fit


def _pipeline(ratio: float, params: dict, terms: int = TEXT_TERMS, share: float = 0.8) -> SamplingPipeline:
    return MD.build_pipeline(
        [c for c in FEATURES if terms or c != "pca"], MD.boosted_trees(params),
        new_features=EN.NewFeatures(["prior", "log_distance"], CATEGORIES, ["n_chars"], "label", rate="lines", age="age", weight=3.0),
        encoder=EN.MixedEncoder(["quality"], CATEGORIES, "label", weight=1.0), drop=["lines", "age"],
        text=TF.TfidfPca("doc_id", "text", terms, TEXT_COMPONENTS, stop=QUERY_STOP),
        vectors=TF.VectorPca("embedding", share, as_vector=True),
        over=MD.SmoteSampler("features", "label", "doc_id", ratio * 1.01, seed=1),
        under=MD.UnderSampler("label", "doc_id", ratio * 2.01, seed=3), pos_weight=2.0)


def _ratio(train) -> float:
    return RS.imbalance(train, "label").first()["ratio"]


def _plain(features: list[str], params: dict) -> SamplingPipeline:
    """Target means inside the estimator, then trees."""
    cats = [c for c in CATEGORIES if c in features]
    return MD.build_pipeline(features, MD.boosted_trees(params), pos_weight=2.0,
                             encoder=EN.MixedEncoder([], cats, "label", weight=1.0) if cats else None)


@register("boosted_trees")
def boosted_trees(spark, sf):
    d = _frame(spark, sf)
    model = _plain(["n_chars", "quality", *CATEGORIES], PARAMS).fit(d.where("split = 'train'"))
    return model.transform(d.where("split = 'test'")).select("doc_id", "label", "score")


@register("feature_pipeline")
def feature_pipeline(spark, sf):
    """New features, encoders, drops, text, vectors, scaler, over- and undersampling, trees as one pipeline."""
    d = _frame(spark, sf, text=True)
    train = d.where("split = 'train'")
    model = _pipeline(_ratio(train), PARAMS).fit(train)
    return model.transform(d.where("split = 'test'")).select("doc_id", "label", "score")


@register("resampled_training", f"""
WITH r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR) || '|2')) AS r,
             count(*) OVER (PARTITION BY toxic) AS n FROM {DOCS_SQL} JOIN embeddings e ON e.vec_id = doc_id),
train AS (SELECT doc_id, toxic FROM r WHERE r > floor(0.1666::DOUBLE * n + 0.5)),
c AS (SELECT sum(toxic) AS p, sum(1 - toxic) AS q, sum(toxic) / sum(1 - toxic) AS ratio FROM train),
m AS (SELECT greatest(p, floor(ratio * 1.01 * q)) AS minority FROM c),
u AS (SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '|3')) AS r FROM train WHERE toxic = 0)
SELECT doc_id, 0::DOUBLE AS label FROM u WHERE r <= floor((SELECT minority FROM m) / ((SELECT ratio FROM c) * 2.01))
UNION ALL SELECT doc_id, 1 FROM train WHERE toxic = 1
UNION ALL SELECT -(j + 1), 1 FROM range((SELECT CAST(minority - p AS BIGINT) FROM m, c)) t(j)""")
def resampled_training(spark, sf):
    """The rows the feature pipeline's samplers hand to its classifier."""
    d = _frame(spark, sf).where("split = 'train'")
    pipe = _pipeline(_ratio(d), PARAMS, terms=0)
    return pipe.training_rows(d).select("doc_id", "label")


@register("grid_search_cv")
def grid_search_cv(spark, sf):
    """Parameters of the encoder, the new features and the booster, each combination fitted as a whole pipeline in
    every fold."""
    d = _frame(spark, sf).where("split = 'train'")
    pipe = _pipeline(_ratio(d), SEARCH_PARAMS, terms=0)
    grid = {"gamma": [0.0, 0.01], (MD.stage_of(pipe, EN.MixedEncoder), "weight"): [0.0, 10.0]}
    return MD.grid_search(pipe, grid, d, "fold", "label", num_folds=FOLDS)


@register("backward_selection")
def backward_selection(spark, sf):
    d = _frame(spark, sf).where("split = 'train'")
    return MD.backward_select(d.select("doc_id", "label", "fold", "n_chars", "quality", *CATEGORIES),
                              ["n_chars", "quality", *CATEGORIES], "label", "fold", FOLDS,
                              lambda features: _plain(features, SEARCH_PARAMS), min_features=1)


@register("feature_importance")
def feature_importance(spark, sf):
    d = _frame(spark, sf)
    names = ["n_chars", "quality", *CATEGORIES]
    model = _plain(names, PARAMS).fit(d.where("split = 'train'"))
    return MD.importance(MD.classifier_of(model), names, 15)


@register("one_hot_vector", f"""
SELECT doc_id, feature, CAST(number AS INTEGER) AS number FROM (
  SELECT doc_id, 'source' AS feature, rs AS number FROM (SELECT doc_id, dense_rank() OVER (ORDER BY source) - 1 AS rs FROM {DOCS_SQL})
  UNION ALL SELECT doc_id, 'doc', row_number() OVER (ORDER BY CAST(doc_id AS VARCHAR)) - 1 FROM {DOCS_SQL}
  UNION ALL SELECT doc_id, 'quality', 0 FROM {DOCS_SQL} WHERE quality = 1)""")
def one_hot_vector(spark, sf):
    """Sparse one-hot of a binary, a small and a key-sized column: the position of each row's one."""
    from ..operators.textfeat import _sparse
    d = docs_labeled(spark, sf).select("doc_id", "quality", "source", F.col("doc_id").alias("doc"))
    out = EN.OneHot(["quality", "source", "doc"], layout="vector").fit(d).transform(d)
    rows = [_sparse(out, f"{c}_vec", ["doc_id"]).select("doc_id", F.lit(c).alias("feature"), F.col("index").alias("number"))
            for c in ("quality", "source", "doc")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
