"""Encoders and engineered features: target means (optionally smoothed),
one-hot, their combination, the prior feature, log-distance and scaling.

All are pipeline stages with real parameters (see ``stages``), so they are fitted inside each fold, reached by a
parameter grid and saved with the pipeline.  Target means for many columns are learned in one pass: the columns are
``unpivot``-ed to (feature, value, label) rows and grouped once (partial aggregation map-side).  Lookups are joins
against the fitted table, a file of known size, which the planner broadcasts while it is small."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Params
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..util import attach_one_row, dense_number, kept_table
from .stages import Configured, FittedModel, param, to_float, to_list, to_str

_NULL_KEY = "\u0000null"  # nulls form their own category

# Largest number of categories for which one-hot makes a column each; above it, ask for vectors.
MAX_COLUMNS = 10_000


def _key(c: str):
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(_NULL_KEY))


class _TargetMeansParams(Params):
    cols = param("cols", "columns to encode", to_list)
    label = param("label", "0/1 label", to_str)
    weight = param("weight", "rows that the overall mean counts as", to_float)


class TargetMeans(_TargetMeansParams, Configured, Estimator):
    """category -> mean label; with ``weight`` w > 0 the smoothed
    (n * mean + w * overall) / (n + w).  A category unseen at fit gets the
    overall mean."""

    def __init__(self, cols: list[str] | None = None, label: str | None = None, weight: float | None = None):
        super().__init__()
        self._setDefault(weight=0.0)
        self._given(cols=cols, label=label, weight=weight)

    def _fit(self, df: DataFrame) -> "TargetMeansModel":
        cols = self.value("cols")
        y = F.col(self.value("label")).cast("double")
        long = df.select(y.alias("__y"), *[_key(c).alias(c) for c in cols]) \
            .unpivot(["__y"], cols, "feature", "value")
        stats = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.avg("__y").alias("mean"),
                                                     F.sum("__y").alias("__s"), F.count("__y").alias("__c"))
        # overall mean from the first feature's cells (each row once): no second pass over df
        overall = stats.where(F.col("feature") == F.lit(cols[0])).agg(
            (F.sum("__s") / F.sum("__c")).alias("__overall"))
        s = attach_one_row(stats, overall)
        w = F.lit(self.value("weight"))
        enc = (F.col("n") * F.col("mean") + w * F.col("__overall")) / (F.col("n") + w)
        table = kept_table(s.select("feature", "value", "n", enc.alias("encoding"), "__overall"), "target-means")
        first = table.select("__overall").first()
        return TargetMeansModel(self, {"overall": first[0] if first else None}, {"means": table.drop("__overall")})


class TargetMeansModel(_TargetMeansParams, FittedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        out, overall = df, F.lit(self.state["overall"]).cast("double")
        for c in self.value("cols"):
            t = self.tables["means"].where(F.col("feature") == c).select(F.col("value").alias("__v"),
                                                                         F.col("encoding").alias("__e"))
            out = (out.withColumn("__v", _key(c))
                   .join(t, "__v", "left")
                   .withColumn(c, F.coalesce(F.col("__e"), overall))
                   .drop("__v", "__e"))
        return out


class _OneHotParams(Params):
    cols = param("cols", "columns to encode", to_list)
    layout = param("layout", "'columns': an integer column for each category; 'vector': one sparse vector a column", to_str)


class OneHot(_OneHotParams, Configured, Estimator):
    """One-hot of the sorted categories of each column; of exactly two categories only the second is
    kept (``drop='if_binary'``); nulls and categories unseen at fit are all zeros.

    ``layout='columns'`` replaces the column by integer columns ``<col>_<value>`` (column names, so the categories
    come to the driver, ``MAX_COLUMNS`` at most).  ``layout='vector'`` replaces it by one sparse vector
    ``<col>_vec`` for any number of categories: they are numbered on the executors and looked up by a join."""

    def __init__(self, cols: list[str] | None = None, layout: str | None = None):
        super().__init__()
        self._setDefault(layout="columns")
        self._given(cols=cols, layout=layout)

    def _fit(self, df: DataFrame) -> "OneHotModel":
        cols = self.value("cols")
        found = (df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot([], cols, "feature", "value")
                 .where(F.col("value").isNotNull()).distinct())
        table, sizes = numbered_within(found, "feature", "value", "one-hot")
        sizes = {c: sizes.get(c, 0) for c in cols}
        binary = [c for c in cols if sizes[c] == 2]
        if binary:          # of two categories the second alone, as number 0
            table = table.withColumn("number", F.col("number") - F.col("feature").isin(binary).cast("long")).where("number >= 0")
            sizes |= dict.fromkeys(binary, 1)
        if self.value("layout") == "columns":
            big = [c for c in cols if sizes[c] > MAX_COLUMNS]
            if big:
                raise ValueError(f"{big}: more than {MAX_COLUMNS} categories for a column each; use layout='vector'")
            names = {c: [] for c in cols}
            for r in table.orderBy("feature", "number").collect():
                names[r["feature"]].append(r["value"])
            return OneHotModel(self, {"sizes": sizes, "names": names})
        return OneHotModel(self, {"sizes": sizes}, {"numbers": table})


def numbered_within(pairs: DataFrame, group: str, value: str, name: str) -> tuple[DataFrame, dict]:
    """Distinct (group, value) rows with ``number``, the value's place (from 0) in its group, and the groups'
    sizes.  No group is sorted in one task; the groups are few (columns)."""
    t = dense_number(pairs, [group, value], "place", name)
    bounds = {r[0]: (r[1], r[2]) for r in t.groupBy(group).agg(F.min("place"), F.count(F.lit(1))).collect()}
    start = F.lit(0).cast("long")
    for g, (low, _) in bounds.items():
        start = F.when(F.col(group) == g, F.lit(low)).otherwise(start)
    return t.select(group, value, (F.col("place") - start).alias("number")), {g: n for g, (_, n) in bounds.items()}


class OneHotModel(_OneHotParams, FittedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        cols, sizes = self.value("cols"), self.state["sizes"]
        if self.value("layout") == "columns":
            new = {f"{c}_{v}": F.coalesce((F.col(f"`{c}`").cast("string") == F.lit(v)).cast("int"), F.lit(0))
                   for c, vals in self.state["names"].items() for v in vals}
            return df.withColumns(new).drop(*cols)
        out = df
        for c in cols:
            n = sizes[c]
            t = self.tables["numbers"].where(F.col("feature") == c).select(F.col("value").alias("__v"), F.col("number").alias("__n"))
            slot = F.coalesce(F.col("__n"), F.lit(n)).cast("double")          # slot n: none of the categories
            meta = {"ml_attr": {"type": "nominal", "name": f"{c}_slot", "num_vals": n + 1}}
            out = (out.withColumn("__v", F.col(f"`{c}`").cast("string")).join(t, "__v", "left").drop("__v")
                   .withColumn("__slot", slot.alias("__slot", metadata=meta)).drop("__n"))
            # the last slot is dropped, so that it is all zeros; the slot's metadata spares a pass for its size
            out = OneHotEncoder(inputCol="__slot", outputCol=f"{c}_vec", dropLast=True).fit(out).transform(out).drop("__slot", c)
        return out


class _MixedParams(Params):
    ohe = param("ohe", "columns for one-hot", to_list)
    target = param("target", "columns for target means", to_list)
    label = param("label", "0/1 label", to_str)
    weight = param("weight", "smoothing weight of the target means", to_float)
    layout = param("layout", "layout of the one-hot", to_str)


class MixedEncoder(_MixedParams, Configured, Estimator):
    """One-hot on ``ohe`` columns and target means on ``target`` columns,
    fitted together."""

    def __init__(self, ohe: list[str] | None = None, target: list[str] | None = None, label: str | None = None,
                 weight: float | None = None, layout: str | None = None):
        super().__init__()
        self._setDefault(ohe=[], target=[], weight=0.0, layout="columns")
        self._given(ohe=ohe, target=target, label=label, weight=weight, layout=layout)

    def _fit(self, df: DataFrame) -> "MixedEncoderModel":
        parts = {}
        if self.value("ohe"):
            parts["one_hot"] = OneHot(self.value("ohe"), self.value("layout")).fit(df)
        if self.value("target"):
            parts["target_means"] = TargetMeans(self.value("target"), self.value("label"), self.value("weight")).fit(df)
        return MixedEncoderModel(self, parts=parts)


class MixedEncoderModel(_MixedParams, FittedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        for p in sorted(self.parts):
            df = self.parts[p].transform(df)
        return df


def add_prior(df: DataFrame, model, draw: bool = False, id_col: str | None = None, seed: int = 0,
              out: str = "priors_predict") -> DataFrame:
    """The prior of a fitted ``PriorsModel`` as a feature: its probability by
    default, or a seeded Bernoulli draw with it."""
    from .priors import prior_draw
    s = model.transform(df)
    if draw:
        s = prior_draw(s, "prior_p", id_col, seed, out)
    else:
        s = s.withColumn(out, F.col("prior_p"))
    return s.drop("prior_p", "prior_q", "prior_missing",
                  *[f"{c}_bin" for c in model.value("continuous")])


# Feature name used by model selection and the transformer alike (one constant).
LOG_DISTANCE = "log_feature"


class _LogDistanceParams(Params):
    rate = param("rate", "rate column", to_str)
    age = param("age", "age column", to_str)
    weight = param("weight", "weight of the age's logarithm", to_float)
    zero = param("zero", "'shift': add m/10 to every rate; 'replace': put m/10 for zeros", to_str)
    out = param("out", "new column", to_str)


class LogDistance(_LogDistanceParams, Configured, Estimator):
    """ln(rate')^2 + weight * ln(age)^2 with rate' = rate + m/10 (``zero=
    'shift'``) or rate with zeros replaced by m/10 (``zero='replace'``); m is
    the smallest positive rate seen at fit (10e5 when there is none)."""

    def __init__(self, rate: str | None = None, age: str | None = None, weight: float | None = None,
                 zero: str | None = None, out: str | None = None):
        super().__init__()
        self._setDefault(weight=1.0, zero="shift", out=LOG_DISTANCE)
        self._given(rate=rate, age=age, weight=weight, zero=zero, out=out)

    def _fit(self, df: DataFrame) -> "LogDistanceModel":
        x = F.col(self.value("rate")).cast("double")
        m = df.agg(F.min(F.when(x > 0, x)).alias("m")).first()["m"]
        return LogDistanceModel(self, {"min_pos": 10e5 if m is None else float(m)})


class LogDistanceModel(_LogDistanceParams, FittedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        x, least = F.col(self.value("rate")).cast("double"), F.lit(self.state["min_pos"] / 10)
        r = x + least if self.value("zero") == "shift" else F.when(x == 0, least).otherwise(x)
        val = F.pow(F.ln(r), 2) + F.lit(self.value("weight")) * F.pow(F.ln(F.col(self.value("age")).cast("double")), 2)
        return df.withColumn(self.value("out"), val)


class _StandardiseParams(Params):
    cols = param("cols", "columns to scale", to_list)


class Standardise(_StandardiseParams, Configured, Estimator):
    """(x - mean) / population std; a zero std is replaced by 1."""

    def __init__(self, cols: list[str] | None = None):
        super().__init__()
        self._given(cols=cols)

    def _fit(self, df: DataFrame) -> "StandardiseModel":
        cols, aggs = self.value("cols"), []
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        return StandardiseModel(self, {"stats": {c: [row[f"m{i}"], row[f"s{i}"] or 1.0] for i, c in enumerate(cols)}})


class StandardiseModel(_StandardiseParams, FittedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                               for c, (m, s) in self.state["stats"].items()})


class _NewFeaturesParams(Params):
    features = param("features", "features to add: 'prior', 'log_distance'", to_list)
    discrete = param("discrete", "discrete keys of the prior", to_list)
    continuous = param("continuous", "binned keys of the prior", to_list)
    n_bins = param("n_bins", "bins of each continuous key")
    label = param("label", "0/1 label", to_str)
    rate = param("rate", "rate column of the log distance", to_str)
    age = param("age", "age column of the log distance", to_str)
    weight = param("weight", "weight of the age's logarithm", to_float)


class NewFeatures(_NewFeaturesParams, Configured, Estimator):
    """The engineered features as one stage: the prior's probability (``priors_predict``) and the log distance
    (``log_feature``), each learned from the rows the stage is fitted on."""

    def __init__(self, features: list[str] | None = None, discrete: list[str] | None = None,
                 continuous: list[str] | None = None, label: str | None = None, rate: str | None = None,
                 age: str | None = None, weight: float | None = None, n_bins: int | None = None):
        super().__init__()
        self._setDefault(features=[], discrete=[], continuous=[], weight=1.0, n_bins=5)
        self._given(features=features, discrete=discrete, continuous=continuous, label=label, rate=rate, age=age,
                    weight=weight, n_bins=n_bins)

    def _fit(self, df: DataFrame) -> "NewFeaturesModel":
        from .priors import Priors
        parts = {}
        if "prior" in self.value("features"):
            parts["prior"] = Priors(self.value("discrete"), self.value("continuous"), self.value("label"), self.value("n_bins")).fit(df)
        if "log_distance" in self.value("features"):
            parts["log_distance"] = LogDistance(self.value("rate"), self.value("age"), self.value("weight")).fit(df)
        return NewFeaturesModel(self, parts=parts)


class NewFeaturesModel(_NewFeaturesParams, FittedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        if "prior" in self.parts:
            df = add_prior(df, self.parts["prior"])
        return self.parts["log_distance"].transform(df) if "log_distance" in self.parts else df
