"""Text and vector features: vocabulary, TF-IDF, TF-IDF + PCA, title
vectors and variance-share PCA.

TF-IDF follows the usual smoothed form: tf = raw count, idf = ln((1+n) /
(1+df)) + 1, rows L2-normalised; the vocabulary is the k terms with the
highest corpus count (ties by term).

No (document, term) rows are shuffled or cached.  A mergeable frequent-items sketch (one per task) gives the
candidate terms with a bound on the count of every other term; a second pass counts the candidates exactly - per
document as a sparse vector, then by (term) with partial aggregation - and the result stands when the k-th count
lies above the bound.  Otherwise the sketch is widened, and beyond its largest size all terms are counted.  Weighting a
document needs its own row only: count vector, times idf, normalised."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.feature import PCA, CountVectorizerModel, ElementwiseProduct, Normalizer, VectorSizeHint, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Params
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import drop_stop, ngrams, stem_udf, tokens
from ..util import kept_table
from .stages import Configured, FittedModel, param, to_bool, to_float, to_int, to_list, to_str

TRACKED = 1 << 16             # terms a sketch holds at first
MOST_TRACKED = 1_000_000      # the largest sketch
MOST_CANDIDATES = 100_000     # candidates a sketch may be asked for
PROJECTED = 1 << 20           # numbers on either side of a block of rows that is projected at once


def with_terms(df: DataFrame, text: str, stop: list[str] | None, ngram: tuple[int, int] = (1, 1), min_len: int = 2,
               stem: Callable[[str], str] | None = None, out: str = "__terms") -> DataFrame:
    """Adds ``out``: the accent-stripped lower-case tokens of at least ``min_len``
    characters, stop words removed, stemmed, as n-grams.  Plain unigrams stay unfiltered, as only a vocabulary that
    passed ``kept_term`` is ever looked up in them."""
    t = tokens(text, accents=True)
    if tuple(ngram) == (1, 1) and stem is None:
        return df.withColumn(out, t)
    d = df.withColumn(out, drop_stop(t, stop, min_len))
    if stem is not None:
        d = d.withColumn(out, stem_udf(stem)(F.col(out)))
    return d if tuple(ngram) == (1, 1) else d.withColumn(out, ngrams(out, *ngram))


def kept_term(stop: list[str] | None, min_len: int = 2) -> Callable[[Column], Column]:
    """Rule for one exploded term: long enough and no stop word (a hash set)."""
    def rule(t: Column) -> Column:
        long = F.char_length(t) >= min_len
        return long & ~t.isin(list(stop)) if stop else long
    return rule


def _sparse(df: DataFrame, vec: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and one row for each entry of the vector: index, value."""
    v = F.unwrap_udt(F.col(vec))
    return (df.select(*keep, _rows_of(F.arrays_zip(v["indices"], v["values"])).alias("e")).where("e.indices IS NOT NULL")
            .select(*keep, F.col("e.indices").alias("index"), F.col("e.values").alias("value")))


def _rows_of(array):
    """A row for each element, and one null where there is none.  For a plain ``explode`` the optimiser adds filters on the
    array below it, which would compute the tokens or vectors three times."""
    return F.explode_outer(array)


def _sized(df: DataFrame, vec: str, size: int) -> DataFrame:
    """Notes a vector column's size in its metadata, so that an assembler need not look at the rows."""
    return VectorSizeHint(inputCol=vec, size=size, handleInvalid="optimistic").transform(df)


def count_vectors(d: DataFrame, vocabulary: list[str], out: str = "__tf", terms: str = "__terms") -> DataFrame:
    """Adds the sparse vector of the counts of the vocabulary's terms."""
    return CountVectorizerModel.from_vocabulary(vocabulary, inputCol=terms, outputCol=out).transform(d)


def _every(d: DataFrame, terms, keep: Callable[[Column], Column] | None) -> DataFrame:
    t = d.select(_rows_of(terms).alias("t"))
    return t.where(keep(F.col("t")) if keep else F.col("t").isNotNull())


def candidates(d: DataFrame, k: int, tracked: int, terms: str = "__terms",
               keep: Callable[[Column], Column] | None = None) -> tuple[list[str], float]:
    """Terms that may be among the k most frequent, and a count that no other term exceeds."""
    wanted = min(MOST_CANDIDATES, tracked, 2 * k + 100)
    row = _every(d, terms, keep).agg(
        F.expr(f"approx_top_k(t, {wanted}, {tracked})").alias("top"), F.count("t").alias("n")).first()
    top = row["top"] or []
    slots = 1 << math.ceil(math.log2(tracked / 0.75))        # of the sketch's table; its error is 3.5 / slots at most
    others = 2 * 3.5 / slots * row["n"]
    if len(top) == wanted:                                   # estimates are never too low and come largest first
        others = max(others, top[-1]["count"])
    elif sum(x["count"] for x in top) == row["n"]:           # every term is held, so nothing was left out
        others = 0
    return [x["item"] for x in top], others


def _count_all(d: DataFrame, k: int, terms: str, keep) -> DataFrame:
    """The k most frequent terms from the counts of all."""
    every = _every(d, terms, keep).groupBy("t").agg(F.count(F.lit(1)).alias("count"))
    df = _every(d, F.array_distinct(terms), keep).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    return every.orderBy(F.col("count").desc(), "t").limit(k).join(df, "t").select(F.col("t").alias("term"), "count", "df")


def select_terms(d: DataFrame, k: int, terms: str = "__terms", keep: Callable[[Column], Column] | None = None,
                 beside: list[str] | None = None) -> tuple[DataFrame, list[str], DataFrame | None]:
    """The k terms of the ``terms`` arrays with the highest corpus count (ties by term): (term, count, df).  With
    ``beside`` also the candidate terms and, as a written table, each document's sparse counts of them (``__tf``) beside
    these columns."""
    tracked = max(TRACKED, 16 * k)
    while True:
        if tracked <= MOST_TRACKED:
            held, others = candidates(d, k, tracked, terms, keep)
        else:
            held, others = [r["term"] for r in _count_all(d, k, terms, keep).collect()], 0
        if not held:
            none = d.sparkSession.createDataFrame([], "term string, count long, df long")
            return none, [], None
        vectors = count_vectors(d, held, terms=terms).select(*(beside or []), "__tf")
        vectors = kept_table(vectors, "term-counts") if beside is not None else vectors
        counts = _sparse(vectors, "__tf", []).groupBy("index").agg(F.sum("value").cast("long").alias("count"), F.count(F.lit(1)).alias("df"))
        names = d.sparkSession.createDataFrame(list(enumerate(held)), "index int, term string")
        top = counts.join(F.broadcast(names), "index").orderBy(F.col("count").desc(), "term").limit(k)   # as many as candidates
        top = kept_table(top.select("term", "count", "df"), "vocabulary")
        low = top.agg(F.count(F.lit(1)), F.min("count")).first()
        if others == 0 or (low[0] == k and low[1] > others):
            return top, held, vectors if beside is not None else None
        tracked *= 8


def vocabulary(d: DataFrame, k: int, terms: str = "__terms", keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """The k terms of the ``terms`` arrays with the highest corpus count (ties by term), with their
    corpus count and document frequency."""
    return select_terms(d, k, terms, keep)[0]


class _TfidfParams(Params):
    id_col = param("id_col", "document id", to_str)
    text = param("text", "text column", to_str)
    k = param("k", "terms of the vocabulary; 0 for no text features", to_int)
    ngram = param("ngram", "least and greatest n of the n-grams")
    stop = param("stop", "stop words", to_list)
    out = param("out", "vector column", to_str)


class _Stemmed:
    """The stemmer is a function, which files cannot hold: a loaded stage is given it again as ``stem``."""
    stem: Callable[[str], str] | None = None

    def _terms(self, df: DataFrame) -> DataFrame:
        return with_terms(df, self.value("text"), self.value("stop"), tuple(self.value("ngram")), stem=self.stem)

    def _rule(self) -> Callable[[Column], Column] | None:
        plain = tuple(self.value("ngram")) == (1, 1) and self.stem is None
        return kept_term(self.value("stop")) if plain else None


class Tfidf(_TfidfParams, _Stemmed, Configured, Estimator):
    def __init__(self, id_col: str | None = None, text: str | None = None, k: int | None = None,
                 ngram: tuple[int, int] | None = None, stop: list[str] | None = None,
                 stem: Callable[[str], str] | None = None, out: str | None = None):
        super().__init__()
        self._setDefault(k=1000, ngram=[1, 1], stop=[], out="tfidf")
        self._given(id_col=id_col, text=text, k=k, ngram=ngram and list(ngram), stop=stop, out=out)
        self.stem = stem

    def _fit(self, df: DataFrame) -> "TfidfModel":
        return self._model(df, vocabulary(self._terms(df), self.value("k"), keep=self._rule()))

    def fit_counts(self, df: DataFrame, beside: list[str]) -> tuple["TfidfModel", DataFrame | None, list[str]]:
        """Fit; also the written counts of the candidate terms beside the given columns of the same rows, from which the
        model can weigh them without reading their texts again (None where there are no terms), and the candidates."""
        cols = list(dict.fromkeys([*beside, self.value("text")]))
        top, held, counts = select_terms(self._terms(df.select(*cols)), self.value("k"), keep=self._rule(), beside=beside)
        return self._model(df if counts is None else counts, top), counts, held

    def _model(self, df: DataFrame, top: DataFrame) -> "TfidfModel":
        n = df.count()
        rows = top.orderBy(F.col("count").desc(), "term").collect()                    # k rows
        m = TfidfModel(self, {"terms": [r["term"] for r in rows], "idf": [math.log((1 + n) / (1 + r["df"])) + 1 for r in rows]})
        m.stem = self.stem
        return m


def fit_long(est: Tfidf, df: DataFrame) -> tuple["TfidfModel", DataFrame]:
    """Fit and weight the same frame: the weights come from the counts of the candidates that the fit wrote, so the
    texts are read twice in all."""
    key = est.value("id_col")
    model, vectors, held = est.fit_counts(df, [key])
    if vectors is None:
        return model, model.long(df)
    idf = dict(zip(model.terms, model.idf))
    by_slot = F.array(*[F.lit(idf.get(t, 0.0)) for t in held])
    v = F.unwrap_udt(F.col("__tf"))
    w = vectors.select(key, v["indices"].alias("i"), F.zip_with(v["indices"], v["values"], lambda i, x: x * F.get(by_slot, i)).alias("w"))
    w = w.withColumn("norm", F.sqrt(F.aggregate("w", F.lit(0.0), lambda s, x: s + x * x)))       # once a document, before exploding
    names = df.sparkSession.createDataFrame([(i, t) for i, t in enumerate(held) if t in idf], "i int, term string")
    rows = w.select(key, "norm", _rows_of(F.arrays_zip("i", "w")).alias("e")).where("e.w > 0")
    return model, (rows.select(key, F.col("e.i").alias("i"), (F.col("e.w") / F.col("norm")).alias("weight"))
                   .join(F.broadcast(names), "i").select(key, "term", "weight"))       # k rows


class TfidfModel(_TfidfParams, _Stemmed, FittedModel):
    @property
    def terms(self) -> list[str]:
        return self.state["terms"]

    @property
    def idf(self) -> list[float]:
        return self.state["idf"]

    def long(self, df: DataFrame) -> DataFrame:
        """(id, term, weight) for vocabulary terms present in each doc."""
        key, out = self.value("id_col"), self.value("out")
        if not self.terms:
            return df.select(key).limit(0).select(key, F.lit("").alias("term"), F.lit(0.0).alias("weight"))
        d = self.transform(df.select(key, self.value("text")))
        names = df.sparkSession.createDataFrame(list(enumerate(self.terms)), "index int, term string")
        return (_sparse(d, out, [key]).join(F.broadcast(names), "index")        # k rows
                .select(key, "term", F.col("value").alias("weight")))

    def _transform(self, df: DataFrame) -> DataFrame:
        """Adds ``out``: an L2-normalised sparse vector over the vocabulary."""
        out = self.value("out")
        if not self.terms:
            return df.withColumn(out, array_to_vector(F.array().cast("array<double>")))
        return self._weigh(count_vectors(self._terms(df), self.terms)).drop("__terms")

    def weigh_counts(self, counts: DataFrame, held: list[str]) -> DataFrame:
        """``transform`` of rows whose counts of the terms ``held`` are there as ``__tf``."""
        at = {t: i for i, t in enumerate(held)}
        sliced = VectorSlicer(inputCol="__held", outputCol="__tf", indices=[at[t] for t in self.terms])
        return self._weigh(sliced.transform(counts.withColumnRenamed("__tf", "__held")).drop("__held"))

    def _weigh(self, d: DataFrame) -> DataFrame:
        ep = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="__tf", outputCol="__w")
        nz = Normalizer(p=2.0, inputCol="__w", outputCol=self.value("out"))
        return nz.transform(ep.transform(d)).drop("__tf", "__w")


def _projected(index: pd.Series, value: pd.Series, loadings: np.ndarray, centre: np.ndarray) -> Iterator[pd.Series]:
    """Sparse rows times the loadings, less the centre, a block of rows at a time: whatever the size of the batch, the
    entries of the rows and the number of components, a block and its result hold ``PROJECTED`` numbers each."""
    block = max(1, PROJECTED // max(loadings.shape))
    for at in range(0, len(index), block):
        i, x = index.iloc[at:at + block].to_numpy(), value.iloc[at:at + block].to_numpy()
        dense = np.zeros((len(i), len(loadings)))
        dense[np.repeat(np.arange(len(i)), [len(r) for r in i]), np.concatenate(i).astype(int)] = np.concatenate(x)
        yield pd.Series(list(dense @ loadings - centre))


class _TfidfPcaParams(_TfidfParams):
    n_comp = param("n_comp", "principal components; 0 for the weights themselves", to_int)


class TfidfPca(_TfidfPcaParams, _Stemmed, Configured, Estimator):
    """TF-IDF, standardised per term (population std), then PCA(n_comp) as ``out``.

    Rows stay sparse: the k x k covariance of the weights is summed over them in a tree, scaled and decomposed on the
    driver; rows are projected in blocks of bounded size, less the means' projection.  The largest loading of a component
    is positive, so its sign is fixed."""

    def __init__(self, id_col: str | None = None, text: str | None = None, k: int | None = None, n_comp: int | None = None,
                 stop: list[str] | None = None, ngram: tuple[int, int] | None = None,
                 stem: Callable[[str], str] | None = None, out: str | None = None):
        super().__init__()
        self._setDefault(k=1000, n_comp=10, ngram=[1, 1], stop=[], out="pca")
        self._given(id_col=id_col, text=text, k=k, n_comp=n_comp, stop=stop, ngram=ngram and list(ngram), out=out)
        self.stem = stem

    def _fit(self, df: DataFrame) -> "TfidfPcaModel":
        return self._fit_weights(df, [])[0]

    def fit_rows(self, df: DataFrame, beside: list[str]) -> tuple["TfidfPcaModel", DataFrame]:
        """Fit and transform the same frame: ``beside`` columns and the vectors.  They come from the counts that the fit
        wrote, so the texts are read twice in all."""
        model, weights = self._fit_weights(df, beside)
        rows = model.transform(df) if weights is None else model.project(weights)
        return model, rows.select(*beside, *[c for c in [self.value("out")] if c in rows.columns])

    def _fit_weights(self, df: DataFrame, beside: list[str]) -> tuple["TfidfPcaModel", DataFrame | None]:
        if not self.value("k"):
            return TfidfPcaModel(self), None
        tf, counts, held = Tfidf(self.value("id_col"), self.value("text"), self.value("k"), tuple(self.value("ngram")),
                                 self.value("stop"), self.stem, "__v").fit_counts(df, beside)
        if counts is None:
            return TfidfPcaModel(self, parts={"tfidf": tf}), None
        rows = tf.weigh_counts(counts, held)
        if not self.value("n_comp"):
            return TfidfPcaModel(self, parts={"tfidf": tf}), rows
        v = rows.select("__v")
        row = v.agg(Summarizer.mean(F.col("__v")).alias("m"), Summarizer.variance(F.col("__v")).alias("s"), F.count("__v").alias("n")).first()
        std = np.sqrt(np.maximum(row["s"].toArray(), 0) * (row["n"] - 1) / row["n"])
        scale = 1 / np.where(std > 0, std, 1)
        cov = RowMatrix(MLUtils.convertVectorColumnsFromML(v, "__v")).computeCovariance().toArray()   # summed in a tree, sparse rows
        variance, axes = np.linalg.eigh(cov * (row["n"] - 1) / row["n"] * scale[:, None] * scale)
        order = np.argsort(-variance, kind="stable")[:min(self.value("n_comp"), len(tf.terms))]
        axes = axes[:, order] * np.where(np.abs(axes).max(0) == axes.max(0), 1, -1)[order]     # largest loading positive
        loadings = axes * scale[:, None]
        table = df.sparkSession.createDataFrame([(i, x.tolist()) for i, x in enumerate(loadings)], "index int, loading array<double>")
        share = np.maximum(variance, 0)[order] / max(np.maximum(variance, 0).sum(), 1e-300)
        return TfidfPcaModel(self, {"explained_variance": share.tolist(), "centre": (row["m"].toArray() @ loadings).tolist()},
                             {"loadings": kept_table(table, "loadings")}, {"tfidf": tf}), rows


class TfidfPcaModel(_TfidfPcaParams, FittedModel):
    @property
    def explained_variance(self) -> list[float]:
        return self.state["explained_variance"]

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.project(self.parts["tfidf"].transform(df)) if "tfidf" in self.parts else df

    def project(self, d: DataFrame) -> DataFrame:
        """``transform`` of rows whose weights are there as ``__v``."""
        out = self.value("out")
        if "loadings" not in self.tables:
            return _sized(d.withColumnRenamed("__v", out), out, len(self.parts["tfidf"].terms))
        rows = self.tables["loadings"].orderBy("index").collect()                    # a row for each term
        held = d.sparkSession.sparkContext.broadcast(np.array([r["loading"] for r in rows]))
        centre = np.array(self.state["centre"])

        @F.pandas_udf("array<double>")
        def project(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for index, value in batches:
                yield from _projected(index, value, held.value, centre)

        v = F.unwrap_udt(F.col("__v"))
        d = d.withColumn(out, array_to_vector(project(v["indices"], v["values"])))
        return _sized(d.drop("__v"), out, len(centre))


def join_vectors(df: DataFrame, vecs: DataFrame, key: str, vec_key: str | None = None) -> DataFrame:
    """Attach precomputed vectors by id (inner join: rows without a vector are
    dropped, never misaligned)."""
    v = vecs if not vec_key or vec_key == key else vecs.withColumnRenamed(vec_key, key)
    return df.join(v, key, "inner")


class _VectorPcaParams(Params):
    col = param("col", "array column of the vectors", to_str)
    share = param("share", "share of the variance to keep; 1 keeps the vectors, 0 drops them", to_float)
    out = param("out", "vector column", to_str)
    as_vector = param("as_vector", "with share 1: the whole vectors as ``out``", to_bool)


class VectorPca(_VectorPcaParams, Configured, Estimator):
    """Keep the fewest principal components whose explained variance reaches
    ``share`` (0 < share < 1); share 1 keeps the vectors as they are, share 0
    drops them."""

    def __init__(self, col: str | None = None, share: float | None = None, out: str | None = None, as_vector: bool | None = None):
        super().__init__()
        if share is not None and not (0 <= share <= 1):
            raise ValueError("share must be in [0, 1]")
        self._setDefault(share=1.0, out="vec_pca", as_vector=False)
        self._given(col=col, share=share, out=out, as_vector=as_vector)

    def _fit(self, df: DataFrame) -> "VectorPcaModel":
        col = self.value("col")
        first = df.select(col).where(F.col(col).isNotNull()).first()
        dim = len(first[0]) if first else 0
        if self.value("share") in (0, 1) or not dim:
            return VectorPcaModel(self, {"k": 0, "dim": dim})
        d = df.select(F.col(col).cast("array<double>").alias(col)).withColumn("__v", array_to_vector(col))
        pca = PCA(k=dim, inputCol="__v", outputCol="__p").fit(d)
        total, k = 0.0, 0
        for k, ev in enumerate(pca.explainedVariance, start=1):
            total += ev
            if total >= self.value("share"):
                break
        return VectorPcaModel(self, {"k": k}, parts={"pca": pca})


class VectorPcaModel(_VectorPcaParams, FittedModel):
    @property
    def k(self) -> int:
        return self.state["k"]

    def _transform(self, df: DataFrame) -> DataFrame:
        col = self.value("col")
        if not self.parts:
            if self.value("share") and self.value("as_vector"):
                return _sized(df.withColumn(self.value("out"), array_to_vector(F.col(col).cast("array<double>"))).drop(col),
                              self.value("out"), self.state["dim"])
            return df if self.value("share") else df.drop(col)
        d = df.withColumn("__v", array_to_vector(F.col(col).cast("array<double>")))
        p = self.parts["pca"].transform(d)
        s = VectorSlicer(inputCol="__p", outputCol=self.value("out"), indices=list(range(self.k))).transform(p)
        return s.drop("__v", "__p", col)
