"""Pipeline stages with real parameters: base classes that save and load, stages that act at fit only,
and the pipeline that runs them.

``Configured`` gives an estimator or transformer its ``Param``s from keywords, so a parameter grid reaches
every one of them (``{stage.getParam("weight"): [0, 1, 5]}``) and ``save``/``load`` keep them.
``FittedModel`` is a model made of its parameters, a JSON-able ``state``, fitted ``tables`` (Parquet files in
the shared work folder: no cache is held and their size is known to the planner) and ``parts`` (other models).

A ``Sampler`` changes rows while a pipeline is fitted and passes them through afterwards.  ``SamplingPipeline``
is ``pyspark.ml.Pipeline`` with that one difference: the rows that later stages are fitted on are those the
sampler gives; the fitted pipeline holds a ``PassThrough`` in its place.  A cross-validation that fits the pipeline
in each fold thus samples and encodes the training rows of that fold alone.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.pipeline import PipelineSharedReadWrite
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReader, MLWriter)
from pyspark.sql import DataFrame

from ..util import kept_table


def param(name: str, doc: str, convert=None) -> Param:
    return Param(Params._dummy(), name, doc, convert)


to_list, to_float, to_int, to_str, to_bool = (
    TypeConverters.toListString, TypeConverters.toFloat, TypeConverters.toInt, TypeConverters.toString, TypeConverters.toBoolean)


class Configured(Params, DefaultParamsReadable, DefaultParamsWritable):
    def _given(self, **values) -> None:
        """Set the parameters that are not None."""
        self._set(**{k: v for k, v in values.items() if v is not None})

    def value(self, name: str):
        p = self.getParam(name)
        return self.getOrDefault(p) if self.isDefined(p) else None


class FittedModel(Configured, Model):
    """Model of an estimator: its parameters are declared by the class and copied from the estimator."""

    def __init__(self, est: Params | None = None, state: dict | None = None, tables: dict[str, DataFrame] | None = None,
                 parts: dict[str, Model] | None = None):
        super().__init__()
        self.state, self.tables, self.parts = dict(state or {}), dict(tables or {}), dict(parts or {})
        if est is not None:
            est._copyValues(self)

    def write(self) -> MLWriter:
        return _FittedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FittedReader(cls)


class _FittedWriter(MLWriter):
    def __init__(self, model: FittedModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={
            "state": m.state, "tables": sorted(m.tables), "parts": sorted(m.parts)})
        for name, t in m.tables.items():
            t.write.parquet(f"{path}/tables/{name}")
        for name, part in m.parts.items():
            part.write().session(spark).save(f"{path}/parts/{name}")


class _FittedReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FittedModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        m = self.cls(state=meta["state"], tables={n: spark.read.parquet(f"{path}/tables/{n}") for n in meta["tables"]},
                     parts={n: DefaultParamsReader.loadParamsInstance(f"{path}/parts/{n}", spark) for n in meta["parts"]})
        m._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(m, meta)
        return m


class DropColumns(Configured, Transformer):
    """Drops the listed columns; names that are not there are ignored."""
    cols = param("cols", "columns to drop", to_list)

    def __init__(self, cols: list[str] | None = None):
        super().__init__()
        self._setDefault(cols=[])
        self._given(cols=cols)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.value("cols"))


class PassThrough(Configured, Transformer):
    """What a sampler leaves in a fitted pipeline."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df


class Sampler(Configured, Estimator):
    """Estimator whose ``resample`` gives the rows that later stages are fitted on."""

    def resample(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> PassThrough:
        return PassThrough()


class FitColumns(Sampler):
    """While fitting: only the listed columns (those there), written once for the stages after it.  Scoring keeps all."""
    cols = param("cols", "columns that later stages are fitted on", to_list)

    def __init__(self, cols: list[str] | None = None):
        super().__init__()
        self._setDefault(cols=[])
        self._given(cols=cols)

    def resample(self, df: DataFrame) -> DataFrame:
        return df.select(*[c for c in self.value("cols") if c in df.columns])

    def _fit(self, df: DataFrame) -> DropColumns:
        return DropColumns()


class SamplingPipeline(Pipeline):
    """``Pipeline`` whose ``Sampler`` stages change the rows that the stages after them are fitted on."""

    def _fit(self, df: DataFrame) -> PipelineModel:
        stages = self.getStages()
        last = max((i for i, s in enumerate(stages) if isinstance(s, Estimator)), default=-1)
        return PipelineModel(self._run(df, last)[1] + list(stages[last + 1:]))

    def fit_maps(self, df: DataFrame, maps: list[dict]) -> list[PipelineModel]:
        """A fitted pipeline for each parameter map.  Maps that differ in the last estimator only share the rows that it
        is fitted on."""
        stages = self.getStages()
        last = max(i for i, s in enumerate(stages) if isinstance(s, Estimator))
        shared, out = {}, []
        for m in maps:
            key = params_before(stages[last], m)
            if key not in shared:
                shared[key] = self.copy(m)._run(df, last - 1, onward=True)
            rows, fitted = shared[key]
            own = self.copy(m).getStages()
            out.append(PipelineModel([*fitted, own[last].fit(rows), *own[last + 1:]]))
        return out

    def training_rows(self, df: DataFrame) -> DataFrame:
        """The rows that the last estimator is fitted on."""
        stages = self.getStages()
        last = max((i for i, s in enumerate(stages) if isinstance(s, Estimator)), default=len(stages))
        return self._run(df, last - 1, onward=True)[0]

    def _run(self, df: DataFrame, last: int, onward: bool = False) -> tuple[DataFrame, list[Transformer]]:
        """Fits the stages up to ``last``; also the rows after them, where the caller needs them."""
        fitted = []
        for i, s in enumerate(self.getStages()[:last + 1]):
            if not isinstance(s, (Estimator, Transformer)):
                raise TypeError(f"not a pipeline stage: {type(s)}")
            m = s.fit(df) if isinstance(s, Estimator) else s
            fitted.append(m)
            if i < last or onward:
                # sampled rows are written: the stages after them read them many times
                df = kept_table(s.resample(df), "sampled") if isinstance(s, Sampler) else m.transform(df)
        return df, fitted

    def write(self) -> MLWriter:
        return _PipelineWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _PipelineReader(cls)


def params_before(stage: Params, m: dict) -> str:
    """The parameters of a map that are not the stage's, as a key."""
    return repr(sorted((p.parent, p.name, repr(v)) for p, v in m.items() if p.parent != stage.uid))


class _PipelineWriter(MLWriter):
    def __init__(self, pipe: SamplingPipeline):
        super().__init__()
        self.pipe = pipe

    def saveImpl(self, path: str) -> None:
        stages = self.pipe.getStages()
        PipelineSharedReadWrite.validateStages(stages)
        PipelineSharedReadWrite.saveImpl(self.pipe, stages, self.sparkSession, path)


class _PipelineReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> SamplingPipeline:
        spark = self.sparkSession
        uid, stages = PipelineSharedReadWrite.load(DefaultParamsReader.loadMetadata(path, spark), spark, path)
        return self.cls(stages=stages)._resetUid(uid)
