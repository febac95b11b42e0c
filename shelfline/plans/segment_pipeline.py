"""Segmentation as one ML pipeline: impute, scale, assemble and cluster, saved and loaded as a whole."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.distribution import grouped_quantiles
from shelfline.schema import SEGMENT_FEATURES


class _Columns(HasInputCols, HasOutputCols):
    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols()))


class MedianImputerModel(_Columns, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fills nulls and NaNs of the input columns by the medians of the table that it was fitted to."""

    medians = Param(Params._dummy(), "medians", "one median per input column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({out: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(m))
                                    for (c, out), m in zip(self._pairs(), self.getOrDefault(self.medians))})


class MedianImputer(_Columns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Exact, interpolated medians; Spark's own imputer has approximate ranks."""

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        columns = self.getInputCols()
        # One row per column.
        found = {r["column"]: r["q"][0] for r in grouped_quantiles(dataset, columns, [0.5]).collect()}
        empty = [c for c in columns if c not in found]
        if empty:
            raise ValueError(f"no median, as no value is known: {', '.join(empty)}")
        model = MedianImputerModel(inputCols=columns, outputCols=self.getOutputCols())
        model.set(model.medians, [found[c] for c in columns])
        return self._copyValues(model)


class PopulationScalerModel(_Columns, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Scales by the means and population deviations of the table that it was fitted to; a constant column becomes 0."""

    means = Param(Params._dummy(), "means", "one mean per input column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "one deviation per input column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numbers = zip(self._pairs(), self.getOrDefault(self.means), self.getOrDefault(self.deviations))
        return dataset.withColumns({out: (F.col(c) - F.lit(m)) / F.lit(s) if s > 0 else F.when(F.col(c).isNotNull(), 0.0)
                                    for (c, out), m, s in numbers})


class PopulationScaler(_Columns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        columns = self.getInputCols()
        row = dataset.agg(F.array(*[F.avg(c) for c in columns]).alias("m"), F.array(*[F.stddev_pop(c) for c in columns]).alias("s")).first()
        model = PopulationScalerModel(inputCols=columns, outputCols=self.getOutputCols())
        model.set(model.means, row["m"])
        model.set(model.deviations, row["s"])
        return self._copyValues(model)


def segment_pipeline(k: int, features: list[str] = SEGMENT_FEATURES, seed: int = 42, max_iter: int = 300) -> Pipeline:
    """Median imputation, population scaling, assembling and K-Means; the result's column is `cluster`."""
    filled, scaled = [f"{c}_filled" for c in features], [f"{c}_z" for c in features]
    return Pipeline(stages=[
        MedianImputer(inputCols=list(features), outputCols=filled),
        PopulationScaler(inputCols=filled, outputCols=scaled),
        VectorAssembler(inputCols=scaled, outputCol="features", handleInvalid="error"),
        KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster"),
    ])


def fit_segments(df: DataFrame, k: int, features: list[str] = SEGMENT_FEATURES, seed: int = 42, restarts: int = 20,
                 max_iter: int = 300) -> PipelineModel:
    """The pipeline with the best of several seeded K-Means fits; the statistics are fitted once.

    Fitting reads `df` often, so it should be a written table.
    """
    *prepare, kmeans = segment_pipeline(k, features, seed, max_iter).getStages()
    prepared = Pipeline(stages=prepare).fit(df)
    vectors = prepared.transform(df).select("features").cache()
    fits = [kmeans.copy({kmeans.seed: seed + i}).fit(vectors) for i in range(restarts)]
    best = min(fits, key=lambda m: m.summary.trainingCost)
    vectors.unpersist()
    return PipelineModel(stages=[*prepared.stages, best])


def save_segments(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_segments(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def place_products(model: PipelineModel, df: DataFrame) -> DataFrame:
    """`df` with its clusters; columns between the stages are left out."""
    return model.transform(df.drop("cluster")).select(*[c for c in df.columns if c != "cluster"], "cluster")
