"""Preprocessing as stages of an ML pipeline: fitted with the model, stored with it, refitted in every fold."""

from __future__ import annotations

import json
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.operators.encoding import Dictionary, Preprocessor
from vitalgrid.session import new_folder


def fitted(estimator: Estimator, df: DataFrame) -> Model:
    """The model of a fit, without its training summary.

    A summary holds the session, and the tasks that apply a model take along all that it holds; a
    session in which anything was observed cannot go along. Copies leave most summaries behind; a model
    whose copy keeps it is stored and read back.
    """
    return _bare(estimator.fit(df), df.sparkSession)


def _bare(model, spark):
    if isinstance(model, PipelineModel):
        return PipelineModel([_bare(stage, spark) for stage in model.stages])
    if not getattr(model, "hasSummary", False):
        return model
    model = model.copy()
    if not model.hasSummary:
        return model
    folder = new_folder(spark, "model")
    model.write().save(folder)
    return type(model).load(folder)


class _Columns(Params):
    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categories = Param(Params._dummy(), "categories", "text columns that become codes", TypeConverters.toListString)
    fallback = Param(Params._dummy(), "fallback", "code of an unknown text: first or most_frequent", TypeConverters.toString)
    scale = Param(Params._dummy(), "scale", "whether columns are standardised", TypeConverters.toBoolean)

    @property
    def features(self) -> list[str]:
        return [*self.getOrDefault(self.numeric), *self.getOrDefault(self.categories)]


class Prepare(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fits category dictionaries, medians and scales."""

    def __init__(self, numeric=(), categories=(), fallback: str = "first", scale: bool = True):
        super().__init__()
        self._set(numeric=list(numeric), categories=list(categories), fallback=fallback, scale=scale)

    def _fit(self, dataset: DataFrame) -> PrepareModel:
        values = {p.name: self.getOrDefault(p) for p in (self.numeric, self.categories, self.fallback, self.scale)}
        fitted = Preprocessor(**values).fit(dataset)
        model = PrepareModel()._set(**values, fitted=json.dumps(fitted.describe()))
        if fitted.dictionary is not None and fitted.dictionary.entries is None:
            # A dictionary that is too large for the driver is a stored table; the model names its place.
            model._set(dictionary=fitted.dictionary.table.inputFiles())
        return model


class PrepareModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Encodes, imputes and scales with what was fitted. All of it is in the stage's parameters, so a
    stored pipeline carries it; only a dictionary beyond the driver's limit is named by its files."""

    fitted = Param(Params._dummy(), "fitted", "everything fitted, as JSON", TypeConverters.toString)
    dictionary = Param(Params._dummy(), "dictionary", "files of a large dictionary", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(dictionary=[])

    def preprocessor(self, spark) -> Preprocessor:
        found = Preprocessor.from_description(json.loads(self.getOrDefault(self.fitted)))
        stored = self.getOrDefault(self.dictionary)
        if stored:
            found.dictionary = Dictionary(None, spark.read.parquet(*stored))
        return found

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.preprocessor(dataset.sparkSession).transform(dataset)


def pipeline(numeric, categories, classifier, scale: bool = True) -> Pipeline:
    """Preparation, assembly and a classifier on `features`, as one estimator: one PipelineModel holds
    all that is fitted, and a cross-validation refits all of it without the held-out fold."""
    prepare = Prepare(numeric, categories, scale=scale)
    return Pipeline(stages=[prepare, VectorAssembler(inputCols=prepare.features, outputCol="features"), classifier])


def fold_accuracy(estimator: Estimator, df: DataFrame, label: str, fold: str = "fold", parallelism: int = 4) -> DataFrame:
    """(fold, rows, accuracy): the whole estimator is fitted on the other folds, every fold at once."""
    def run(held: int):
        model = fitted(estimator, df.filter(F.col(fold) != held))
        hit = (F.col("prediction") == F.col(label)).cast("double")
        rows, accuracy = model.transform(df.filter(F.col(fold) == held)).agg(F.count(F.lit(1)), F.avg(hit)).first()
        return held, rows, accuracy

    # As many numbers as there are folds.
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    with ThreadPool(parallelism) as pool:
        return df.sparkSession.createDataFrame(pool.map(run, folds, chunksize=1), "fold int, rows long, accuracy double")
