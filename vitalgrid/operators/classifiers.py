"""Classifiers on MLlib: fitting, comparison, search, scoring, retraining."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from threading import Lock

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.scoring import risk_tier
from vitalgrid.operators.encoding import (
    Preprocessor,
    collect_scale,
    fit_scale,
    scaled,
)
from vitalgrid.operators.neighbors import nearest
from vitalgrid.operators.perceptron import Perceptron
from vitalgrid.operators.sequences import stratified_kfold, stratified_split
from vitalgrid.operators.stages import fitted
from vitalgrid.operators.trees import BoostedTrees, Forest
from vitalgrid.session import materialize, new_folder, spread
from vitalgrid.streaming import logs

SEED = 42
# MLlib grows trees to depth 30 at most; an unlimited depth becomes this.
UNLIMITED_DEPTH = 30
# Models that want scaled input.
SCALED = {"logistic_regression", "rbf_svc", "mlp"}
# Iterative fits end when the loss improves by less than this share.
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Sizes:
    """Hyper-parameters that set how long a fit takes."""

    trees: int = 100
    boosting_rounds: int = 100
    iterations: int = 1000
    hidden: tuple[int, ...] = (100, 50)
    fourier: int = 256
    neighbours: int = 5


def random_forest(sizes: Sizes = Sizes(), max_depth: int = 10, min_leaf: int = 2, label: str = "label"):
    return Forest(
        labelCol=label, featuresCol="features", numTrees=sizes.trees, maxDepth=max_depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=SEED,
    )


def gradient_boosting(sizes: Sizes = Sizes(), label: str = "label"):
    return BoostedTrees(
        labelCol=label, featuresCol="features", maxIter=sizes.boosting_rounds, stepSize=0.1, maxDepth=3, seed=SEED,
    )


def logistic_regression(rows: int, sizes: Sizes = Sizes(), label: str = "label", c: float = 1.0):
    """The penalty 1/C is on the summed loss; MLlib's is on the mean."""
    return LogisticRegression(
        labelCol=label, featuresCol="scaled_features", maxIter=sizes.iterations,
        regParam=1.0 / (c * max(rows, 1)), standardization=False,
    )


def decision_tree(label: str = "label"):
    return DecisionTreeClassifier(
        labelCol=label, featuresCol="features", maxDepth=5, minInstancesPerNode=5, seed=SEED
    )


def naive_bayes(label: str = "label"):
    return NaiveBayes(labelCol=label, featuresCol="features", modelType="gaussian")


def mlp(inputs: int, sizes: Sizes = Sizes(), label: str = "label"):
    return Perceptron(inputs, sizes.hidden, label, iterations=sizes.iterations, tolerance=TOLERANCE, seed=SEED)


# Random Fourier features (Rahimi and Recht 2007): a linear margin on them is an RBF margin.


def fourier_features(vector: Column, inputs: int, outputs: int, gamma: float | None = None) -> Column:
    """`sqrt(2/D) * cos(W x + b)`, in Arrow batches; W and b come from the seed, not from data."""
    gamma = gamma if gamma is not None else 1.0 / inputs
    rng = np.random.default_rng(SEED)
    weights = rng.normal(0.0, np.sqrt(2 * gamma), (inputs, outputs))
    shifts = rng.uniform(0.0, 2 * np.pi, outputs)

    @F.pandas_udf("array<double>")
    def project(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=object)
        x = np.array([np.asarray(v, dtype=np.float64) for v in values])
        return pd.Series(list(np.sqrt(2.0 / outputs) * np.cos(x @ weights + shifts)))

    return array_to_vector(project(vector_to_array(vector)))


class RbfMargin:
    """Linear margin on Fourier features, with a logistic fit of the margin as probability."""

    def __init__(self, inputs: int, rows: int, sizes: Sizes = Sizes(), label: str = "label", c: float = 1.0):
        self.inputs, self.sizes, self.label = inputs, sizes, label
        self.margin = LinearSVC(
            labelCol=label, featuresCol="fourier", maxIter=sizes.iterations, tol=TOLERANCE,
            regParam=1.0 / (c * max(rows, 1)), standardization=False, rawPredictionCol="margin_raw",
            predictionCol="margin_prediction",
        )
        self.calibration = LogisticRegression(labelCol=label, featuresCol="margin", maxIter=100)

    def _fourier(self, df: DataFrame) -> DataFrame:
        projected = fourier_features(F.col("scaled_features"), self.inputs, self.sizes.fourier)
        return df.withColumn("fourier", projected)

    @staticmethod
    def _margin(df: DataFrame) -> DataFrame:
        value = vector_to_array("margin_raw")[1]
        return df.withColumn("margin", array_to_vector(F.array(value)))

    def fit(self, df: DataFrame) -> RbfMargin:
        # The fit keeps its own blocks of the projected rows; they are projected anew for the margins,
        # as a stored table of them is many times the rows.
        prepared = self._fourier(df).select(self.label, "fourier")
        self.margin = fitted(self.margin, prepared)
        margins = self._margin(self.margin.transform(prepared)).select(self.label, "margin")
        self.calibration = fitted(self.calibration, spread(materialize(margins, "margins")))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        margins = self._margin(self.margin.transform(self._fourier(df)))
        return self.calibration.transform(margins).drop(
            "fourier", "margin_raw", "margin_prediction", "margin"
        )


class NearestVote:
    """k nearest neighbours as a model: the training rows are the model."""

    def __init__(self, identifier: str = "id", label: str = "label", k: int = 5):
        self.identifier, self.label, self.k, self.train = identifier, label, k, None

    def fit(self, df: DataFrame) -> NearestVote:
        self.train = df
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Every row gets its own vote, also where identifiers repeat; without training rows the
        probability is a half."""
        def with_array(rows):
            return rows.withColumn("_array", vector_to_array("features"))

        # The numbers of rows are made once; a second pass over the input could number them otherwise.
        asked = materialize(with_array(df).withColumn("_row", F.monotonically_increasing_id()), "asked")
        known = with_array(self.train).withColumn("_row", F.col(self.identifier))
        found = nearest(asked, known, self.k, "_row", "_array", self.label, exclude_self=False)
        exact = F.min("distance").alias("least")
        share = F.sum(
            F.when(F.col("least") > 0, 1 / F.col("distance"))
            .when(F.col("distance") == 0, 1.0).otherwise(0.0)
        )
        votes = (
            found.join(found.groupBy("_row").agg(exact), "_row")
            .groupBy("_row", "label").agg(share.alias("w"))
            .groupBy("_row")
            .agg(
                F.sum(F.when(F.col("label") == 1, F.col("w")).otherwise(0.0)).alias("one"),
                F.sum("w").alias("all"),
            )
            .select("_row", (F.col("one") / F.col("all")).alias("_p"))
        )
        p = F.coalesce("_p", F.lit(0.5))
        return asked.join(votes, "_row", "left").select(
            *df.columns,
            (p > 0.5).cast("double").alias("prediction"),
            array_to_vector(F.array(1 - p, p)).alias("probability"),
        )


# Models whose fits take long, by the number of jobs that follow each other in one.
LONGEST_FIRST = ("gradient_boosting", "mlp", "rbf_svc", "random_forest", "knn", "logistic_regression")
# Models whose fit holds many times its rows (256 projected columns of each), and how many run at once.
HEAVY, HEAVY_AT_ONCE = ("rbf_svc",), 2


def estimators(rows: int, inputs: int, sizes: Sizes = Sizes(), label: str = "label") -> dict[str, Callable]:
    """Fresh estimator per model name."""
    return {
        "random_forest": lambda: random_forest(sizes, label=label),
        "gradient_boosting": lambda: gradient_boosting(sizes, label),
        "logistic_regression": lambda: logistic_regression(rows, sizes, label),
        "rbf_svc": lambda: RbfMargin(inputs, rows, sizes, label),
        "knn": lambda: NearestVote(label=label, k=sizes.neighbours),
        "naive_bayes": lambda: naive_bayes(label),
        "decision_tree": lambda: decision_tree(label),
        "mlp": lambda: mlp(inputs, sizes, label),
    }


def with_vectors(df: DataFrame, features: Sequence[str], scales: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """Adds `features`, and `scaled_features` where scales are given."""
    df = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    if scales is None:
        return df
    columns = [scaled(F.col(f"`{c}`"), scales[c]) for c in features]
    return df.withColumn("scaled_features", array_to_vector(F.array(*columns)))


def fit_scales(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    return collect_scale(fit_scale(df, features))


def probability_of_one(probability: str = "probability") -> Column:
    return vector_to_array(probability)[1]


def as_scores(df: DataFrame, *keep: str) -> DataFrame:
    """Prediction, both probabilities and the risk tier."""
    p = probability_of_one()
    return df.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        (1 - p).alias("probability_no_disease"),
        p.alias("probability_disease"),
        risk_tier(p).alias("risk_level"),
    )


def quality(scored: DataFrame, label: str = "label") -> tuple[float, float]:
    """(accuracy, AUC) of a frame with prediction and probability."""
    rows = materialize(scored.select(
        F.col(label).cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"),
        probability_of_one().alias("score"),
    ), "scored")
    accuracy = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy").evaluate(rows)
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(rows)
    return accuracy, auc


def compare_models(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    identifier: str = "id",
    names: Sequence[str] | None = None,
    folds: int = 5,
    test_share: float = 0.2,
    sizes: Sizes = Sizes(),
    parallelism: int = 8,
) -> DataFrame:
    """Hold-out and cross-validated accuracy and AUC per model, one row each.

    All fits, of every model and fold, are independent jobs and share the cluster.
    """
    split = materialize(stratified_split(df, label, identifier, test_share), "split")
    train = split.filter(F.col("part") == "train").drop("part")
    test = split.filter(F.col("part") == "test").drop("part")
    scales = fit_scales(train, features)
    keep = [identifier, label, "features", "scaled_features"]
    train = materialize(stratified_kfold(train, label, identifier, folds), "folds")
    train = spread(materialize(with_vectors(train, features, scales).select(*keep, "fold"), "train"))
    test = spread(materialize(with_vectors(test, features, scales).select(*keep), "test"))
    made = estimators(train.count(), len(features), sizes, label)

    def run(task):
        name, held = task
        known, asked = train, test
        if held is not None:
            known, asked = train.filter(F.col("fold") != held), train.filter(F.col("fold") == held).drop("fold")
        return quality(fitted(made[name](), known.drop("fold")).transform(asked), label)

    names = list(names or made)
    # The longest fits first, so that none of them is left to run alone at the end.
    tasks = sorted(
        ((name, held) for held in (None, *range(folds)) for name in names),
        key=lambda task: LONGEST_FIRST.index(task[0]) if task[0] in LONGEST_FIRST else len(LONGEST_FIRST),
    )
    heavy = [task for task in tasks if task[0] in HEAVY]
    others = [task for task in tasks if task[0] not in HEAVY]
    with ThreadPool(min(HEAVY_AT_ONCE, parallelism)) as few, ThreadPool(max(1, parallelism - HEAVY_AT_ONCE)) as many:
        apart = [(few, heavy), (many, others)]
        waiting = [(part, pool.map_async(run, part, chunksize=1)) for pool, part in apart]
        found = {task: result for part, results in waiting for task, result in zip(part, results.get())}
    rows = []
    for name in names:
        accuracies, aucs = np.array([found[name, held] for held in range(folds)]).T
        rows.append((
            name, *map(float, found[name, None]), float(accuracies.mean()), float(accuracies.std()),
            float(aucs.mean()), float(aucs.std()),
        ))
    return df.sparkSession.createDataFrame(
        rows,
        "model string, accuracy double, auc double, cv_accuracy_mean double, cv_accuracy_std double,"
        " cv_auc_mean double, cv_auc_std double",
    )


# Search grids: trees, depth (unlimited = the limit), rows per leaf, columns per split.
STREAM_GRID = {
    "numTrees": [50, 100], "maxDepth": [UNLIMITED_DEPTH, 10], "minInstancesPerNode": [1, 2],
    "featureSubsetStrategy": ["sqrt"],
}
BATCH_GRID = {
    "numTrees": [100, 200, 300], "maxDepth": [UNLIMITED_DEPTH, 10, 20, 30],
    "minInstancesPerNode": [1, 2, 4], "featureSubsetStrategy": ["sqrt", "log2"],
}


def _text(point: Mapping) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in point.items())


def grid_search(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    identifier: str = "id",
    grid: Mapping[str, Sequence] = STREAM_GRID,
    folds: int = 3,
    parallelism: int = 8,
    folder: str | None = None,
) -> tuple[DataFrame, object]:
    """Cross-validated accuracy per parameter set, best first, and the model refitted with the best.

    Every (parameter set, fold) is a fit of its own, and its accuracy is a batch of the log
    `folder/results` as soon as it is known. A search that is started again with the same folder takes
    up what the log has and fits only the rest; the folds depend on the identifiers alone. The largest
    forests are fitted first. Under ten rows there is nothing to search: the default forest is fitted.
    """
    rows = df.count()
    folds = min(folds, max(2, rows // 3))
    forest = random_forest(label=label)
    spark = df.sparkSession
    schema = "rank int, parameters string, accuracy double"
    if rows < 10:
        model = fitted(forest, with_vectors(df, features))
        return spark.createDataFrame([(1, "default", None)], schema), model
    folder = folder or new_folder(spark, "search")
    results = f"{folder}/results"
    folded = materialize(stratified_kfold(df, label, identifier, folds), "folds")
    data = spread(materialize(with_vectors(folded, features).select(label, "features", "fold"), "grid"))
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(forest.getParam(name), list(values))
    points = {_text(p): p for p in builder.build()}
    # The log holds one row for each parameter set and fold.
    log = logs.read_log_or_none(spark, results)
    found = {} if log is None else {(r["parameters"], r["fold"]): r["accuracy"] for r in log.collect()}
    tasks, one_writer = [(text, held) for text in points for held in range(folds)], Lock()

    def size(task):
        named = {p.name: v for p, v in points[task[0]].items()}
        return -named.get("numTrees", 1) * named.get("maxDepth", 1) / named.get("minInstancesPerNode", 1)

    def run(task):
        text, held = task
        known, asked = data.filter(F.col("fold") != held), data.filter(F.col("fold") == held)
        accuracy = forest.copy(points[text]).accuracy(known, asked)
        row = spark.createDataFrame([(text, held, accuracy)], "parameters string, fold int, accuracy double")
        with one_writer:
            logs.append_batch(row.coalesce(1), results, tasks.index(task))
        return accuracy

    open_tasks = sorted((t for t in tasks if t not in found), key=size)
    with ThreadPool(parallelism) as pool:
        found.update(zip(open_tasks, pool.map(run, open_tasks, chunksize=1)))
    mean = {text: sum(found[text, held] for held in range(folds)) / folds for text in points}
    board = sorted(mean.items(), key=lambda item: (-item[1], item[0]))
    table = spark.createDataFrame([(i, text, float(a)) for i, (text, a) in enumerate(board, 1)], schema)
    return table, fitted(forest.copy(points[board[0][0]]), data)


def importance_table(model, features: Sequence[str], spark) -> DataFrame:
    """`(feature, weight)` of a fitted tree ensemble: one row per input column."""
    weights = model.featureImportances.toArray()
    return spark.createDataFrame(
        [(name, float(w)) for name, w in zip(features, weights)], "feature string, weight double"
    )


# Fitted preprocessing and forest together ----------------------------------------------------


@dataclass
class RiskModel:
    """A preprocessor and the stages fitted on its output."""

    preprocessor: Preprocessor
    stages: PipelineModel

    def score(self, df: DataFrame, *keep: str) -> DataFrame:
        held = df.select("*", *[F.col(c).alias(f"_keep_{c}") for c in keep])
        out = self.stages.transform(self.preprocessor.transform(held))
        return as_scores(out, *[f"_keep_{c}" for c in keep]).withColumnsRenamed(
            {f"_keep_{c}": c for c in keep}
        )

    @property
    def forest(self):
        return self.stages.stages[-1]


def fit_risk_model(
    df: DataFrame,
    numeric: Sequence[str],
    categories: Sequence[str],
    label: str = "label",
    preprocessor: Preprocessor | None = None,
    sizes: Sizes = Sizes(),
    max_depth: int = 10,
    min_leaf: int = 1,
) -> RiskModel:
    """Forest on encoded, imputed and scaled columns; a given preprocessor is used as it is."""
    preprocessor = preprocessor or Preprocessor(list(numeric), list(categories)).fit(df)
    # Tree growing passes over the rows once per level: prepared rows are written once.
    prepared = spread(materialize(
        preprocessor.transform(df).select(*preprocessor.features, label), "training"
    ))
    stages = Pipeline(stages=[
        VectorAssembler(inputCols=preprocessor.features, outputCol="features"),
        random_forest(sizes, max_depth, min_leaf, label),
    ])
    return RiskModel(preprocessor, fitted(stages, prepared))


def tuned_risk_model(
    df: DataFrame,
    numeric: Sequence[str],
    categories: Sequence[str],
    label: str = "label",
    identifier: str = "id",
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 5,
    folder: str | None = None,
) -> tuple[DataFrame, RiskModel]:
    """The board of a search over a grid (the batch grid, unless another is given) and the forest that
    is refitted with its best parameters. A search with a folder goes on where it was ended."""
    preprocessor = Preprocessor(list(numeric), list(categories)).fit(df)
    prepared = materialize(preprocessor.transform(df).select(identifier, *preprocessor.features, label), "tuning")
    board, forest = grid_search(
        prepared, preprocessor.features, label, identifier, BATCH_GRID if grid is None else grid, folds, folder=folder
    )
    assembler = VectorAssembler(inputCols=preprocessor.features, outputCol="features")
    return board, RiskModel(preprocessor, PipelineModel(stages=[assembler, forest]))
