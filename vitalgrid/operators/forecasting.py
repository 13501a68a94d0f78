"""Next-reading forecast from the last readings of a series."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions.scoring import absolute_error, percent_error
from vitalgrid.operators.encoding import collect_scale, fit_scale, inverse_scale, scaled
from vitalgrid.operators.sequences import series_positions, sliding_sequence
from vitalgrid.session import materialize, spread

PREDICTION = "scaled_prediction"


@dataclass
class Forecaster:
    """Scales and the regression on scaled lags: of the target alone, or of several columns."""

    steps: int
    scale: tuple[float, float]
    stages: PipelineModel
    run: dict
    columns: dict[str, tuple[float, float]] = field(default_factory=dict)

    def predict(self, windows: DataFrame, sequence: str = "sequence") -> DataFrame:
        """Adds `predicted` in the target's own unit to rows with a window of raw readings."""
        inputs = scaled_lags(sequence, self.scale, self.columns)
        ready = windows.withColumn("features", array_to_vector(inputs))
        return (
            self.stages.transform(ready)
            .withColumn("predicted", inverse_scale(F.col(PREDICTION), self.scale))
            .drop("features", PREDICTION)
        )


def readings(value: str, columns: Sequence[str] = ()) -> Column:
    """What a window holds of each row: the value, or several columns as an array."""
    if not columns:
        return F.col(f"`{value}`")
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns])


def scaled_lags(sequence: str, scale, columns: Mapping[str, tuple[float, float]]) -> Column:
    if not columns:
        return F.transform(sequence, lambda x: scaled(x, scale))
    return F.flatten(F.transform(sequence, lambda x: F.array(*[
        scaled(x[i], each) for i, each in enumerate(columns.values())
    ])))


def _regression():
    return LinearRegression(
        featuresCol="features", labelCol="scaled_target", predictionCol=PREDICTION,
        regParam=1e-3, maxIter=100,
    )


def training_windows(
    df: DataFrame, value: str, steps: int, share: float = 0.2, columns: Sequence[str] = (), **how
) -> DataFrame:
    """Windows with their target, and `held` for the last `share` of each series' windows.

    The rows are numbered while they are narrow: a series of n rows has n - steps windows.
    """
    held = F.col("position") > F.col("group_rows") - F.ceil((F.col("group_rows") - steps) * F.lit(share))
    marked = series_positions(df, **how).withColumn("held", held).drop("position", "group_rows")
    return sliding_sequence(marked, readings(value, columns), steps, with_target=True, target=value, **how)


def stop_round(losses: Sequence[float], patience: int) -> int:
    """Number of rounds to keep: up to the lowest loss before `patience` rounds in a row without a lower one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def _boosted(ready: DataFrame, rounds: int, patience: int) -> tuple[PipelineModel, list[dict]]:
    """Boosting on the rows that are not held; the held ones decide how many rounds are kept.

    All rounds are grown and the loss after each is measured in one pass over either part. The fit
    with fewer rounds grows the same first trees.
    """
    train, tail = ready.filter(~F.col("held")), ready.filter("held")

    def grown(n: int):
        return GBTRegressor(
            featuresCol="features", labelCol="scaled_target", predictionCol=PREDICTION, maxIter=n,
            maxDepth=3, stepSize=0.1, seed=42,
        ).fit(train)

    model = grown(rounds)
    losses = model.evaluateEachIteration(train, "squared")
    tail_losses = losses if tail.isEmpty() else model.evaluateEachIteration(tail, "squared")
    kept = stop_round(tail_losses, patience)
    history = [
        {"round": i + 1, "loss": float(a), "val_loss": float(b), "kept": i < kept}
        for i, (a, b) in enumerate(zip(losses, tail_losses))
    ]
    return PipelineModel(stages=[model if kept == rounds else grown(kept)]), history


def fit_forecaster(
    df: DataFrame,
    value: str = "use_kw",
    steps: int = 60,
    kind: str = "linear",
    rounds: int = 30,
    share: float = 0.2,
    columns: Sequence[str] = (),
    patience: int = 5,
    stored: DataFrame | None = None,
) -> Forecaster | None:
    """One regression pooled over all series; the newest `share` of each series is held out.

    The held-out rows stop the boosted kind: once `patience` rounds in a row have not lowered their
    loss, the rounds up to the lowest are kept, and `run["rounds"]` has the losses after every round.
    `stored` is a written table of the `training_windows` of the same arguments, if there is one.

    None if no window is left to train on: no series has `steps` rows and a next one yet.
    """
    scales = collect_scale(fit_scale(df, list(dict.fromkeys([value, *columns]))))
    scale, lagged = scales[value], {c: scales[c] for c in columns}
    windows = training_windows(df, value, steps, share, columns) if stored is None else stored
    inputs = scaled_lags("sequence", scale, lagged)
    ready = windows.select(
        array_to_vector(inputs).alias("features"),
        scaled(F.col("target"), scale).alias("scaled_target"), "held",
    )
    # The fit and the losses read the windows; they are written once, to the shared folder. A regression
    # takes two passes, and scales stored windows on the way.
    if stored is None or kind == "boosted":
        ready = spread(materialize(ready, "windows"))
    samples = ready.filter(~F.col("held")).count()
    if not samples:
        return None
    history: list[dict] = []
    if kind == "boosted":
        stages, history = _boosted(ready, rounds, patience)
    else:
        stages = Pipeline(stages=[_regression()]).fit(ready.filter(~F.col("held")))
    error = F.col(PREDICTION) - F.col("scaled_target")
    losses = dict(stages.transform(ready).groupBy("held").agg(F.avg(error * error)).collect())
    run = {
        "samples": samples, "rounds": history, "final_loss": losses.get(False), "final_val_loss": losses.get(True),
    }
    return Forecaster(steps, scale, stages, run, lagged)


def score_windows(model: Forecaster, windows: DataFrame) -> DataFrame:
    """Forecast, actual value and errors of windows that carry their target."""
    scored = model.predict(windows).withColumnRenamed("target", "actual")
    error = absolute_error(F.col("predicted"), F.col("actual"))
    return scored.withColumns({
        "error": error, "error_pct": percent_error(error, F.col("actual")),
    }).drop("sequence")


def training_runs(spark: SparkSession, runs: Sequence[dict]) -> DataFrame:
    """Training history as a table: one row per run."""
    def loss(run, name):
        value = run.get(name)
        return None if value is None or math.isnan(value) else float(value)

    return spark.createDataFrame(
        [
            (i, int(run["samples"]), loss(run, "final_loss"), loss(run, "final_val_loss"))
            for i, run in enumerate(runs, 1)
        ],
        "run int, samples bigint, final_loss double, final_val_loss double",
    ).withColumn("timestamp", F.current_timestamp())


def round_history(spark: SparkSession, run: dict) -> DataFrame:
    """Losses of a boosted fit, one row per round."""
    rows = [(r["round"], r["loss"], r["val_loss"], r["kept"]) for r in run["rounds"]]
    return spark.createDataFrame(rows, "round int, loss double, val_loss double, kept boolean")
