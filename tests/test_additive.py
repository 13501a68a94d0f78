"""Additive fits, sketches and observed counts: what merges must equal what is computed at once."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from vitalgrid.operators import additive, forecasting, sketches
from vitalgrid.plans import learning, streams
from vitalgrid.session import new_folder
from vitalgrid.sources import tables
from vitalgrid.streaming import files, logs, progress
from vitalgrid.streaming.energy import EnergyStream


@pytest.fixture(scope="module")
def rows(spark):
    random = np.random.default_rng(8)
    x = random.normal(500, 3, (400, 4))
    x[:, 3] = 7.0  # a column that does not vary
    y = x[:, 0] * 2 - x[:, 1] + random.normal(0, 0.5, 400)
    data = [(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    data += [(900, [1.0, None, 2.0, 3.0], 1.0), (901, [1.0, 2.0, 3.0, 4.0], None), (902, [float("nan")] * 4, 1.0)]
    return spark.createDataFrame(data, "id int, features array<double>, target double"), x, y


def test_sums_of_batches_give_the_fit_of_all_rows(spark, rows):
    df, x, y = rows
    centre = 480.0
    parts = [additive.Moments.of(df.filter(F.col("id") % 3 == i), 4, centre) for i in range(3)]
    merged, whole = parts[0] + parts[1] + parts[2], additive.Moments.of(df, 4, centre)
    assert merged.rows == whole.rows == 400
    (w, b), (v, c) = merged.fit(), whole.fit()
    assert np.abs(w - v).max() < 1e-9 and abs(b - c) < 1e-6
    # A plain solution of the penalised standardised equations.
    scale = x[:, :3].std(axis=0)
    z = (x[:, :3] - x[:, :3].mean(axis=0)) / scale
    t = (y - y.mean()) / y.std()
    plain = np.linalg.solve(z.T @ z / 400 + np.eye(3) * additive.PENALTY, z.T @ t / 400) * y.std() / scale
    assert np.abs(w[:3] - plain).max() < 1e-9 and w[3] == 0
    error = y - x @ w - b
    assert abs(merged.mean_squared(w, b) - (error ** 2).mean()) < 1e-6
    again = additive.Moments.none(4, centre).filled(merged.table(spark))
    assert (again.totals == merged.totals).all()
    assert additive.Moments.none(4).fit() is None


def test_it_is_the_regression_of_the_library(rows):
    df, _, y = rows
    kept = df.filter("id < 900").select(array_to_vector("features").alias("features"), ((F.col("target") - y.mean()) / y.std()).alias("target"))
    theirs = LinearRegression(featuresCol="features", labelCol="target", regParam=additive.PENALTY, solver="normal").fit(kept)
    mine, _ = additive.Moments.of(df, 4, 480.0).fit()
    # The library's penalty is divided by the sample deviation of the target, which is 1 up to 1/n.
    assert np.abs(theirs.coefficients.toArray() * y.std() - mine).max() < 1e-4


def test_a_model_that_did_not_learn_is_seen(rows):
    df, _, y = rows
    sums = additive.Moments.of(df, 4, 480.0)
    weights, intercept = sums.fit()
    assert sums.leftover(weights, intercept) < learning.UNEXPLAINED
    assert sums.leftover(np.zeros(4), y.mean()) > 0.3
    assert sums.leftover(weights, intercept + 1) > 0.1


def test_a_stream_refits_from_one_table_of_sums(spark, folder):
    df = tables.series(spark, folder)
    energy = EnergyStream(spark, new_folder(spark, "energy"), steps=5, keep=15, first_windows=50, refit_every=50)
    parts = streams.in_slices(df, "event_id", 6)
    for batch_id, part in enumerate(parts):
        energy.forecast_batch(part, batch_id)
        assert len(logs.Manifest.load(spark, energy.table("moments")).parts) <= 2
    energy.forecast_batch(parts[-1], len(parts) - 1)  # a repeated batch changes nothing
    assert energy.read("history") is None
    model = energy.load(energy.registry.latest())
    taken = energy.registry.facts(energy.registry.latest())["batch_id"]
    seen = df.filter(F.col("event_id").isin([r[0] for p in parts[:taken + 1] for r in p.select("event_id").collect()]))
    windows = forecasting.training_windows(seen, "use_kw", 5).select(F.col("sequence").alias("features"), "target")
    weights, intercept = additive.Moments.of(windows, 5).fit()
    assert np.abs(np.array(model.weights) - weights).max() < 1e-9 and abs(model.intercept - intercept) < 1e-6
    assert additive.AdditiveForecaster.from_facts(model.facts()) == additive.AdditiveForecaster(
        model.steps, model.weights, model.intercept, model.columns)


def test_windows_of_several_columns(spark):
    rows = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]],), ([[1.0, None], [3.0, 4.0]],)], "sequence array<array<double>>")
    model = additive.AdditiveForecaster(2, (1.0, 10.0, 100.0, 1000.0), 0.5, ("a", "b"))
    assert [r["predicted"] for r in model.predict(rows).collect()] == [4321.5, None]


def test_rounds_are_kept_up_to_the_lowest_loss():
    assert forecasting.stop_round([5, 4, 3, 4, 4, 2], 5) == 6
    assert forecasting.stop_round([5, 4, 3, 4, 4, 2], 2) == 3
    assert forecasting.stop_round([5, 5, 5], 9) == 1


def test_boosting_keeps_a_history_of_its_rounds(spark, folder):
    df = tables.series(spark, folder)
    model = forecasting.fit_forecaster(df, "use_kw", 5, kind="boosted", rounds=6, patience=2)
    history = forecasting.round_history(spark, model.run).orderBy("round").collect()
    kept = [r for r in history if r["kept"]]
    assert len(history) == 6 and len(kept) == len(model.stages.stages[-1].trees)
    assert [r["loss"] for r in history] == sorted((r["loss"] for r in history), reverse=True)
    # The model with fewer rounds has the losses that were told after its last round.
    assert abs(model.run["final_val_loss"] - kept[-1]["val_loss"]) < 1e-9
    assert abs(model.run["final_loss"] - kept[-1]["loss"]) < 1e-9


# Sketches ----------------------------------------------------------------------------------


def test_a_profile_of_batches_reads_sketches_only(spark):
    n = 40_000
    df = spark.range(n).select(
        (F.col("id") * 7919 % n).cast("double").alias("x"), (F.col("id") % 37).cast("int").alias("few"),
        F.concat(F.lit("t"), F.col("id") % 9_000).alias("text"),
        F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).when(F.col("id") % 10 == 1, None).otherwise(1.5).alias("holes"),
        F.lit(None).cast("double").alias("none"),
    )
    target = new_folder(spark, "sketches")
    for batch in range(5):
        sketches.append_sketch(df.filter(F.floor(F.col("x") / 8_000) == batch), target, batch)
    sketches.append_sketch(df.filter("x >= 32000"), target, 4)  # a repeated batch counts once
    found = {r["column"]: r for r in sketches.stored_profile(spark, target).collect()}
    assert {f.split("/")[-2] for f in sketches.stored_profile(spark, target).inputFiles()} == {f"batch_id={i}" for i in range(5)}
    x = found["x"]
    assert (x["n_rows"], x["n_values"], x["low"], x["high"]) == (n, n, 0, n - 1)
    assert abs(x["mean"] - (n - 1) / 2) < 1e-6 and abs(x["std"] - n / 12 ** 0.5) < 1
    assert abs(x["n_distinct"] / n - 1) < 0.03 and abs(found["text"]["n_distinct"] / 9_000 - 1) < 0.03
    for q in (25, 50, 75):
        assert abs(x[f"q{q}"] / n - q / 100) < 0.01
    assert found["few"]["n_distinct"] == 37 and found["few"]["q50"] == 18
    assert (found["holes"]["n_values"], found["holes"]["n_distinct"], found["holes"]["std"]) == (n * 8 // 10, 1, 0)
    assert found["none"]["n_values"] == 0 and found["none"]["q50"] is None and found["text"]["mean"] is None
    assert sketches.stored_medians(spark, target, ["few", "none"]) == {"few": 18.0, "none": None}


def test_a_large_mean_does_not_spoil_the_deviation(spark):
    df = spark.range(1_000).select((F.col("id") % 2 + 1_000_000).cast("double").alias("x"))
    row = sketches.profile(sketches.sketch(df)).first()
    assert abs(row["std"] - 0.50025) < 1e-3


# Observed counts ---------------------------------------------------------------------------


def test_a_write_tells_its_counts_without_a_job_of_its_own(spark):
    context = spark.sparkContext
    context.setJobGroup("observed-write", "")
    try:
        told = progress.write_observed(
            spark.range(100), progress.tally(F.col("id") < 60), lambda df: df.write.parquet(new_folder(spark, "rows"))
        )
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert told == {"sent": 60, "failed": 40}
    assert len(context.statusTracker().getJobIdsForGroup("observed-write")) == 1


def test_stream_progress_is_one_record_a_batch(spark):
    from vitalgrid.streaming import runtime

    source, target = new_folder(spark, "source"), new_folder(spark, "progress")
    checkpoint, out = new_folder(spark, "checkpoint"), new_folder(spark, "out")
    with progress.ProgressLog(spark, target) as log:
        for n in (5, 8):
            spark.range(n).coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema("id long").parquet(source)
            runtime.drain(
                progress.observed(stream, "ids", progress.tally(F.col("id") > 1)),
                lambda df, i: logs.append_batch(df, out, i), checkpoint,
            )
    rows = [(r["batch_id"], r["input_rows"], r["metrics"]["ids"]) for r in log.read().orderBy("batch_id").collect()]
    assert rows == [(0, 5, {"sent": 3.0, "failed": 2.0}), (1, 8, {"sent": 6.0, "failed": 2.0})]
    assert len([n for n in files.names(spark, target) if n.endswith(".json")]) == 2
