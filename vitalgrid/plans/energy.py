"""Queries over the meter series: windows, baseline forecast, errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions.columns import rounded
from vitalgrid.functions.scoring import absolute_error, alert_tier as alert, clock_text, percent_error
from vitalgrid.operators import additive, metrics, sequences
from vitalgrid.operators.forecasting import fit_forecaster, readings, round_history, training_windows
from vitalgrid.plans.learning import checked_forecasts
from vitalgrid.schemas import ENERGY_EVENT, ENERGY_FEATURES, ENERGY_TARGET, METERS
from vitalgrid.session import materialize, new_folder
from vitalgrid.sources import messages, tables
from vitalgrid.streaming import logs

STEPS = 60
COLD_START = STEPS + 100
HIGH, MEDIUM = 100.0, 50.0


def sequence_text(sequence: Column | str) -> Column:
    """The whole window as text, in hundredths."""
    return F.array_join(
        F.transform(sequence, lambda x: F.round(x * 100).cast("bigint").cast("string")), ","
    )


def forecasts(spark: SparkSession, folder: str, rows_per_chunk: int | None = None) -> DataFrame:
    """Naive forecast: the reading before. First readings have none and are left out."""
    return with_errors(
        sequences.previous_value(
            tables.series(spark, folder), "use_kw", "predicted", rows_per_chunk=rows_per_chunk
        )
        .filter(F.col("predicted").isNotNull())
        .withColumnRenamed("use_kw", "actual")
    )


def with_errors(df: DataFrame) -> DataFrame:
    error = absolute_error(F.col("predicted"), F.col("actual"))
    return df.withColumns({
        "error": error, "error_pct": percent_error(error, F.col("actual")),
    })


def tail_n(spark, folder):
    df = tables.series(spark, folder)
    return sequences.newest_rows(df, 1000, "time", "event_id").select("event_id", "series_id", "use_kw")


def filter_type(spark, folder):
    return tables.series(spark, folder).filter(F.col("data_type") == "purchase").select(
        "event_id", "series_id", "use_kw"
    )


def derive_weather(spark, folder):
    df = messages.derive_weather(tables.series(spark, folder).select("event_id", "use_kw"), "use_kw")
    return df.select("event_id", *[rounded(c).alias(c) for c in messages.WEATHER])


def epoch_format(spark, folder):
    df = tables.series(spark, folder)
    epoch = F.unix_seconds("time")
    return df.select("event_id", epoch.alias("epoch"), clock_text(epoch).alias("clock"))


def downsample(spark, folder):
    return sequences.downsample(tables.series(spark, folder), 10).select("event_id", "series_id", "use_kw")


def sliding_sequence(spark, folder):
    return sequences.sliding_sequence(tables.series(spark, folder), "use_kw", STEPS).select(
        "series_id", "event_id", sequence_text("sequence").alias("sequence")
    )


def next_step_target(spark, folder):
    windows = sequences.sliding_sequence(
        tables.series(spark, folder), "use_kw", STEPS, with_target=True
    )
    return windows.select("series_id", "event_id", sequence_text("sequence").alias("sequence"), "target")


def latest_sequence(spark, folder):
    return sequences.latest_sequence(tables.series(spark, folder), "use_kw", STEPS).select(
        "series_id", "event_id", sequence_text("sequence").alias("sequence")
    )


def bounded_history(spark, folder):
    return sequences.bounded_history(tables.series(spark, folder), STEPS + 10).select(
        "series_id", "event_id", "use_kw"
    )


def energy_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The series as decoded energy events: eight meters and four weather columns a reading, sent
    and read back as keyed JSON."""
    use = F.col("use_kw")
    meters = [use.alias(ENERGY_TARGET)] + [
        (use * (i / 10)).alias(name) for i, name in enumerate(METERS[1:8], 1)
    ]
    df = tables.series(spark, folder).select("series_id", "event_id", "time", *meters, "data_type")
    sent = messages.derive_weather(df, ENERGY_TARGET).withColumn("micros", F.unix_micros("time"))
    key = F.concat_ws(":", "series_id", "event_id", "micros")
    sent = sent.withColumn("time", F.unix_seconds("time"))
    names = [f.name for f in ENERGY_EVENT.fields if f.name in sent.columns]
    read, _ = messages.split_corrupt(
        messages.decode_json(messages.encode_messages(sent, key, names), ENERGY_EVENT, ["key"])
    )
    ids = F.split(F.col("key"), ":")
    return read.withColumns({
        "series_id": ids[0].cast("bigint"), "event_id": ids[1].cast("bigint"),
        "time": F.timestamp_micros(ids[2].cast("bigint")),
    }).drop("key")


def energy_windows(spark, folder):
    """Windows over the twelve columns of an energy event, with the next load as the target."""
    windows = sequences.sliding_sequence(
        energy_feed(spark, folder), readings(ENERGY_TARGET, ENERGY_FEATURES), STEPS, with_target=True,
        target=ENERGY_TARGET,
    )
    return windows.select(
        "series_id", "event_id", sequence_text(F.flatten("sequence")).alias("sequence"), "target"
    )


def energy_forecast(spark, folder):
    """Held-out forecasts of the load from the twelve columns of the last 60 events."""
    df = energy_feed(spark, folder)
    df = materialize(df.select("series_id", "event_id", "time", *[F.col(f"`{c}`") for c in ENERGY_FEATURES]), "events")
    windows = materialize(training_windows(df, ENERGY_TARGET, STEPS, columns=ENERGY_FEATURES), "windows")
    model = fit_forecaster(df, ENERGY_TARGET, STEPS, columns=ENERGY_FEATURES, stored=windows)
    return checked_forecasts(model, windows)


def _training_rows(spark, folder, steps):
    windows = sequences.sliding_sequence(tables.series(spark, folder), "use_kw", steps, with_target=True)
    return windows.select("series_id", "event_id", "sequence", "target")


def forecast_moments(spark, folder):
    """The sums that the additive fit over the last 60 readings is made of."""
    rows = _training_rows(spark, folder, STEPS).select(additive.lags("sequence").alias("features"), "target")
    return additive.product_sums(rows, STEPS).select("i", "j", F.round("total", 4).alias("total"))


def additive_forecast(spark, folder):
    """Forecasts of an additive fit of each reading on the one before, and the fit's own loss."""
    rows = materialize(_training_rows(spark, folder, 1), "windows")
    sums = additive.Moments.of(rows.select(additive.lags("sequence").alias("features"), "target"), 1)
    model = additive.AdditiveForecaster.of(sums, 1)
    if model is None:
        return rows.select("series_id", "event_id", F.lit(0.0).alias("predicted"), F.lit(0.0).alias("loss"))
    return model.predict(rows).select(
        "series_id", "event_id", rounded("predicted").alias("predicted"),
        F.lit(round(model.run["final_loss"], 4)).alias("loss"),
    )


def retrain_marks(spark, folder):
    """Every 100th forecast of a feed."""
    marks = sequences.retrain_marks(forecasts(spark, folder), 100, group=["data_type"])
    return marks.select("data_type", "event_id", "position", "run")


def chrono_split(spark, folder):
    return sequences.chrono_split(tables.series(spark, folder)).select("series_id", "event_id", "part")


def chrono_split_three(spark, folder):
    """Train, validation tail and test of every series."""
    parts = sequences.chrono_split(tables.series(spark, folder), 0.2, validation=0.1)
    return parts.select("series_id", "event_id", "part")


def boosted_forecast(spark, folder):
    """Losses after every round of the boosted forecaster, and which rounds its validation tail kept."""
    model = fit_forecaster(tables.series(spark, folder), "use_kw", STEPS, kind="boosted")
    run = model.run if model else {"rounds": []}
    return round_history(spark, run)


def recent_k(spark, folder):
    rows = metrics.recent(forecasts(spark, folder), 10, "time", "event_id")
    return rows.select("event_id", "actual", "predicted", rounded("error").alias("error"))


def forecast_baseline(spark, folder):
    return forecasts(spark, folder).select("series_id", "event_id", "actual", "predicted")


def _error_rows(df):
    return df.select(
        "event_id", "actual", "predicted", rounded("error").alias("error"),
        rounded("error_pct").alias("error_pct"),
    )


def forecast_error(spark, folder):
    return _error_rows(forecasts(spark, folder))


def forecast_metrics(spark, folder):
    return metrics.forecast_metrics(forecasts(spark, folder))


def series_stats(spark, folder):
    return metrics.series_stats(forecasts(spark, folder))


def alert_tier(spark, folder):
    return forecasts(spark, folder).select(
        "event_id", alert(F.col("predicted"), HIGH, MEDIUM).alias("tier")
    )


def cold_start_gate(spark, folder):
    """Per feed: has the history reached the rows a first model needs, and with which row."""
    return sequences.cold_start(tables.series(spark, folder), COLD_START, group=["data_type"])


def prediction_log(spark, folder):
    """Forecast records written to the log, one of the batches twice."""
    target = new_folder(spark, "prediction_log")
    records = _error_rows(forecasts(spark, folder))
    small = F.coalesce(F.col("error") < 20, F.lit(False))  # a null error goes with the large ones
    for batch, part in ((0, records.filter(small)), (1, records.filter(~small)), (1, records.filter(~small))):
        logs.append_batch(part, target, batch)
    return logs.read_log(spark, target).drop("batch_id")


QUERIES = {
    f.__name__: f
    for f in (
        tail_n, filter_type, derive_weather, epoch_format, downsample, sliding_sequence,
        next_step_target, latest_sequence, bounded_history, retrain_marks, chrono_split, recent_k,
        forecast_baseline, forecast_error, forecast_metrics, series_stats, alert_tier,
        cold_start_gate, prediction_log, energy_windows, energy_forecast,
        forecast_moments, additive_forecast, chrono_split_three, boosted_forecast,
    )
}
