"""Queries that run as streams.

Each publishes a table as keyed JSON messages in two slices of the order and drains the stream
after every slice, so that the second run starts from the checkpoint of the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from vitalgrid.functions.columns import rounded
from vitalgrid.functions.scoring import absolute_error, percent_error
from vitalgrid.operators import metrics
from vitalgrid.plans.energy import forecasts, sequence_text
from vitalgrid.plans.learning import valid_scores
from vitalgrid.session import new_folder
from vitalgrid.sources import messages, tables
from vitalgrid.streaming import logs, progress, rolling, runtime
from vitalgrid.streaming.clinical import ClinicalStream, initial_training
from vitalgrid.streaming.energy import EnergyStream

SLICES = 2
FORECAST_SLICES = 10
STEPS = 60

READING = StructType([
    StructField("series_id", LongType()), StructField("event_id", LongType()),
    StructField("time_us", LongType()), StructField("data_type", StringType()),
    StructField("use_kw", DoubleType()),
])
FORECAST = StructType([
    StructField("event_id", LongType()), StructField("actual", DoubleType()),
    StructField("predicted", DoubleType()),
])


def in_slices(df: DataFrame, order: str, slices: int = SLICES, even: bool = False) -> list[DataFrame]:
    """The table in `slices` parts along an order column, of about as many rows each or, `even`, of
    equal spans of whole numbers; rows without an order come first."""
    if even:
        low, high = df.agg(F.min(order), F.max(order)).first()
        cuts = [] if low is None else [low + (high - low) * i // slices for i in range(1, slices)]
    else:
        cuts = df.agg(
            F.percentile_approx(order, [i / slices for i in range(1, slices)], 1000).alias("cuts")
        ).first()["cuts"]
    part = sum((F.coalesce((F.col(order) > F.lit(cut)).cast("int"), F.lit(0)) for cut in cuts), F.lit(0))
    sliced = df.withColumn("_slice", part)
    return [sliced.filter(F.col("_slice") == i).drop("_slice") for i in range(slices)]


def publish_and_drain(
    spark: SparkSession, parts: list[DataFrame], topic: str, drain: Callable[[DataFrame], None]
) -> None:
    for part in parts:
        messages.write_messages(part, topic, kind="files")
        drain(messages.message_stream(spark, topic, kind="files"))


def _meter_messages(spark, folder, slices, even=False) -> list[DataFrame]:
    df = tables.series(spark, folder).withColumn("time_us", F.unix_micros("time")).select(*READING.names)
    parts = in_slices(df, "time_us", slices, even)
    return [messages.encode_messages(part, F.col("event_id")) for part in parts]


def _readings(stream: DataFrame) -> DataFrame:
    good, _ = messages.split_corrupt(messages.decode_json(stream, READING))
    return good.withColumn("time", F.timestamp_micros("time_us")).drop("time_us")


def _run(spark, folder, handle, parse=_readings, mode="append", slices=SLICES, even=False) -> None:
    """Publishes the meter series and drains it through a handler."""
    checkpoint, topic = new_folder(spark, "checkpoint"), new_folder(spark, "topic")
    publish_and_drain(
        spark, _meter_messages(spark, folder, slices, even), topic,
        lambda stream: runtime.drain(parse(stream), handle, checkpoint, mode),
    )


def stream_source(spark, folder):
    """Keys and fields of the messages as they come out of the source."""
    target = new_folder(spark, "log")

    def decode(stream):
        good, _ = messages.split_corrupt(messages.decode_json(stream, READING, keep=["key"]))
        return good.withColumn("key", F.col("key").cast("string"))

    _run(spark, folder, lambda df, i: logs.append_batch(df, target, i), decode)
    return logs.read_log(spark, target).select("key", "series_id", "event_id", "data_type", "use_kw")


def stream_append(spark, folder):
    """One feed of the series, filtered on the stream and appended to a log."""
    target = new_folder(spark, "log")
    _run(
        spark, folder, lambda df, i: logs.append_batch(df, target, i),
        lambda stream: _readings(stream).filter(F.col("data_type") == "purchase"),
    )
    return logs.read_log(spark, target).select("series_id", "event_id", "use_kw")


def stream_sequence(spark, folder):
    energy = EnergyStream(spark, new_folder(spark, "energy"), steps=STEPS)
    _run(spark, folder, energy.sequence_batch)
    return energy.read("sequences").select(
        "series_id", "event_id", sequence_text("sequence").alias("sequence")
    )


def stream_state_sequence(spark, folder):
    """The same windows from keyed state, and from which reading on a series can have a model."""
    target = new_folder(spark, "windows")
    _run(
        spark, folder, lambda df, i: logs.append_batch(df, target, i),
        lambda stream: rolling.keyed_windows(_readings(stream), steps=STEPS),
    )
    return logs.read_log(spark, target).select(
        "series_id", "event_id", "position", "warm", sequence_text("sequence").alias("sequence")
    )


def _forecast_stream(spark, folder, steps: int) -> EnergyStream:
    """Many small batches: the first ones stay cold, as no series has a full window yet."""
    energy = EnergyStream(spark, new_folder(spark, "energy"), steps=steps, high=100.0, medium=50.0)
    _run(spark, folder, energy.forecast_batch, slices=FORECAST_SLICES, even=True)
    return energy


PREDICTIONS = (
    "series_id long, event_id long, clock string, actual double, predicted double, error double, error_pct double,"
    " tier string, model_version int"
)


def _predictions(spark, folder, steps: int) -> DataFrame:
    """What the stream forecast; no rows if it stayed cold."""
    made = _forecast_stream(spark, folder, steps).read("predictions")
    return spark.createDataFrame([], PREDICTIONS) if made is None else made


def stream_forecast(spark, folder):
    return _predictions(spark, folder, STEPS).select(
        "series_id", "event_id", "clock", "actual", "predicted", "error", "error_pct", "tier",
        "model_version",
    )


def stream_forecast_rows(spark, folder):
    """Which readings a stream with a window of five is to forecast, and by which version of the model."""
    return _predictions(spark, folder, 5).select("series_id", "event_id", "clock", "actual", "model_version")


def stream_additive(spark, folder):
    """The stream with a window of one reading, whose fits and forecasts have a closed form."""
    return _predictions(spark, folder, 1).select(
        "series_id", "event_id", "actual", rounded("predicted").alias("predicted"), rounded("error").alias("error"),
        rounded("error_pct").alias("error_pct"), "tier", "model_version",
    )


def stream_metrics(spark, folder):
    """Running error report over all forecasts so far, as of the last batch."""
    records = forecasts(spark, folder).select("event_id", "actual", "predicted")
    parts = [messages.encode_messages(p, F.col("event_id")) for p in in_slices(records, "event_id")]
    topic, checkpoint, target = (new_folder(spark, n) for n in ("topic", "checkpoint", "report"))

    def report(stream):
        good, _ = messages.split_corrupt(messages.decode_json(stream, FORECAST))
        error = absolute_error(F.col("predicted"), F.col("actual"))
        rows = good.withColumn("error", error).withColumn(
            "error_pct", percent_error(F.col("error"), F.col("actual"))
        )
        runtime.drain(
            metrics.forecast_metrics(rows), lambda df, i: logs.append_batch(df, target, i),
            checkpoint, mode="complete",
        )

    publish_and_drain(spark, parts, topic, report)
    log = logs.read_log(spark, target)
    last = log.agg(F.max("batch_id")).first()[0]
    return log.filter(F.col("batch_id") == last).drop("batch_id")


def stream_progress(spark, folder):
    """Per micro-batch of a feed with broken messages: how many were sent and failed, as the stream
    itself reports it."""
    target, topic, checkpoint = (new_folder(spark, n) for n in ("progress", "topic", "checkpoint"))
    df = tables.patients(spark, folder).drop("dataset")
    broken = tables.read_table(spark, folder, "documents").select(
        F.concat(F.lit("doc_"), "doc_id").alias("key"), F.col("text").alias("value")
    )
    parts = [messages.encode_messages(part, F.col("id")) for part in in_slices(df, "id", even=True)]
    clinical = ClinicalStream(spark, new_folder(spark, "clinical"))

    def run(stream):
        good = F.col(messages.CORRUPT).isNull()
        runtime.drain(
            progress.observed(clinical.parse(stream), "messages", progress.tally(good)), clinical.route_batch, checkpoint
        )

    with progress.ProgressLog(spark, target) as log:
        publish_and_drain(spark, [*parts, broken], topic, run)
    told = F.col("metrics")["messages"]
    return log.read().select(
        "batch_id", told["sent"].cast("long").alias("sent"), told["failed"].cast("long").alias("failed"),
    )


# Clinical ----------------------------------------------------------------------------------


def _clinical_messages(spark, folder) -> list[DataFrame]:
    df = tables.patients(spark, folder).drop("dataset")
    return [messages.encode_messages(part, F.col("id")) for part in in_slices(df, "id")]


def dual_stream(spark, folder):
    """Rows per route, of patients and of documents that are no JSON at all."""
    clinical = ClinicalStream(spark, new_folder(spark, "clinical"))
    documents = tables.read_table(spark, folder, "documents").select(
        F.concat(F.lit("doc_"), "doc_id").alias("key"), F.col("text").alias("value")
    )
    publish_and_drain(
        spark, [*_clinical_messages(spark, folder), documents], new_folder(spark, "topic"),
        lambda stream: runtime.drain(
            clinical.parse(stream), clinical.route_batch, clinical.table("checkpoints/route")
        ),
    )
    routes = None
    for name in ("to_score", "to_train", "quarantine"):
        part = clinical.read(name).agg(
            F.lit(name).alias("route"), F.count(F.lit(1)).alias("rows"),
        )
        routes = part if routes is None else routes.unionByName(part)
    return routes


def stream_score(spark, folder):
    """Unlabelled rows scored on the stream by a forest fitted on the labelled table."""
    clinical = ClinicalStream(spark, new_folder(spark, "clinical"))
    rows = messages.decode_clinical(
        messages.encode_messages(tables.patients(spark, folder).drop("dataset"), F.col("id"))
    ).drop(messages.CORRUPT)
    initial_training(spark, rows.filter("num is not null"), clinical.registry)

    def score(stream):
        good = messages.split_corrupt(clinical.parse(stream))[0]
        runtime.drain(
            good.filter(F.col("num").isNull()), clinical.score_batch, clinical.table("checkpoints/score")
        )

    publish_and_drain(spark, _clinical_messages(spark, folder), new_folder(spark, "topic"), score)
    return clinical.read("predictions").select("id", "model_version", valid_scores().alias("valid"))


def _trained(spark, folder) -> ClinicalStream:
    clinical = ClinicalStream(spark, new_folder(spark, "clinical"))

    def train(stream):
        good = messages.split_corrupt(clinical.parse(stream))[0]
        runtime.drain(
            good.filter(F.col("num").isNotNull()), clinical.train_batch, clinical.table("checkpoints/train")
        )

    publish_and_drain(spark, _clinical_messages(spark, folder), new_folder(spark, "topic"), train)
    return clinical


def stream_train_blocks(spark, folder):
    """Which block every labelled row was trained in."""
    return _trained(spark, folder).read("blocks").select("id", "block")


def stream_models(spark, folder):
    """Versions that the training stream published."""
    clinical = _trained(spark, folder)
    records = logs.read_log(spark, f"{clinical.registry.folder}/versions")
    return records.select(
        F.col("batch_id").alias("version"),
        F.get_json_object("meta", "$.facts.mode").alias("mode"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        stream_source, stream_append, stream_sequence, stream_state_sequence, stream_forecast,
        stream_forecast_rows, stream_additive,
        stream_metrics, stream_progress, dual_stream, stream_score, stream_train_blocks, stream_models,
    )
}
