"""Streams against batches, restarts, repeated batches, models."""

import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import classifiers, forecasting, sequences
from vitalgrid.operators.classifiers import Sizes
from vitalgrid.operators.registry import Registry
from vitalgrid.plans import learning, streams
from vitalgrid.session import new_folder
from vitalgrid.sources import messages, tables
from vitalgrid.streaming import logs, runtime
from vitalgrid.streaming.clinical import ClinicalStream, initial_training
from vitalgrid.streaming.energy import EnergyStream

TREES = Sizes(trees=3)


def clinical_rows(spark, folder):
    sent = messages.encode_messages(tables.patients(spark, folder).drop("dataset"), F.col("id"))
    return messages.decode_clinical(sent).drop(messages.CORRUPT)


def test_window_stream_equals_batch_and_survives_repeats(spark, folder):
    df = tables.series(spark, folder)
    energy = EnergyStream(spark, new_folder(spark, "energy"), steps=10, keep=20, compact_every=1)
    parts = streams.in_slices(df, "event_id")
    for batch_id, part in enumerate(parts):
        energy.sequence_batch(part, batch_id)
    energy.sequence_batch(parts[-1], len(parts) - 1)  # a repeated batch
    got = energy.read("sequences").select("series_id", "event_id", "sequence")
    want = sequences.sliding_sequence(df, "use_kw", 10).select("series_id", "event_id", "sequence")
    assert got.count() == want.count() > 0
    assert want.exceptAll(got).count() == 0
    tail = energy._tail(len(parts)).groupBy("series_id").count().agg(F.max("count")).first()[0]
    assert tail <= 20


def test_compaction_keeps_idle_series(spark):
    def rows(series, times):
        return spark.createDataFrame(
            [(series, t, t, float(t)) for t in times], "series_id int, event_id int, time int, use_kw double"
        )

    energy = EnergyStream(spark, new_folder(spark, "energy"), steps=4, keep=6, compact_every=2)
    for batch_id, batch in enumerate((rows(1, range(3)), rows(2, range(9)), rows(2, range(9, 11)), rows(2, [11]), rows(1, [3, 4]))):
        energy.sequence_batch(batch, batch_id)
    got = energy.read("sequences").filter("series_id = 1").orderBy("event_id").collect()
    assert [r["sequence"] for r in got] == [[0.0, 1.0, 2.0, 3.0], [1.0, 2.0, 3.0, 4.0]]
    assert energy._tail(5).count() == 5 + 6


def test_a_short_window_carries_over_few_rows(spark):
    """What a batch stores and the next one reads is in proportion to the window."""
    rows = spark.range(200).select((F.col("id") % 2).alias("series_id"), F.col("id").alias("event_id"), F.col("id").alias("time"), F.col("id").cast("double").alias("use_kw"))
    energy = EnergyStream(spark, new_folder(spark, "energy"), steps=1)
    energy.sequence_batch(rows, 0)
    assert energy._tail(1).count() == 2 * 11
    assert EnergyStream(spark, new_folder(spark, "energy")).keep == 70


def test_cold_start_then_forecasts_then_refit(spark, folder):
    df = tables.series(spark, folder)
    energy = EnergyStream(spark, new_folder(spark, "energy"), steps=5, keep=15)
    first = df.filter("event_id < 100")
    energy.forecast_batch(first, 0)
    assert energy.registry.latest() is None and energy.read("predictions") is None
    energy.forecast_batch(df.filter("event_id between 100 and 499"), 1)
    assert energy.registry.latest() == 2
    energy.forecast_batch(df.filter("event_id >= 500"), 2)
    made = energy.read("predictions")
    assert made.filter("batch_id = 2").count() == df.filter("event_id >= 500").count()
    assert energy.registry.latest() == 3 and energy.read("runs").count() == 2
    wrong = made.filter(F.abs(F.abs(F.col("predicted") - F.col("actual")) - F.col("error")) > 1e-9)
    assert wrong.count() == 0


def test_default_stream_stays_cold_until_windows_are_there(spark, folder):
    """Sparse batches of many series: rows enough, but for long no series with a full window."""
    df = tables.series(spark, folder)
    energy = EnergyStream(spark, new_folder(spark, "energy"))
    versions, made = [], []
    for batch_id, part in enumerate(streams.in_slices(df, "event_id", 10)):
        energy.forecast_batch(part, batch_id)
        versions.append(energy.registry.latest())
        predictions = energy.read("predictions")
        made.append(predictions.count() if predictions is not None else 0)
    windows = sequences.sliding_sequence(df, "use_kw", 60, with_target=True).count()
    assert versions[0] is None and versions[4] is None
    if windows >= 200:
        assert versions[-1] is not None and made[-1] > 0
    else:  # too few in this table: still cold, and still running
        assert made[-1] == 0 or versions[-1] is not None


def test_two_queries_with_their_triggers_on_one_source(spark, folder):
    clinical = ClinicalStream(spark, new_folder(spark, "clinical"), sizes=TREES)
    rows = tables.patients(spark, folder).drop("dataset").filter("id < 200")
    topic = new_folder(spark, "topic")
    messages.write_messages(messages.encode_messages(rows, F.col("id")), topic, kind="files")
    initial_training(spark, clinical_rows(spark, folder).filter("num is not null"), clinical.registry, TREES)
    source = messages.message_stream(spark, topic, kind="files")
    queries = clinical.start_dual(source, runtime.SCORE_TRIGGER, runtime.TRAIN_TRIGGER)
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    want = rows.groupBy(F.col("num").isNull().alias("unlabelled")).count().collect()
    want = {r["unlabelled"]: r["count"] for r in want}
    assert clinical.read("predictions").count() == want[True]
    assert clinical.read("blocks").count() == want[False] // 5 * 5
    assert clinical.registry.latest() >= 1


def test_rows_wait_for_a_model(spark, folder):
    rows = clinical_rows(spark, folder)
    clinical = ClinicalStream(spark, new_folder(spark, "clinical"), sizes=TREES)
    unlabelled = rows.filter("num is null")
    clinical.score_batch(unlabelled.filter("id < 500"), 0)
    assert clinical.read("predictions") is None
    clinical.train_batch(rows.filter("num is not null and id < 400"), 0)
    clinical.score_batch(unlabelled.filter("id >= 500"), 1)
    clinical.score_batch(unlabelled.filter("id >= 500"), 1)
    scored = clinical.read("predictions")
    assert scored.count() == unlabelled.count() == scored.select("id").distinct().count()
    bad = scored.filter(
        (F.col("probability_disease") < 0) | (F.col("probability_disease") > 1)
        | (F.abs(F.col("probability_disease") + F.col("probability_no_disease") - 1) > 1e-9)
    )
    assert bad.count() == 0


def test_blocks_are_complete_and_trained_once(spark, folder):
    rows = clinical_rows(spark, folder).filter("num is not null")
    clinical = ClinicalStream(spark, new_folder(spark, "clinical"), sizes=TREES, incremental=True)
    clinical.train_batch(rows.filter("id < 4"), 0)  # fills no block
    assert clinical.registry.latest() is None
    clinical.train_batch(rows.filter("id between 4 and 32"), 1)
    clinical.train_batch(rows.filter("id between 4 and 32"), 1)
    clinical.train_batch(rows.filter("id between 33 and 70"), 2)
    table = clinical.read("blocks")
    sizes = [r["count"] for r in table.groupBy("block").count().collect()]
    total = rows.filter("id <= 70").count()
    assert set(sizes) == {5} and sum(sizes) == total // 5 * 5
    want = sequences.blocks(rows.filter("id <= 70"), 5, "id").select("id", "block")
    assert want.exceptAll(table.select("id", "block")).count() == 0
    assert clinical.registry.latest() == 3
    assert clinical.registry.facts(2)["mode"] == "initial" and clinical.registry.facts(3)["mode"] == "incremental"


def test_a_failed_block_is_set_aside(spark, folder, monkeypatch):
    rows = clinical_rows(spark, folder).filter("num is not null")
    clinical = ClinicalStream(spark, new_folder(spark, "clinical"), sizes=TREES)

    def broken(*args, **kwargs):
        raise kind("no fit today")

    monkeypatch.setattr("vitalgrid.streaming.clinical.fit_risk_model", broken)
    kind = ValueError
    clinical.train_batch(rows.filter("id < 12"), 0)
    assert clinical.read("failed_blocks").filter("reason like '%no fit today%'").count() == 10
    assert clinical.registry.latest() is None
    kind = RuntimeError  # nothing about the rows: the batch fails and is repeated later
    with pytest.raises(RuntimeError):
        clinical.train_batch(rows.filter("id between 12 and 40"), 1)
    assert clinical.read("failed_blocks").count() == 10


def test_batches_are_read_by_path(spark):
    folder = new_folder(spark, "log")
    for i in (*range(8), 9):
        logs.append_batch(spark.range(i, i + 1), folder, i)
    few = logs.read_batches(spark, folder, 5, 7)
    assert sorted(map(tuple, few.collect())) == [(5, 5), (6, 6), (7, 7)]
    assert len(few.inputFiles()) <= 3 * spark.sparkContext.defaultParallelism
    assert not [f for f in few.inputFiles() if "batch_id=4" in f or "batch_id=9" in f]
    assert logs.read_batches(spark, folder, 7, 9).count() == 2  # a gap
    assert logs.read_batches(spark, folder, 0, -1) is None
    assert logs.read_batches(spark, folder + "-absent", 0, 3) is None


def test_log_replaces_a_repeated_batch(spark):
    folder = new_folder(spark, "log")
    logs.append_batch(spark.range(5), folder, 0)
    logs.append_batch(spark.range(7), folder, 1)
    logs.append_batch(spark.range(7), folder, 1)
    assert logs.read_log(spark, folder).count() == 12
    assert logs.read_log_or_none(spark, folder + "-absent") is None
    with open(f"{folder}/batch_id=1/part-broken.parquet", "w") as broken:
        broken.write("this is no parquet file")
    with pytest.raises(Exception, match="part-broken"):  # a damaged log is not an empty one
        logs.read_log_or_none(spark, folder).count()


@pytest.fixture(scope="module")
def prepared(spark, folder):
    df = learning.labelled(spark, folder).select("id", "label", *learning.FEATURES)
    split = sequences.stratified_split(df, "label", "id").cache()
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    scales = classifiers.fit_scales(train, learning.FEATURES)
    return (
        classifiers.with_vectors(train, learning.FEATURES, scales),
        classifiers.with_vectors(test, learning.FEATURES, scales),
    )


@pytest.mark.parametrize("name", ["random_forest", "logistic_regression", "decision_tree", "naive_bayes", "knn"])
def test_models_beat_the_majority(prepared, name):
    train, test = prepared
    sizes = Sizes(trees=10, iterations=50)
    made = classifiers.estimators(train.count(), len(learning.FEATURES), sizes)[name]()
    accuracy, auc = classifiers.quality(made.fit(train).transform(test))
    ones = test.agg(F.avg("label")).first()[0]
    assert accuracy > max(ones, 1 - ones) - 0.05 and auc > 0.55


def test_model_roundtrip(spark, folder):
    row = learning.model_roundtrip(spark, folder).first()
    assert row["rows"] > 0 and row["different"] == 0


def test_registry_shows_complete_versions_only(spark, folder):
    registry = Registry(spark, new_folder(spark, "registry"))
    assert registry.latest() is None
    df = tables.series(spark, folder)
    model = forecasting.fit_forecaster(df, "use_kw", 5)
    model.stages.write().overwrite().save(f"{registry.folder}/models/v00000009/stages")
    assert registry.latest() is None
    registry.save(3, model.stages, steps=5)
    assert registry.latest() == 3 and registry.latest(before=3) is None


def test_boosted_forecast(spark, folder):
    model = forecasting.fit_forecaster(tables.series(spark, folder), "use_kw", 5, kind="boosted", rounds=3)
    assert model.run["samples"] > 0 and model.run["final_val_loss"] > 0


def test_grid_under_ten_rows(spark):
    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(6)], "id int, label int, x double")
    board, model = classifiers.grid_search(df, ["x"])
    assert board.first()["parameters"] == "default" and model is not None
