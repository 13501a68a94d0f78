"""Plans: no Python rows in the hot path, checked broadcasts, pruned scans."""

import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import encoding, forecasting, ordered, sequences
from vitalgrid.plans import catalog
from vitalgrid.session import materialize, shared_folder
from vitalgrid.sources import tables
from vitalgrid.streaming import files

NATIVE = [
    "clean_and_engineer", "label_encode_transform", "preprocess", "standard_scale", "gaussian_nb",
    "sliding_sequence", "next_step_target", "chrono_split", "forecast_metrics", "roc_curve",
    "classification_report", "evaluate", "prob_histogram", "pair_emit", "augment_minority",
    "json_encode", "describe", "stratified_kfold", "topk_others",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_native_plan(spark, folder, name):
    text = plan(catalog.queries()[name](spark, folder))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, text


def test_small_dictionary_is_broadcast_large_is_joined(spark, folder):
    df = tables.patients(spark, folder)
    fitted = encoding.fit_dictionary(df, ["cp"])
    small = plan(encoding.encode(df, ["cp"], encoding.Dictionary.of(fitted)))
    assert "BroadcastHashJoin" in small and "hashpartitioning" not in small
    stored = encoding.Dictionary.of(fitted, limit=2)
    assert "ResolvedHint" not in encoding.encode(df, ["cp"], stored)._jdf.queryExecution().analyzed().toString()


def test_scaling_needs_no_shuffle(spark, folder):
    df = tables.patients(spark, folder)
    scale = encoding.collect_scale(encoding.fit_scale(df, ["age", "thalch"]))
    assert "Exchange" not in plan(encoding.standard_scale(df, scale))


def test_scan_reads_two_columns(spark, folder):
    text = plan(catalog.queries()["class_distribution"](spark, folder))
    assert "o_totalprice" in text and "o_orderpriority" not in text.split("ReadSchema")[1]
    text = plan(catalog.queries()["filter_type"](spark, folder))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in text


def test_split_positions_move_the_rows_once(spark, folder):
    """The join with the offsets reuses the window's partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = tables.series(spark, folder).select("series_id", "event_id", "time")
        cut = ordered.range_buckets(df, "time", "event_id", rows_per_bucket=50)
        positions = ordered.row_positions(cut, ["time", "event_id"], ["series_id"])
        text = plan(positions)
        rows_side = text.split("SortMergeJoin")[1].split("FileScan")[0]
        assert rows_side.count("Exchange") == 1, text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chunks_bound_a_window(spark, folder):
    df = tables.series(spark, folder).withColumn("series_id", F.lit(1))
    rows = ordered.row_window(df, ["series_id"], "time", "event_id", carry=9, rows_per_chunk=100)
    sizes = rows.frame.groupBy("series_id", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100 + 9
    assert sequences.sliding_sequence(df, "use_kw", 10, rows_per_chunk=100).count() == df.count() - 9


def test_stored_windows_are_not_written_again(spark, folder):
    df = tables.series(spark, folder)
    windows = materialize(forecasting.training_windows(df, "use_kw", 3), "windows")
    plain = forecasting.fit_forecaster(df, "use_kw", 3)
    written = files.names(spark, f"{shared_folder(spark)}/vitalgrid")
    given = forecasting.fit_forecaster(df, "use_kw", 3, stored=windows)
    assert files.names(spark, f"{shared_folder(spark)}/vitalgrid") == written
    for name in ("samples", "final_loss", "final_val_loss"):
        assert abs(given.run[name] - plain.run[name]) < 1e-9
