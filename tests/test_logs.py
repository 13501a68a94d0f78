"""Logs with a manifest: what is listed and read stays bounded, readers are never cut off."""

import pytest
from pyspark.sql import functions as F

from vitalgrid.operators.registry import Registry
from vitalgrid.session import new_folder
from vitalgrid.streaming import files, logs


@pytest.fixture(scope="module")
def long_log(spark):
    folder, counts = new_folder(spark, "log"), {}
    for i in range(130):
        logs.append_batch(spark.range(i, i + 1).coalesce(1), folder, i)
        if i in (63, 127):
            counts[i] = (len(logs.read_log(spark, folder).inputFiles()), sum(len(files.names(spark, f"{folder}/{d}")) for d in ("", "segments", "_manifest")))
    return folder, counts


def test_an_old_log_lists_no_more_than_a_young_one(spark, long_log):
    folder, counts = long_log
    assert counts[127][0] <= counts[63][0] + 64 // logs.FAN
    assert counts[127][1] <= counts[63][1] + 64 // logs.FAN
    table = logs.read_log(spark, folder)
    assert sorted(map(tuple, table.collect())) == [(i, i) for i in range(130)]
    # Batches that a segment holds, single ones, and both.
    for first, last in ((3, 5), (126, 128), (100, 129), (0, 0)):
        assert sorted(r[0] for r in logs.read_batches(spark, folder, first, last).collect()) == list(range(first, last + 1))
    assert len(logs.read_batches(spark, folder, 129, 129).inputFiles()) == 1
    assert logs.state_before(spark, folder, 130)["id"] == 129 and logs.state_before(spark, folder, 20)["id"] == 19
    assert logs.newest_batch(spark, folder) == 129 and logs.newest_batch(spark, folder, 20) == 19
    assert logs.newest_batch(spark, folder, 0) is None and logs.state_before(spark, folder, 0) is None


def test_superseded_files_are_removed_after_a_grace(spark, long_log):
    folder, _ = long_log
    left = [n for n in files.names(spark, folder) if n.startswith("batch_id=")]
    assert len(left) <= logs.FAN + logs.GRACE + 1 and "batch_id=0" not in left
    assert len(files.names(spark, f"{folder}/_manifest")) <= logs.GRACE
    manifest = logs.Manifest.load(spark, folder)
    assert len(manifest.superseded) <= 2 * logs.FAN + 1


def test_a_reader_of_an_older_manifest_goes_on(spark):
    folder = new_folder(spark, "log")
    for i in range(logs.FAN):
        logs.append_batch(spark.range(i, i + 1).coalesce(1), folder, i)
    reader = logs.read_log(spark, folder)
    for i in range(logs.FAN, logs.FAN + 3):  # the first of these compacts what the reader reads
        logs.append_batch(spark.range(i, i + 1).coalesce(1), folder, i)
    assert len(logs.Manifest.load(spark, folder).parts) < logs.FAN
    assert reader.count() == logs.FAN


def test_a_repeated_batch_counts_once_even_when_it_was_compacted(spark):
    folder = new_folder(spark, "log")
    for i in range(logs.FAN + 2):
        logs.append_batch(spark.range(i, i + 1).coalesce(1), folder, i)
    logs.append_batch(spark.range(100, 102), folder, 4)
    logs.append_batch(spark.range(200, 203), folder, 4)
    got = logs.read_log(spark, folder).groupBy("batch_id").count().collect()
    assert {r[0]: r[1] for r in got} == {i: 3 if i == 4 else 1 for i in range(logs.FAN + 2)}
    assert sorted(r[0] for r in logs.read_batch(spark, folder, 4).collect()) == [200, 201, 202]
    assert logs.read_batch(spark, folder, 99) is None


def test_columns_may_come_but_keep_their_type(spark):
    folder = new_folder(spark, "log")
    logs.append_batch(spark.range(2), folder, 0)
    logs.append_batch(spark.range(2).withColumn("more", F.lit("x")), folder, 1)
    assert sorted(map(tuple, logs.read_log(spark, folder).select("batch_id", "more").distinct().collect()), key=repr) == [(0, None), (1, "x")]
    with pytest.raises(ValueError, match="more was string"):
        logs.append_batch(spark.range(2).withColumn("more", F.lit(1)), folder, 2)


def test_state_tables_keep_the_newest_batches(spark):
    folder = new_folder(spark, "state")
    for i in range(40):
        logs.append_batch(spark.range(i, i + 1).coalesce(1), folder, i, keep=3)
    assert sorted(r[0] for r in logs.read_log(spark, folder).collect()) == [37, 38, 39]
    assert len([n for n in files.names(spark, folder) if n.startswith("batch_id=")]) <= 3 + logs.GRACE


def test_the_registry_removes_old_versions(spark):
    registry = Registry(spark, new_folder(spark, "registry"), keep=2)
    from pyspark.ml import PipelineModel

    for version in (1, 2, 5):
        registry.save(version, PipelineModel(stages=[]), steps=version)
    assert registry.latest() == 5 and registry.latest(before=5) == 2
    assert files.names(spark, f"{registry.folder}/models") == ["v00000002", "v00000005"]
    assert registry.load(5)[0].stages == [] and registry.facts(1) == {"steps": 1}
