"""The split paths for large tables give the same rows as the plain ones."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import bayes, encoding, metrics, neighbors, ordered, profile, quantiles, sequences
from vitalgrid.operators.augment import augment_minority
from vitalgrid.plans.energy import forecasts
from vitalgrid.sources import messages, tables


def same(left, right):
    assert left.columns == right.columns
    assert left.count() == right.count() > 0
    assert left.exceptAll(right).count() == 0


@pytest.fixture(scope="module")
def series(spark, folder):
    """A third of all rows in one series, many of them at one time."""
    df = tables.series(spark, folder)
    hot = F.col("event_id") % 3 == 0
    return df.withColumns({
        "series_id": F.when(hot, F.lit(-1)).otherwise(F.col("series_id")),
        "time": F.when(hot & (F.col("event_id") < 600), F.lit("2024-01-10 00:00:00").cast("timestamp")).otherwise(F.col("time")),
    }).cache()


def test_positions_by_range(series):
    for group in (["series_id"], []):
        same(
            sequences.series_positions(series, group),
            sequences.series_positions(series, group, rows_per_bucket=40),
        )


def test_heavy_value_is_cut_along_the_tie(series):
    buckets = ordered.range_buckets(series, "time", "event_id", rows_per_bucket=40)
    largest = buckets.frame.groupBy(ordered.BUCKET).count().agg(F.max("count")).first()[0]
    assert largest <= 120


def test_small_groups_need_no_buckets(spark):
    """However many rows there are: only a group that is too large for a task is cut."""
    df = spark.range(300).select((F.col("id") % 30).alias("series_id"), F.col("id").alias("time"), F.col("id").alias("event_id"))
    assert ordered.row_window(df, ["series_id"], "time", "event_id", carry=3, rows_per_chunk=50).helpers == ()
    assert not ordered.range_buckets(df, "time", "event_id", 50, ["series_id"]).split
    assert ordered.range_buckets(df, "time", "event_id", 5, ["series_id"]).split
    assert ordered.range_buckets(df, "time", "event_id", 50).split


def test_positions_by_hash(series):
    same(
        ordered.positions_by_hash(series, "event_id", ["data_type"]),
        ordered.positions_by_hash(series, "event_id", ["data_type"], rows_per_bucket=30),
    )


def test_null_groups_keep_their_rows(spark):
    df = spark.range(200).withColumn("g", F.when(F.col("id") % 2 == 0, F.lit("a")))
    same(
        ordered.positions_by_range(df, "id", None, ["g"]),
        ordered.positions_by_range(df, "id", None, ["g"], rows_per_bucket=20),
    )


@pytest.mark.parametrize("with_target", [False, True])
def test_sliding_sequence(series, with_target):
    same(
        sequences.sliding_sequence(series, "use_kw", 12, with_target),
        sequences.sliding_sequence(series, "use_kw", 12, with_target, rows_per_chunk=25),
    )


def test_window_longer_than_chunk(series):
    same(
        sequences.sliding_sequence(series, "use_kw", 40),
        sequences.sliding_sequence(series, "use_kw", 40, rows_per_chunk=10),
    )


def test_sequence_keeps_nulls(spark):
    df = spark.createDataFrame(
        [(1, i, i, None if i == 2 else float(i)) for i in range(5)],
        "series_id int, event_id int, time int, use_kw double",
    )
    rows = sequences.sliding_sequence(df, "use_kw", 3).orderBy("event_id").collect()
    assert [r["sequence"] for r in rows] == [[0.0, 1.0, None], [1.0, None, 3.0], [None, 3.0, 4.0]]


def test_baseline_forecast(spark, folder):
    same(forecasts(spark, folder), forecasts(spark, folder, rows_per_chunk=50))


def test_blocks_splits_and_folds(spark, folder):
    df = tables.patients(spark, folder).filter("num is not null").select("id", (F.col("num") > 0).cast("int").alias("label"))
    same(sequences.blocks(df, 5, "id"), sequences.blocks(df, 5, "id", rows_per_bucket=70))
    same(
        sequences.stratified_split(df, "label", "id"),
        sequences.stratified_split(df, "label", "id", rows_per_bucket=70),
    )
    folds = sequences.stratified_kfold(df, "label", "id", rows_per_bucket=70)
    same(sequences.stratified_kfold(df, "label", "id"), folds)
    sizes = folds.groupBy("label", "fold").count().groupBy("label").agg((F.max("count") - F.min("count")).alias("d"))
    assert max(r["d"] for r in sizes.collect()) <= 1


def test_newest_rows(series):
    same(
        sequences.newest_rows(series, 100, "time", "event_id"),
        sequences.newest_rows(series, 100, "time", "event_id", rows_per_bucket=200),
    )


def test_pairs(spark, folder):
    df = tables.patients(spark, folder).select("id", "dataset", "num")
    same(messages.emit_pairs(df, "id"), messages.emit_pairs(df, "id", rows_per_bucket=90))


def test_dictionary(spark, folder):
    df = tables.read_table(spark, folder, "part")
    same(
        encoding.fit_dictionary(df, ["p_name", "p_brand"]),
        encoding.fit_dictionary(df, ["p_name", "p_brand"], rows_per_bucket=10),
    )


def test_exact_quantiles(series):
    wanted = {"use_kw": [0.0, 0.25, 0.5, 0.9, 1.0], "event_id": [0.5]}
    plain = quantiles.exact_quantiles(series, wanted)
    narrowed = quantiles.exact_quantiles(series, wanted, distinct_limit=50)
    assert plain == narrowed
    values = np.array([r[0] for r in series.select("use_kw").collect()])
    assert np.allclose(plain["use_kw"], np.quantile(values, wanted["use_kw"]))


def test_quantiles_of_repeated_values(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 3.0).otherwise(F.col("id").cast("double")).alias("x"), F.lit(None).cast("double").alias("y"))
    for limit in (None, 5):
        found = quantiles.exact_quantiles(df, {"x": [0.5, 0.75], "y": [0.5]}, distinct_limit=limit)
        assert found == {"x": [3.0, 749.25], "y": [None]}


def test_curves(spark, folder):
    df = tables.scored(spark, folder)
    for table in (metrics.roc_curve, metrics.pr_curve, metrics.roc_auc):
        same(table(df), table(df, rows_per_bucket=9))


def test_auc_of_reversed_scores(spark, folder):
    df = tables.scored(spark, folder)
    there = metrics.roc_auc(df).first()[0]
    back = metrics.roc_auc(df.withColumn("score", 1 - F.col("score"))).first()[0]
    assert math.isclose(there + back, 1.0, abs_tol=1e-5)
    one = df.filter("y = 1")
    assert metrics.roc_auc(one).first()[0] is None


def test_neighbours_against_brute_force(spark, folder):
    df = tables.read_table(spark, folder, "embeddings")
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in df.collect()}
    ids = np.array(sorted(vectors))
    table = np.stack([vectors[i] for i in ids])
    for block_rows in (None, 30):
        found = neighbors.nearest(df, df, 3, block_rows=block_rows)
        got = {}
        for r in found.orderBy("vec_id", "rank").collect():
            got.setdefault(r["vec_id"], []).append(r["neighbour"])
        assert len(got) == len(ids)
        for i in ids[:: max(1, len(ids) // 60)]:
            d = ((table - vectors[i]) ** 2).sum(axis=1)
            d[ids == i] = np.inf
            assert got[i] == list(ids[np.lexsort((ids, d))[:3]])


def test_moments_merge():
    rng = np.random.default_rng(0)
    a, b = rng.normal(5, 2, 40), rng.normal(-1, 1, 25)
    parts = [bayes.Moments(len(x), (x.mean(),), (x.var() * len(x),)) for x in (a, b)]
    total, both = bayes.merged(parts), np.concatenate([a, b])
    assert math.isclose(total.means[0], both.mean()) and math.isclose(total.spreads[0] / total.rows, both.var())


def test_augment_counts(spark):
    df = spark.createDataFrame([(i, 1, 50.0 + i) for i in range(1)], "id int, label int, age double")
    rows = augment_minority(df).collect()
    assert sorted((r["id"], r["label"], r["synthetic"]) for r in rows) == [(0, 1, 0), (10000, 0, 1), (10001, 0, 1)]
    many = spark.range(50).select("id", F.lit(0).alias("label"), (F.col("id") + 30.0).alias("age"))
    plain, split = augment_minority(many), augment_minority(many, rows_per_bucket=7)
    assert plain.filter("synthetic = 1 and label = 1").count() == 25
    same(plain, split)
    lone = spark.createDataFrame([(1, 0, 40.0), (2, 0, 50.0), (3, 1, 60.0)], "id int, label int, age double")
    extra = augment_minority(lone).filter("synthetic = 1").collect()
    assert sorted(r["id"] for r in extra) == [20003, 20004] and all(r["label"] == 1 and 58 <= r["age"] <= 62 for r in extra)


def test_training_check(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "id int, num int")
    assert profile.training_check(df, "num", ["a"]).first()["status"] == "warning: single class"
    assert profile.training_check(df.filter("id > 5"), "num", ["a"]).first()["status"] == "error: no data"


def test_schema_profile_sketch(spark, folder):
    df = tables.patients(spark, folder)
    exact = {r["column"]: r for r in profile.schema_profile(df).collect()}
    for r in profile.schema_profile(df, exact=False).collect():
        assert (r["n_rows"], r["n_values"], r["type"]) == (exact[r["column"]]["n_rows"], exact[r["column"]]["n_values"], exact[r["column"]]["type"])
        assert abs(r["n_distinct"] - exact[r["column"]]["n_distinct"]) <= 0.15 * exact[r["column"]]["n_distinct"] + 1


def test_text_order_with_a_shared_prefix(spark):
    from vitalgrid.operators import ordered

    texts = [f"https://same.example/{i:05d}" for i in range(400)] + [None]
    df = spark.createDataFrame([(t,) for t in reversed(texts)], "value string")
    buckets = ordered.text_buckets(df, "value", rows_per_bucket=50)
    sizes = [r["count"] for r in buckets.frame.groupBy(buckets.column).count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 150
    got = {r["value"]: r["position"] for r in ordered.row_positions(buckets, ["value"]).collect()}
    want = sorted(texts, key=lambda t: (t is not None, t or ""))
    assert got == {t: i for i, t in enumerate(want, 1)}


def test_training_rows_are_copied_to_visiting_slices_only(spark):
    import numpy as np

    from vitalgrid.operators import neighbors

    random = np.random.default_rng(0)
    centres = random.normal(0, 100, (20, 4))

    def rows(n, first):
        return spark.createDataFrame(
            [(first + i, (centres[i % 20] + random.normal(0, 1, 4)).tolist(), i % 2) for i in range(n)],
            "vec_id long, embedding array<double>, label int",
        )

    train = rows(400, 0)
    copies = []
    for probes in (rows(200, 1_000), rows(1_600, 10_000)):
        found = neighbors.nearest(probes, train, 3, block_rows=20)
        assert found.count() == 3 * probes.count()
        plan = found._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
        copies.append(found)


def test_a_block_finds_the_nearest_without_all_pairs(monkeypatch):
    random = np.random.default_rng(5)
    rows = random.integers(-30, 30, (6_000, 3)).astype(float)
    rows[:50] = rows[0]  # ties go to the smaller id
    ids, asked = random.permutation(6_000), rows[::20]
    exact, pairs = neighbors._squared, []
    monkeypatch.setattr(neighbors, "_squared", lambda a, b: pairs.append(len(a)) or exact(a, b))
    for exclude_self in (True, False):
        own = ids[::20]
        probe, row, _ = neighbors.Block(ids, rows).nearest(own, asked, np.full(len(asked), np.inf), 5, exclude_self)
        for i in range(len(asked)):
            d2 = ((rows - asked[i]) ** 2).sum(axis=1)
            d2[exclude_self & (ids == own[i])] = np.inf
            assert ids[row[probe == i]].tolist() == ids[np.lexsort((ids, d2))[:5]].tolist()
    assert sum(pairs) < 0.05 * 2 * len(asked) * len(rows)


def test_neighbours_leave_out_vectors_that_have_no_distance(spark):
    rows = [(i, [float(i), 0.0], i % 2) for i in range(8)] + [(8, None, 0), (9, [float("nan"), 1.0], 0), (10, [1.0, None], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = neighbors.nearest(df, df, 2, block_rows=3).collect()
    assert {r["vec_id"] for r in found} == {r["neighbour"] for r in found} == set(range(8)) and len(found) == 16


def test_nothing_is_numbered_where_no_row_is_added(spark):
    df = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("double").alias("age"))
    out = augment_minority(df)
    assert "Window" not in out._jdf.queryExecution().toString()
    assert out.columns == [*df.columns, "synthetic"] and out.filter("synthetic = 0").count() == out.count() == 40
    for few in ("id % 40 < 1", "false"):
        added = augment_minority(df.withColumn("label", F.expr(few).cast("int"))).filter("synthetic = 1").count()
        assert added == (2 if "<" in few else 20)
