"""Models against plain ones, searches that go on, pipelines that carry their preparation."""

import json
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from vitalgrid.operators import classifiers, perceptron, stages
from vitalgrid.plans import learning
from vitalgrid.schemas import TEXT_CATEGORIES
from vitalgrid.session import new_folder, spread
from vitalgrid.streaming import logs


@pytest.fixture(scope="module")
def points(spark):
    random = np.random.default_rng(1)
    x = random.normal(0, 1, (300, 3))
    y = (x[:, 0] * x[:, 1] + 0.3 * random.normal(0, 1, 300) > 0).astype(float)
    rows = [(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, x array<double>, label double").repartition(5)
    return df.withColumn("scaled_features", array_to_vector("x")), x, y


def test_the_gradient_is_that_of_the_loss():
    network = perceptron.Network((3, 4, 2, 1))
    random = np.random.default_rng(3)
    weights, x, y = network.start(1), random.normal(0, 1, (20, 3)), random.integers(0, 2, 20).astype(float)
    _, gradient = network.loss(weights, x, y)
    for i in range(len(weights)):
        step = np.zeros(len(weights))
        step[i] = 1e-6
        numeric = (network.loss(weights + step, x, y)[0] - network.loss(weights - step, x, y)[0]) / 2e-6
        assert abs(numeric - gradient[i]) < 1e-4
    assert network.penalised(weights).sum() == 3 * 4 + 4 * 2 + 2


def test_the_perceptron_is_that_of_one_machine(points, monkeypatch):
    df, x, y = points
    monkeypatch.setattr(perceptron, "BRANCH", 2)  # sums are added up in a tree
    monkeypatch.setattr(perceptron, "spread", lambda rows: rows.repartition(5))
    made = perceptron.Perceptron(3, (8, 4), penalty=0.5, iterations=40, tolerance=1e-9).fit(df)
    network, penalty = made.network, 0.5
    masked = network.penalised(made.weights)

    def value(w):
        loss, gradient = network.loss(w, x, y)
        return loss / 300 + 0.5 * penalty * float((masked * w) @ w) / 300, gradient / 300 + penalty * masked * w / 300

    plain, losses = perceptron.minimise(value, network.start(42), 40, 1e-9)
    assert len(losses) == len(made.losses) and abs(losses[-1] - made.losses[-1]) < 1e-6
    assert np.abs(network.probability(plain, x) - network.probability(made.weights, x)).max() < 1e-4
    scored = made.transform(df).select("id", "label", "prediction", classifiers.probability_of_one().alias("p")).toPandas()
    assert np.abs(scored.sort_values("id")["p"].to_numpy() - network.probability(made.weights, x)).max() < 1e-9
    assert (scored["prediction"] == scored["label"]).mean() > 0.75
    # The penalty holds the weights down.
    loose = perceptron.Perceptron(3, (8, 4), penalty=0.0, iterations=40, tolerance=1e-9).fit(df)
    assert np.abs(loose.weights).sum() > np.abs(made.weights).sum()


def test_a_search_that_was_ended_fits_only_the_rest(spark, folder, monkeypatch):
    df = learning.labelled(spark, folder).select("id", "label", "age", "chol", "oldpeak").limit(300)
    grid = {"numTrees": [2, 3], "maxDepth": [3, 2]}
    target, whole, appended = new_folder(spark, "search"), logs.append_batch, []

    def until(n):
        def append(row, place, batch_id, **how):
            if len(appended) == n:
                raise RuntimeError("the driver is gone")
            appended.append(batch_id)
            whole(row, place, batch_id, **how)

        return append

    monkeypatch.setattr(logs, "append_batch", until(3))
    with pytest.raises(RuntimeError, match="driver is gone"):
        classifiers.grid_search(df, ["age", "chol", "oldpeak"], grid=grid, folds=2, folder=target, parallelism=1)
    assert len(appended) == 3
    monkeypatch.setattr(logs, "append_batch", until(99))
    board, model = classifiers.grid_search(df, ["age", "chol", "oldpeak"], grid=grid, folds=2, folder=target)
    assert sorted(appended) == list(range(8))  # every fit once
    again, _ = classifiers.grid_search(df, ["age", "chol", "oldpeak"], grid=grid, folds=2)
    assert [tuple(r) for r in board.collect()] == [tuple(r) for r in again.collect()]
    best = dict(pair.split("=") for pair in board.first()["parameters"].split(", "))
    assert model.getNumTrees == int(best["numTrees"])


def test_a_tuned_model_uses_the_batch_grid(spark, folder, monkeypatch):
    assert np.prod([len(v) for v in classifiers.BATCH_GRID.values()]) == 216 / 3  # one split size of three
    monkeypatch.setitem(classifiers.BATCH_GRID, "numTrees", [2])
    monkeypatch.setitem(classifiers.BATCH_GRID, "maxDepth", [2, 3])
    monkeypatch.setitem(classifiers.BATCH_GRID, "minInstancesPerNode", [1])
    monkeypatch.setitem(classifiers.BATCH_GRID, "featureSubsetStrategy", ["sqrt"])
    df = learning.patients(spark, folder).filter("label is not null").limit(400)
    board, model = classifiers.tuned_risk_model(df, learning.MEASURED, TEXT_CATEGORIES, folds=2)
    assert board.count() == 2 and model.score(df, "id").filter(learning.valid_scores()).count() == df.count()


def test_a_pipeline_scores_the_same_in_another_process(spark, folder, tmp_path):
    df = learning.patients(spark, folder).filter("label is not null")
    whole = stages.pipeline(learning.MEASURED + learning.SWITCHES, TEXT_CATEGORIES, classifiers.decision_tree())
    model = whole.fit(df)
    stored, rows, out = (str(tmp_path / n) for n in ("model", "rows", "out"))
    model.write().overwrite().save(stored)
    df.write.parquet(rows)
    script = (
        "import sys; sys.path.insert(0, %r)\n"
        "from vitalgrid.session import build_session\n"
        "from pyspark.ml import PipelineModel\n"
        "from pyspark.ml.functions import vector_to_array\n"
        "spark = build_session('again', 'local[2]', spark__ui__enabled='false')\n"
        "model = PipelineModel.load(%r)\n"
        "model.transform(spark.read.parquet(%r)).select('id', vector_to_array('probability')[1].alias('q')).write.parquet(%r)\n"
    ) % (learning.__file__.rsplit("/", 3)[0], stored, rows, out)
    subprocess.run([sys.executable, "-c", script], check=True, timeout=300)
    scored = model.transform(df).select("id", classifiers.probability_of_one().alias("p"))
    joined = scored.join(spark.read.parquet(out), "id")
    assert joined.count() == df.count() and joined.filter(F.abs(F.col("p") - F.col("q")) > 1e-12).count() == 0
    loaded = PipelineModel.load(stored).stages[0]
    assert loaded.features == whole.getStages()[0].features


def test_every_fold_has_scales_of_its_own(spark, folder):
    df = learning.patients(spark, folder).filter("label is not null").withColumn("fold", (F.col("id") % 2).cast("int"))
    prepare = stages.Prepare(learning.MEASURED, TEXT_CATEGORIES)
    fitted = [json.loads(prepare.fit(df.filter(F.col("fold") != f)).getOrDefault("fitted")) for f in (0, 1)]
    assert fitted[0]["scales"] != fitted[1]["scales"] and fitted[0]["medians"].keys() == fitted[1]["medians"].keys()
    whole = stages.pipeline(learning.MEASURED, TEXT_CATEGORIES, classifiers.decision_tree())
    rows = stages.fold_accuracy(whole, df, "label").orderBy("fold").collect()
    assert [r["fold"] for r in rows] == [0, 1] and all(0.5 < r["accuracy"] <= 1 for r in rows)


def test_a_dictionary_beyond_the_limit_is_named_by_its_files(spark, monkeypatch):
    from vitalgrid.operators import encoding

    monkeypatch.setattr(encoding, "DICTIONARY_LIMIT", 3)
    df = spark.createDataFrame([(float(i), f"c{i % 7}") for i in range(70)], "x double, c string")
    model = stages.Prepare(["x"], ["c"], scale=False).fit(df)
    assert model.getOrDefault("dictionary")
    codes = {r["c"] for r in model.transform(df).select("c").distinct().collect()}
    assert codes == set(range(7))


@pytest.mark.parametrize("constant", [0.2, 0.9])
def test_a_constant_model_turns_the_checks_red(spark, constant):
    scored = spark.range(100).select(
        (F.col("id") % 3 == 0).cast("int").alias("label"), F.lit(int(constant > 0.5)).alias("prediction"),
        F.lit(constant).alias("probability_disease"),
    )
    assert not learning.learnt(scored)


def test_logistic_regression_is_the_plain_one(spark):
    random = np.random.default_rng(5)
    x = random.normal(0, 1, (200, 2))
    y = (random.random(200) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 1] + 0.3)))).astype(float)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, label double")
    made = classifiers.logistic_regression(200).fit(df.withColumn("scaled_features", array_to_vector("x")))
    design, beta = np.column_stack([x, np.ones(200)]), np.zeros(3)
    ridge = np.diag([1.0, 1.0, 0.0])
    for _ in range(30):  # Newton steps of the summed loss with half the squared weights
        p = 1 / (1 + np.exp(-design @ beta))
        beta -= np.linalg.solve((design.T * (p * (1 - p))) @ design + ridge, design.T @ (p - y) + ridge @ beta)
    assert np.abs(np.append(made.coefficients.toArray(), made.intercept) - beta).max() < 1e-3


def test_every_row_gets_a_vote_of_its_own(spark):
    rows = [(1, [0.0], 0), (1, [10.0], 1), (2, [10.0], 1), (3, [0.5], 0)]
    df = spark.createDataFrame(rows, "id int, x array<double>, label int").withColumn("features", array_to_vector("x"))
    model = classifiers.NearestVote(k=1).fit(df.filter("id > 1"))
    got = model.transform(df).select("id", "label", "prediction").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0.0), (1, 1, 1.0), (2, 1, 1.0), (3, 0, 0.0)]


def test_long_texts_stay_out_of_the_driver(spark):
    from vitalgrid.operators import encoding

    df = spark.createDataFrame([("a",), ("b" * 5_000,)], "c string")
    dictionary = encoding.Dictionary.of(encoding.fit_dictionary(df, ["c"]))
    assert dictionary.entries is None
    assert sorted(r["c"] for r in encoding.encode(df, ["c"], dictionary).collect()) == [0, 1]


def test_only_absent_sources_are_skipped(spark, tmp_path):
    from vitalgrid.sources import tables

    here = spark.createDataFrame([(1,)], "x int")
    union, skipped = tables.union_sources(spark, {"here": here, "gone": str(tmp_path / "gone")})
    assert skipped == ["gone"] and union.count() == 1
    with pytest.raises(Exception, match="DATATYPE|PARSE|[Tt]ype"):
        tables.union_sources(spark, {"here": here, "bad": str(tmp_path)}, schema="x nosuchtype")


@pytest.mark.parametrize("name", ["random_forest", "logistic_regression", "rbf_svc"])
def test_models_score_in_a_session_that_has_observed(spark, points, name):
    df = points[0].withColumn("features", F.col("scaled_features"))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).count()
    assert seen.get["rows"] == 300
    made = classifiers.estimators(300, 3, classifiers.Sizes(trees=3, iterations=5, fourier=4))[name]()
    assert classifiers.quality(stages.fitted(made, df).transform(df))[0] > 0.4


def test_a_fit_is_dealt_out_evenly_and_in_bounded_parts(spark):
    low = spark.range(0, 900, 1, 1).union(spark.range(900, 1_000, 1, 9))  # one part has most of the rows
    cores = spark.sparkContext.defaultParallelism
    for rows, most, tasks in ((100, 1_000, cores), (100, 50, cores * -(-1_000 // (50 * cores))), (500, 1_000, 2), (5_000, 9_000, 1)):
        dealt = spread(low, rows, most)
        held = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert dealt.rdd.getNumPartitions() == tasks and sum(held) == 1_000 and max(held) <= min(most, 1.5 * 1_000 / tasks)
    assert dealt.select("id").distinct().count() == 1_000


def test_the_margin_fit_stores_no_projected_rows(points, monkeypatch):
    stored, store = [], classifiers.materialize
    monkeypatch.setattr(classifiers, "materialize", lambda df, label: stored.append(df.columns) or store(df, label))
    sizes = classifiers.Sizes(iterations=20, fourier=64)
    classifiers.RbfMargin(3, 300, sizes).fit(points[0])
    assert stored == [["label", "margin"]]


def test_the_perceptron_takes_packed_rows_a_few_at_a_time():
    x, y = np.arange(3000.0).reshape(1500, 2), np.arange(1500.0) % 2
    batch = pa.RecordBatch.from_arrays([pa.array(list(x)), pa.array(y)], names=["x", "y"])
    packed = list(perceptron._pack([batch, batch.slice(0, 0), batch.slice(0, 7)]))
    assert [(b.num_rows, b.column("n").to_pylist()) for b in packed] == [(1, [1500]), (1, [7])]
    blocks = list(perceptron._blocks(packed))
    assert max(len(b) for _, b in blocks) <= perceptron.TOGETHER
    assert (np.concatenate([b for b, _ in blocks]) == np.concatenate([x, x[:7]])).all()
    assert (np.concatenate([b for _, b in blocks]) == np.concatenate([y, y[:7]])).all()
