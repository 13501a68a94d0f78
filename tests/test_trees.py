"""Forests and boosted trees against MLlib's, and grown whole against grown level by level."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.sql import functions as F

from vitalgrid.operators import classifiers, trees
from vitalgrid.plans import learning
from vitalgrid.plans.clinical import labelled
from vitalgrid.session import materialize, ship


@pytest.fixture(scope="module")
def rows(spark, folder):
    ship(spark)
    df = labelled(spark, folder).select("id", "label", *learning.FEATURES)
    return materialize(classifiers.with_vectors(df, learning.FEATURES)).repartition(3, "id").cache()


def scores(model, rows):
    scored = model.transform(rows).select("id", classifiers.probability_of_one().alias("p")).toPandas()
    return scored.sort_values("id")["p"].to_numpy()


def shape(model):
    """The trees without the names of the model and its trees."""
    return [tree.toDebugString.split("\n", 1)[1] for tree in model.trees]


def test_one_tree_is_mllibs(rows):
    how = {"labelCol": "label", "maxDepth": 5, "minInstancesPerNode": 3, "seed": 1}
    plain = DecisionTreeClassifier(**how).fit(rows)
    own = trees.Forest(numTrees=1, bootstrap=False, featureSubsetStrategy="all", **how).fit(rows)
    assert shape(own)[0] == plain.toDebugString.split("\n", 1)[1]
    assert np.allclose(scores(own, rows), scores(plain, rows))
    assert np.allclose(own.featureImportances.toArray(), plain.featureImportances.toArray())


def test_boosted_trees_are_mllibs(rows):
    how = {"labelCol": "label", "maxIter": 5, "maxDepth": 3, "stepSize": 0.1, "seed": 1}
    plain = GBTClassifier(**how).fit(rows)
    own = trees.BoostedTrees(**how).fit(rows)
    assert own.treeWeights == plain.treeWeights
    assert np.allclose(scores(own, rows), scores(plain, rows), atol=1e-9)


def test_boosted_by_level(rows, monkeypatch):
    """Margins are stored twice on the way."""
    monkeypatch.setattr(trees, "ROUNDS_STORED", 2)
    how = {"labelCol": "label", "maxIter": 6, "maxDepth": 3, "seed": 1}
    whole, levels = trees.BoostedTrees(**how), trees.BoostedTrees(**how)
    levels.whole_rows = 0
    assert np.allclose(scores(whole.fit(rows), rows), scores(levels.fit(rows), rows), atol=1e-9)


@pytest.mark.parametrize("cells", [trees.PASS_CELLS, 700])
def test_forest_by_level(rows, monkeypatch, cells):
    """Whole trees and trees by level are the same, also where a level takes several passes."""
    monkeypatch.setattr(trees, "PASS_CELLS", cells)
    how = {"labelCol": "label", "numTrees": 4, "maxDepth": 6, "featureSubsetStrategy": "sqrt", "seed": 1}
    whole, levels = trees.Forest(**how), trees.Forest(**how)
    levels.whole_rows = 0
    first, second = whole.fit(rows), levels.fit(rows)
    assert shape(first) == shape(second)
    assert first.totalNumNodes > 4 and not first.hasSummary


@pytest.mark.parametrize("whole", [trees.WHOLE_ROWS, 0])
def test_accuracy_is_that_of_the_model(rows, whole):
    """The votes of deep trees that stay in their tasks are those of the stored model."""
    known, asked = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    forest = trees.Forest(labelCol="label", numTrees=5, maxDepth=30, seed=1)
    forest.whole_rows = whole
    hit = (F.col("prediction") == F.col("label")).cast("double")
    plain = forest.fit(known).transform(asked).agg(F.avg(hit)).first()[0]
    assert forest.accuracy(known, asked) == pytest.approx(plain, abs=1e-12)
    assert forest.accuracy(known, asked.filter("id is null")) is None


def test_pure_and_empty_tables(spark, rows):
    one = rows.withColumn("label", F.lit(1))
    model = trees.Forest(labelCol="label", numTrees=2, seed=1).fit(one)
    assert model.totalNumNodes == 2 and (scores(model, rows) == 1).all()
    with pytest.raises(ValueError):
        trees.Forest(labelCol="label").fit(rows.filter("id is null"))


def test_cuts_at_equal_depth():
    values = np.arange(1000.0)
    cuts = trees.cut_points(values, 1000, 32)
    assert len(cuts) == 31 and abs(np.diff(np.searchsorted(values, cuts)) - 31.25).max() < 1
    assert list(trees.cut_points(np.array([1.0, 3.0, 3.0]), 3, 32)) == [2.0]


@pytest.mark.parametrize("whole", [trees.WHOLE_ROWS, 0])
def test_nothing_to_split(rows, whole):
    """A level at which no node is split ends a tree, at the root too."""
    how = {"labelCol": "label", "minInstancesPerNode": 10**6, "seed": 1}
    for made in (trees.Forest(numTrees=2, **how), trees.BoostedTrees(maxIter=2, **how)):
        made.whole_rows = whole
        assert [tree.numNodes for tree in made.fit(rows).trees] == [1, 1]
