"""Quality and toxicity: accuracy on held-out rows, exactness of the search, defined results."""

import zlib

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import queries, quality, toxicity
from vitalgrid.llm.shared import fold, labelled_sample, segments

SF = "/root/testdata/sf0.01"


def _auc(scores, labels):
    ranks = np.argsort(np.argsort(scores)) + 1
    positive = sum(labels)
    return (sum(r for r, y in zip(ranks, labels) if y) - positive * (positive + 1) / 2) / (positive * (len(labels) - positive))


@pytest.mark.parametrize("name, label, least", [("op1_quality", "quality", 0.95), ("op9_toxicity", "toxic", 0.8)])
def test_held_out_accuracy(spark, name, label, least):
    found = queries.QUERIES[name](spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert found.count() == documents.count()
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert _auc([r["score"] for r in rows], [r[label] for r in rows]) >= least
    cut = {"quality": 0.3, "toxic": 0.7}[label]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= cut) for r in rows)
    lost = sum(r["predicted"] != r[label] for r in rows if r[label] == (label == "quality"))
    assert lost <= 0.3 * sum(r[label] == (label == "quality") for r in rows)


def test_folds_are_crc32_of_the_text(spark):
    ids = [0, 1, 17, 123_456_789, -5]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(fold(F.col("doc_id"), 5)).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) % 5 for i in ids]


def test_sample_takes_an_id_once_and_only_known_labels(spark):
    documents = corpus.documents(spark, [(1, "a", None, None, None), (1, "b", None, None, None), (2, None, None, None, None), (3, "c", None, None, None)])
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, 5), (None, 1), (9, 0)], "doc_id long, quality int")
    got = corpus.rows_of(labelled_sample(documents, labels, "quality", F.lit(True), 10))
    assert got == [(1, "b", 1), (2, "", 1)]


def _brute_nearest(index, vectors, ids, terms, tf, k):
    """Cosines with all examples, without the index."""
    query = dict(zip(terms.tolist(), index.unit(terms, tf, index.idf)))
    scored = []
    for i, (t, f) in zip(ids, vectors):
        cosine = sum(query.get(a, 0.0) * b for a, b in zip(t.tolist(), index.unit(t, f, index.idf)))
        if cosine > 0:
            scored.append((-round(cosine, 9), i))
    return [(i, -c) for c, i in sorted(scored)[:k]]


def test_block_max_search_is_exact():
    random = np.random.default_rng(3)
    idf = random.uniform(0.5, 5, 40)

    def vector():
        terms = np.sort(random.choice(40, random.integers(1, 6), replace=False))
        return terms, random.integers(1, 4, len(terms)).astype(float)

    vectors, ids = [vector() for _ in range(300)], list(range(1000, 1300))
    vectors += vectors[:50]  # ties
    ids += range(50)
    index = toxicity.Index(ids, [i % 2 for i in ids], vectors, idf, block=16)
    for _ in range(60):
        terms, tf = vector()
        rows, cosines = index.nearest(terms, tf, 7)
        got = list(zip(index.ids[rows].tolist(), cosines.tolist()))
        want = _brute_nearest(index, vectors, ids, terms, tf, 7)
        assert [g[0] for g in got] == [w[0] for w in want]
        assert np.allclose([g[1] for g in got], [w[1] for w in want])


def test_isotonic_rises_and_stays_inside():
    xs, ys = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.8, 0.9]), np.array([0, 1, 0, 0, 1]))
    assert (np.diff(ys) >= 0).all() and 0 < ys.min() and ys.max() < 1 and (np.diff(xs) >= 0).all()


def test_features_do_not_depend_on_the_segments(monkeypatch):
    settings = quality.Settings()
    text = corpus.long_text(2_000)
    whole = quality.features(text, settings)
    assert "".join(segments(text, 1_000)) == text
    assert len(whole) > 2_000 * 3
    one, two = quality.counted(text, settings), quality.counted(f"  {text}\n", settings)
    assert (one[0] == two[0]).all() and np.allclose(one[1], two[1])
    repeated = quality.features("spam spam spam", settings)
    other = quality.features("eggs eggs eggs", settings)
    assert set(repeated) & set(other)  # an immediate repeat is one feature for all words


@pytest.mark.parametrize("extra", [False, True])
def test_models_score_every_kind_of_row(spark, extra):
    documents = corpus.documents(spark, extra=extra)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 0, 1), (5, 0, 1), (8, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    poor = quality.fit(documents, labels, "quality", F.lit(True))
    toxic = toxicity.fit(documents, labels, "toxic", F.lit(True))
    rows = documents.select(
        "doc_id", quality.scorer(spark, poor)("text").alias("q"), toxicity.scorer(spark, toxic)("text").alias("t")
    ).collect()
    assert len(rows) == len(corpus.edge_rows())
    assert all(0 <= r["q"] <= 1 and 0 <= r["t"]["score"] <= 1 for r in rows)
    assert len({r["q"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1  # no words: the same score


def test_models_without_examples(spark):
    empty = corpus.documents(spark, [])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(empty, none, "quality", F.lit(True)).score("any text") == pytest.approx(0.5)
    model = toxicity.fit(empty, none, "toxic", F.lit(True))
    assert model.score("any text") == (0.0, [], [])
    assert empty.select(quality.scorer(spark, quality.fit(empty, none, "quality", F.lit(True)))("text")).count() == 0
