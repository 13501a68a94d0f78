"""Queries over scored rows, model boards, importances and vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions import scoring
from vitalgrid.functions.columns import rounded
from vitalgrid.operators import metrics, neighbors, sequences
from vitalgrid.session import new_folder
from vitalgrid.sources import tables


def risk_tier(spark, folder):
    return tables.scored(spark, folder).select("id", scoring.risk_tier(F.col("score")).alias("tier"))


def accuracy(spark, folder):
    return metrics.accuracy(tables.scored(spark, folder))


def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(tables.scored(spark, folder))


def diagnostic_rates(spark, folder):
    return metrics.diagnostic_rates(tables.scored(spark, folder))


def classification_report(spark, folder):
    return metrics.classification_report(tables.scored(spark, folder))


def roc_auc(spark, folder):
    return metrics.roc_auc(tables.scored(spark, folder))


def roc_curve(spark, folder):
    return metrics.roc_curve(tables.scored(spark, folder))


def pr_curve(spark, folder):
    return metrics.pr_curve(tables.scored(spark, folder))


def prob_histogram(spark, folder):
    return metrics.prob_histogram(tables.scored(spark, folder))


def evaluate(spark, folder):
    return metrics.evaluate(tables.scored(spark, folder))


def report(spark, folder):
    """Report tables of a scored run, written and read back: `(section, name, value)`."""
    df = tables.scored(spark, folder)
    matrix = metrics.confusion_matrix(df).select(
        F.concat(F.lit("actual_"), "actual").alias("name"),
        F.stack(F.lit(2), F.lit("predicted_0"), F.col("predicted_0"), F.lit("predicted_1"), F.col("predicted_1")).alias("said", "n"),
    )
    parts = {
        "evaluation": metrics.evaluate(df).select(F.col("metric").alias("name"), "value"),
        "matrix": matrix.select(
            F.concat_ws("_", "name", "said").alias("name"), F.col("n").cast("double").alias("value")
        ),
    }
    target = new_folder(spark, "report")
    tables.write_report(parts, target)
    read = [
        spark.read.schema("name string, value double").json(f"{target}/{name}")
        .select(F.lit(name).alias("section"), "name", "value")
        for name in parts
    ]
    return reduce(DataFrame.unionByName, read)


MODELS = {"fine": 100, "tenths": 10, "quarters": 4}


def _boards(spark, folder) -> DataFrame:
    """Accuracy, AUC and fold deviation of three scores: the given one and two coarser ones."""
    folded = sequences.stratified_kfold(tables.scored(spark, folder), "y", "id", 5)
    boards = []
    for model, steps in MODELS.items():
        coarse = F.floor(F.col("score") * steps + 1e-9) / steps
        rows = folded.select("y", "fold", coarse.alias("score"), (coarse > 0.5).cast("int").alias("pred"))
        auc = metrics.roc_auc(rows)
        hit = (F.col("y") == F.col("pred")).cast("double")
        folds = rows.groupBy("fold").agg(F.avg(hit).alias("accuracy"))
        # Each of the three is one row.
        board = (
            metrics.accuracy(rows)
            .crossJoin(auc)
            .crossJoin(metrics.cv_summary(folds).select(F.col("std").alias("cv_std")))
        )
        boards.append(board.select(F.lit(model).alias("model"), "accuracy", "auc", "cv_std"))
    return reduce(DataFrame.unionByName, boards)


def leaderboard(spark, folder):
    return metrics.leaderboard(_boards(spark, folder).drop("cv_std"))


def quality_band(spark, folder):
    return _boards(spark, folder).select(
        "model",
        scoring.accuracy_band(F.col("accuracy")).alias("accuracy_band"),
        scoring.stability_band(F.col("cv_std")).alias("stability_band"),
        scoring.use_band(F.col("accuracy")).alias("use_band"),
    )


def importance_topk(spark, folder):
    return metrics.importance_topk(tables.importances(spark, folder), 10)


def topk_others(spark, folder):
    return metrics.topk_others(tables.importances(spark, folder), 8)


def importance_by_group(spark, folder):
    return metrics.importance_by_group(tables.importances(spark, folder))


def feature_label_join(spark, folder):
    documents = tables.read_table(spark, folder, "documents")
    labels = tables.read_table(spark, folder, "labels")
    return documents.join(labels, "doc_id").select("doc_id", "lang", "n_chars", "quality", "toxic")


def knn_topk(spark, folder):
    vectors = tables.read_table(spark, folder, "embeddings")
    return neighbors.nearest(vectors, vectors, 5).select(
        "vec_id", "rank", "neighbour", rounded("distance").alias("distance")
    )


def knn_classify(spark, folder):
    vectors = tables.read_table(spark, folder, "embeddings")
    return neighbors.classify(neighbors.nearest(vectors, vectors, 5))


QUERIES = {
    f.__name__: f
    for f in (
        risk_tier, accuracy, confusion_matrix, diagnostic_rates, classification_report, roc_auc,
        roc_curve, pr_curve, prob_histogram, evaluate, report, leaderboard, quality_band, importance_topk,
        topk_others, importance_by_group, feature_label_join, knn_topk, knn_classify,
    )
}
