"""The registered queries of the operators and their SQL forms."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm import centroids, chat, codes, licenses, mixing, packing, quality, simhash, suffixes, toxicity, urls, vectors
from vitalgrid.llm.oracles import ORACLES  # noqa: F401
from vitalgrid.llm.shared import fold, table
from vitalgrid.session import ship

QUALITY_FOLDS, QUALITY_HELD, QUALITY_CUT = 5, 0, 0.3
TOXIC_FOLDS, TOXIC_HELD, TOXIC_CUT = 3, 1, 0.7


def quality_model(spark: SparkSession, documents: DataFrame, folder: str) -> quality.Model:
    learnable = fold(F.col("doc_id"), QUALITY_FOLDS) != QUALITY_HELD
    return quality.fit(documents, table(spark, folder, "labels"), "quality", learnable)


def toxicity_model(spark: SparkSession, documents: DataFrame, folder: str) -> toxicity.Model:
    learnable = fold(F.col("doc_id"), TOXIC_FOLDS) != TOXIC_HELD
    return toxicity.fit(documents, table(spark, folder, "labels"), "toxic", learnable)


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = quality_model(spark, documents, folder)
    return documents.select(
        "doc_id", (fold(F.col("doc_id"), QUALITY_FOLDS) == QUALITY_HELD).alias("held_out"),
        quality.scorer(spark, model)("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op3_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.read_back(chat.format_turns(rows))


def op5_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash(table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = vectors.scaled(table(spark, folder, "embeddings"))
    return vectors.top_k(rows.where("vec_id % 50 = 0"), rows)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity_model(spark, documents, folder)
    return documents.select(
        "doc_id", (fold(F.col("doc_id"), TOXIC_FOLDS) == TOXIC_HELD).alias("held_out"),
        toxicity.scorer(spark, model)("text").alias("found"),
    ).select(
        "doc_id", "held_out", "found.score", (F.col("found.score") >= TOXIC_CUT).cast("int").alias("predicted"),
        "found.neighbours", "found.cosines",
    )


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op11_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"))


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings")).drop("compared")


def op13_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.compress(table(spark, folder, "embeddings"))


def _shipped(query):
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(ship(spark), folder)

    return run


QUERIES = {
    f.__name__: _shipped(f) for f in (
        op1_quality, op2_packing, op3_embeddings, op4_chat, op5_urls, op6_simhash, op7_mixing, op8_topk,
        op9_toxicity, op10_licenses, op11_suffixes, op12_centroids, op13_codes,
    )
}
