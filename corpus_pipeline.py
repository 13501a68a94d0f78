"""A corpus in five stages: toxicity, quality, near-duplicates, mixture, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; `run` writes it as Parquet to the
shared folder and reads it again as the next stage's documents. The labels come from `sf_dir`.
Extra columns of the documents pass through the first four stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm import mixing, packing, quality, simhash, toxicity
from vitalgrid.llm.queries import QUALITY_CUT, TOXIC_CUT, quality_model, toxicity_model
from vitalgrid.llm.shared import fresh, table
from vitalgrid.session import materialize, ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the cut."""
    model = toxicity_model(ship(spark), docs, sf_dir)
    return docs.where(toxicity.scorer(spark, model)("text").score < TOXIC_CUT)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut."""
    model = quality_model(ship(spark), docs, sf_dir)
    return docs.where(quality.scorer(spark, model)("text") >= QUALITY_CUT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one of the smallest id.

    Rows that repeat that id with the same text are one document. Rows without an id are kept only
    where their whole component has none, one for each fingerprint.
    """
    return simhash.representatives(ship(spark) and docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of the sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in the sequences."""
    return packing.pack(ship(spark) and docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# The classifiers and the fingerprints have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
