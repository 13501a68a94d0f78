"""Batch sources: parquet tables, headered CSV files, several sources at once."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Headered CSV with a declared schema: no inference pass over the files."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> str:
    (
        df.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode("overwrite").csv(path)
    )
    return path


def write_report(report: Mapping[str, DataFrame], folder: str, form: str = "json") -> None:
    """Metric tables of a report, one folder each."""
    for name, table in report.items():
        table.write.mode("overwrite").format(form).save(f"{folder}/{name}")


def union_sources(
    spark: SparkSession,
    sources: Mapping[str, DataFrame | str] | Iterable[DataFrame | str],
    schema: StructType | None = None,
    tag: str = "source",
) -> tuple[DataFrame, list[str]]:
    """Union of data frames and CSV paths by column name, tagged with the source name.

    Returns the union and the names of the sources that are not there; columns that a source lacks
    are null. Any other failure to open a source is raised.
    """
    if not isinstance(sources, Mapping):
        sources = {f"source_{i}": source for i, source in enumerate(sources, 1)}
    frames, skipped = [], []
    for name, source in sources.items():
        try:
            if isinstance(source, DataFrame):
                frame = source
            elif schema is not None:
                frame = read_csv(spark, source, schema)
            else:
                frame = spark.read.option("header", True).csv(source)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            skipped.append(name)
            continue
        frames.append(frame.withColumn(tag, F.lit(name)))
    if not frames:
        raise ValueError(f"none of the sources can be read: {skipped}")
    return (
        reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames),
        skipped,
    )


# Views over the driver's tables ------------------------------------------------------------


def patients(spark: SparkSession, folder: str) -> DataFrame:
    """Dirty clinical rows: nulls, text `nan`, padding, mixed case, out-of-range values."""
    orders = read_table(spark, folder, "orders")
    key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")

    def pick(selector, *texts, other=None):
        chain = reduce(
            lambda acc, item: acc.when(selector == item[0], F.lit(item[1])),
            list(enumerate(texts))[1:],
            F.when(selector == 0, F.lit(texts[0])),
        )
        return chain.otherwise(F.lit(other)) if other is not None else chain

    severity = (
        F.when((key * 7) % 110 > 50, 1).otherwise(0)
        + F.when(price > 250000, 1).otherwise(0)
        + F.when(cust % 3 == 0, 2).otherwise(0)
        - 1
    )
    return orders.select(
        key.alias("id"),
        pick(cust % 3, "site_a", "site_b", other="site_c").alias("dataset"),
        (25 + (key * 7) % 110).cast("double").alias("age"),
        pick((key * 13) % 5, "Male", " male ", "Female", "F").alias("sex"),
        pick(
            (key * 3 + cust) % 7, "typical angina", "atypical angina", "non-anginal",
            "asymptomatic", "Asympt", "2", other="9",
        ).alias("cp"),
        F.when(key % 17 != 0, (70 + cust % 150).cast("double")).alias("trestbps"),
        F.when(key % 11 != 0, (80 + F.floor(price / 900)).cast("double")).alias("chol"),
        pick(key % 4, "TRUE", "FALSE", "true", other="nan").alias("fbs"),
        pick(cust % 4, "normal", "ST-T abnormality", "lv hypertrophy", other="abnormal").alias("restecg"),
        (50 + (key * 11 + cust) % 190).cast("double").alias("thalch"),
        pick((key + cust) % 3, "TRUE", "FALSE").alias("exang"),
        (((key * 31) % 120).cast("double") / 10 - 1).alias("oldpeak"),
        pick((key * 5 + cust) % 4, "upsloping", "flat", "down", other="unknown").alias("slope"),
        F.when(key % 13 != 0, (cust % 6).cast("double")).alias("ca"),
        pick(
            (key * 7 + cust) % 6, "normal", "fixed", "reversable defect", "reversible", "1",
            other="nan",
        ).alias("thal"),
        F.when(key % 10 != 9, F.greatest(F.lit(0), severity).cast("int")).alias("num"),
    )


def series(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed meter readings; order inside a series by `(time, event_id)`."""
    return read_table(spark, folder, "events").select(
        F.col("user_id").alias("series_id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("time"),
        F.col("event_type").alias("data_type"),
        F.col("value").alias("use_kw"),
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labels and scores with ties."""
    orders = read_table(spark, folder, "orders")
    high = F.col("o_totalprice") > 300000
    score100 = F.when(high, 30).otherwise(0) + (F.col("o_orderkey") * 37 + F.col("o_custkey")) % 70
    return orders.select(
        F.col("o_orderkey").alias("id"),
        high.cast("int").alias("y"),
        (score100.cast("double") / 100).alias("score"),
        (score100 > 50).cast("int").alias("pred"),
    )


def importances(spark: SparkSession, folder: str) -> DataFrame:
    """A given ranking table: one weight per feature name."""
    return (
        read_table(spark, folder, "part")
        .groupBy(F.col("p_brand").alias("feature"))
        .agg(F.sum("p_size").cast("bigint").alias("weight"))
        .select(
            "feature",
            F.when(F.col("feature") < "Brand#3", "clinical").otherwise("engineered").alias("kind"),
            "weight",
        )
    )


def labelled_docs(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    labels = read_table(spark, folder, "labels")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic"
    )
