"""Helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.session import new_folder

#: Bytes of a table that may be broadcast; a caller proves its bound or takes another way.
BROADCAST_BYTES = 32 << 20

#: Longest piece of text that is worked on at once; longer texts are taken piece by piece, whole.
SEGMENT_CHARS = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % folds).cast("int")


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, learnable: Column, limit: int
) -> DataFrame:
    """At most `limit` labelled documents as (doc_id, text, label), the same ones in every run.

    Ids are taken in the order of their hash, so that the sample is the same share of every source.
    An id that has several labels or several texts counts once, with the largest of each. Labels
    other than 0 and 1 and null ids are left out.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learnable)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    # The sample is bounded by `limit` rows of two numbers.
    return (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))
    )


def segments(text: str, limit: int = SEGMENT_CHARS):
    """Pieces of a text that add up to it, cut at blanks; an unbroken run is cut at the limit."""
    begin = 0
    while len(text) - begin > limit:
        cut = max(text.rfind(" ", begin, begin + limit), text.rfind("\n", begin, begin + limit))
        cut = cut if cut > begin else begin + limit
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


def fresh(name: str, columns: list[str]) -> str:
    """A column name that the table does not have yet (names are compared as Spark does)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, to be broadcast if all its rows fit BROADCAST_BYTES, else left to a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def kept_table(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows as a written table, and its folder, which `discard` removes when nothing reads it."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder of the shared scratch space that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Ask for a collection of garbage, after which Spark drops the shuffle files of finished jobs."""
    spark.sparkContext._jvm.System.gc()
