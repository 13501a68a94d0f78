"""Small files of the shared folder, through the file systems that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    system, place = _at(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The whole file or none of it: it is written beside its place and then renamed."""
    system, place = _at(spark, path)
    _, beside = _at(spark, f"{path}.part")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(beside, place):
        system.delete(place, False)
        if not system.rename(beside, place):
            raise OSError(f"cannot write {path}")


def remove(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a path."""
    system, place = _at(spark, path)
    return system.getContentSummary(place).getLength()
