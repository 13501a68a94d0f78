"""The first version of a stream's model, fitted on a labelled table."""

from pyspark.sql import functions as F

from vitalgrid.operators.classifiers import Sizes
from vitalgrid.operators.registry import Registry
from vitalgrid.session import new_folder, ship
from vitalgrid.sources import messages, tables
from vitalgrid.streaming.clinical import initial_training


def test_rows_are_decoded_once(spark, folder):
    """Whatever makes the rows (a decoder, here a counted function) runs once for each."""
    ship(spark)
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(value):
        made.add(1)
        return value

    sent = messages.encode_messages(tables.patients(spark, folder).drop("dataset"), F.col("id"))
    rows = messages.decode_clinical(sent).drop(messages.CORRUPT).filter("num is not null")
    expected = rows.count()
    rows = rows.withColumn("num", counted(F.col("num").cast("long")))
    assert initial_training(spark, rows, Registry(spark, new_folder(spark, "registry")), Sizes(trees=2)) == 1
    assert made.value == expected
