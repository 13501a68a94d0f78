"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = os.path.dirname(os.path.abspath(__file__))

# Settings that may be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # The JVM never compiles methods past this size; Spark then takes its split form instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "vitalgrid", master: str | None = None, **settings) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        # Call sites per column expression are for debugging; they double the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; partition counts and memory stay the cluster's business."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package to the Python workers, once a context; a run then works from any folder."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = os.path.join(tempfile.mkdtemp(prefix="vitalgrid-"), "vitalgrid")
        root, name = os.path.split(PACKAGE)
        context.addPyFile(shutil.make_archive(archive, "zip", root, name))
        _shipped.add(context.applicationId)
    return spark


_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint directory.

    Only a local session without one (a unit test) gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        active = spark.sparkContext._jsc.sc().getCheckpointDir()
        if active.isDefined():
            return active.get()
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="vitalgrid-")
        spark.sparkContext.setCheckpointDir(configured)
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/vitalgrid/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """The rows as a written table: later passes scan it, and lost executors cost no recomputation."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Rows that are worth a task of their own in an iterative fit: less, and starting tasks costs more
#: than the work they share.
FIT_ROWS = 20_000
#: Rows that one task of a fit may hold: a forest keeps about 1.5 KB of each.
MOST_ROWS = 300_000
#: How much more than its even share a task may have before the rows are dealt out anew.
UNEVEN = 1.5


def spread(stored: DataFrame, rows_per_task: int = FIT_ROWS, most_rows: int = MOST_ROWS) -> DataFrame:
    """A stored table in as many partitions as its rows deserve, for iterative fits.

    A fit runs hundreds of short jobs over the same rows. A table of a few thousand rows is one task
    of each, so that many fits share the cluster; a table whose files are too few, too large or too
    uneven is dealt out to all cores, in so many parts that none is too large to hold.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    # One number per partition.
    held = [row["count"] for row in stored.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    rows = sum(held)
    wanted = min(cores, max(1, -(-rows // rows_per_task)))
    if rows > most_rows * wanted:
        # Full rounds of tasks: none is left to run alone at the end.
        wanted = cores * -(-rows // (most_rows * cores))
    even = -(-rows // wanted)
    if wanted > 1 and max(held) > UNEVEN * even:
        return stored.repartition(wanted)
    return stored.coalesce(wanted) if wanted < cores and len(held) > wanted else stored
