"""What streams and writes report of themselves: counts on the way, without a job of their own."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from vitalgrid.streaming import files

PROGRESS = (
    "query string, batch_id long, timestamp string, input_rows long, rows_per_second double, duration_ms long,"
    " metrics map<string, map<string, double>>"
)


def tally(good: Column) -> dict[str, Column]:
    """Sent and failed messages, as metrics of an observation."""
    return {"sent": F.count_if(good), "failed": F.count_if(~good)}


def observed(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> DataFrame:
    """The same rows; whatever reads them also computes the metrics."""
    return df.observe(name, *[value.alias(key) for key, value in metrics.items()])


def write_observed(df: DataFrame, metrics: Mapping[str, Column], write: Callable[[DataFrame], None]) -> dict:
    """Hands the rows to `write` and returns the metrics that its own pass over them gave."""
    seen = Observation()
    write(df.observe(seen, *[value.alias(key) for key, value in metrics.items()]))
    return seen.get


class ProgressLog(StreamingQueryListener):
    """Writes what every micro-batch reports to a table: one small file a batch, named by query and
    batch, so that a repeated batch replaces its own record. Used as a context:

        with ProgressLog(spark, folder) as log:
            runtime.drain(...)
        log.read()

    Leaving it waits until the reports of all queries that ended have arrived.
    """

    def __init__(self, spark: SparkSession, folder: str, wait_seconds: float = 60.0):
        self.spark, self.folder, self.wait_seconds = spark, folder, wait_seconds
        self.running: set[str] = set()
        self.failed: list[Exception] = []
        self.changed = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        with self.changed:
            self.changed.wait_for(lambda: not self.running, self.wait_seconds)
        self.spark.streams.removeListener(self)
        if self.failed and error[0] is None:
            raise self.failed[0]

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        if not progress.numInputRows and not metrics:
            return  # an idle trigger
        name = progress.name or str(progress.id)
        record = {
            "query": name, "batch_id": progress.batchId, "timestamp": progress.timestamp,
            "input_rows": progress.numInputRows, "rows_per_second": progress.processedRowsPerSecond,
            "duration_ms": progress.batchDuration, "metrics": metrics,
        }
        try:
            files.write_text(self.spark, f"{self.folder}/{progress.id}-{progress.batchId:012d}.json", json.dumps(record, default=float))
        except Exception as error:  # raised where the log is closed; a listener's own failure is only logged
            self.failed.append(error)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.running.discard(str(event.runId))
            self.changed.notify_all()

    def read(self) -> DataFrame:
        return read_progress(self.spark, self.folder)


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """(query, batch_id, timestamp, input_rows, rows_per_second, duration_ms, metrics), a row a batch."""
    return spark.read.schema(PROGRESS).json(folder)
