"""Rolling windows in Spark's keyed state: list state, event-time timers, expiry of idle series.

The table form of the window (`streaming.energy`) spreads one busy series over tasks. This form keeps
a series in one task, and in return orders late readings: a reading waits until the watermark has
passed its time, so what the windows are made of does not depend on how the stream was cut.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

READING = "micros long, event_id long, value double"
WINDOW = "series_id long, event_id long, position long, warm boolean, sequence array<double>"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RollingWindow(StatefulProcessor):
    """State of one series: readings that wait for the watermark, the newest `steps` that went before,
    and how many there were.

    A timer stands at the time of the oldest waiting reading. When it fires, all readings up to the
    watermark leave in the order `(time, event_id)`, each with the window that ends with it. A second
    timer stands `idle_ms` after the newest one; if nothing came until then, the series is forgotten.
    A reading that comes so long after the one before starts the series anew in either case.
    """

    def __init__(self, steps: int, warm_after: int, idle_ms: int | None = None, ttl_ms: int | None = None):
        self.steps, self.warm_after, self.idle_ms, self.ttl_ms = steps, warm_after, idle_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", READING, self.ttl_ms)
        self.tail = handle.getListState("tail", READING, self.ttl_ms)
        self.seen = handle.getValueState("seen", "n long", self.ttl_ms)

    def _timer(self, milliseconds: int) -> None:
        if self.ttl_ms is None:
            self.handle.registerTimer(milliseconds)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for frame in rows:
            values = [None if pd.isna(v) else float(v) for v in frame["value"]]
            arrived = list(zip(frame["micros"].tolist(), frame["event_id"].tolist(), values))
            if arrived:
                self.waiting.appendList(arrived)
                least = min(r[0] for r in arrived) // 1000
                earliest = least if earliest is None else min(earliest, least)
        if self.ttl_ms is not None:
            yield from self._emit(key, None)
        elif earliest is not None:
            self._timer(max(earliest, timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._emit(key, timerValues.getCurrentWatermarkInMs())

    def _emit(self, key, watermark: int | None) -> Iterator[pd.DataFrame]:
        """Windows of the readings up to the watermark (None: of all)."""
        waiting = sorted(self.waiting.get(), key=lambda r: (r[0], r[1])) if self.waiting.exists() else []
        due = [r for r in waiting if watermark is None or r[0] // 1000 <= watermark]
        before = [tuple(r) for r in self.tail.get()] if self.tail.exists() else []
        if not due:
            if before and not waiting and self.idle_ms is not None and before[-1][0] // 1000 + self.idle_ms <= watermark:
                self.tail.clear()
                self.seen.clear()
            return
        rest = waiting[len(due):]
        if rest:
            self.waiting.put([tuple(r) for r in rest])
            self._timer(rest[0][0] // 1000)
        else:
            self.waiting.clear()
        seen = self.seen.get()[0] if self.seen.exists() else 0
        rows, found = before, []
        for reading in map(tuple, due):
            if rows and self.idle_ms is not None and reading[0] // 1000 - rows[-1][0] // 1000 >= self.idle_ms:
                rows, seen = [], 0
            seen += 1
            rows = [*rows[1 - self.steps:], reading] if self.steps > 1 else [reading]
            if len(rows) == self.steps:
                found.append((key[0], reading[1], seen, [r[2] for r in rows]))
        self.tail.put(rows)
        self.seen.update((seen,))
        if self.idle_ms is not None:
            self._timer(rows[-1][0] // 1000 + self.idle_ms)
        if found:
            frame = pd.DataFrame(found, columns=["series_id", "event_id", "position", "sequence"])
            yield frame.assign(warm=frame["position"] >= self.warm_after)[["series_id", "event_id", "position", "warm", "sequence"]]

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """List state and timers need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def keyed_windows(
    readings: DataFrame, value: str = "use_kw", steps: int = 60, warm_after: int | None = None,
    late: str = "0 seconds", idle: int | None = None, ttl: int | None = None,
) -> DataFrame:
    """`(series_id, event_id, position, warm, sequence)`: the window of `steps` readings that ends with
    each reading of a stream `(series_id, event_id, time, value)`.

    `position` numbers the readings of a series; from `warm_after` on (default: steps + 100) a series
    has enough of them for a first model. A reading waits until the watermark, `late` behind the
    newest time of the stream, has passed it; a reading that comes later than that is dropped by Spark
    and counted in its progress. A series without a reading for `idle` seconds of event time is
    forgotten and starts anew. With `ttl` (seconds) state ages by the clock instead: then nothing waits, every
    micro-batch is ordered for itself, and state that was not touched for so long is dropped. Spark runs
    such a stream for the clock even without data, so it needs a trigger interval and is stopped from
    outside; it never drains.

    Defined results: readings without a series or a time take no part; a null or NaN value is a null
    of its windows.
    """
    use_state_store(readings.sparkSession)
    # Spark also asks the processor for its state from a worker beside the driver, which has no
    # shipped files: the class travels with its code.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    if idle is not None and ttl is not None:
        raise ValueError("idle is event time and ttl is clock time; a stream has one of them")
    rows = readings.filter(F.col("series_id").isNotNull() & F.col("time").isNotNull())
    rows = rows.select(
        F.col("series_id").cast("long").alias("series_id"), F.col("event_id").cast("long").alias("event_id"), "time",
        F.unix_micros("time").alias("micros"), F.col(value).cast("double").alias("value"),
    ).withWatermark("time", late)
    processor = RollingWindow(
        steps, steps + 100 if warm_after is None else warm_after,
        None if idle is None else int(idle * 1000), None if ttl is None else int(ttl * 1000),
    )
    return rows.groupBy("series_id").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=WINDOW, outputMode="Append",
        timeMode="EventTime" if ttl is None else "ProcessingTime",
    )
