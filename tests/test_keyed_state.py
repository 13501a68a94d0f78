"""Rolling windows in keyed state: late readings, restarts, idle series."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from vitalgrid.session import new_folder
from vitalgrid.streaming import logs, rolling, runtime

START = datetime.datetime(2024, 1, 1)
SCHEMA = "series_id long, event_id long, time timestamp, use_kw double"


class Feed:
    """A folder that is streamed anew, from its checkpoint, after every file."""

    def __init__(self, spark, **how):
        self.spark, self.how = spark, how
        self.source, self.checkpoint, self.out = (new_folder(spark, n) for n in ("source", "checkpoint", "windows"))

    def send(self, *rows):
        """Rows of (series, seconds, value)."""
        table = [(s, i, START + datetime.timedelta(seconds=t), v) for i, (s, t, v) in enumerate(rows)]
        # The event id is the second, so that results can be read.
        table = [(s, (when - START).seconds, when, v) for s, _, when, v in table]
        self.spark.createDataFrame(table, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)
        stream = rolling.keyed_windows(self.spark.readStream.schema(SCHEMA).parquet(self.source), **self.how)
        if "ttl" not in self.how:
            runtime.drain(stream, self.keep, self.checkpoint)
            return self
        query = runtime.start(stream, self.keep, self.checkpoint, every="1 second")
        try:
            end = time.monotonic() + 120
            while sum(p.numInputRows for p in query.recentProgress) < len(rows) and time.monotonic() < end:
                time.sleep(0.2)
        finally:
            query.stop()
        return self

    def keep(self, df, batch_id):
        logs.append_batch(df, self.out, batch_id)

    def windows(self, series):
        found = logs.read_log(self.spark, self.out).filter(F.col("series_id") == series).orderBy("event_id", "position")
        return [(r["event_id"], r["position"], r["warm"], r["sequence"]) for r in found.collect()]


def test_windows_go_on_after_a_restart_and_late_readings_find_their_place(spark):
    feed = Feed(spark, steps=3, warm_after=4, late="10 seconds")
    feed.send((1, 0, 0.0), (1, 2, 2.0), (2, 1, 9.0)).send((1, 1, 1.0), (1, 20, 20.0))
    # The watermark stands at 10: the reading of second 1 came late but in time.
    assert feed.windows(1) == [(2, 3, False, [0.0, 1.0, 2.0])]
    feed.send((1, 3, 3.0), (1, 40, float("nan")))
    # Second 3 is behind the watermark and is dropped; second 20 has left, second 40 waits.
    assert feed.windows(1) == [(2, 3, False, [0.0, 1.0, 2.0]), (20, 4, True, [1.0, 2.0, 20.0])]
    feed.send((2, 90, 1.0))
    assert feed.windows(1)[-1] == (40, 5, True, [2.0, 20.0, None])
    assert feed.windows(2) == []


def test_an_idle_series_is_forgotten(spark):
    feed = Feed(spark, steps=2, idle=100)
    feed.send((1, 0, 0.0), (1, 1, 1.0), (2, 1, 5.0)).send((2, 90, 6.0)).send((1, 95, 95.0), (2, 99, 7.0))
    assert feed.windows(1) == [(1, 2, False, [0.0, 1.0]), (95, 3, False, [1.0, 95.0])]
    feed.send((2, 150, 8.0)).send((2, 300, 9.0)).send((1, 301, 1.5), (1, 302, 2.5), (2, 303, 0.0))
    # Both were silent for more than 100 seconds and start anew, whether or not time passed in between.
    assert feed.windows(1)[2:] == [(302, 2, False, [1.5, 2.5])]
    assert [w[:2] for w in feed.windows(2)] == [(90, 2), (99, 3), (150, 4), (303, 2)]


def test_state_by_the_clock_waits_for_nothing(spark):
    feed = Feed(spark, steps=2, ttl=3600)
    feed.send((1, 1, 1.0), (1, 0, 0.0)).send((1, 2, 2.0))
    assert feed.windows(1) == [(1, 2, False, [0.0, 1.0]), (2, 3, False, [1.0, 2.0])]
    with pytest.raises(ValueError):
        rolling.keyed_windows(spark.createDataFrame([], SCHEMA), idle=1, ttl=1)
