"""How many fits of the leaderboard run at once."""

import threading
import time

from pyspark.sql import functions as F

from vitalgrid.operators import classifiers
from vitalgrid.session import ship


def test_heavy_fits_are_few_at_once(spark, monkeypatch):
    """The rows of every heavy fit, many times as wide as the table, are held at the same time."""
    ship(spark)
    running, most, lock = [0], [0], threading.Lock()
    fit = classifiers.RbfMargin.fit

    def watched(self, df):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(1)
        try:
            return fit(self, df)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(classifiers.RbfMargin, "fit", watched)
    df = spark.range(200).select("id", (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 7 + F.col("id") % 2 * 3.0).alias("x"))
    board = classifiers.compare_models(
        df, ["x"], names=["rbf_svc", "naive_bayes"], folds=3, sizes=classifiers.Sizes(iterations=5, fourier=8)
    ).collect()
    assert [r["model"] for r in board] == ["rbf_svc", "naive_bayes"] and most[0] == classifiers.HEAVY_AT_ONCE
