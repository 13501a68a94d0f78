"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_RUNS     timed runs per query, the median counts (default 3, after one warm-up)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitalgrid.plans import catalog  # noqa: E402
from vitalgrid.session import build_session  # noqa: E402

HEADLINE = [
    "scan_csv", "json_encode", "pair_emit", "clean_and_engineer", "label_encode_transform",
    "preprocess", "describe", "schema_profile", "stratified_kfold", "train_blocks",
    "augment_minority", "gaussian_nb", "cv_fold_accuracy", "sliding_sequence", "next_step_target",
    "latest_sequence", "chrono_split", "forecast_metrics", "series_stats", "classification_report",
    "roc_auc", "pr_curve", "prob_histogram", "evaluate", "topk_others", "knn_classify",
]
# Fits and streams: one run each.
SINGLE = [
    "rf_scores", "forecast", "energy_forecast", "stream_sequence", "stream_score", "stream_forecast",
    "additive_forecast", "sketch_profile", "stream_state_sequence",
]

# The table that a query reads, where it is not the orders that stand for patients.
TABLE_OF = {name: "events" for name in (
    "sliding_sequence", "next_step_target", "latest_sequence", "chrono_split", "forecast_metrics", "series_stats",
    "forecast", "energy_forecast", "stream_sequence", "stream_forecast", "additive_forecast", "stream_state_sequence",
)} | {"knn_classify": "embeddings"}


def run(spark, query, folder) -> float:
    begin = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "vitalgrid-bench", f"local[{cpus}]",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = catalog.queries(), {}
    for name in HEADLINE:
        run(spark, queries[name], folder)
        seconds[name] = round(
            statistics.median(run(spark, queries[name], folder) for _ in range(runs)), 3
        )
    for name in SINGLE:
        seconds[name] = round(run(spark, queries[name], folder), 3)
    rows = {name: spark.read.parquet(f"{folder}/{name}.parquet").count() for name in ("orders", "events", "embeddings")}
    read = {name: rows[TABLE_OF.get(name, "orders")] for name in seconds}
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds,
        "rows_per_second": {name: round(read[name] / s) for name, s in seconds.items() if s}, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
