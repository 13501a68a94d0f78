"""Row windows over keyed series, row blocks and data splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.operators.ordered import (
    ROWS_PER_BUCKET,
    positions_by_hash,
    positions_by_range,
    row_window,
    sample_of,
)

KEYS = ("series_id",)
TIME = "time"
TIE = "event_id"


def sliding_sequence(
    df: DataFrame,
    values: Column | str,
    steps: int = 60,
    with_target: bool = False,
    group: Sequence[str] = KEYS,
    order: str = TIME,
    tie: str = TIE,
    rows_per_chunk: int | None = None,
    target: str | None = None,
) -> DataFrame:
    """One row per full window of `steps` rows, with the values in order in `sequence`.

    Without a target a window ends at its row. With one it ends at the row before, and the row's
    own value (or its column `target`) is the `target`; a window that no row follows is left out.
    """
    value = F.col(values) if isinstance(values, str) else values
    rows = row_window(df, group, order, tie, steps, rows_per_chunk)
    shift = 1 if with_target else 0
    frame = rows.window.rowsBetween(-(steps - 1) - shift, -shift)
    # struct keeps nulls, which collect_list would drop
    sequence = F.transform(
        F.collect_list(F.struct(value.alias("v"))).over(frame), lambda x: x["v"]
    )
    result = rows.frame.withColumn("sequence", sequence)
    if with_target:
        result = result.withColumn("target", F.col(f"`{target}`") if target else value)
    return result.filter(rows.own & (F.size("sequence") == steps)).drop(*rows.helpers)


def previous_value(
    df: DataFrame,
    value: str,
    out: str = "previous",
    group: Sequence[str] = KEYS,
    order: str = TIME,
    tie: str = TIE,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Value of the row before in the same series, null for the first row."""
    rows = row_window(df, group, order, tie, 1, rows_per_chunk)
    return (
        rows.frame.withColumn(out, F.lag(value, 1).over(rows.window))
        .filter(rows.own).drop(*rows.helpers)
    )


def series_positions(
    df: DataFrame,
    group: Sequence[str] = KEYS,
    order: str = TIME,
    tie: str = TIE,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    return positions_by_range(df, order, tie, group, rows_per_bucket)


def bounded_history(
    df: DataFrame, keep: int = 70, group: Sequence[str] = KEYS, order: str = TIME, tie: str = TIE
) -> DataFrame:
    """Newest `keep` rows of each series.

    A limit on the rank lets every task drop all but `keep` rows of a series before the shuffle, so
    a busy series is small when it arrives.
    """
    newest = Window.partitionBy(*group).orderBy(F.col(order).desc(), F.col(tie).desc())
    return df.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= keep).drop("_place")


def latest_sequence(df: DataFrame, value: str, steps: int = 60, group: Sequence[str] = KEYS, **how) -> DataFrame:
    """The newest full window of each series; series that are too short are left out."""
    newest = bounded_history(df, steps, group=group, **how)
    # At most `steps` rows per group are left here.
    ordered = F.sort_array(F.collect_list(F.struct(TIME, TIE, F.col(value).alias("v"))))
    return (
        newest.groupBy(*group)
        .agg(ordered.alias("rows"))
        .filter(F.size("rows") == steps)
        .select(
            *group,
            F.element_at("rows", -1)[TIE].alias(TIE),
            F.transform("rows", lambda r: r["v"]).alias("sequence"),
        )
    )


def downsample(df: DataFrame, step: int = 10, **how) -> DataFrame:
    """Every `step`-th row of each series, starting with the first."""
    return (
        series_positions(df, **how)
        .filter((F.col("position") - 1) % step == 0)
        .drop("position", "group_rows")
    )


def chrono_split(df: DataFrame, share: float = 0.2, validation: float = 0.0, **how) -> DataFrame:
    """`part` is test for the last `ceil(n * share)` rows of each series, train before; with
    `validation`, that share of the rows before the test rows, the newest of them, is validation."""
    test_rows = F.ceil(F.col("group_rows") * F.lit(share))
    before = F.col("group_rows") - test_rows
    part = F.when(F.col("position") > before, "test")
    if validation:
        part = part.when(F.col("position") > before - F.ceil(before * F.lit(validation)), "validation")
    return (
        series_positions(df, **how)
        .withColumn("part", part.otherwise("train"))
        .drop("position", "group_rows")
    )


def retrain_marks(df: DataFrame, interval: int = 100, **how) -> DataFrame:
    """The rows after which a model is refitted: every `interval`-th prediction of a series."""
    return (
        series_positions(df, **how)
        .filter(F.col("position") % interval == 0)
        .withColumn("run", F.floor(F.col("position") / interval).cast("bigint"))
        .drop("group_rows")
    )


def cold_start(df: DataFrame, need: int = 160, group: Sequence[str] = KEYS, **how) -> DataFrame:
    """Per series: rows so far, whether they reach `need`, and the row that reached it."""
    return (
        series_positions(df, group, **how)
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.when(F.col("position") == need, F.col(TIE))).alias("opened_by"),
        )
        .withColumn("ready", (F.col("n") >= need).cast("int"))
    )


def blocks(
    df: DataFrame,
    size: int,
    order: str,
    tie: str | None = None,
    full_only: bool = True,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """`block` per `size` rows in arrival order, counted from 0; a short last block waits."""
    numbered = positions_by_range(df, order, tie, (), rows_per_bucket)
    block = F.floor((F.col("position") - 1) / size).cast("bigint")
    result = numbered.withColumn("block", block)
    if full_only:
        full = F.floor(F.col("group_rows") / size)
        result = result.filter(F.col("block") < full)
    return result.drop("position", "group_rows")


def stratified_split(
    df: DataFrame, label: str, identifier: str, share: float = 0.2, rows_per_bucket: int | None = None
) -> DataFrame:
    """`part` is test for the first `ceil(n * share)` rows of each class in hash order.

    A class with one row makes the split plain: by hash order over all rows.
    """
    smallest = df.groupBy(label).count().agg(F.min("count")).first()[0]
    group = [label] if smallest is None or smallest >= 2 else []
    numbered = positions_by_hash(df, identifier, group, rows_per_bucket)
    test = F.col("position") <= F.ceil(F.col("group_rows") * F.lit(share))
    return numbered.withColumn("part", F.when(test, "test").otherwise("train")).drop(
        "position", "group_rows"
    )


def stratified_kfold(
    df: DataFrame, label: str, identifier: str, folds: int = 5, rows_per_bucket: int | None = None
) -> DataFrame:
    """`fold` from 0: rows of a class are dealt out in hash order."""
    numbered = positions_by_hash(df, identifier, [label], rows_per_bucket)
    return numbered.withColumn(
        "fold", ((F.col("position") - 1) % folds).cast("int")
    ).drop("position", "group_rows")


def newest_rows(df: DataFrame, n: int, order: str, tie: str, rows_per_bucket: int | None = None) -> DataFrame:
    """The last n rows of the whole table.

    On a large table an approximate cut on the order column leaves a little more than n rows
    before the top-n sort, and the scan skips older row groups.
    """
    rows = df.count()
    if rows > max(n, rows_per_bucket or ROWS_PER_BUCKET):
        accuracy = 10_000
        share = 1 - n / rows - 40 / accuracy
        if share > 0:
            sample = sample_of(df, rows, 100 * accuracy)
            cut = sample.agg(F.percentile_approx(order, share, accuracy).alias("cut")).first()["cut"]
            newer = df.filter(F.col(order) >= F.lit(cut))
            if newer.count() >= n:
                df = newer
    return df.orderBy(F.col(order).desc(), F.col(tie).desc()).limit(n)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)
