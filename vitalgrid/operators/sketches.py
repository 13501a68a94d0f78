"""Profiles that merge: what a batch adds is sketched once, and a profile of all batches reads sketches.

A column's sketch is a row of counts, sums and extremes, which merge exactly, a HyperLogLog sketch of
its values and, for numbers, a KLL sketch of their distribution. The rows of a table are scanned once,
when they are appended; its profile then costs the same however many rows there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from vitalgrid.functions.columns import finite
from vitalgrid.streaming import logs

#: Buckets of a HyperLogLog sketch are 2^HLL: the error of a distinct count is about 1 %.
HLL = 14
#: Size of a KLL sketch: the error of a rank is about 0.35 %.
KLL = 800
QUARTILES = (0.25, 0.5, 0.75)


def sketch(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, values (not null; for floating numbers: finite), low, high,
    total and squares (of numbers), distinct_sketch and value_sketch. One scan; no row is exploded."""
    def parts(i: int, name: str, numeric: bool) -> list[Column]:
        raw = F.col(f"`{name}`")
        value = finite(raw.cast("double")) if numeric else raw
        text = raw.cast("string") if not numeric else value.cast("string")
        number = value if numeric else F.lit(None).cast("double")
        return [
            F.count(value).alias(f"n_values__{i}"),
            F.min(number).alias(f"low__{i}"), F.max(number).alias(f"high__{i}"),
            F.sum(number).alias(f"total__{i}"), F.sum(number * number).alias(f"squares__{i}"),
            F.hll_sketch_agg(text, F.lit(HLL)).alias(f"distinct_sketch__{i}"),
            (F.kll_sketch_agg_double(number, F.lit(KLL)) if numeric else F.max(F.lit(None).cast("binary"))).alias(f"value_sketch__{i}"),
        ]

    fields = [(i, f.name, isinstance(f.dataType, NumericType), f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *[p for i, name, numeric, _ in fields for p in parts(i, name, numeric)])
    kept = ("n_values", "low", "high", "total", "squares", "distinct_sketch", "value_sketch")
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("column"), F.lit(kind).alias("type"), F.col("n_rows"),
            *[F.col(f"{k}__{i}").alias(k) for k in kept],
        )
        for i, name, _, kind in fields
    ])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def append_sketch(df: DataFrame, folder: str, batch_id: int) -> None:
    """Sketches a batch of rows into the table `folder`; a repeated batch replaces its own sketch."""
    logs.append_batch(sketch(df), folder, batch_id)


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column of all the sketches, mergeable again."""
    return sketches.groupBy("column").agg(
        F.max("type").alias("type"), F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
    )


def profile(sketches: DataFrame) -> DataFrame:
    """Per column: type, n_rows, n_values, mean, std, low, high (exact up to rounding), and the estimates
    n_distinct, q25, q50 and q75."""
    mean = F.col("total") / F.nullif("n_values", F.lit(0))
    spread = (F.col("squares") - F.col("total") * mean) / F.nullif(F.col("n_values") - 1, F.lit(0))
    some = (F.col("n_values") > 0) & F.col("low").isNotNull()
    quantiles = [
        F.when(some, F.kll_sketch_get_quantile_double("value_sketch", F.lit(q))).alias(f"q{int(q * 100)}") for q in QUARTILES
    ]
    return merged(sketches).select(
        "column", "type", "n_rows", "n_values", F.when(some, mean).alias("mean"),
        F.when(some, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("std"), "low", "high",
        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"), *quantiles,
    )


def stored_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of every batch so far. Only sketches are read."""
    return profile(logs.read_log(spark, folder))


def stored_medians(spark: SparkSession, folder: str, columns: list[str]) -> dict[str, float | None]:
    """Estimated medians, as `Preprocessor` and imputation use them."""
    table = stored_profile(spark, folder).filter(F.col("column").isin(list(columns)))
    return {r["column"]: r["q50"] for r in table.select("column", "q50").collect()}
