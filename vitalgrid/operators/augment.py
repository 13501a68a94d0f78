"""Extra rows for a class that a training block lacks or holds once."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.operators.ordered import positions_by_range
from vitalgrid.schemas import JITTERED

OPPOSITE_ID = 10_000
REPEAT_ID = 20_000
OPPOSITE_JITTER = 0.05
REPEAT_JITTER = 0.03


def hash_unit(*parts: Column) -> Column:
    """Repeatable number in [-1, 1) from an md5 digest."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**31) - 1.0


def hash_normal(*parts: Column) -> Column:
    """Repeatable standard normal number (Box and Muller) from two md5 digests."""
    u = (hash_unit(*parts, F.lit("u")) + 1) / 2
    v = (hash_unit(*parts, F.lit("v")) + 1) / 2
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)


def _jitter(columns: Sequence[str], identifier: str, scale: Column, seed: int | None) -> dict[str, Column]:
    """Relative jitter per column, floor 0: even, or normal where a seed is given. Both come from
    md5, so a repeated batch gets the same rows however it is dealt out."""
    def noise(i, c):
        if seed is None:
            return hash_unit(F.col(identifier), F.lit(c), F.col("copy"))
        return hash_normal(F.lit(seed), F.col(identifier), F.lit(c), F.col("copy"))

    return {
        c: F.greatest(F.lit(0.0), F.col(c) * (1.0 + scale * noise(i, c)))
        for i, c in enumerate(columns)
    }


def _copies(df, identifier, label, new_label, id_shift, scale, columns, seed):
    values = _jitter(columns, identifier, F.lit(scale), seed)
    return df.select(
        *[
            (F.col(identifier) + id_shift + F.col("copy")).alias(c) if c == identifier
            else new_label.cast("int").alias(c) if c == label
            else F.when(F.col(c).isNotNull(), values[c]).alias(c) if c in values
            else F.col(c)
            for c in df.columns if c != "copy" and not c.startswith("_")
        ],
        F.lit(1).alias("synthetic"),
    )


def augment_minority(
    df: DataFrame,
    identifier: str = "id",
    label: str = "label",
    block: str | None = None,
    columns: Sequence[str] = JITTERED,
    seed: int | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Rows plus synthetic ones (`synthetic` = 1), per block or over the whole table.

    One class only: `max(2, n // 2)` jittered copies with the opposite label. A class with one
    row: two jittered copies of it. Labels are 0 or 1.
    """
    columns = [c for c in columns if c in df.columns]
    group = [block] if block else []
    if block:
        # Blocks are a handful of rows.
        whole = Window.partitionBy(block)
        placed = df.withColumns({
            "_position": F.row_number().over(whole.orderBy(identifier)).cast("bigint"),
            "_rows": F.count(F.lit(1)).over(whole),
            "_ones": F.sum(label).over(whole),
        })
    else:
        totals = df.agg(F.coalesce(F.sum(label), F.lit(0)).alias("ones"), F.count(F.lit(1)).alias("rows")).first()
        if min(totals["ones"], totals["rows"] - totals["ones"]) > 1:
            # Both classes have rows enough: nothing is added, and no row needs a number.
            return df.withColumn("synthetic", F.lit(0))
        placed = (
            positions_by_range(df, identifier, None, group, rows_per_bucket)
            .withColumnsRenamed({"position": "_position", "group_rows": "_rows"})
            .withColumn("_ones", F.lit(totals["ones"]))
        )
    n, ones = F.col("_rows"), F.col("_ones")
    single_class = (ones == 0) | (ones == n)
    wanted = F.greatest(F.lit(2), F.floor(n / 2)).cast("bigint")
    first = F.col("_position") - 1
    opposite = (
        placed.filter(single_class & (first < wanted))
        .withColumn("copy", F.explode(F.sequence(first, wanted - 1, n)))
    )
    lone = (~single_class) & (
        ((n - ones == 1) & (F.col(label) == 0))
        | ((ones == 1) & (n - ones != 1) & (F.col(label) == 1))
    )
    repeated = placed.filter(lone).withColumn(
        "copy", F.explode(F.array(F.lit(0).cast("bigint"), F.lit(1).cast("bigint")))
    )
    return (
        df.withColumn("synthetic", F.lit(0))
        .unionByName(_copies(
            opposite, identifier, label, 1 - F.col(label), OPPOSITE_ID, OPPOSITE_JITTER, columns, seed
        ))
        .unionByName(_copies(
            repeated, identifier, label, F.col(label), REPEAT_ID, REPEAT_JITTER, columns, seed
        ))
    )
