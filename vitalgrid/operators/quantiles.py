"""Exact quantiles without holding a column's values in one task.

Value counts replace rows, and a column with many distinct values is narrowed first: approximate
percentiles give a bracket that is known (by counting) to hold the wanted ranks, until few enough
distinct values are left in it. Only counts and single values reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.columns import finite

DISTINCT_LIMIT = 1_000_000
ACCURACY = 20_000
# Rows a bracket is estimated from.
SAMPLE_ROWS = 1_000_000


class _Bracket:
    """The values `[low, high]` of a column that hold the wanted quantile; all of them at first."""

    def __init__(self, column: str, share: float, rows: int = 0, distinct: int = 0):
        self.column, self.share = column, share
        self.low = self.high = None
        self.below, self.inside, self.rows, self.distinct = 0, rows, rows, distinct

    @property
    def ranks(self) -> tuple[int, int]:
        """The two ranks around the quantile, from 0."""
        rank = self.share * (self.rows - 1)
        return math.floor(rank), math.ceil(rank)

    def value(self):
        return F.col(f"`{self.column}`")

    def holds(self):
        if self.low is None:
            return self.value().isNotNull()
        return self.value().between(F.lit(self.low), F.lit(self.high))


def _brackets(
    values: DataFrame, wanted: Mapping[str, Sequence[float]], distinct_limit: int
) -> dict[str, list[_Bracket]]:
    profile = values.agg(*[
        stat(F.col(f"`{c}`")).alias(f"{tag}{i}")
        for i, c in enumerate(wanted)
        for tag, stat in (("n", F.count), ("d", F.approx_count_distinct))
    ]).first()
    brackets = {
        c: [_Bracket(c, share, profile[f"n{i}"], profile[f"d{i}"]) for share in shares]
        for i, (c, shares) in enumerate(wanted.items())
    }

    def wide():
        return [b for column in brackets.values() for b in column if b.distinct > distinct_limit]

    while wide() and _narrow(values, wide()):
        pass
    return brackets


def _narrow(df: DataFrame, brackets: list[_Bracket]) -> bool:
    """Shrinks the brackets by one round; False where nothing shrank."""
    probes = []
    drawn = df.withColumn("_draw", F.rand(11))
    for i, b in enumerate(brackets):
        first, last = b.ranks
        used = min(b.inside, SAMPLE_ROWS)
        # Sketch error, and six standard errors of a sampled rank.
        slack = 4 / ACCURACY + (3 / math.sqrt(used) if used < b.inside else 0.0)
        shares = [
            max(0.0, (first - b.below) / b.inside - slack),
            min(1.0, (last - b.below + 1) / b.inside + slack),
        ]
        inside = F.when(b.holds() & (F.col("_draw") <= used / b.inside), b.value())
        probes.append(F.percentile_approx(inside, shares, ACCURACY).alias(f"p{i}"))
    found = drawn.agg(*probes).first()
    counts = []
    for i, b in enumerate(brackets):
        low, high = found[f"p{i}"] or (b.low, b.high)
        if low is None:
            return False
        fits = b.value().between(F.lit(low), F.lit(high))
        counts += [
            F.count_if(b.value() < F.lit(low)).alias(f"b{i}"),
            F.count_if(fits).alias(f"n{i}"),
            F.approx_count_distinct(F.when(fits, b.value())).alias(f"d{i}"),
        ]
    counted = df.agg(*counts).first()
    shrank = False
    for i, b in enumerate(brackets):
        below, inside = counted[f"b{i}"], counted[f"n{i}"]
        first, last = b.ranks
        if below <= first and last < below + inside and inside < b.inside:
            b.low, b.high = found[f"p{i}"] or (b.low, b.high)
            b.below, b.inside, b.distinct = below, inside, counted[f"d{i}"]
            shrank = True
    return shrank


def _pick(values: DataFrame, brackets: list[_Bracket]) -> dict[int, float]:
    """Quantile per bracket, from the counts of the values left in it."""
    cells = F.array(*[
        F.struct(F.lit(i).alias("target"), F.when(b.holds(), b.value()).alias("value"))
        for i, b in enumerate(brackets)
    ])
    counts = (
        values.select(F.explode(cells).alias("x")).select("x.target", "x.value")
        .filter(F.col("value").isNotNull())
        .groupBy("target", "value").count()
    )
    # Partitions are bounded by the distinct values left in a bracket.
    whole = Window.partitionBy("target")
    shares = F.array(*[F.lit(float(b.share)) for b in brackets])[F.col("target")]
    below = F.array(*[F.lit(b.below) for b in brackets])[F.col("target")]
    # Rows of the column: known where a bracket was cut, else all that were counted.
    known = F.array(*[F.lit(b.rows) for b in brackets])[F.col("target")]
    rows = F.when(known > 0, known).otherwise(F.col("inside"))
    rank = shares * (rows - 1)

    def at(position):
        position = position - below
        return (F.col("upto") > position) & (F.col("upto") - F.col("count") <= position)

    hits = (
        counts.withColumns({
            "upto": F.sum("count").over(whole.orderBy("value")),
            "inside": F.sum("count").over(whole),
        })
        .withColumn("rank", rank)
        .filter(at(F.floor("rank")) | at(F.ceil("rank")))
        .groupBy("target")
        .agg(F.min("value").alias("a"), F.max("value").alias("b"), F.max("rank").alias("rank"))
        .collect()
    )
    return {
        id(brackets[row["target"]]): row["a"] + (row["b"] - row["a"]) * (row["rank"] - math.floor(row["rank"]))
        for row in hits
    }


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    distinct_limit: int | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles by linear interpolation over the non-null values of each column."""
    distinct_limit = distinct_limit or DISTINCT_LIMIT
    values = df.select(*[finite(F.col(f"`{c}`").cast("double")).alias(c) for c in wanted])
    if df.count() <= distinct_limit:
        brackets = {c: [_Bracket(c, share) for share in shares] for c, shares in wanted.items()}
    else:
        brackets = _brackets(values, wanted, distinct_limit)
    found = _pick(values, [b for column in brackets.values() for b in column])
    return {c: [found.get(id(b)) for b in column] for c, column in brackets.items()}


def exact_medians(df: DataFrame, columns: Sequence[str], **limits) -> dict[str, float | None]:
    found = exact_quantiles(df, {c: [0.5] for c in columns}, **limits)
    return {c: quantiles[0] for c, quantiles in found.items()}
