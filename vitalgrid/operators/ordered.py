"""Running totals and row positions over an order, without sorting a whole group in one task.

A window ordered over a large group puts that group into one task. Here the order is cut into
buckets first: rows are ranked inside `(group, bucket)`, and the totals of the earlier buckets,
a small aggregate, are added. Bucket and rank shuffle on the same key, so the rows move once.
Where no group is over `ROWS_PER_BUCKET` rows, however many groups there are, the plain window is used:
it already spreads the groups, and the rows move once.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from vitalgrid.session import materialize

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 8_192
# Rows per bucket that cut points are estimated from.
SAMPLE_PER_BUCKET = 1_000
BUCKET = "_bucket"


@dataclass(frozen=True)
class Buckets:
    """A bucket column for an order; `column` is None where one bucket is enough."""

    frame: DataFrame
    column: str | None = None

    @property
    def split(self) -> bool:
        return self.column is not None


def bucket_count(rows: int, rows_per_bucket: int) -> int:
    return min(MAX_BUCKETS, max(1, math.ceil(rows / rows_per_bucket)))


def order_value(df: DataFrame, column: str) -> Column:
    """Order-preserving double of a number or a timestamp."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (TimestampType, TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    return F.coalesce(value.cast("double"), F.lit(float("-inf")))


def sample_of(df: DataFrame, rows: int, wanted: int) -> DataFrame:
    """About `wanted` of the rows, to estimate cut points with; results never depend on it."""
    return df if rows <= wanted else df.sample(fraction=wanted / rows, seed=7)


def _cuts(df: DataFrame, value: Column, buckets: int, rows: int) -> list[float]:
    """Estimated quantiles. Sampling first keeps the sketch that a task sends to a few rows."""
    shares = [i / buckets for i in range(1, buckets)]
    row = (
        sample_of(df, rows, buckets * SAMPLE_PER_BUCKET)
        .agg(F.percentile_approx(value, shares, 8 * buckets).alias("cuts")).first()
    )
    return [cut for cut in row["cuts"] or [] if math.isfinite(cut)]


def _assign(df: DataFrame, value: Column, cuts: Sequence[float], name: str) -> DataFrame:
    points = sorted(set(cuts))
    if not points:
        return df.withColumn(name, F.lit(0.0))
    cutter = Bucketizer(
        splits=[float("-inf"), *points, float("inf")], inputCol=f"{name}_in", outputCol=name,
        handleInvalid="keep",
    )
    return cutter.transform(df.withColumn(f"{name}_in", value)).drop(f"{name}_in")


def group_sizes(df: DataFrame, group: Sequence[str]) -> tuple[int, int]:
    """Rows of the table and of its largest group."""
    if not group:
        rows = df.count()
        return rows, rows
    rows, largest = df.groupBy(*group).count().agg(F.sum("count"), F.max("count")).first()
    return rows or 0, largest or 0


def range_buckets(
    df: DataFrame, order: str, tie: str | None = None, rows_per_bucket: int | None = None, group: Sequence[str] = ()
) -> Buckets:
    """Equal-depth buckets along `order`, fitted on the data (at most `MAX_BUCKETS` cut points); none
    where every group fits one.

    A single order value that fills a bucket alone is cut once more along `tie`.
    """
    rows_per_bucket = rows_per_bucket or ROWS_PER_BUCKET
    rows, largest = group_sizes(df, group)
    if largest <= rows_per_bucket:
        return Buckets(df)
    buckets = bucket_count(rows, rows_per_bucket)
    value = order_value(df, order)
    cuts = _cuts(df, value, buckets, rows)
    heavy = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    # A heavy value sits alone between its own cut and the next double above it.
    frame = _assign(df, value, cuts + [math.nextafter(h, math.inf) for h in heavy], "_range")
    if heavy and tie is not None:
        at_heavy = value.isin(heavy)
        tie_value = order_value(df, tie)
        tie_cuts = _cuts(df.filter(at_heavy), tie_value, buckets, rows)
        frame = _assign(frame, tie_value, tie_cuts, "_tie")
        frame = frame.withColumn("_tie", F.when(at_heavy, F.col("_tie")).otherwise(0.0))
    else:
        frame = frame.withColumn("_tie", F.lit(0.0))
    code = (F.col("_range") * (4 * MAX_BUCKETS) + F.col("_tie")).cast("bigint")
    return Buckets(frame.withColumn(BUCKET, code).drop("_range", "_tie"), BUCKET)


def hash_buckets(df: DataFrame, digest: str, rows_per_bucket: int | None = None) -> Buckets:
    """Buckets of an order by hex digest: its leading digits."""
    buckets = bucket_count(df.count(), rows_per_bucket or ROWS_PER_BUCKET)
    if buckets == 1:
        return Buckets(df)
    digits = math.ceil(math.log(buckets, 16))
    return Buckets(df.withColumn(BUCKET, F.substring(digest, 1, digits)), BUCKET)


def text_buckets(df: DataFrame, text: str, rows_per_bucket: int | None = None) -> Buckets:
    """Buckets of an alphabetical order, cut at sampled texts; a shared prefix does not matter.

    The cut rows are stored: a second sample might cut them elsewhere.
    """
    buckets = bucket_count(df.count(), rows_per_bucket or ROWS_PER_BUCKET)
    if buckets == 1:
        return Buckets(df)
    ranged = df.repartitionByRange(buckets, text).withColumn(BUCKET, F.spark_partition_id())
    return Buckets(materialize(ranged, "ordered"), BUCKET)


def running_totals(
    buckets: Buckets,
    order: Sequence[Column | str],
    totals: Mapping[str, Column],
    group: Sequence[str] = (),
) -> DataFrame:
    """Adds, per entry of `totals`, the running sum `name` and the group sum `name_all`.

    The order must be unique inside a group.
    """
    df = buckets.frame
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    to_here = (Window.unboundedPreceding, Window.currentRow)
    if not buckets.split:
        whole = Window.partitionBy(*group)
        upto = whole.orderBy(*order).rowsBetween(*to_here)
        return df.withColumns(
            {name: F.sum(value).over(upto) for name, value in totals.items()}
            | {f"{name}_all": F.sum(value).over(whole) for name, value in totals.items()}
        )
    # One struct key: equal for null group values too, and the join reuses the window's shuffle.
    keyed = df.withColumn("_key", F.struct(*group, buckets.column))
    per_bucket = keyed.groupBy("_key").agg(
        *[F.sum(value).alias(f"_sum_{name}") for name, value in totals.items()]
    )
    whole = Window.partitionBy(*[F.col(f"_key.{name}") for name in group])
    earlier = whole.orderBy(F.col(f"_key.{buckets.column}")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_bucket.select(
        "_key",
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}")
            for name in totals
        ],
        *[F.sum(f"_sum_{name}").over(whole).alias(f"{name}_all") for name in totals],
    )
    inside = Window.partitionBy("_key").orderBy(*order).rowsBetween(*to_here)
    ranked = keyed.withColumns(
        {f"_in_{name}": F.sum(value).over(inside) for name, value in totals.items()}
    )
    return (
        ranked.join(offsets, "_key")
        .withColumns({name: F.col(f"_in_{name}") + F.col(f"_before_{name}") for name in totals})
        .select(*df.columns, *totals, *[f"{name}_all" for name in totals])
        .drop(buckets.column)
    )


def row_positions(
    buckets: Buckets, order: Sequence[Column | str], group: Sequence[str] = ()
) -> DataFrame:
    """Adds `position` (from 1) and `group_rows`."""
    numbered = running_totals(buckets, order, {"position": F.lit(1).cast("bigint")}, group)
    return numbered.withColumnRenamed("position_all", "group_rows")


def positions_by_hash(
    df: DataFrame, identifier: str, group: Sequence[str] = (), rows_per_bucket: int | None = None
) -> DataFrame:
    """Shuffled but repeatable order: md5 of the identifier."""
    digested = df.withColumn("_digest", F.md5(F.col(identifier).cast("string")))
    buckets = hash_buckets(digested, "_digest", rows_per_bucket)
    return row_positions(buckets, ["_digest", identifier], group).drop("_digest")


def positions_by_range(
    df: DataFrame,
    order: str,
    tie: str | None = None,
    group: Sequence[str] = (),
    rows_per_bucket: int | None = None,
) -> DataFrame:
    buckets = range_buckets(df, order, tie, rows_per_bucket, group)
    return row_positions(buckets, [order] + ([tie] if tie else []), group)


@dataclass(frozen=True)
class RowWindow:
    """Rows ready for a ROWS frame that looks back at most `carry` rows.

    `frame` may hold a row twice: once where it belongs and once as context of the next chunk;
    only rows with `own` are results.
    """

    frame: DataFrame
    window: object
    own: Column
    helpers: tuple[str, ...]


def row_window(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    tie: str,
    carry: int,
    rows_per_chunk: int | None = None,
) -> RowWindow:
    """A window over `group` whose partitions stay bounded however long one group is.

    Where a group is over `ROWS_PER_BUCKET` rows, each is cut into chunks of equal length by row
    position, and the last `carry` rows of a chunk are repeated in front of the next one.
    """
    rows_per_chunk = rows_per_chunk or ROWS_PER_BUCKET
    buckets = range_buckets(df, order, tie, rows_per_chunk, group)
    if not buckets.split:
        return RowWindow(df, Window.partitionBy(*group).orderBy(order, tie), F.lit(True), ())
    # A row is context of every later chunk that starts within `carry` rows after it.
    length = max(rows_per_chunk, carry)
    chunk = F.floor((F.col("position") - 1) / length)
    last = F.floor((F.col("position") - 1 + carry) / length)
    placed = (
        row_positions(buckets, [order, tie], group)
        .withColumn("_home", chunk)
        .withColumn("_chunk", F.explode(F.sequence(chunk, last)))
    )
    window = Window.partitionBy(*group, "_chunk").orderBy("position")
    return RowWindow(
        placed, window, F.col("_home") == F.col("_chunk"),
        ("position", "group_rows", "_home", "_chunk"),
    )
