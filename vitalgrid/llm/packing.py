"""Best-fit packing of tokenised documents, in bulk-synchronous rounds.

A document is its ids and an end id. Longer documents are cut at the capacity; full pieces are
sequences of their own, the other pieces are packed. Enough empty sequences for the whole size are
opened at once. Every round takes the pieces above a falling length, the longest first:

1. pieces (once) and gaps (every round) are sorted by size over all partitions, and get their rank
   within their size; the ranks of the places in a gap follow from the rank of the gap;
2. a successor sweep from the largest size down gives each piece the smallest free place that holds
   it. The sweep runs over the counts of lengths and of place sizes, of which there are at most as
   many as the capacity has tokens; its result are runs of ranks, joined to pieces and places;
3. pieces that want the same place are told apart by rank: piece r of a run takes place r of it;
4. the gaps shrink by what they took, and the next round sees them.

A gap offers several places in a round if it is far larger than the pieces. Pieces that find no
place wait for the next round, where smaller gaps are counted anew; pieces longer than every gap
get new sequences. Each round places at least the longest piece that waits.

Defined results: a null or empty text is the end id alone. Repeated rows are packed each by itself.
An empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.llm import tokens
from vitalgrid.session import materialize

CAPACITY = 4_096
END = 1
#: Share of the waiting pieces that fit one place of a large gap.
PLACE_SHARE = 0.8
ROUNDS_PER_LENGTH = 2
SHORTEST_STEP = 64


def pieces(documents: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """All pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    end = np.asarray([END], "<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = tokens.tokens(vocabulary)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = tokenizer.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # As text, because a null would turn the ids of a whole batch into floating-point numbers.
    named = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = named.mapInPandas(cut, "doc_id string, piece int, start long, length long, ids_crc32 long")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _sorted(rows: DataFrame, size: str, key: list[str], label: str) -> DataFrame:
    """The rows sorted by size over all partitions and stored, with partition and position."""
    return materialize(
        rows.repartitionByRange(size, *key).sortWithinPartitions(size, *key)
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), label,
    )


def _runs(stored: DataFrame, size: str) -> list[tuple[int, int, int, int]]:
    """(partition, size, number of rows, first position) of the runs of equal sizes in a sorted table.

    A size spans neighbouring partitions, so there are at most as many runs as partitions and sizes.
    """
    runs = stored.groupBy("part", size).agg(F.count("*"), F.min("at")).collect()
    return sorted(map(tuple, runs), key=lambda r: (r[1], r[0]))


def successors(waiting: np.ndarray, places: np.ndarray):
    """Runs (length, first of the waiting pieces, number, size, first place) of a sweep from the
    largest size down, in which each piece takes the smallest free place that holds it."""
    runs, free = [], []  # free places as [size, first, number], the smallest size last
    for size in range(len(waiting) - 1, 0, -1):
        if places[size]:
            free.append([size, 0, int(places[size])])
        wanted, done = int(waiting[size]), 0
        while wanted > done and free:
            top = free[-1]
            n = min(wanted - done, top[2])
            runs.append((size, done, n, top[0], top[1]))
            done, top[1], top[2] = done + n, top[1] + n, top[2] - n
            if not top[2]:
                free.pop()
    return runs


def _place_size(waiting: np.ndarray) -> int:
    upto = np.cumsum(waiting)
    return int(np.searchsorted(upto, PLACE_SHARE * upto[-1]))


def pack(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of (doc_id, text)."""
    spark = documents.sparkSession
    vocabulary = vocabulary or tokens.default_vocabulary()
    cut = materialize(
        pieces(documents, vocabulary, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces"
    )
    full = cut.where(F.col("length") == capacity).select(
        *cut.columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    stored = _sorted(cut.where(F.col("length") < capacity), "length", ["row"], "sorted")
    waiting, shifts = np.zeros(capacity + 1, np.int64), []
    for part, length, n, first in _runs(stored, "length"):
        shifts.append((part, length, int(waiting[length]) - first))
        waiting[length] += n
    table = spark.createDataFrame(shifts, "part int, length long, shift long")
    ranked = stored.join(F.broadcast(table), ["part", "length"]).withColumn("rank", F.col("at") + F.col("shift"))
    placed = _rounds(spark, ranked.drop("part", "at", "shift"), waiting, capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    if placed is None:
        return full.select(columns)
    # At most `capacity` pieces share a sequence.
    along = Window.partitionBy("sequence_id").orderBy("round", "row").rowsBetween(Window.unboundedPreceding, -1)
    packed = placed.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0)).cast("long"))
    return packed.select(columns).union(full.select(columns))


def _rounds(spark, ranked: DataFrame, counts: np.ndarray, capacity: int) -> DataFrame | None:
    """Rounds until every piece has a sequence; `counts` says how many pieces of each length wait."""
    waiting, taken = counts.copy(), np.zeros_like(counts)
    lengths = np.arange(capacity + 1)
    gaps, runs, opened = None, [], 0
    above, tries = capacity // 2, 0
    placed, number = None, 0
    while waiting.any():
        active = np.where(lengths > above, waiting, 0)
        if active.any():
            if gaps is None:
                more = max(-(-int(waiting @ lengths) // capacity), int(waiting[capacity // 2 + 1:].sum()))
            else:
                beyond = np.where(lengths > max((gap for _, gap, _, _ in runs), default=0), active, 0)
                more = -(-int(beyond @ lengths) // capacity)
            if more:
                # Not literals: those would turn the join by partition and gap into a nested loop.
                none = F.col("id") - F.col("id")
                fresh = spark.range(opened, opened + more).select(
                    F.col("id").alias("sequence_id"), (none + capacity).alias("gap"),
                    (none - 1).cast("int").alias("part"), F.col("id").alias("at"),
                )
                gaps = fresh if gaps is None else gaps.union(fresh)
                runs.append((-1, capacity, more, opened))
                opened += more
            found, done = _round(spark, ranked, gaps, runs, active, taken, number, capacity)
            placed, number = found if placed is None else placed.union(found), number + 1
            waiting, taken = waiting - done, taken + done
            if waiting.any():
                left = gaps.select("sequence_id", "gap").union(found.select("sequence_id", -F.col("length")))
                # A gap that is too small for every piece that waits is done with.
                left = left.groupBy("sequence_id").agg(F.sum("gap").alias("gap")).where(
                    F.col("gap") >= int(np.flatnonzero(waiting)[0])
                )
                gaps = _sorted(left, "gap", ["sequence_id"], "gaps")
                runs = _runs(gaps, "gap")
        tries += 1
        if tries >= ROUNDS_PER_LENGTH or not active.any():
            above, tries = (above // 2 if above > SHORTEST_STEP else 0), 0
    return placed


def _round(spark, ranked, gaps, runs, active, taken, number: int, capacity: int):
    """The pieces that find a place in this round, with their sequence, and their number by length.

    A gap of `g` tokens offers places of `unit` tokens, as far as they go, and one of the rest. All
    gaps of one size offer the same, so the rank of a place follows from the rank of its gap.
    """
    least, unit = int(np.flatnonzero(active)[0]), _place_size(active)
    runs = [r for r in runs if r[1] >= least]
    share = 1 + int(active.sum()) // max(1, sum(n for _, _, n, _ in runs))
    places, offered = np.zeros(capacity + 1, np.int64), []
    for part, gap, n, first in runs:
        offers = max(1, min(gap // unit, share))
        rest = gap - (offers - 1) * unit
        rest_from = int(places[rest])
        places[rest] += n
        unit_from = int(places[unit])
        places[unit] += n * (offers - 1)
        offered.append((part, gap, -first, offers, rest, rest_from, unit_from))
    swept = successors(active, places)
    done = np.zeros_like(active)
    for length, _, n, _, _ in swept:
        done[length] += n
    # Both tables are bounded: by partitions and sizes, and by two runs for each size.
    offers = spark.createDataFrame(
        offered, "part int, gap long, shift long, offers int, rest long, rest_from long, unit_from long"
    )
    chosen = spark.createDataFrame([
        (length, int(taken[length]) + first, int(taken[length]) + first + n, size, place - int(taken[length]) - first)
        for length, first, n, size, place in swept
    ], "of_length long, from_rank long, to_rank long, size long, shift long")
    last = F.col("place") == F.col("offers")
    within = F.col("at") + F.col("shift")
    free = gaps.join(F.broadcast(offers), ["part", "gap"]).withColumn(
        "place", F.explode(F.sequence(F.lit(1), F.col("offers")))
    ).select(
        "sequence_id", F.when(last, F.col("rest")).otherwise(F.lit(unit).cast("long")).alias("size"),
        F.when(last, F.col("rest_from") + within)
        .otherwise(F.col("unit_from") + within * (F.col("offers") - 1) + F.col("place") - 1).alias("rank"),
    )
    longest = int(np.flatnonzero(active)[-1])
    # With one length only, the filter would make the join's key a constant and lose the hash join.
    in_band = ranked.where(F.col("length").between(least, longest)) if least < longest else ranked
    wanted = in_band.join(F.broadcast(chosen), (
        (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    )).withColumn("rank", F.col("rank") + F.col("shift")).drop("of_length", "from_rank", "to_rank", "shift")
    return materialize(
        wanted.join(free, ["size", "rank"]).drop("size", "rank").withColumn("round", F.lit(number)), "placed"
    ), done
