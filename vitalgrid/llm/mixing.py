"""Mixing sources to target weights, with DataFrame functions only.

Capped water-filling: all sources share the whole size by weight, a source stops at its cap (its
size times the most epochs), and the excess goes to the others by weight. With the sources in the
order of cap per weight, the common level is (total - caps before) / (weights from here on) at the
first source that does not reach its cap, which is the largest such value.

A source then repeats all its documents the whole number of times that the target holds, and a
seeded part of them once more: the documents in the order of a seeded hash up to the point where
their size meets the rest. That point is found in two steps, 4,096 hash ranges of each source and
then the documents of one range, so that no source is ever sorted whole.

Defined results: a null text has size 0, null sources are one source, the last one. Rows that share
a doc_id share the hash and are taken together. Documents of a source without words are taken zero
times. The mix of an empty table is empty. Other columns keep their names and values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.llm.shared import fresh
from vitalgrid.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"mix {seed} "), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(sizes: DataFrame, epochs: int = EPOCHS, weights=WEIGHTS) -> DataFrame:
    """Adds `target` to (source, source_size), one row a source; weights repeat in the sources' order.

    The table has one row a source, so its windows need no partitions.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*map(F.lit, weights))
    caps = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    caps = caps.withColumn("cap", F.col("source_size") * epochs)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    levels = caps.withColumn("level", (total - before).cast("double") / rest)
    return levels.withColumn("target", F.least(
        F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight")
    )).select("source", "source_size", "target")


def plan(documents: DataFrame, epochs: int = EPOCHS, weights=WEIGHTS, seed: int = SEED) -> DataFrame:
    """One row a source: source, source_size, target, whole repetitions, and the hash up to which
    its documents are taken once more (null: none)."""
    sized = materialize(documents.select(
        "source", word_count(F.col("text")).alias("size"), hash_of(F.col("doc_id"), seed).alias("hash")
    ), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    share = targets(sizes, epochs, weights).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    ).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    range_of = F.substring("hash", 1, 3)
    ranges = sized.groupBy("source", range_of.alias("range")).agg(F.sum("size").alias("size"))
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    reach = ranges.withColumn("upto", F.sum("size").over(along)).alias("r").join(
        share.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))
    )
    # The range in which the rest is met, and the last one before it.
    edge = reach.groupBy(F.col("s.source").alias("source")).agg(
        F.first("part").alias("part"),
        F.min(F.when(F.col("upto") > F.col("part"), F.col("range"))).alias("range"),
        F.max(F.when(F.col("upto") <= F.col("part"), F.col("range"))).alias("filled"),
        F.max(F.when(F.col("upto") <= F.col("part"), F.col("upto"))).alias("before"),
    )
    inside = sized.withColumn("range", range_of).alias("d").join(
        edge.where("range is not null").alias("e"),
        F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.range") == F.col("e.range")),
    ).groupBy(F.col("e.source").alias("source"), "hash").agg(
        F.sum("size").alias("size"), F.first("part").alias("part"),
        F.coalesce(F.first("before"), F.lit(0)).alias("before"),
    )
    in_range = Window.partitionBy("source").orderBy("hash").rowsBetween(Window.unboundedPreceding, 0)
    # A document is in if the rest reaches its middle.
    cut = inside.withColumn("middle", F.col("before") + F.sum("size").over(in_range) - F.col("size") / 2).where(
        F.col("middle") <= F.col("part")
    ).groupBy("source").agg(F.max("hash").alias("last"))
    cuts = edge.alias("e").join(cut.alias("c"), F.col("e.source").eqNullSafe(F.col("c.source")), "left").select(
        F.col("e.source").alias("source"),
        # Every hash of a filled range is below the range's digits and a letter past "f".
        F.coalesce("c.last", F.concat(F.col("e.filled"), F.lit("g"))).alias("last"),
    )
    return share.alias("s").join(cuts.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left").select(
        "s.source", "source_size", "target", F.col("whole").cast("long").alias("whole"), "last"
    )


def mix(documents: DataFrame, **settings) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of (doc_id, text, source)."""
    return with_times(documents.select("doc_id", "text", "source"), "times", **settings).select(
        "doc_id", word_count(F.col("text")).alias("size"), "source_size", "target", "times"
    ).withColumn("taken", F.col("size") * F.col("times")).drop("times")


def with_times(documents: DataFrame, times: str, seed: int = SEED, **settings) -> DataFrame:
    """The documents with how often the mix takes them, and source_size and target of their source."""
    sources = materialize(plan(documents, seed=seed, **settings), "sources")
    columns = documents.columns
    own = sources.select(
        F.col("source").alias("_mix_source"), "source_size", "target", "whole", "last"
    )
    joined = documents.join(own, F.col("source").eqNullSafe(F.col("_mix_source")))
    once_more = (hash_of(F.col("doc_id"), seed) <= F.col("last")) & (F.col("source_size") > 0)
    return joined.withColumn(times, F.col("whole") + F.when(once_more, 1).otherwise(0)).select(
        *columns, "source_size", "target", times
    )


def mixed_documents(documents: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of the input."""
    inner = {c: fresh(f"_c{i}", documents.columns) for i, c in enumerate(documents.columns)}
    plain = documents.select(*(F.col(f"`{c}`").alias(n) for c, n in inner.items()))
    known = {c: plain[inner[c]].alias(c) for c in ("doc_id", "text", "source")}
    packed = plain.select(*known.values(), F.struct(*inner.values()).alias("_row"))
    taken = with_times(packed, "_times", **settings).where("_times > 0")
    rows = taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return rows.select(*(F.col(f"_row.{n}").alias(c) for c, n in inner.items()))
