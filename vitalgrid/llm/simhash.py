"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits within 3 bits of each other are cut into two halves: one of the halves
differs in one bit at most. Each distinct fingerprint is indexed under both halves as they are and
under each half with one bit left out. Equal keys bring fingerprints together, and the whole
fingerprints are compared. Only the connection of a bucket is passed on (a star for each group of
linked fingerprints), never all its pairs; connected components make the groups.

A bucket of more than `crowd` fingerprints is not worked on whole: its rows get finer keys, the
same variants of the quarters of the other half. A finer bucket fixes all but 18 bits, so it has
2^18 fingerprints at most, and these are compared in blocks.

Defined results: a null text counts as empty; a text without a word has fingerprint zero, linked
like any other. Repeated rows and copies share a fingerprint and so a component. A null doc_id
takes part but never names a component, unless all of it are null. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from vitalgrid.llm.components import components
from vitalgrid.llm.shared import SEGMENT_CHARS
from vitalgrid.session import materialize

SEED, SHINGLE, DISTANCE = 42, 3, 3
CROWD = 2_048
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words in lists of bounded length; each list after the first repeats the last two words."""
    if len(text) <= SEGMENT_CHARS:
        yield text.split()  # of bytes: exactly the six ASCII blanks
        return
    words: list[bytes] = []
    for match in WORD.finditer(text):
        words.append(match.group())
        if len(words) == 100_000:
            yield words
            words = words[-(SHINGLE - 1):]
    yield words


def fingerprint(text: str | None) -> int:
    """SimHash of the 3-word shingles of a whole text as an unsigned number."""
    counts, n, short = np.zeros(64, np.int64), 0, b""
    for words in _word_lists((text or "").encode("utf-8", "replace").lower()):
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
        size = len(words) - SHINGLE + 1
        if size <= 0:
            short = b" ".join(words)
            continue
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, size)
        for begin in range(0, size, 65_536):
            part = hashes[begin:begin + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += size
    if not n:
        if not short:
            return 0
        return xxhash.xxh64_intdigest(short, SEED)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    """Fingerprints as the signed numbers of the same bits."""
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def variants(value: Column, bits: int) -> Column:
    """A segment as it is (first) and with each of its bits left out, as (slot, rest, left-out bit)."""
    whole = F.struct(F.lit(0).alias("slot"), value.alias("rest"), F.lit(0).alias("side"))
    cut = [
        F.struct(
            F.lit(b + 1).alias("slot"), value.bitwiseAND(F.lit(~(1 << b))).alias("rest"),
            F.shiftright(value, b).bitwiseAND(F.lit(1)).cast("int").alias("side"),
        )
        for b in range(bits)
    ]
    return F.array(whole, *cut)


def _segment(value: Column, at: int, bits: int) -> Column:
    return F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << bits) - 1))


def _bit_count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def linked_stars(values: np.ndarray, sides: np.ndarray | None) -> list[tuple[int, int]]:
    """(smallest, other) of each group of linked fingerprints in a bucket, compared in blocks.

    With `sides`, only links between both sides count: the others are found elsewhere.
    """
    left = np.arange(len(values))
    found = []
    while len(left) > 1:
        group, left = left[:1], left[1:]
        frontier = group
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            step = max(1, 4_000_000 // len(left))
            for begin in range(0, len(frontier), step):
                own = frontier[begin:begin + step]
                close = _bit_count(values[own][:, None] ^ values[left][None, :]) <= DISTANCE
                if sides is not None:
                    close &= sides[own][:, None] != sides[left][None, :]
                near |= close.any(axis=0)
            frontier, left = left[near], left[~near]
            group = np.concatenate([group, frontier])
        if len(group) > 1:
            members = values[group].view(np.int64)
            least = int(members.min())
            found += [(least, int(m)) for m in members if m != least]
    return found


def bucket_links(crowd: int | None):
    """Reads (key, side, fingerprint) sorted by key; gives stars (a, b, crowded = false), or the rows
    of a bucket of more than `crowd` fingerprints back as (key, fingerprint, crowded = true)."""
    columns = ["a", "b", "crowded"]

    def batch(rows):
        a, b, c = (list(x) for x in zip(*rows)) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.bool_())], columns
        )

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, t) for t in (np.int64, np.int8, np.uint64)]
        passing = None  # key of the crowded bucket that is being passed through

        def settle(keys, sides, values):
            """Links of complete buckets."""
            if not len(keys):
                return
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.concatenate([begins, [len(keys)]]))
            whole = keys % 64 == 0  # slot 0: the segment as it is
            pairs = begins[sizes == 2]
            close = _bit_count(values[pairs] ^ values[pairs + 1]) <= DISTANCE
            close &= whole[pairs] | (sides[pairs] != sides[pairs + 1])
            hit = pairs[close]
            x, y = values[hit].view(np.int64), values[hit + 1].view(np.int64)
            rows = list(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), repeat(False)))
            for begin, size in zip(begins[sizes > 2], sizes[sizes > 2]):
                span = slice(begin, begin + size)
                own = None if whole[begin] else sides[span]
                if own is None or own.min() != own.max():
                    rows += [(a, b, False) for a, b in linked_stars(values[span], own)]
            if rows:
                yield batch(rows)

        for received in batches:
            got = [received.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            got[1], got[2] = got[1].astype(np.int8), got[2].view(np.uint64)
            if passing is not None:
                same = int(np.searchsorted(got[0], passing, "right"))
                if same:
                    yield batch([(passing, v, True) for v in got[2][:same].view(np.int64).tolist()])
                    got = [x[same:] for x in got]
                if not len(got[0]):
                    continue
                passing = None
            held = [np.concatenate(x) for x in zip(held, got)]
            if not len(held[0]):
                continue
            if crowd is not None:
                keys, sizes = np.unique(held[0], return_counts=True)
                for key in keys[sizes > crowd]:
                    own = held[0] == key
                    yield batch([(int(key), v, True) for v in held[2][own].view(np.int64).tolist()])
                    if key == held[0][-1]:
                        passing = key
                    held = [x[~own] for x in held]
                if not len(held[0]) or passing is not None:
                    yield from settle(*held)
                    held = [x[:0] for x in held]
                    continue
            open_from = int(np.searchsorted(held[0], held[0][-1]))
            yield from settle(*(x[:open_from] for x in held))
            held = [x[open_from:] for x in held]
        yield from settle(*held)

    return links


def _in_buckets(entries: DataFrame, crowd: int | None) -> DataFrame:
    return (
        entries.select("key", "side", "fp").repartition("key").sortWithinPartitions("key")
        .mapInArrow(bucket_links(crowd), "a long, b long, crowded boolean")
    )


def fingerprint_links(nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints (column fp) as links within 3 bits do."""
    # The key holds the rest of the half, which half it is, and the slot.
    entries = None
    for upper, at in enumerate((0, 32)):
        half = nodes.select("fp", F.explode(variants(_segment(F.col("fp"), at, 32), 32)).alias("e")).select(
            ((F.col("e.rest") * 2 + upper) * 64 + F.col("e.slot")).alias("key"), "e.side", "fp"
        )
        entries = half if entries is None else entries.union(half)
    first = materialize(_in_buckets(entries, crowd), "buckets")
    crowded = first.where("crowded").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    if crowded.isEmpty():
        return first.select("a", "b")
    # The key says which half the bucket fixes; the quarters of the other half make finer keys.
    other = F.when(F.floor(F.col("key") / 64) % 2 == 1, _segment(F.col("fp"), 0, 32)).otherwise(
        _segment(F.col("fp"), 32, 32)
    )
    # Every link of two fingerprints counts here, whatever bits are left out: the key's slot is 0.
    finer = None
    for at in (0, 16):
        quarter = crowded.select("key", "fp", F.explode(variants(_segment(other, at, 16), 16)).alias("e")).select(
            F.xxhash64("key", F.lit(at), "e.rest", "e.slot").bitwiseAND(F.lit(~63)).alias("key"),
            F.lit(0).alias("side"), "fp",
        )
        finer = quarter if finer is None else finer.union(quarter)
    second = materialize(_in_buckets(finer, None), "buckets")
    return first.where("not crowded").select("a", "b").union(second.select("a", "b"))


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _grouped(documents: DataFrame, crowd: int) -> DataFrame:
    """(doc_id, fp, text_hash, component_id) of every row."""
    marked = materialize(documents.select(
        "doc_id", fingerprints(F.coalesce("text", F.lit(""))).alias("fp"), text_hash().alias("text_hash")
    ), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    stars = components(fingerprint_links(nodes.select("fp"), crowd))
    grouped = nodes.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = grouped.join(named, "root").select("fp", "root", "component_id")
    return marked.join(of_print, "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def simhash(documents: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) of every row of (doc_id, text)."""
    return _grouped(documents, crowd).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(documents: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row of each component with all its columns: the smallest doc_id, then the smallest hash
    of the text; of rows that repeat both, the one with the smallest hash of the whole row."""
    columns = documents.columns
    hashed = [F.col(f"`{c}`") for c, kind in documents.dtypes if not kind.startswith("map")]
    kept = _grouped(documents, crowd).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("kept")
    ).select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.text_hash").alias("kept_hash"))
    # Copies of a row meet in the partial aggregation, before anything moves.
    rows = documents.select(
        F.col("doc_id").alias("_id"), text_hash().alias("_hash"), F.xxhash64(*hashed).alias("_order"),
        F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns))).alias("_row"),
    ).groupBy("_id", "_hash").agg(F.min_by("_row", "_order").alias("_row"))
    joined = rows.join(kept, F.col("_id").eqNullSafe(F.col("kept_id")) & (F.col("_hash") == F.col("kept_hash")), "left_semi")
    return joined.select(*(F.col(f"_row.c{i}").alias(c) for i, c in enumerate(columns)))
