"""Removal of byte strings that an earlier document has too, by a family of suffix arrays.

Documents come in batches. A batch gets a suffix array, sorted by the first bytes of the suffixes; it
is scanned in order together with every array the family already has for suffixes that begin like
one of another document; then it becomes a level of the family. Two levels of equal size are merged
before the next batch comes, so n batches leave about log2(n) levels and every suffix is rewritten
that often.

The arrays are sparse without losing a match. A string of `length` bytes holds `length - GRAM + 1`
runs of GRAM bytes; the run with the smallest hash, the leftmost of equals, stands at the same place
wherever the string occurs. Only suffixes that begin with such a run are kept, about one in
seventeen, and each string belongs to exactly one of them. So two documents share a string only if
their arrays share the beginning of the suffix it belongs to. What the scan finds is then verified:
the strings of a found suffix are compared with those of all suffixes of the same beginning.

An array is dealt into buckets by a hash of the beginning. A bucket is one row of a table, whose
cells are columns of numbers: a suffix costs 32 bytes there and a few instructions of numpy, which
is what makes a pass over all suffixes of a corpus affordable.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.shared import discard, kept_table, release, small
from vitalgrid.session import materialize, new_folder

#: Bytes by which suffixes are sorted and compared: two words of eight.
GRAM = 16
#: Bytes of text that are searched for markers at once, and suffixes that are sorted at once.
STRETCH, RUN = 1 << 18, 1 << 19
#: Suffixes of a bucket, on average.
BUCKET = 1 << 18
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))
_UPPER = np.uint64(0xFFFFFFFF00000000)


def _words(text: np.ndarray, order: str = "<") -> np.ndarray:
    """The eight bytes at every place of a text as a number."""
    view = np.ndarray(shape=(max(0, len(text) - 7),), dtype=f"{order}u8", buffer=text, strides=(1,))
    return view.astype(np.uint64)


def hashes(text: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of the `width` (eight or more) bytes at every place of a text."""
    words, n = _words(text), len(text) - width + 1
    found = np.full(n, seed, np.uint64)
    for at in [*range(0, width - 8, 8), width - 8]:
        found ^= words[at:at + n]
        found *= _A
        found ^= found >> np.uint64(29)
    found *= _C
    found ^= found >> np.uint64(32)
    return found


def markers(text: np.ndarray, length: int, begins: np.ndarray | None = None):
    """Places of the marking runs of texts that stand end to end (`begins`; each has `length` bytes or
    more), and the first and the last of the strings of each."""
    runs = len(text) - GRAM + 1
    order = (hashes(text, GRAM) & _UPPER) | np.arange(runs, dtype=np.uint64)
    reach, width = 1, length - GRAM + 1
    while reach < width:
        step = min(reach, width - reach)
        order = np.minimum(order[:-step], order[step:])
        reach += step
    place = (order & ~_UPPER).astype(np.int64)
    string = np.arange(len(place))
    if begins is not None and len(begins) > 1:
        # No string reaches from one text into the next.
        inside = np.ones(len(place), bool)
        for begin in begins[1:]:
            inside[max(0, begin - length + 1):begin] = False
        string, place = string[inside], place[inside]
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[new], string[new], string[np.append(new[1:], len(place)) - 1]


#: Columns of an array: the first sixteen bytes as two numbers, the document, and the place with its
#: strings, `_packed`.
CELLS = ("high", "low", "doc_id", "spot")
TYPES = (np.uint64, np.uint64, np.int64, np.int64)
ARRAY = "bucket int, " + ", ".join(f"{c} binary" for c in CELLS)


def _packed(place, first, last):
    """A place and its first and last string as one number; strings begin at most 63 bytes before it."""
    return (place << 12) | ((place - first) << 6) | (last - first)


def _unpacked(spot):
    place = spot >> 12
    first = place - ((spot >> 6) & 63)
    return place, first, first + (spot & 63)


def _row(bucket: int, columns) -> list:
    return [bucket, *(np.ascontiguousarray(c, dtype=t).tobytes() for c, t in zip(columns, TYPES))]


def _columns(row) -> list[np.ndarray]:
    return [np.frombuffer(cell, t) for cell, t in zip(row, TYPES)]


def _table(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))],
        names=["bucket", *CELLS],
    )


def _stretches(batches: Iterator[pa.RecordBatch]):
    """Documents of about STRETCH bytes together: their ids, bytes and where each begins."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("bytes").to_pylist()):
            ids.append(doc_id)
            texts.append(data)
            size += len(data)
            if size >= STRETCH:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def suffixes(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """The kept suffixes of (doc_id, bytes) as sorted runs, a row for each run and bucket."""

    def emit(held):
        high, low, doc_id, spot = (np.concatenate(c) for c in zip(*held))
        bucket = (((high * _A) ^ (low * _B)) >> np.uint64(33)) % np.uint64(buckets)
        order = np.lexsort((low, high, bucket))
        edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]]))
        rows = [
            _row(int(bucket[order[a]]), [c[order[a:b]] for c in (high, low, doc_id, spot)]) for a, b in zip(edges, edges[1:])
        ]
        for at in range(0, len(rows), 64):
            yield _table(rows[at:at + 64])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for ids, data in _stretches(batches):
            text = np.frombuffer(b"".join(data), np.uint8)
            begins = np.cumsum([0, *map(len, data)])[:-1]
            place, first, last = markers(text, length, begins)
            which = np.searchsorted(begins, place, "right") - 1
            words, base = _words(text, ">"), begins[which]
            held.append((words[place], words[place + 8], np.array(ids, np.int64)[which], _packed(place - base, first - base, last - base)))
            size += len(place)
            if size >= RUN:
                yield from emit(held)
                held, size = [], 0
        if held:
            yield from emit(held)

    return texts.select("doc_id", "bytes").mapInArrow(sample, ARRAY)


def _merged(rows) -> list[np.ndarray]:
    """Sorted runs as one."""
    columns = [np.concatenate(c) for c in zip(*map(_columns, rows))]
    order = np.lexsort((columns[1], columns[0]))
    return [c[order] for c in columns]


def _one_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by bucket: one run for each bucket."""
    bucket, held = None, []
    for batch in batches:
        for number, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", *CELLS))):
            if number != bucket and held:
                yield _table([_row(bucket, _merged(held))])
                held = []
            bucket = number
            held.append(row)
    if held:
        yield _table([_row(bucket, _merged(held))])


SPOTS = "part int, doc_id binary, spot binary"


class Bucketed:
    """A table in buckets of a column, one file each: what joins it by that column finds it in place."""

    def __init__(self, rows: DataFrame, label: str, column: str, buckets: int):
        self.spark = rows.sparkSession
        self.name, self.folder = f"{label}_{uuid.uuid4().hex}", new_folder(self.spark, label)
        (
            rows.write.bucketBy(buckets, column).option("path", self.folder).option("compression", "zstd")
            .saveAsTable(self.name)
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.spark, self.folder)


class Family:
    """Suffix arrays as tables of one row a bucket, bucketed by it, so that arrays meet bucket by
    bucket without being moved. `levels` are (batches, table), oldest first."""

    def __init__(self, spark: SparkSession, buckets: int, crowd: int = 1 << 14):
        self.spark, self.buckets, self.crowd = spark, buckets, crowd
        self.levels: list[tuple[int, Bucketed]] = []

    def _store(self, runs: DataFrame) -> Bucketed:
        together = runs.repartition(self.buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_one_run, ARRAY)
        return Bucketed(together, "suffixes", "bucket", self.buckets)

    def add(self, runs: DataFrame) -> DataFrame:
        """Take a batch in; what is returned, to be read before the next batch comes, are its suffixes and those of the levels that begin like a
        suffix of another document, as (part, doc_id, spot) with many of them in a row. The lowest bit
        of a spot says that its beginning is crowded by now. A suffix may be returned by several
        batches; one in a crowd is returned by every batch that adds to it.
        """
        self._merge()
        own = self._store(runs)
        met, names = own.read(), [CELLS]
        for i, (_, level) in enumerate(self.levels):
            names.append(tuple(f"{c}{i}" for c in CELLS))
            met = met.join(level.read().withColumnsRenamed(dict(zip(CELLS, names[-1]))), "bucket", "left")
        parts, crowd = self.buckets, self.crowd

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    arrays = [[batch.column(c)[i].as_py() for c in cells] for cells in names]
                    arrays = [_columns(a) for a in arrays if a[0] is not None]
                    high, low, doc_id, spot = (np.concatenate(c) for c in zip(*arrays))
                    fresh = np.arange(len(high)) < len(arrays[0][0])
                    order = np.lexsort((low, high))
                    high, low, doc_id, spot, fresh = (c[order] for c in (high, low, doc_id, spot, fresh))
                    new = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
                    sizes = np.diff(np.append(new, len(high)))
                    several = np.minimum.reduceat(doc_id, new) < np.maximum.reduceat(doc_id, new)
                    several &= np.logical_or.reduceat(fresh, new)
                    hit = np.flatnonzero(np.repeat(several, sizes))
                    spot = (spot << 1) | np.repeat(sizes > crowd, sizes)
                    yield from _dealt(doc_id[hit], spot[hit], parts)

        found = met.mapInArrow(scan, SPOTS)
        self.levels.append((1, own))
        return found

    def _merge(self) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, late), (m, early) = self.levels.pop(), self.levels.pop()
            self.levels.append((n + m, self._store(early.read().union(late.read()))))
            early.drop()
            late.drop()

    def drop(self) -> None:
        for _, level in self.levels:
            level.drop()
        self.levels = []


def _dealt(doc_id: np.ndarray, spot: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Suffixes dealt into parts by their document, a row for each part."""
    if not len(doc_id):
        return
    part = (((doc_id.view(np.uint64) * _A) >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0, [True]]))
    yield pa.RecordBatch.from_arrays([
        pa.array(part[order[edges[:-1]]].astype(np.int32)),
        *(pa.array([c[order[a:b]].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()) for c in (doc_id, spot)),
    ], names=["part", "doc_id", "spot"])


def spots_of_documents(found: DataFrame, parts: int) -> DataFrame:
    """(doc_id, spots): the found suffixes of every document, each once, with the crowded bit if any
    batch has set it."""

    def settle(held) -> pa.RecordBatch:
        doc_id, spot = (np.concatenate([np.frombuffer(x, np.int64) for x in c]) for c in zip(*held))
        order = np.lexsort((-spot, doc_id))
        doc_id, spot = doc_id[order], spot[order]
        # Of a spot with and without the bit the one with it comes first.
        once = np.concatenate([[True], (doc_id[1:] != doc_id[:-1]) | (spot[1:] >> 1 != spot[:-1] >> 1)])
        doc_id, spot = doc_id[once], spot[once]
        new = np.flatnonzero(np.concatenate([[True], doc_id[1:] != doc_id[:-1]]))
        return pa.RecordBatch.from_arrays([
            pa.array(doc_id[new]), pa.ListArray.from_arrays(np.append(new, len(doc_id)).astype(np.int32), spot)
        ], names=["doc_id", "spots"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for number, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "spot"))):
                if number != part and held:
                    yield settle(held)
                    held = []
                part = number
                held.append(row)
        if held:
            yield settle(held)

    dealt = found.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "doc_id long, spots array<long>")


def remove_repeats(documents: DataFrame, length: int = 50, batches: int = 4, crowd: int = 1 << 14) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document, as UTF-8 bytes: every byte
    is removed that is covered by a string of `length` bytes that also starts in a document with a
    smaller doc_id. Strings are judged on the input; `n_spans` counts maximal removed runs.

    Documents are taken in by `batches` batches in the order of their ids. A copy of a whole document
    is settled by its digest, before any suffix is made. Suffixes with one beginning are verified in
    one task up to `crowd` of them; the strings of more crowded ones are dealt out by their own hash,
    where a string that many documents share is reduced to its smallest doc_id before it moves.
    Verified strings are compared by 64-bit hashes (128 bits in crowds).

    Defined results: a null text is empty. A document without an id keeps all its bytes and takes
    none from others. Rows with the same doc_id are documents of their own, neither before the other.
    Texts shorter than `length` stay whole. Other columns are not read.
    """
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("bytes")).withColumn("mark", F.xxhash64("bytes"))
    facts = materialize(rows.select(
        "doc_id", "mark", F.octet_length("bytes").cast("long").alias("n_bytes"), F.sha2("bytes", 256).alias("digest")
    ), "facts")
    same = facts.where(f"doc_id is not null and n_bytes >= {length}").groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")
    ).where("least < most").select("digest", "least")
    copies = materialize(
        facts.join(same, "digest").where("doc_id > least").select("doc_id", "mark").distinct(), "copies"
    )
    texts = rows.where(F.col("doc_id").isNotNull() & (F.octet_length("bytes") >= length)).join(
        small(copies, 32), ["doc_id", "mark"], "left_anti"
    )
    shares = [i / batches for i in range(1, batches)]
    cuts = facts.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 10_000)).first()[0] or [] if shares else []
    bounds = [None, *sorted(set(cuts)), None]
    n_bytes = facts.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // ((length - GRAM + 2) // 2 * BUCKET)))
    family, found, folders = Family(spark, buckets, crowd), None, []
    for low, high in zip(bounds, bounds[1:]):
        part = texts
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        matches, folder = kept_table(family.add(suffixes(part, length, buckets)), "found")
        folders.append(folder)
        found = matches if found is None else found.union(matches)
        release(spark)
    family.drop()
    # The texts with a found suffix move once, and are then read in place by what follows.
    placed, folder = kept_table(spots_of_documents(found, buckets), "spots")
    for old in folders:
        discard(spark, old)
    held = texts.repartition(buckets, "doc_id").join(placed, "doc_id").select("doc_id", "mark", "bytes", "spots")
    held = Bucketed(held, "held", "doc_id", buckets)
    discard(spark, folder)
    release(spark)
    spans = materialize(_verified(_excerpts(held.read(), length), length), "spans")
    release(spark)
    crowded = held.read().where(F.exists("spots", lambda x: x % 2 == 1))
    if not crowded.isEmpty():
        spans = spans.union(materialize(_crowded(crowded, length), "crowded_spans"))
        release(spark)
    cut = materialize(_cut(held.read(), spans), "cut")
    held.drop()
    whole = copies.withColumn("copy", F.lit(True))
    copied = F.coalesce("copy", F.lit(False))
    done = facts.join(small(whole, 32), ["doc_id", "mark"], "left").join(cut, ["doc_id", "mark"], "left")
    return done.select(
        "doc_id", "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept", "digest")).alias("kept_sha256"),
    )


def _chosen(batch: pa.RecordBatch, crowd: int):
    """Of every text: its id, mark and bytes, and the first and last strings of its suffixes that are
    (not) in a crowd, with their places."""
    for doc_id, mark, data, spots in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "mark", "bytes", "spots"))):
        spot = np.array(spots, np.int64)
        spot = np.sort(spot[(spot & 1) == crowd] >> 1)
        place, first, last = _unpacked(spot)
        # A row that repeats another's id with a shorter text has fewer places.
        yield doc_id, mark, data, place, first, last


def _excerpts(held: DataFrame, length: int) -> DataFrame:
    """(key, doc_id, mark, first, excerpt): of every found suffix the bytes that hold its strings, with
    a hash of its beginning."""

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, mark, data, place, first, last in _chosen(batch, 0):
                fits = last + length <= len(data)
                place, first, last = place[fits], first[fits], last[fits]
                words = _words(np.frombuffer(data, np.uint8))
                key = (words[place] * _A) ^ (words[place + 8] * _B)
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(np.full(len(place), doc_id, np.int64)),
                    pa.array(np.full(len(place), mark, np.int64)), pa.array(first.astype(np.int32)),
                    pa.array([data[a:b] for a, b in zip(first.tolist(), (last + length).tolist())], pa.binary()),
                ], names=["key", "doc_id", "mark", "first", "excerpt"])

    alone = held.where(F.exists("spots", lambda x: x % 2 == 0))
    return alone.mapInArrow(cut_out, "key long, doc_id long, mark long, first int, excerpt binary")


SPAN = "doc_id long, mark long, begin int, end int"


def _verified(excerpts: DataFrame, length: int) -> DataFrame:
    """Removed stretches of the excerpts: all excerpts of one key are compared in one task."""

    def settle(groups: pa.Table) -> pa.RecordBatch:
        sizes = pc.binary_length(groups.column("excerpt")).to_numpy() - length + 1
        flat = np.frombuffer(b"".join(groups.column("excerpt").to_pylist()), np.uint8)
        begin = np.cumsum(sizes + length - 1) - (sizes + length - 1)
        row = np.repeat(np.arange(len(sizes)), sizes)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        string = hashes(flat, length)[begin[row] + offset]
        doc_id = groups.column("doc_id").to_numpy()[row]
        order = np.lexsort((doc_id, string))
        new = np.concatenate([[True], string[order][1:] != string[order][:-1]])
        least = doc_id[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        removed = np.zeros(len(row), bool)
        removed[order] = doc_id[order] > least
        # Runs of removed strings of one row.
        edge = np.concatenate([[True], row[1:] != row[:-1]])
        opens = removed & (edge | ~np.concatenate([[False], removed[:-1]]))
        closes = removed & np.append(edge[1:] | ~removed[1:], True)
        a, b = np.flatnonzero(opens), np.flatnonzero(closes)
        first = groups.column("first").to_numpy()
        return pa.RecordBatch.from_arrays([
            pa.array(doc_id[a]), pa.array(groups.column("mark").to_numpy()[row[a]]),
            pa.array((first[row[a]] + offset[a]).astype(np.int32)), pa.array((first[row[b]] + offset[b] + length).astype(np.int32)),
        ], names=["doc_id", "mark", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # Whole groups: all rows before those of the last key; that key may go on.
            end = batch.num_rows
            keys = batch.column("key").to_numpy()
            last = keys[-1]
            others = np.flatnonzero(keys != last)
            end = int(others[-1]) + 1 if len(others) else 0
            ready = [*held, batch.slice(0, end)]
            if end:
                yield settle(pa.Table.from_batches(ready).combine_chunks())
                held = [batch.slice(end)]
            elif held and held[-1].column("key")[-1].as_py() != last:
                yield settle(pa.Table.from_batches(held).combine_chunks())
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield settle(pa.Table.from_batches(held).combine_chunks())

    return excerpts.repartition("key").sortWithinPartitions("key").mapInArrow(run, SPAN)


def _crowded(held: DataFrame, length: int) -> DataFrame:
    """The same of crowded beginnings, string by string."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, mark, data, _, first, last in _chosen(batch, 1):
                text, fits = np.frombuffer(data, np.uint8), last + length <= len(data)
                at = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[fits], last[fits])] or [np.empty(0, np.int64)])
                if not len(at):
                    continue
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(hashes(text, length, seed)[at].view(np.int64)) for seed in (1, 1_000_003)),
                    pa.array(np.full(len(at), doc_id, np.int64)), pa.array(np.full(len(at), mark, np.int64)), pa.array(at.astype(np.int32)),
                ], names=["x", "y", "doc_id", "mark", "begin"])

    rows = materialize(held.mapInArrow(strings, "x long, y long, doc_id long, mark long, begin int"), "strings")
    firsts = rows.groupBy("x", "y").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    # The strings of crowds that several documents share are few beside their places.
    firsts = small(materialize(firsts.where("least < most").select("x", "y", "least"), "firsts"), 48)
    return rows.join(firsts, ["x", "y"]).where("doc_id > least").select(
        "doc_id", "mark", "begin", (F.col("begin") + length).alias("end")
    )


def _cut(held: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, mark, removed, spans, kept) of the documents that lose something."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data, stretches in zip(batch.column("bytes").to_pylist(), batch.column("stretches")):
                begin, end = (stretches.values.field(i).to_numpy() for i in (0, 1))
                order = np.argsort(begin, kind="stable")
                begin, reach = begin[order], np.maximum.accumulate(end[order])
                fresh_run = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
                begin, end = begin[fresh_run], reach[np.append(fresh_run[1:], len(reach)) - 1]
                kept = hashlib.sha256()
                for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(data)]):
                    kept.update(data[a:b])
                found.append((int((end - begin).sum()), len(begin), kept.hexdigest()))
            if found:
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("mark"), *(pa.array(x) for x in zip(*found))
                ], names=["doc_id", "mark", "removed", "spans", "kept"])

    stretches = spans.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("stretches"))
    # By the id alone, by which the texts are bucketed; a row that repeats both id and text is cut once.
    once = held.join(stretches.withColumnRenamed("mark", "of"), "doc_id").where(F.col("mark") == F.col("of")).select(
        "doc_id", "mark", "bytes", "stretches"
    )
    return once.mapInArrow(cut, "doc_id long, mark long, removed long, spans long, kept string").distinct()
