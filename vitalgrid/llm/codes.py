"""Compression of vectors to codes: a codebook for each of equal parts, searched by Hadamard sums.

Parts and entries are padded with zeros to a power of two, m, and multiplied by the Walsh-Hadamard
matrix, whose rows stand in the order of their sign changes. The transform keeps distances up to a
factor: the squared differences of two transformed parts add up to m times the squared distance, and
every leading sum is at most that. The first coefficients hold most of smooth parts, so an entry
whose sum exceeds the best total leaves early. All of it is whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.integers import SATURATED, TOTALS, Totals, countable, exact, floor_means, joined, largest, matrix, saturated, saturated_sum, whole
from vitalgrid.session import materialize


def sequency_matrix(width: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of the next power of two, rows by their number of sign changes."""
    signs = np.ones((1, 1), np.int64)
    while len(signs) < width:
        signs = np.block([[signs, signs], [signs, -signs]])
    changes = (signs[:, 1:] != signs[:, :-1]).sum(axis=1)
    return signs[np.argsort(changes, kind="stable")]


def transform(parts: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows padded with zeros and transformed; the padding adds nothing, so its columns are left out."""
    return exact(parts.dot(signs[:, :parts.shape[1]].T), len(signs))


def nearest_entries(parts: np.ndarray, entries: np.ndarray, signs: np.ndarray):
    """Of every part: its nearest entry, ties to the lower index, the squared distance, and the number
    of (entry, coefficient) steps that were taken."""
    if len(signs) * (2 * len(signs) * max(largest(parts), largest(entries))) ** 2 >= 1 << 62:
        parts, entries = parts.astype(object), entries.astype(object)
    x, e = transform(parts, signs), transform(entries, signs)
    sums = (x[:, 0, None] - e[:, 0]) ** 2
    guess = sums.argmin(axis=1)
    limit = ((x - e[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= limit[:, None])
    total, steps = sums[row, entry], sums.size
    for i in range(1, len(signs)):
        steps += len(row)
        total = total + (x[row, i] - e[entry, i]) ** 2
        alive = np.flatnonzero(total <= limit[row])
        row, entry, total = row[alive], entry[alive], total[alive]
    order = np.lexsort((entry, total, row)) if total.dtype != object else np.array(
        sorted(range(len(row)), key=lambda i: (row[i], total[i], entry[i])), dtype=np.int64
    )
    first = order[np.flatnonzero(np.concatenate([[True], row[order][1:] != row[order][:-1]]))]
    return entry[first], total[first] // len(signs), steps


def compress(vectors: DataFrame, label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector.

    Components become floor(scale * x), and vectors are cut into equal parts. A position's codebook
    starts as that part of the vectors with the smallest vec_ids; each round assigns every part to its
    nearest entry and replaces each used entry by the componentwise floor(sum / count) of its parts.
    `code` has two hex digits a part (more, where there are more than 256 entries), `error` is the
    final squared distance over all parts, `label_error` its sum over equal labels, nulls together.

    What travels: vectors are written once and scanned in every round; a task gives one sum for each
    entry and component; the driver gets the codebooks' numbers. Sums by label are reduced in the
    tasks before they move, so a label that many rows have is one row of each task.

    Defined results: null vectors, empty ones, and those with a null or non-finite component (or one
    whose scaled form does not fit 62 bits) have no row. Vectors are read at the greatest length there
    is, rounded up to a multiple of the parts, with zeros at the end. Fewer vectors than entries give
    codebooks of as many entries. Rows that repeat a vec_id are vectors of their own; of equal ids the
    smaller vector comes first, and null ids come last. Errors above 2^63 - 1 are given as that. Other
    columns are not read.
    """
    kept = vectors.where(countable(scale)).select("vec_id", F.col(label).alias("label"), whole(scale).alias("values"))
    kept = materialize(kept, "whole_vectors")
    longest, shortest = kept.agg(F.max(F.size("values")), F.min(F.size("values"))).first()
    if longest is None:
        zero = F.lit(0).cast("long")
        return kept.select("vec_id", F.lit("").alias("code"), zero.alias("error"), zero.alias("label_error"), F.lit("").alias("codebooks_sha256"))
    width = -(-longest // parts)
    if shortest < width * parts:
        lacking = F.array_repeat(F.lit(0).cast("long"), F.lit(width * parts) - F.size("values"))
        kept = kept.withColumn("values", F.concat("values", lacking))
    # As many rows as a codebook has entries.
    chosen = kept.orderBy(F.col("vec_id").asc_nulls_last(), "values").limit(entries).select("values").collect()
    books = np.array([list(r[0]) for r in chosen], dtype=np.int64).reshape(len(chosen), parts, width).transpose(1, 0, 2)
    signs = sequency_matrix(width)
    digits = max(2, len(f"{len(chosen) - 1:x}"))

    def coded(batch: pa.RecordBatch, books: np.ndarray):
        values = matrix(batch).reshape(batch.num_rows, parts, width)
        return values, [nearest_entries(values[:, i], books[i], signs)[:2] for i in range(parts)]

    def sums(books: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = Totals(parts * books.shape[1], width)
            for batch in batches:
                if batch.num_rows:
                    values, found = coded(batch, books)
                    for i, (entry, _) in enumerate(found):
                        totals.add(entry + i * books.shape[1], values[:, i])
            yield from totals.batches()

        return run

    for _ in range(rounds):
        flat = floor_means(kept.select("values").mapInArrow(sums(books), TOTALS), books.reshape(-1, width))
        books = flat.reshape(books.shape)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, found = coded(batch, books)
                text = [np.char.mod(f"%0{digits}x", entry) for entry, _ in found]
                code = ["".join(row) for row in zip(*(t.tolist() for t in text))]
                wide = parts * max(largest(e) for _, e in found) > SATURATED
                error = saturated(sum(e.astype(object) if wide else e for _, e in found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"],
                )

    kinds = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    found = materialize(kept.mapInArrow(last, f"{kinds}, code string, error long"), "codes")
    of_label = found.groupBy(F.col("label").alias("same")).agg(saturated_sum("error").alias("label_error"))
    digest = hashlib.sha256(joined(books.ravel()).encode()).hexdigest()
    return found.join(of_label, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
