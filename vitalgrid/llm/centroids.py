"""Clustering of vectors around centroids in whole numbers, with a filter of rotated coordinates.

Every vector is stored with its leading coordinates along the principal axes of the table and the
norm of the rest. For a vector x and a centroid c, with p their leading coordinates and r the norms
of what is left,

    |x - c|^2  >=  |p(x) - p(c)|^2 + (r(x) - r(c))^2,

so most centroids are ruled out by a few numbers. What the bound leaves, with an allowance for the
rounding of the rotation, is compared in whole numbers, which alone decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.integers import TOTALS, Totals, countable, exact, floor_means, joined, matrix, saturated, saturated_sum, whole
from vitalgrid.session import materialize

#: Share of the squared lengths that covers what rounding can do to a bound.
ALLOWANCE = 1e-9


class Rotation:
    """The leading principal axes of a table around its mean."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray):
        self.mean, self.axes = mean, axes

    def split(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading coordinates, norm of the rest, and the squared length that rounding is measured by."""
        moved = values.astype(np.float64) - self.mean
        leading = moved @ self.axes
        square = (moved * moved).sum(axis=1)
        rest = np.sqrt(np.maximum(square - (leading * leading).sum(axis=1), 0.0))
        return leading, rest, square + (self.mean * self.mean).sum()


def principal_axes(stored: DataFrame, size: int, leading: int) -> Rotation:
    """Mean and principal axes from sums over all vectors: size * (size + 1) + 1 numbers to the driver."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + size + size * size)
        for batch in batches:
            values = matrix(batch).astype(np.float64)
            total += np.concatenate([[len(values)], values.sum(axis=0), (values.T @ values).ravel()])
        yield pa.RecordBatch.from_pydict({"slot": pa.array(np.arange(len(total), dtype=np.int32)), "total": pa.array(total)})

    found = stored.select("values").mapInArrow(moments, "slot int, total double").groupBy("slot").agg(F.sum("total"))
    total = np.zeros(1 + size + size * size)
    for slot, value in found.collect():
        total[slot] = value
    n = max(total[0], 1.0)
    mean = total[1:size + 1] / n
    spread = total[size + 1:].reshape(size, size) / n - np.outer(mean, mean)
    _, axes = np.linalg.eigh((spread + spread.T) / 2)
    return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, :leading]))


def nearest(values, leading, rest, square, centroids: np.ndarray, rotation: Rotation):
    """Of every vector: its nearest centroid, ties to the smaller number, the squared distance, and
    the number of centroids that were compared in whole numbers."""
    c_leading, c_rest, c_square = rotation.split(centroids)
    both = exact(np.concatenate([values, centroids]), values.shape[1])
    values, centroids = both[:len(values)], both[len(values):]
    bound = (rest[:, None] - c_rest) ** 2
    for i in range(leading.shape[1]):
        bound += (leading[:, i, None] - c_leading[:, i]) ** 2
    bound -= ALLOWANCE * (square[:, None] + c_square + 1.0)

    def distance(rows, c):
        apart = values[rows] - centroids[c]
        return (apart * apart).sum(axis=1)

    cluster = bound.argmin(axis=1)
    best = distance(np.arange(len(values)), cluster)
    compared = np.ones(len(values), np.int64)
    first = cluster.copy()
    for c in range(len(centroids)):
        rows = np.flatnonzero((bound[:, c] <= best.astype(np.float64)) & (first != c))
        if not len(rows):
            continue
        found = distance(rows, c)
        compared[rows] += 1
        better = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = found[better], c
    return cluster, best, compared


def cluster(vectors: DataFrame, clusters: int = 16, rounds: int = 3, scale: int = 64, size: int = 64, leading: int = 8, seed: int = 1) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, compared) of every vector
    of `size` components.

    Components become floor(scale * x). The first centroids are the vectors whose `seed:vec_id` has
    the smallest sha256; each of the rounds assigns all vectors to the nearest centroid and replaces
    every centroid that has vectors by their componentwise floor(sum / count). `compared` counts the
    centroids whose distance was computed; the others were ruled out by the bound.

    What travels: the rotated table is written once and scanned in every round; a task gives one sum
    for each cluster and component, and the driver gets clusters * size sums a round.

    Defined results: vectors that are null, of another length, or hold a null or non-finite component
    (or one whose scaled form does not fit 62 bits) have no row. Fewer vectors than clusters give as
    many centroids as vectors. Rows that repeat a vec_id are vectors of their own; of equal hashes the
    smaller vector comes first. A null vec_id is hashed as an empty text. Distances and inertias above
    2^63 - 1 are given as that. Other columns are not read.
    """
    kept = vectors.where(countable(scale) & (F.size("embedding") == size)).select("vec_id", whole(scale).alias("values"))
    kept = materialize(kept, "whole_vectors")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    # As many rows as there are clusters.
    chosen = kept.select("values", F.sha2(named, 256).alias("hash")).orderBy("hash", "values").limit(clusters).collect()
    if not chosen:
        return kept.select(
            "vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")),
            F.lit("").alias("centroid_sha256"), F.lit(0).cast("long").alias("compared"),
        )
    centers = np.array([list(r["values"]) for r in chosen], dtype=np.int64)
    rotation = principal_axes(kept, size, leading)

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, rest, square = rotation.split(matrix(batch))
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1], p.ravel()),
                pa.array(rest), pa.array(square),
            ], names=["vec_id", "values", "leading", "rest", "square"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    stored = materialize(kept.mapInArrow(
        rotate, f"vec_id {kind}, values array<long>, leading array<double>, rest double, square double"
    ), "rotated")

    def assigned(batch: pa.RecordBatch, centers: np.ndarray):
        values = matrix(batch)
        parts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rest", "square"))
        return values, *nearest(values, matrix(batch, "leading", np.float64), *parts, centers, rotation)

    def sums(centers: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = Totals(*centers.shape)
            for batch in batches:
                values, number, _, _ = assigned(batch, centers)
                totals.add(number, values)
            yield from totals.batches()

        return run

    for _ in range(rounds):
        centers = floor_means(stored.mapInArrow(sums(centers), TOTALS), centers)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, number, distance, compared = assigned(batch, centers)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(saturated(distance)), pa.array(compared)],
                names=["vec_id", "cluster", "distance", "compared"],
            )

    found = materialize(stored.mapInArrow(last, f"vec_id {kind}, cluster int, distance long, compared long"), "assigned")
    digests = stored.sparkSession.createDataFrame(
        [(i, hashlib.sha256(joined(c).encode()).hexdigest()) for i, c in enumerate(centers)],
        "cluster int, centroid_sha256 string",
    )
    inertia = found.agg(saturated_sum("distance").alias("inertia"))
    of_cluster = found.groupBy("cluster").agg(saturated_sum("distance").alias("cluster_inertia"))
    # One row for each cluster; their number is an argument.
    facts = digests.join(F.broadcast(of_cluster), "cluster").join(F.broadcast(inertia))
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared"
    )
