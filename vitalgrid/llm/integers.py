"""Whole-number forms of vectors and exact means of them, for the clustering and the coding of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.vectors import usable

#: Scaled components stay below this; what reaches it is as little a number as infinity.
LARGEST = 1 << 62
#: The largest distance or error that its column can hold; anything above is given as this.
SATURATED = (1 << 63) - 1

TOTALS = "cell int, slot int, total string, n long"


def countable(scale: int, column: str = "embedding") -> Column:
    """Whether a vector is there, without null or non-finite components, and its scaled form fits 64 bits."""
    small = F.forall(F.col(column), lambda x: F.abs(x.cast("double")) * scale < float(LARGEST))
    return usable(column) & F.coalesce(small, F.lit(False))


def whole(scale: int, column: str = "embedding") -> Column:
    return F.transform(F.col(column), lambda x: F.floor(x.cast("double") * scale).cast("long"))


def matrix(batch: pa.RecordBatch, column: str = "values", kind=np.int64) -> np.ndarray:
    """Equally long arrays of a column as the rows of a matrix."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(batch.num_rows, -1)


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.min(initial=0))), abs(int(values.max(initial=0))))


def exact(values: np.ndarray, terms: int = 1) -> np.ndarray:
    """The numbers in a type in which `terms` squares of their differences add up without overflow."""
    return values if values.dtype != object and terms * (2 * largest(values)) ** 2 < 1 << 62 else values.astype(object)


def saturated(numbers: np.ndarray) -> np.ndarray:
    if numbers.dtype != object:
        return numbers.astype(np.int64)
    return np.array([min(int(x), SATURATED) for x in numbers], dtype=np.int64)


def saturated_sum(column: str) -> Column:
    total = F.sum(F.col(column).cast("decimal(38,0)"))
    return F.least(total, F.lit(SATURATED).cast("decimal(38,0)")).cast("long")


class Totals:
    """Sums of the rows of each cell, in numbers of any size; a task gives a few rows for each cell."""

    def __init__(self, cells: int, width: int):
        self.sums = np.zeros((cells, width), dtype=object)
        self.counts = np.zeros(cells, dtype=np.int64)

    def add(self, cell: np.ndarray, values: np.ndarray) -> None:
        if not len(cell):
            return
        order = np.argsort(cell, kind="stable")
        cell, values = cell[order], values[order]
        begins = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        values = values if len(cell) * largest(values) < 1 << 62 else values.astype(object)
        self.sums[cell[begins]] += np.add.reduceat(values, begins, axis=0).astype(object)
        self.counts[cell[begins]] += np.diff(np.append(begins, len(cell)))

    def batches(self) -> Iterator[pa.RecordBatch]:
        cells = np.flatnonzero(self.counts)
        if len(cells):
            width = self.sums.shape[1]
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array(np.repeat(cells, width).astype(np.int32)),
                "slot": pa.array(np.tile(np.arange(width), len(cells)).astype(np.int32)),
                "total": pa.array([str(x) for x in self.sums[cells].ravel()], pa.string()),
                "n": pa.array(np.repeat(self.counts[cells], width)),
            })


def floor_means(totals: DataFrame, before: np.ndarray) -> np.ndarray:
    """The cells' new values: floor(sum / count), or what they were before where nothing fell into them.

    The rows that come to the driver are as many as the numbers of `before`.
    """
    summed = totals.groupBy("cell", "slot").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    after = before.astype(object)
    for cell, slot, total, n in summed.collect():
        after[cell, slot] = int(total) // n
    return after.astype(np.int64)


def joined(numbers) -> str:
    return ",".join(str(int(x)) for x in numbers)
