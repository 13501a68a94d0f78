"""Linear forecasts from sums that add up: a refit costs what is new, not what is old.

The fit of a linear model needs nothing of the rows but the sums of all products of their columns.
Those of a batch are computed once, in the tasks, and are added to the sums so far; the coefficients
follow from a few thousand numbers. Sums are taken around a fixed centre, so that they stay precise
for readings that are large and vary little.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Penalty on the coefficients, in units of standardised columns.
PENALTY = 1e-3
SUMS = "i int, j int, total double"


def lags(sequence: str, columns: Sequence[str] = ()) -> Column:
    """The window as one array of numbers: readings in order, each with its columns in order."""
    return F.flatten(sequence) if columns else F.col(sequence)


@dataclass(frozen=True)
class Moments:
    """Sums over rows (1, x - centre, y - centre): entry (i, j) adds up the product of columns i and j;
    entry (0, 0) is the number of rows."""

    totals: np.ndarray
    centre: float = 0.0

    @staticmethod
    def none(inputs: int, centre: float = 0.0) -> Moments:
        return Moments(np.zeros((inputs + 2, inputs + 2)), centre)

    @staticmethod
    def of(rows: DataFrame, inputs: int, centre: float = 0.0) -> Moments:
        return Moments.none(inputs, centre).filled(product_sums(rows, inputs, centre))

    def filled(self, table: DataFrame) -> Moments:
        """The sums of a table of SUMS: (inputs + 2)(inputs + 3) / 2 numbers."""
        totals = np.zeros_like(self.totals)
        for i, j, total in table.select("i", "j", "total").collect():
            totals[i, j] = totals[j, i] = total
        return Moments(totals, self.centre)

    def table(self, spark) -> DataFrame:
        size = len(self.totals)
        rows = [(i, j, float(self.totals[i, j])) for i in range(size) for j in range(i, size)]
        return spark.createDataFrame(rows, SUMS)

    def __add__(self, other: Moments) -> Moments:
        if self.centre != other.centre:
            raise ValueError("sums around different centres do not add up")
        return Moments(self.totals + other.totals, self.centre)

    @property
    def rows(self) -> int:
        return int(round(self.totals[0, 0]))

    def fit(self, penalty: float = PENALTY) -> tuple[np.ndarray, float] | None:
        """Coefficients and intercept; None without rows.

        The normal equations are solved for standardised columns with `penalty` on their diagonal; a
        column that does not vary gets no weight.
        """
        n = self.totals[0, 0]
        if n < 1:
            return None
        mean = self.totals[0, 1:] / n
        spread = self.totals[1:, 1:] / n - np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
        scale = np.where(scale > 1e-9 * (1 + np.abs(mean)), scale, 0.0)
        safe = np.where(scale > 0, scale, 1.0)
        likeness = np.where(np.outer(scale, scale) > 0, spread / np.outer(safe, safe), 0.0)
        inputs = len(mean) - 1
        system = likeness[:inputs, :inputs] + np.diag(np.where(scale[:inputs] > 0, penalty, 1.0))
        weights = np.linalg.solve(system, likeness[:inputs, inputs])
        weights = np.where(scale[:inputs] > 0, weights * scale[inputs] / safe[:inputs], 0.0)
        return weights, float(self.centre + mean[inputs] - weights @ (self.centre + mean[:inputs]))

    def leftover(self, weights: np.ndarray, intercept: float) -> float:
        """Largest correlation that a model's residual still has with an input, or its mean in units of
        the target's deviation: near 0 for a least-squares fit, however noisy the rows."""
        n = self.totals[0, 0]
        weights = np.asarray(weights, dtype=float)
        around = np.concatenate([[intercept + self.centre * (weights.sum() - 1)], weights, [-1.0]])
        products = self.totals @ around / n
        mean = self.totals[0, 1:] / n
        scale = np.sqrt(np.maximum(np.diag(self.totals)[1:] / n - mean * mean, 0.0))
        inputs, varies = len(mean) - 1, scale > 1e-9 * (1 + np.abs(mean))
        if not varies[inputs]:
            return float(abs(products[0]))
        left = np.append(products[1:inputs + 1] - products[0] * mean[:inputs], products[0])[np.append(varies[:inputs], True)]
        return float(np.abs(left / np.append(scale[:inputs], 1.0)[np.append(varies[:inputs], True)]).max() / scale[inputs])

    def mean_squared(self, weights: np.ndarray, intercept: float) -> float | None:
        """Mean squared error of a model over the rows, from the sums alone."""
        n = self.totals[0, 0]
        if n < 1:
            return None
        # The model in centred columns: its residual is linear in (1, x, y).
        around = np.concatenate([[intercept + self.centre * (weights.sum() - 1)], weights, [-1.0]])
        return max(0.0, float(around @ self.totals @ around) / n)


def product_sums(rows: DataFrame, inputs: int, centre: float = 0.0) -> DataFrame:
    """SUMS of rows (features array, target): a task gives one number for each pair of columns.

    Rows with a null or NaN reading or target are left out.
    """
    whole = F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x)) & F.col("target").isNotNull() & ~F.isnan("target")
    kept = rows.where(whole & (F.size("features") == inputs)).select(
        F.col("features").cast("array<double>").alias("features"), F.col("target").cast("double").alias("target")
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((inputs + 2, inputs + 2))
        for batch in batches:
            if batch.num_rows:
                x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, inputs)
                y = batch.column("target").to_numpy(zero_copy_only=False)
                block = np.column_stack([np.ones(len(y)), x - centre, y - centre])
                totals += block.T @ block
        if totals[0, 0]:
            i, j = np.triu_indices(inputs + 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(totals[i, j])], names=["i", "j", "total"]
            )

    return kept.mapInArrow(add_up, SUMS).groupBy("i", "j").agg(F.sum("total").alias("total"))


@dataclass(frozen=True)
class AdditiveForecaster:
    """A linear forecast of the next reading; scoring is a column expression."""

    steps: int
    weights: tuple[float, ...]
    intercept: float
    columns: tuple[str, ...] = ()
    run: dict = field(default_factory=dict)

    @staticmethod
    def of(moments: Moments, steps: int, columns: Sequence[str] = (), penalty: float = PENALTY) -> AdditiveForecaster | None:
        fitted = moments.fit(penalty)
        if fitted is None:
            return None
        weights, intercept = fitted
        run = {"samples": moments.rows, "final_loss": moments.mean_squared(weights, intercept)}
        return AdditiveForecaster(steps, tuple(map(float, weights)), intercept, tuple(columns), run)

    def predict(self, windows: DataFrame, sequence: str = "sequence") -> DataFrame:
        """Adds `predicted`; a window with a null reading has none."""
        weights = F.array(*[F.lit(w) for w in self.weights])
        products = F.zip_with(lags(sequence, self.columns), weights, lambda x, w: x * w)
        total = F.aggregate(products, F.lit(self.intercept), lambda a, x: a + x)
        return windows.withColumn("predicted", total)

    def facts(self) -> dict:
        return {"steps": self.steps, "weights": list(self.weights), "intercept": self.intercept, "columns": list(self.columns)}

    @staticmethod
    def from_facts(facts: dict) -> AdditiveForecaster:
        return AdditiveForecaster(facts["steps"], tuple(facts["weights"]), facts["intercept"], tuple(facts["columns"]))
