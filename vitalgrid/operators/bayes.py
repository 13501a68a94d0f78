"""Gaussian naive Bayes from grouped moments, and its cross-validation in one pass."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMOOTHING = 1e-9
# Classes a model may have: their moments are literals of the scoring expression.
CLASS_LIMIT = 1_000


@dataclass(frozen=True)
class Moments:
    """Rows, mean and summed squared deviation per feature of one group of rows."""

    rows: int
    means: tuple[float, ...]
    spreads: tuple[float, ...]

    def merge(self, other: Moments) -> Moments:
        """Pairwise update of Chan, Golub and LeVeque."""
        rows = self.rows + other.rows
        means, spreads = [], []
        for a, b, s, t in zip(self.means, other.means, self.spreads, other.spreads):
            delta = b - a
            means.append(a + delta * other.rows / rows)
            spreads.append(s + t + delta * delta * self.rows * other.rows / rows)
        return Moments(rows, tuple(means), tuple(spreads))


def grouped_moments(df: DataFrame, features: Sequence[str], *group: str) -> dict[tuple, Moments]:
    """One map-side combined aggregate; as many rows as there are classes (times folds)."""
    table = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            stat(F.col(f"`{c}`").cast("double")).alias(f"{tag}{i}")
            for i, c in enumerate(features)
            for tag, stat in (("m", F.avg), ("v", F.var_pop))
        ],
    )
    found = table.limit(CLASS_LIMIT + 1).collect()
    if len(found) > CLASS_LIMIT:
        raise ValueError(f"more than {CLASS_LIMIT} classes")
    size = range(len(features))
    return {
        tuple(row[g] for g in group): Moments(
            row["rows"],
            tuple(row[f"m{i}"] for i in size),
            tuple(row[f"v{i}"] * row["rows"] for i in size),
        )
        for row in found
    }


def merged(parts) -> Moments:
    parts = list(parts)
    total = parts[0]
    for part in parts[1:]:
        total = total.merge(part)
    return total


@dataclass(frozen=True)
class GaussianBayes:
    features: tuple[str, ...]
    classes: dict[int, Moments]

    def log_likelihoods(self) -> dict[int, Column]:
        everything = merged(self.classes.values())
        floor = SMOOTHING * max(s / everything.rows for s in everything.spreads)
        scores = {}
        for label, m in sorted(self.classes.items()):
            variances = [s / m.rows + floor for s in m.spreads]
            constant = math.log(m.rows / everything.rows) - 0.5 * sum(
                math.log(2 * math.pi * v) for v in variances
            )
            score = F.lit(constant)
            for name, mean, variance in zip(self.features, m.means, variances):
                deviation = F.col(f"`{name}`").cast("double") - F.lit(mean)
                score = score - deviation * deviation / F.lit(2 * variance)
            scores[label] = score
        return scores

    def prediction(self) -> Column:
        """Class with the highest score, ties to the smaller label."""
        best = F.array_max(F.array(*[
            F.struct(score.alias("s"), F.lit(-label).alias("l"))
            for label, score in self.log_likelihoods().items()
        ]))
        return (-best["l"]).cast("int")

    def probability(self, label: int = 1) -> Column:
        """Posterior of one class."""
        scores = self.log_likelihoods()
        top = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
        weights = {k: F.exp(v - top) for k, v in scores.items()}
        return weights.get(label, F.lit(0.0)) / sum(weights.values())


def fit_bayes(df: DataFrame, features: Sequence[str], label: str) -> GaussianBayes:
    moments = grouped_moments(df, features, label)
    return GaussianBayes(tuple(features), {key[0]: m for key, m in moments.items()})


def fold_accuracy(
    df: DataFrame, features: Sequence[str], label: str, fold: str = "fold"
) -> DataFrame:
    """Accuracy per fold of a model fitted on the other folds.

    Moments are grouped by fold and class once; each fold's model merges those of the others, and
    all folds are scored in one more pass.
    """
    moments = grouped_moments(df, features, fold, label)
    hit = F.lit(None).cast("double")
    for held in sorted({key[0] for key in moments}):
        classes = {
            c: merged(m for (f, k), m in moments.items() if f != held and k == c)
            for c in sorted({k for f, k in moments if f != held})
        }
        predicted = GaussianBayes(tuple(features), classes).prediction()
        hit = F.when(F.col(fold) == held, (predicted == F.col(label)).cast("double")).otherwise(hit)
    return df.groupBy(fold).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(hit).alias("accuracy")
    )
