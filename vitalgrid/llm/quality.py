"""Quality classifier: supervised subword embeddings.

Words, pairs of neighbouring words and the character n-grams of words (with a blank as the boundary
mark) are hashed into a table of vectors. A document is the average of its vectors, and a softmax layer gives the
probability of each label. Vectors and layer are learnt together by stochastic gradient descent.

All is numpy over whole texts: code points, rolling n-gram codes and polynomial word codes. As the
layer is linear in the average, scoring needs one number per bucket: the difference of both labels.

Defined results: a null text counts as empty; a text without a word gets the bias alone. Repeated
rows are scored each by itself. Without examples of both labels every score is the smoothed share
of label 1 (0.5 without any). Words of over 1,000 characters count as several words. Other columns
of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.shared import labelled_sample, segments

LONGEST_WORD = 1_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # golden-ratio constant of multiplicative hashing
BASE = np.uint64(1_000_003)


@dataclass(frozen=True)
class Settings:
    """`examples` bounds the labelled sample that is learnt from."""

    examples: int = 6_000
    bits: int = 17
    size: int = 8
    grams: tuple[int, ...] = (2, 3, 4)
    epochs: int = 6
    rate: float = 0.5
    seed: int = 7


_powers = np.cumprod(np.full(LONGEST_WORD + 1, BASE, np.uint64), dtype=np.uint64)


def _buckets(codes: np.ndarray, bits: int) -> np.ndarray:
    codes = codes ^ (codes >> np.uint64(29))
    return ((codes * MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int32)


def features(text: str, settings: Settings) -> np.ndarray:
    """Buckets of all words, word pairs and character n-grams of one segment of a text."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (points <= 32) & ((points == 32) | ((points >= 9) & (points <= 13)))
    codes = np.where(blank, np.uint64(32), points.astype(np.uint64))
    edges = np.flatnonzero(np.diff(blank.view(np.int8)))
    begins, lengths = edges[::2] + 1, edges[1::2] - edges[::2]
    found = []
    if len(begins):
        if lengths.max() > LONGEST_WORD:
            parts = -(-lengths // LONGEST_WORD)
            step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            begins = np.repeat(begins, parts) + step * LONGEST_WORD
            lengths = np.minimum(np.repeat(lengths, parts) - step * LONGEST_WORD, LONGEST_WORD)
        offset = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        terms = (codes[np.repeat(begins, lengths) + offset] + np.uint64(1)) * _powers[offset]
        words = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
        found.append(_buckets(words, settings.bits))
        # A pair is coded by the difference of its words: an immediate repeat is one feature for all words.
        found.append(_buckets(np.diff(words), settings.bits))
    for n in settings.grams:
        count = len(codes) - n + 1
        if count <= 0:
            continue
        gram = np.full(count, n, np.uint64)
        inside = np.ones(count, bool)
        for j in range(n):
            gram = gram * BASE + codes[j:j + count]
            if 0 < j < n - 1:
                inside &= ~blank[j:j + count]
        if n == 2:
            inside &= ~(blank[:count] & blank[1:])
        found.append(_buckets(gram[inside], settings.bits))
    return np.concatenate(found) if found else np.empty(0, np.int32)


def counted(text: str | None, settings: Settings):
    """Distinct buckets of a whole text and their shares."""
    total = np.zeros(0, np.int32)
    counts = np.zeros(0, np.int64)
    for piece in segments(text or ""):
        buckets, n = np.unique(features(piece, settings), return_counts=True)
        merged, where = np.unique(np.concatenate([total, buckets]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([counts, n]), len(merged)).astype(np.int64)
        total = merged
    return total, counts / max(1, counts.sum())


def train(examples, labels: np.ndarray, settings: Settings):
    """Stochastic gradient descent, one document a step; returns weight per bucket and bias.

    `examples` are pairs of buckets and shares.
    """
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (1 << settings.bits, settings.size)).astype(np.float32) / settings.size
    layer, bias = np.zeros((2, settings.size), np.float32), np.zeros(2, np.float32)
    steps, done = max(1, settings.epochs * len(examples)), 0
    for _ in range(settings.epochs):
        for i in random.permutation(len(examples)):
            buckets, shares = examples[i]
            rate = settings.rate * (1.0 - done / steps)
            done += 1
            own = vectors[buckets]
            mean = shares @ own
            logits = layer @ mean + bias
            p = np.exp(logits - logits.max())
            gap = p / p.sum()
            gap[labels[i]] -= 1.0
            back = layer.T @ gap
            layer -= rate * np.outer(gap, mean)
            bias -= 0.1 * rate * gap
            if len(buckets):
                # A step of a length that does not depend on how many features a text has.
                reach = 3.0 * rate / np.sqrt(shares @ shares)
                vectors[buckets] = own - reach * np.outer(shares, back)
    return (vectors @ (layer[1] - layer[0])).astype(np.float64), float(bias[1] - bias[0])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    settings: Settings

    def score(self, text: str | None) -> float:
        total, n = 0.0, 0
        for piece in segments(text or ""):
            buckets = features(piece, self.settings)
            total += self.weights[buckets].sum()
            n += len(buckets)
        margin = (total / n if n else 0.0) + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(margin, -50, 50))))


def fit(
    documents: DataFrame, labels: DataFrame, label: str, learnable: Column,
    settings: Settings = Settings(),
) -> Model:
    """Learns from a bounded sample of labelled rows; the model has a fixed size."""

    def as_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [counted(t, settings) for t in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "label": frame["label"],
                "buckets": [b for b, _ in rows], "shares": [s.astype(np.float32) for _, s in rows],
            })

    sample = labelled_sample(documents, labels, label, learnable, settings.examples)
    # At most `examples` rows, each of at most one entry per bucket of the table.
    rows = sample.mapInPandas(
        as_counts, "doc_id long, label int, buckets array<int>, shares array<float>"
    ).toArrow()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    known = rows["label"].to_numpy()[order]
    if len(set(known.tolist())) < 2:
        share = (known.sum() + 0.5) / (len(known) + 1.0)
        return Model(np.zeros(1 << settings.bits), float(np.log(share / (1 - share))), settings)
    buckets, shares = rows["buckets"].combine_chunks(), rows["shares"].combine_chunks()
    values = [
        (buckets[int(i)].values.to_numpy(), shares[int(i)].values.to_numpy()) for i in order
    ]
    return Model(*train(values, known, settings), settings)


def scorer(spark, model: Model):
    """Column function: text -> probability of label 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = shared.value
        for texts in batches:
            yield pd.Series([fitted.score(t) for t in texts], dtype="float64")

    return score
