"""Random forests and boosted trees, grown from binned rows in bytes.

The estimators are MLlib's with their parameters, and so are the models; only the growing is done here. Rows
become one byte for each input (the bin of its value) and are packed in blocks, a thirtieth of what MLlib
keeps of a row. Rows that fit one task are grown on whole: a task grows trees with all their levels. Of more
rows every task counts its own, level by level; the counts of a tree meet in one task, which finds the splits.
Both ways give the same trees: weights and columns of a node are drawn from the seed, not from the tasks.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.session import new_folder, ship

#: Rows that cut points are estimated from (all, if there are fewer); MLlib takes 10,000.
CUT_ROWS = 20_000
#: Rows of a packed block.
BLOCK_ROWS = 65_536
#: Rows that a task may hold whole: of a forest, and of boosted trees, whose fit is one task then.
WHOLE_ROWS, WHOLE_BOOSTED = 2_000_000, 800_000
#: Counts that a task holds in one pass; where a level has more, it takes several.
PASS_CELLS = 16_000_000
#: Rows of a block that are counted at once: what is made of them stays in a core's cache.
TOGETHER = 16_384
#: Cells of a column that several inputs with few values share.
SHARED_CELLS = 1_024
#: Rounds after which the margins of boosted rows are stored.
ROUNDS_STORED = 5
#: Nodes that are counted and split at once.
NODES_AT_ONCE = 256

NODE = (
    "struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
    "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


# Rows --------------------------------------------------------------------------------------------


def cut_points(values: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """Thresholds of one input: between all its values if they are few, else at about equal depth (the rule
    of MLlib)."""
    found, counts = np.unique(values, return_counts=True)
    splits = min(bins, rows) - 1
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) <= splits:
        return middle
    stride = len(values) / (splits + 1)
    cuts, target, passed = [], stride, counts[0]
    for i, count in enumerate(counts[1:]):
        before, passed = passed, passed + count
        if abs(before - target) < abs(passed - target):
            cuts.append(middle[i])
            target += stride
    return np.array(cuts)


@dataclass(frozen=True)
class Table:
    """Packed rows `(block, n, x, y)` with what a fit has to know of all of them."""

    packed: DataFrame
    rows: int
    classes: int
    cuts: tuple[np.ndarray, ...]

    @property
    def widths(self) -> np.ndarray:
        return np.array([len(c) + 1 for c in self.cuts])


def _inputs(df: DataFrame, features: str, label: str) -> DataFrame:
    return df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))


def pack(df: DataFrame, features: str, label: str, bins: int) -> Table:
    # A fit may be the first thing in a session that needs the package in the workers.
    ship(df.sparkSession)
    rows = _inputs(df, features, label)
    y = F.col("y")
    whole = F.count_if(y.isNull() | (y < 0) | (y != F.floor(y)))
    count, highest, wrong = rows.agg(F.count(F.lit(1)), F.max("y"), whole).first()
    if not count:
        raise ValueError("no rows to fit")
    if wrong:
        raise ValueError(f"{wrong} labels are no class numbers")
    # Only where the cuts are put depends on these rows; a bin counts all rows of the table.
    known = rows.select("x") if count <= CUT_ROWS else rows.select("x").sample(fraction=CUT_ROWS / count, seed=7)
    table = known.toArrow()
    known = table.column("x").combine_chunks()
    known = known.flatten().to_numpy(zero_copy_only=False).reshape(len(known), -1)
    if not np.isfinite(known).all():
        raise ValueError("an input is not a finite number")
    cuts = tuple(cut_points(column, count, bins) for column in known.T)
    return Table(_binned(rows, cuts), count, max(2, int(highest) + 1), cuts)


def _binned(rows: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    """Rows as blocks of bytes, each with a number of its own."""
    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, xs, ys = TaskContext.get().partitionId(), 0, [], []

        def block():
            x, y = np.concatenate(xs, axis=1), np.concatenate(ys)
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + made], pa.int64()), pa.array([len(y)], pa.int64()),
                pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary()),
            ], names=["block", "n", "x", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if np.isnan(x).any():
                raise ValueError("an input is not a number")
            xs.append(np.stack([np.searchsorted(c, v).astype(np.uint8) for c, v in zip(cuts, x.T)]))
            ys.append(batch.column("y").to_numpy(zero_copy_only=False).astype(np.uint8))
            if sum(map(len, ys)) >= BLOCK_ROWS:
                yield block()
                made, xs, ys = made + 1, [], []
        if ys:
            yield block()

    # A task passes on as many counts as a level has, however few its rows are: one task a core.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(cores).mapInArrow(to_blocks, "block long, n long, x binary, y binary")


def _unpacked(batches: Iterator[pa.RecordBatch]):
    """(block, inputs by column, labels) of packed rows."""
    for batch in batches:
        for i in range(batch.num_rows):
            y = np.frombuffer(batch.column("y")[i].as_buffer(), np.uint8)
            x = np.frombuffer(batch.column("x")[i].as_buffer(), np.uint8).reshape(-1, len(y))
            yield batch.column("block")[i].as_py(), x, y


def _pieces(n: int) -> list[slice]:
    return [slice(at, at + TOGETHER) for at in range(0, n, TOGETHER)]


# Trees -------------------------------------------------------------------------------------------


class Tree:
    """Nodes of one tree, a level after the other; the children of a node follow each other.

    `feature` is -1 at a leaf, rows with a bin up to `cut` go left, to `left`.
    """

    def __init__(self, stats: np.ndarray):
        self.feature, self.cut, self.left = np.full(1, -1), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.gain, self.stats, self.open = np.full(1, -1.0), stats[None, :], np.zeros(1, np.int64)

    def grow(self, nodes: np.ndarray, feature, cut, gain, stats_left, stats_right, closed) -> None:
        """Splits `nodes`; of their children (left and right in turn) those not `closed` are open next."""
        first = len(self.feature)
        self.feature[nodes], self.cut[nodes], self.gain[nodes] = feature, cut, gain
        self.left[nodes] = first + 2 * np.arange(len(nodes))
        new = 2 * len(nodes)
        stats = np.stack([stats_left, stats_right], axis=1).reshape(new, self.stats.shape[1])
        self.feature = np.concatenate([self.feature, np.full(new, -1)])
        self.cut = np.concatenate([self.cut, np.zeros(new, np.int64)])
        self.left = np.concatenate([self.left, np.zeros(new, np.int64)])
        self.gain = np.concatenate([self.gain, np.full(new, -1.0)])
        self.stats = np.concatenate([self.stats, stats])
        self.open = first + np.flatnonzero(~closed)

    def place(self, x: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
        """The node that each of `rows` has reached after `depth` splits."""
        at = np.zeros(len(rows), np.int64)
        flat, n = x.reshape(-1), x.shape[1]
        leaf = self.feature < 0
        feature = np.where(leaf, 0, self.feature) * n
        cut, left = np.where(leaf, 255, self.cut), np.where(leaf, np.arange(len(leaf)), self.left)
        for _ in range(depth):
            at = left[at] + (flat[feature[at] + rows] > cut[at])
        return at

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row; rows that have reached theirs are not asked again."""
        found = np.zeros(x.shape[1], np.int64)
        rows, at = np.arange(x.shape[1]), found.copy()
        while True:
            inner = self.feature[at] >= 0
            found[rows[~inner]] = at[~inner]
            rows, at = rows[inner], at[inner]
            if not len(rows):
                return found
            at = self.left[at] + (x[self.feature[at], rows] > self.cut[at])

    def given(self, x: np.ndarray, values: np.ndarray):
        """The value of the node that each row has reached: whole columns at once, for trees of few nodes."""
        kind = np.uint8 if len(self.feature) <= 256 else np.uint32

        def below(node: int):
            if self.feature[node] < 0:
                return kind(node)
            right = np.negative((x[self.feature[node]] > self.cut[node]).astype(kind))
            a, b = below(self.left[node]), below(self.left[node] + 1)
            return a ^ ((a ^ b) & right)

        found = below(0)
        return values[found] if np.ndim(found) else np.full(x.shape[1], values[found])

    def pruned(self, predict) -> Tree:
        """Two leaves that predict the same are one, as in MLlib."""
        prediction, feature = predict(self.stats).tolist(), self.feature.tolist()
        for node, left in zip(np.flatnonzero(self.feature >= 0)[::-1].tolist(), self.left[self.feature >= 0][::-1].tolist()):
            if feature[left] < 0 and feature[left + 1] < 0 and prediction[left] == prediction[left + 1]:
                feature[node] = -1
        self.feature = np.array(feature)
        return self

    def rows(self, tree: int, cuts, predict, impurity) -> pa.RecordBatch:
        """The nodes that can be reached, as MLlib stores them."""
        prediction, feature = predict(self.stats), self.feature
        kept = np.zeros(len(feature), bool)
        kept[0] = True
        below = np.zeros(1, np.int64)
        while len(below):
            below = self.left[below[feature[below] >= 0]]
            below = np.concatenate([below, below + 1])
            kept[below] = True
        chosen = np.flatnonzero(kept)
        number = np.cumsum(kept) - 1
        feature, left = feature[chosen], self.left[chosen]
        inner = feature >= 0
        stats = self.stats[chosen]
        threshold = np.zeros(len(chosen))
        threshold[inner] = [cuts[f][c] for f, c in zip(feature[inner], self.cut[chosen][inner])]
        left = np.where(inner, number[left], -1)
        arrays = lambda flat, sizes: pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, pa.float64())
        )
        split = pa.StructArray.from_arrays([
            pa.array(np.where(inner, feature, -1), pa.int32()),
            arrays(threshold[inner], inner.astype(int)), pa.array(np.full(len(chosen), -1), pa.int32()),
        ], names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        node = pa.StructArray.from_arrays([
            pa.array(np.arange(len(chosen)), pa.int32()), pa.array(prediction[chosen], pa.float64()),
            pa.array(impurity(stats), pa.float64()), arrays(stats.reshape(-1), np.full(len(chosen), stats.shape[1])),
            pa.array(np.rint(stats[:, 0] if predict is _mean else stats.sum(axis=1)).astype(np.int64), pa.int64()),
            pa.array(np.where(inner, self.gain[chosen], -1.0), pa.float64()),
            pa.array(left, pa.int32()), pa.array(np.where(inner, left + 1, -1), pa.int32()), split,
        ], names=[
            "id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split",
        ])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(chosen), tree), pa.int32()), node], names=["treeID", "nodeData"])


def _store(model: type, estimator, nodes: DataFrame, trees: int, weights: Sequence[float], tree_class: str, **facts):
    """The MLlib model of stored nodes."""
    spark = nodes.sparkSession
    folder = new_folder(spark, "trees")
    nodes.write.parquet(f"{folder}/data")

    def plain(params) -> dict:
        return {p.name: value for p, value in params.items()}

    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    whole = {
        **about, "class": f"org.apache.spark.ml.classification.{model.__name__}", "uid": estimator.uid,
        "paramMap": plain(estimator._paramMap), "defaultParamMap": plain(estimator._defaultParamMap), **facts, "numTrees": trees,
    }
    shared = ("maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "featuresCol", "labelCol", "predictionCol")
    params = {name: estimator.getOrDefault(name) for name in shared}
    each = [
        (i, json.dumps({
            **about, "class": tree_class, "uid": f"{estimator.uid}_{i}", "paramMap": params, "defaultParamMap": {},
        }), float(weight)) for i, weight in enumerate(weights)
    ]
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{folder}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/treesMetadata")
    return model.load(folder)


# Forests -----------------------------------------------------------------------------------------

#: Poisson draws with mean 1 (a bootstrap sample), by a random number of 16 bits.
_DRAWS = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]) * 65_536, np.arange(65_536), side="right"
).astype(np.uint8)


def _largest(stats: np.ndarray) -> np.ndarray:
    return stats.argmax(axis=1).astype(float)


def _gini(stats: np.ndarray) -> np.ndarray:
    count = stats.sum(axis=-1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(count > 0, 1.0 - ((stats / count[..., None]) ** 2).sum(axis=-1), 0.0)


@dataclass(frozen=True)
class Growth:
    """How the trees of a forest grow."""

    widths: np.ndarray
    classes: int
    depth: int
    least: int
    gain: float
    columns: int
    bootstrap: bool
    seed: int

    def weights(self, tree: int, block: int, n: int) -> np.ndarray:
        """How often each row of a block is in the sample of a tree."""
        if not self.bootstrap:
            return np.ones(n, np.uint8)
        drawn = np.random.default_rng([self.seed, tree, block]).bit_generator.random_raw(-(-n // 4))
        return _DRAWS[drawn.view(np.uint16)[:n]]

    def choose(self, tree: int, level: int, nodes: int) -> np.ndarray:
        """The inputs that each open node of a level may split on."""
        total = len(self.widths)
        if self.columns >= total:
            return np.broadcast_to(np.arange(total), (nodes, total))
        drawn = np.random.default_rng([self.seed, tree, level, 1]).random((nodes, total))
        return np.sort(np.argpartition(drawn, self.columns - 1, axis=1)[:, :self.columns], axis=1)

    def counts(self, x: np.ndarray, y, weight, rows, slot, columns: np.ndarray) -> np.ndarray:
        """Weight by (open node, its column, bin) and class, as one line of cells. `rows` are those of `x`,
        `slot` their nodes, `columns` the inputs of each node."""
        sizes = self.widths[columns]
        start = (np.cumsum(sizes) - sizes.reshape(-1)).reshape(sizes.shape)
        cells, n, flat = int(sizes.sum()) * self.classes, x.shape[1], x.reshape(-1)
        first, offset = start.T * self.classes, columns.T * n
        total, step = np.zeros(cells), max(TOGETHER // 2, cells // 2)
        for at in range(0, len(rows), step):
            here = slice(at, at + step)
            where, node, label, heavy = rows[here], slot[here], y[here], weight[here]
            for j in range(columns.shape[1]):
                key = flat[offset[j][node] + where].astype(np.int64)
                key *= self.classes
                key += first[j][node]
                key += label
                if cells < len(where):
                    total += np.bincount(key, heavy, cells)
                else:
                    np.add.at(total, key, heavy)
        return total.reshape(-1, self.classes)

    def split(self, cells: np.ndarray, columns: np.ndarray):
        """For each node its best split: column, bin, gain and the counts on its left."""
        sizes = self.widths[columns].reshape(-1)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        inner = starts > 0
        lefts, rights = [], []
        for each in cells.T:
            sums = np.cumsum(each)
            before = np.where(inner, sums[starts - 1], 0.0)
            lefts.append(sums - np.repeat(before, sizes))
            rights.append(np.repeat(sums[ends - 1], sizes) - sums)
        nl, nr = sum(lefts), sum(rights)
        n = nl + nr
        with np.errstate(invalid="ignore", divide="ignore"):
            # Impurities of the node and of both sides, the sides by their share.
            whole = 1.0 - sum(((a + b) / n) ** 2 for a, b in zip(lefts, rights))
            left = 1.0 - sum((a / nl) ** 2 for a in lefts)
            right = 1.0 - sum((b / nr) ** 2 for b in rights)
            gain = whole - nl / n * left - nr / n * right
        gain[(nl < self.least) | (nr < self.least) | ~(gain >= self.gain)] = -np.inf
        gain[ends - 1] = -np.inf
        node_starts = starts[::columns.shape[1]]
        best = np.maximum.reduceat(gain, node_starts)
        node_sizes = np.diff(np.append(node_starts, len(gain)))
        hit = np.flatnonzero(gain == np.repeat(best, node_sizes))
        at = hit[np.searchsorted(hit, node_starts)]
        segment = np.searchsorted(ends, at, side="right")
        return columns.reshape(-1)[segment], at - starts[segment], best, np.stack([a[at] for a in lefts], axis=1)

    def apply(self, tree: Tree, level: int, found) -> None:
        """Splits the open nodes as found; what is pure, deep or not worth a split stays a leaf."""
        feature, cut, gain, left = found
        taken = gain > 0
        nodes = tree.open[taken]
        left = left[taken]
        right = tree.stats[nodes] - left
        closed = np.stack([_gini(left), _gini(right)], axis=1).reshape(-1) < 2.3e-16
        if level + 1 >= self.depth:
            closed[:] = True
        tree.grow(nodes, feature[taken], cut[taken], gain[taken], left, right, closed)

    def start(self, stats: np.ndarray) -> Tree:
        tree = Tree(stats)
        if self.depth == 0 or _gini(stats[None, :])[0] < 2.3e-16:
            tree.open = tree.open[:0]
        return tree

    def whole(self, number: int, blocks) -> Tree:
        """A tree of rows that are all here; they are kept in the order of their nodes."""
        weight = np.concatenate([self.weights(number, block, len(y)) for block, _, y in blocks])
        rows = np.flatnonzero(weight)
        x = np.take(np.concatenate([x for _, x, _ in blocks], axis=1), rows, axis=1)
        y, weight = np.concatenate([y for _, _, y in blocks])[rows], weight[rows].astype(float)
        tree = self.start(np.bincount(y, weight, self.classes))
        slot, level = np.zeros(len(y), np.int64), 0
        while len(tree.open):
            columns = self.choose(number, level, len(tree.open))
            bounds = np.searchsorted(slot, np.arange(0, len(tree.open) + NODES_AT_ONCE, NODES_AT_ONCE))
            found = []
            for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
                part = columns[i * NODES_AT_ONCE:(i + 1) * NODES_AT_ONCE]
                inside = slot[low:high] - i * NODES_AT_ONCE
                # The columns of a node lie together: whole columns are read through `low`.
                cells = self.counts(x, y[low:high], weight[low:high], np.arange(low, high), inside, part)
                found.append(self.split(cells, part))
            feature, cut, gain, left = (np.concatenate(parts) for parts in zip(*found))
            taken = gain > 0
            right = x[feature[slot], np.arange(len(slot))] > cut[slot]
            # Of the children, which are open next, in their order.
            self.apply(tree, level, (feature, cut, gain, left))
            level += 1
            if not len(tree.open):
                break
            first = len(tree.feature) - 2 * int(taken.sum())
            order = np.cumsum(taken) - 1
            child = np.where(taken[slot], 2 * order[slot] + right, -1)
            place = np.full(2 * int(taken.sum()) + 1, -1)
            place[tree.open - first] = np.arange(len(tree.open))
            slot = place[child]
            stay = np.flatnonzero(slot >= 0)
            stay = stay[np.argsort(slot[stay], kind="stable")]
            x, y, weight, slot = np.take(x, stay, axis=1), y[stay], weight[stay], slot[stay]
        return tree


def _sent(packed: DataFrame, spark: SparkSession):
    """All packed rows, for every task that asks for them."""
    rows = packed.select("block", "x", "y").collect()
    return spark.sparkContext.broadcast(sorted((r["block"], bytes(r["x"]), bytes(r["y"])) for r in rows))


def _received(sent) -> list[tuple[int, np.ndarray, np.ndarray]]:
    labels = [(block, x, np.frombuffer(y, np.uint8)) for block, x, y in sent.value]
    return [(block, np.frombuffer(x, np.uint8).reshape(-1, len(y)), y) for block, x, y in labels]


def _grow_whole(table: Table, growth: Growth, trees: int, spark: SparkSession) -> DataFrame:
    """Every tree in one task, which gets all rows (in bytes)."""
    sent, cuts = _sent(table.packed, spark), table.cuts

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = None
        for batch in batches:
            blocks = blocks or _received(sent)
            for number in batch.column("id").to_pylist():
                yield growth.whole(number, blocks).pruned(_largest).rows(number, cuts, _largest, _gini)

    tasks = min(trees, spark.sparkContext.defaultParallelism * 4)
    return spark.range(0, trees, 1, tasks).mapInArrow(grow, f"treeID int, nodeData {NODE}")


def _vote_whole(table: Table, asked: DataFrame, growth: Growth, trees: int, spark: SparkSession) -> tuple[int, int]:
    """(rows, hits) of a forest on other rows. A task adds up what its trees say of each of them, so that
    deep trees never leave it."""
    sent, others = _sent(table.packed, spark), _sent(asked, spark)
    classes = growth.classes

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, total = None, 0.0
        for batch in batches:
            blocks, held = blocks or _received(sent), _received(others)
            for number in batch.column("id").to_pylist():
                tree = growth.whole(number, blocks).pruned(_largest)
                share = tree.stats / tree.stats.sum(axis=1, keepdims=True)
                total = total + np.concatenate([share[tree.leaves(x)] for _, x, _ in held])
        if blocks is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["votes"])

    try:
        labels = np.concatenate([y for _, _, y in _received(others)] or [np.zeros(0, np.uint8)])
        if not len(labels):
            return 0, 0
        tasks = min(trees, spark.sparkContext.defaultParallelism)
        made = spark.range(0, trees, 1, tasks).mapInArrow(vote, "votes binary")
        # As many numbers as there are rows for each task; the rows are few enough for one task.
        votes = sum(np.frombuffer(r["votes"]) for r in made.toLocalIterator()).reshape(-1, classes)
        return len(labels), int((votes.argmax(axis=1) == labels).sum())
    finally:
        sent.unpersist()
        others.unpersist()


def _grow_by_level(table: Table, growth: Growth, trees: int, spark: SparkSession) -> DataFrame:
    """All trees, level by level: every task counts its rows, the counts of a tree meet in one task."""
    packed = table.packed.persist()
    parts = spark.sparkContext.defaultParallelism
    classes, widths, cuts = growth.classes, growth.widths, table.cuts

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((trees, classes))
        for block, x, y in _unpacked(batches):
            for number in range(trees):
                sums[number] += np.bincount(y, growth.weights(number, block, len(y)), classes)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    try:
        sums = sum(
            np.frombuffer(r["sums"]).reshape(trees, classes)
            for r in packed.mapInArrow(totals, "sums binary").collect()
        )
        grown = [growth.start(s) for s in sums]
        level = 0
        while any(len(t.open) for t in grown):
            chosen = {i: growth.choose(i, level, len(t.open)) for i, t in enumerate(grown) if len(t.open)}
            # (tree, first node, last node) by passes of bounded size.
            passes, room = [[]], PASS_CELLS
            for i, columns in chosen.items():
                sizes = np.cumsum(widths[columns].sum(axis=1) * classes)
                low = 0
                while low < len(columns):
                    done = sizes[low - 1] if low else 0
                    high = int(np.searchsorted(sizes, done + room, side="right"))
                    if high == low:
                        if room < PASS_CELLS:
                            passes.append([])
                            room = PASS_CELLS
                            continue
                        high = low + 1
                    passes[-1].append((i, low, high))
                    room -= sizes[high - 1] - done
                    low = high
            found = {i: [] for i in chosen}
            for jobs in passes:
                for number, low, result in _level(packed, growth, grown, chosen, jobs, level, parts, spark):
                    found[number].append((low, result))
            for i, results in found.items():
                results = [r for _, r in sorted(results, key=lambda r: r[0])]
                growth.apply(grown[i], level, tuple(np.concatenate(p) for p in zip(*results)))
            level += 1
    finally:
        packed.unpersist()
    batches = [t.pruned(_largest).rows(i, cuts, _largest, _gini) for i, t in enumerate(grown)]
    return spark.createDataFrame(pa.Table.from_batches(batches), f"treeID int, nodeData {NODE}")


def _level(packed: DataFrame, growth: Growth, grown, chosen, jobs, level: int, parts: int, spark: SparkSession):
    """(tree, first node, best splits) of one pass over the rows."""
    sent = spark.sparkContext.broadcast([(i, low, high, grown[i], chosen[i][low:high]) for i, low, high in jobs])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for block, x, y in _unpacked(batches):
            kept = kept or [0.0] * len(sent.value)
            weights = {}
            for job, (i, low, high, tree, columns) in enumerate(sent.value):
                if i not in weights:
                    weight = growth.weights(i, block, len(y))
                    rows = np.flatnonzero(weight)
                    slots = np.full(len(tree.feature), -1)
                    slots[tree.open] = np.arange(len(tree.open))
                    slot = slots[tree.place(x, rows, level)]
                    weights = {i: (weight[rows].astype(float), rows, slot)}
                weight, rows, slot = weights[i]
                inside = np.flatnonzero((slot >= low) & (slot < high))
                kept[job] = kept[job] + growth.counts(
                    x, y[rows[inside]], weight[inside], rows[inside], slot[inside] - low, columns
                )
        for job, cells in enumerate(kept or []):
            yield pa.RecordBatch.from_arrays(
                [pa.array([job], pa.int32()), pa.array([cells.astype(np.uint32).tobytes()], pa.binary())], names=["job", "cells"]
            )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for job, cells in zip(batch.column("job").to_pylist(), batch.column("cells")):
                sums[job] = sums.get(job, 0.0) + np.frombuffer(cells.as_buffer(), np.uint32).astype(float)
        for job, cells in sums.items():
            columns = sent.value[job][4]
            found = growth.split(cells.reshape(-1, growth.classes), columns)
            yield pa.RecordBatch.from_arrays([
                pa.array([job], pa.int32()),
                *(pa.array([np.ascontiguousarray(v, t).tobytes()], pa.binary()) for v, t in zip(found, (np.int64, np.int64, float, float))),
            ], names=["job", "feature", "cut", "gain", "left"])

    counted = packed.mapInArrow(count, "job int, cells binary").repartition(min(parts, len(jobs)), "job")
    # One line for each tree: its new splits.
    for r in counted.mapInArrow(best, "job int, feature binary, cut binary, gain binary, left binary").collect():
        number, low, _ = jobs[r["job"]]
        left = np.frombuffer(r["left"]).reshape(-1, growth.classes)
        yield number, low, (np.frombuffer(r["feature"], np.int64), np.frombuffer(r["cut"], np.int64), np.frombuffer(r["gain"]), left)
    sent.unpersist()


class Forest(RandomForestClassifier):
    """MLlib's random forest, grown here."""

    #: Rows up to which a tree is grown whole in a task.
    whole_rows = WHOLE_ROWS

    def _growth(self, table: Table) -> Growth:
        trees, inputs = self.getNumTrees(), len(table.cuts)
        columns = {
            "sqrt": math.ceil(math.sqrt(inputs)), "log2": max(1, math.ceil(math.log2(inputs))),
            "onethird": math.ceil(inputs / 3), "all": inputs,
            "auto": inputs if trees == 1 else math.ceil(math.sqrt(inputs)),
        }[self.getFeatureSubsetStrategy()]
        return Growth(
            table.widths, table.classes, self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain(),
            columns, self.getBootstrap(), self.getSeed() & 0xFFFFFFFFFFFF,
        )

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        spark, trees = dataset.sparkSession, self.getNumTrees()
        table = pack(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getMaxBins())
        grow = _grow_whole if table.rows <= self.whole_rows else _grow_by_level
        return _store(
            RandomForestClassificationModel, self, grow(table, self._growth(table), trees, spark), trees, [1.0] * trees,
            "org.apache.spark.ml.classification.DecisionTreeClassificationModel",
            numFeatures=len(table.cuts), numClasses=table.classes,
        )

    def accuracy(self, known: DataFrame, asked: DataFrame) -> float | None:
        """Share of the rows of `asked` that the forest fitted on `known` names rightly; None without rows.

        Where the rows fit a task, no model is stored and read for it.
        """
        features, label = self.getFeaturesCol(), self.getLabelCol()
        table = pack(known, features, label, self.getMaxBins())
        if max(table.rows, asked.count()) > self.whole_rows:
            hit = (F.col(self.getPredictionCol()) == F.col(label)).cast("double")
            return self.fit(known).transform(asked).agg(F.avg(hit)).first()[0]
        others = _binned(_inputs(asked, features, label), table.cuts)
        rows, hits = _vote_whole(table, others, self._growth(table), self.getNumTrees(), known.sparkSession)
        return hits / rows if rows else None


# Boosted trees -----------------------------------------------------------------------------------


def _mean(stats: np.ndarray) -> np.ndarray:
    return stats[:, 1] / stats[:, 0]


def _variance(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 2] - stats[:, 1] ** 2 / stats[:, 0]) / stats[:, 0]


@dataclass(frozen=True)
class Shared:
    """Inputs with few values put together in columns of at most `SHARED_CELLS` cells, which are counted
    once and summed up for each input."""

    groups: tuple[tuple[int, ...], ...]
    widths: np.ndarray

    @classmethod
    def of(cls, widths: np.ndarray) -> Shared:
        groups: list[list[int]] = []
        sizes: list[int] = []
        for f in np.argsort(-widths, kind="stable"):
            for g, size in enumerate(sizes):
                if size * widths[f] <= SHARED_CELLS:
                    groups[g].append(int(f))
                    sizes[g] *= int(widths[f])
                    break
            else:
                groups.append([int(f)])
                sizes.append(int(widths[f]))
        return cls(tuple(map(tuple, groups)), widths)

    def size(self, group: int) -> int:
        return int(np.prod(self.widths[list(self.groups[group])]))

    def columns(self, x: np.ndarray) -> list[np.ndarray]:
        made = []
        for group in self.groups:
            code = x[group[0]].astype(np.uint16)
            for f in group[1:]:
                code *= np.uint16(self.widths[f])
                code += x[f]
            made.append(code)
        return made

    def by_input(self, counted: list[np.ndarray]) -> list[np.ndarray]:
        """(node, bin) of each input, of the counts (node, cell) of each group."""
        found = [None] * len(self.widths)
        for group, cells in zip(self.groups, counted):
            cells = cells.reshape(len(cells), *self.widths[list(group)])
            for i, f in enumerate(group):
                found[f] = cells.sum(axis=tuple(j + 1 for j in range(len(group)) if j != i))
        return found


def _boosted_counts(shared: Shared, columns, slot, residual, nodes: int, squares: bool) -> list[np.ndarray]:
    """(count, sum and sum of squares; node, cell) of each group of inputs; the squares, if they are not
    asked for, of the first group only."""
    found, squared = [], residual * residual
    for g, code in enumerate(columns):
        size = shared.size(g)
        key = code if slot is None else slot.astype(np.uint16 if nodes * size <= 65_536 else np.int64) * size + code
        key, cells = key.astype(np.intp), nodes * size
        parts = [np.bincount(key, minlength=cells), np.bincount(key, residual, cells)]
        if squares or not g:
            parts.append(np.bincount(key, squared, cells))
        found.append(np.stack(parts).reshape(len(parts), nodes, size))
    return found


@dataclass(frozen=True)
class Boosting:
    """One regression tree after the other on the residuals of the logistic loss, as in MLlib: labels are
    -1 and 1, the first tree has weight 1, the others the step size."""

    widths: np.ndarray
    rounds: int
    depth: int
    least: int
    gain: float
    step: float

    def weight(self, number: int) -> float:
        return 1.0 if number == 0 else self.step

    @staticmethod
    def residual(y: np.ndarray, margin: np.ndarray, number: int) -> np.ndarray:
        sign = 2.0 * y - 1.0
        return sign if number == 0 else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))

    def grow(self, tree: Tree | None, counted: list[np.ndarray], shared: Shared, level: int) -> Tree:
        """The tree with the splits of one more level."""
        kinds = min(map(len, counted))
        inputs = [shared.by_input([c[k] for c in counted]) for k in range(kinds)]
        totals = counted[0].sum(axis=2).T
        if tree is None:
            tree = Tree(totals[0])
        # The squares of an open node come with the counts of its own level.
        tree.stats[tree.open, 2] = totals[:, 2]
        nodes = len(tree.open)
        best = [(-np.inf, -1, -1, None)] * nodes
        for f in range(len(self.widths)):
            if self.widths[f] < 2:
                continue
            sums = [np.cumsum(i[f], axis=1) for i in inputs]
            count, total = sums[0].astype(float), sums[1]
            nl, sl, n, s = count[:, :-1], total[:, :-1], count[:, -1:], total[:, -1:]
            nr, sr = n - nl, s - sl
            with np.errstate(invalid="ignore", divide="ignore"):
                gain = (sl * sl / nl + sr * sr / nr - s * s / n) / n
            gain[(nl < self.least) | (nr < self.least) | ~(gain >= self.gain)] = -np.inf
            for node, at in enumerate(gain.argmax(axis=1)):
                if gain[node, at] > best[node][0]:
                    left = np.array([*(c[node, at] for c in sums), *[0.0] * (3 - kinds)], float)
                    best[node] = (gain[node, at], f, at, left)
        taken = np.array([b[0] > 0 for b in best], bool)
        nodes = tree.open[taken]
        best = [b for b, t in zip(best, taken) if t]
        if not best:
            tree.open = tree.open[:0]
            return tree
        left = np.array([b[3] for b in best])
        closed = np.full(2 * len(best), level + 1 >= self.depth)
        tree.grow(nodes, [b[1] for b in best], [b[2] for b in best], [b[0] for b in best], left, tree.stats[nodes] - left, closed)
        return tree

    def whole(self, blocks) -> list[Tree]:
        """All trees of rows that are all here, a block at a time."""
        shared, trees = Shared.of(self.widths), []
        blocks = [(block, x[:, piece], y[piece]) for block, x, y in blocks for piece in _pieces(len(y))]
        columns = [shared.columns(x) for _, x, _ in blocks]
        margins = [np.zeros(len(y)) for _, _, y in blocks]
        for number in range(self.rounds):
            residuals = [self.residual(y, m, number) for (_, _, y), m in zip(blocks, margins)]
            tree = None
            for level in range(self.depth):
                counted = None
                for b, (_, x, y) in enumerate(blocks):
                    part = self.counts(shared, tree, x, columns[b], residuals[b], level)
                    counted = part if counted is None else [a + c for a, c in zip(counted, part)]
                tree = self.grow(tree, counted, shared, level)
                if not len(tree.open):
                    break
            trees.append(tree)
            for b, (_, x, y) in enumerate(blocks):
                margins[b] += tree.given(x, self.weight(number) * _mean(tree.stats))
        return trees

    def counts(self, shared: Shared, tree: Tree | None, x, columns, residual, level: int):
        squares = level + 1 == self.depth
        if tree is None:
            return _boosted_counts(shared, columns, None, residual, 1, squares)
        slots = np.full(len(tree.feature), -1, np.int32)
        slots[tree.open] = np.arange(len(tree.open))
        slot = tree.given(x, slots)
        if len(tree.open) < np.count_nonzero(tree.feature < 0):
            rows = np.flatnonzero(slot >= 0)
            columns, slot, residual = [c[rows] for c in columns], slot[rows], residual[rows]
        return _boosted_counts(shared, columns, slot, residual, len(tree.open), squares)

    def rows(self, tree: Tree, number: int, cuts) -> pa.RecordBatch:
        return tree.pruned(_mean).rows(number, cuts, _mean, _variance)


def _boost_whole(table: Table, boosting: Boosting, spark: SparkSession) -> DataFrame:
    cuts = table.cuts

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sorted(_unpacked(batches), key=lambda b: b[0])
        if blocks:
            for number, tree in enumerate(boosting.whole(blocks)):
                yield boosting.rows(tree, number, cuts)

    return table.packed.select("block", "x", "y").repartition(1).mapInArrow(grow, f"treeID int, nodeData {NODE}")


def _boost_by_level(table: Table, boosting: Boosting, spark: SparkSession) -> DataFrame:
    """A pass over the rows for each level. The margins of the trees up to a stored round lie with the rows,
    those since are computed anew. The rows are an RDD: stored rounds would make a plan of hundreds of steps."""
    shared = Shared.of(boosting.widths)
    rows = table.packed.select("x", "y").rdd
    stored = rows.map(lambda r: (bytes(r["x"]), bytes(r["y"]), bytes(8 * len(r["y"])))).persist(StorageLevel.MEMORY_AND_DISK)
    upto, trees = 0, []
    try:
        for number in range(boosting.rounds):
            since = [(boosting.weight(i), trees[i]) for i in range(upto, number)]
            if len(since) == ROUNDS_STORED:
                newer = stored.map(_moved(since)).persist(StorageLevel.MEMORY_AND_DISK)
                newer.count()
                stored.unpersist()
                stored, upto, since = newer, number, []
            tree = None
            for level in range(boosting.depth):
                tree = boosting.grow(tree, _boosted_pass(stored, boosting, shared, since, tree, number, level), shared, level)
                if not len(tree.open):
                    break
            trees.append(tree)
    finally:
        stored.unpersist()
    batches = [boosting.rows(t, i, table.cuts) for i, t in enumerate(trees)]
    return spark.createDataFrame(pa.Table.from_batches(batches), f"treeID int, nodeData {NODE}")


def _arrays(row: tuple[bytes, bytes, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs by column, labels and margins."""
    y = np.frombuffer(row[1], np.uint8)
    return np.frombuffer(row[0], np.uint8).reshape(-1, len(y)), y, np.frombuffer(row[2])


def _margin(x: np.ndarray, stored: np.ndarray, since) -> np.ndarray:
    margin = stored.copy()
    for weight, tree in since:
        margin += tree.given(x, weight * _mean(tree.stats))
    return margin


def _moved(since):
    def move(row):
        x, y, stored = _arrays(row)
        return row[0], row[1], b"".join(_margin(x[:, p], stored[p], since).tobytes() for p in _pieces(len(y)))

    return move


def _boosted_pass(stored: RDD, boosting: Boosting, shared: Shared, since, tree: Tree | None, number: int, level: int):
    """The counts of all rows for one level of one tree."""
    nodes = 1 if tree is None else len(tree.open)
    kinds = [3 if not g or level + 1 == boosting.depth else 2 for g in range(len(shared.groups))]
    sizes = [k * nodes * shared.size(g) for g, k in enumerate(kinds)]

    def count(rows):
        total = np.zeros(sum(sizes))
        for row in rows:
            x, y, margin = _arrays(row)
            for piece in _pieces(len(y)):
                part = x[:, piece]
                residual = boosting.residual(y[piece], _margin(part, margin[piece], since), number)
                parts = boosting.counts(shared, tree, part, shared.columns(part), residual, level)
                total += np.concatenate([p.reshape(-1) for p in parts])
        yield total.tobytes()

    # One line of a few thousand numbers for each task, of which there is one a core.
    total = sum(np.frombuffer(sums) for sums in stored.mapPartitions(count).collect())
    parts = np.split(total, np.cumsum(sizes)[:-1])
    return [p.reshape(k, nodes, -1) for p, k in zip(parts, kinds)]


class BoostedTrees(GBTClassifier):
    """MLlib's boosted trees, grown here."""

    #: Rows up to which a fit is one task.
    whole_rows = WHOLE_BOOSTED

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        spark, rounds = dataset.sparkSession, self.getMaxIter()
        table = pack(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getMaxBins())
        if table.classes > 2:
            raise ValueError("boosted trees take two classes")
        boosting = Boosting(
            table.widths, rounds, self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain(), self.getStepSize()
        )
        grow = _boost_whole if table.rows <= self.whole_rows else _boost_by_level
        return _store(
            GBTClassificationModel, self, grow(table, boosting, spark), rounds,
            [boosting.weight(i) for i in range(rounds)], "org.apache.spark.ml.regression.DecisionTreeRegressionModel",
            numFeatures=len(table.cuts),
        )
