"""Near-duplicate vectors and exact top-k search over a table of (vec_id, embedding)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.llm.components import components
from vitalgrid.session import materialize


def usable(column: str = "embedding"):
    """Whether a vector is there and has neither null nor non-finite components."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & fine & (F.size(column) > 0), F.lit(False))


def _unit(rows: pd.Series) -> np.ndarray:
    """Vectors of length one in double precision."""
    matrix = np.array(rows.tolist(), dtype=np.float64)
    # Twice, so that neither huge nor tiny components overflow.
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _groups(frames: Iterator[pd.DataFrame], key: str, limit: int | None = None):
    """Whole groups of a stream of frames that is sorted by the key."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        begins = np.flatnonzero(np.concatenate([[True], frame[key].to_numpy()[1:] != frame[key].to_numpy()[:-1]]))
        for begin, end in zip(begins, [*begins[1:], len(frame)]):
            part = frame.iloc[begin:end]
            if held and held[0][key].iloc[0] != part[key].iloc[0]:
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


class Hashing:
    """Signs of random hyperplanes: `tables` codes of `bits` bits, the same for every run."""

    def __init__(self, rows: int, size: int, threshold: float, miss: float = 1e-4, crowd: int = 256, seed: int = 5):
        """Bits grow with the logarithm of the rows, so that a bucket of unlike vectors stays near
        `crowd`; tables are as many as keep the chance to miss a link at the threshold below `miss`."""
        self.bits = max(4, min(30, math.ceil(math.log2(max(rows, 1) / crowd)) if rows > crowd else 4))
        together = (1 - math.acos(min(1.0, threshold)) / math.pi) ** self.bits
        self.tables = max(1, math.ceil(math.log(miss) / math.log(1 - together))) if together < 1 else 1
        self.planes = np.random.default_rng([seed, size]).standard_normal((size, self.tables * self.bits))

    def codes(self, unit: np.ndarray) -> np.ndarray:
        signs = (unit @ self.planes > 0).reshape(len(unit), self.tables, self.bits)
        return (signs @ (1 << np.arange(self.bits, dtype=np.int64))).astype(np.int32)


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, block: int = 512) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: random-hyperplane sign hashing in several
    tables, exact cosines in double precision, connected components.

    Equal vectors are one class with a count. A bucket is cut into blocks, and pairs of blocks are
    compared in tasks of their own; of a pair that meets in several tables only the first counts.
    Tasks give counts and a star for each group of linked classes, never all pairs.

    Defined results: a vector that is null, empty, zero or holds a null or non-finite component has
    no links and is its own component. Vectors of different lengths do not meet. Rows with the same
    vec_id are rows of their own, which may link each other; their component is named by the
    smallest vec_id. Other columns are not read.
    """
    rows = vectors.select("vec_id", "embedding")
    rows = rows.withColumn("fine", usable() & F.exists("embedding", lambda x: x != 0))
    rows = materialize(rows, "vectors")
    classes = materialize(
        rows.where("fine").groupBy("embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
        .withColumn("class", F.monotonically_increasing_id()), "classes",
    )
    sizes = dict(classes.groupBy(F.size("embedding")).count().collect())  # one row a vector length
    found = None
    for size, count in sorted(sizes.items()):
        part = _links(classes.where(F.size("embedding") == size), Hashing(count, size, threshold), threshold, block)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = materialize(found, "vector_links")
    stars = components(found.where("b >= 0").select("a", "b"))
    counts = found.where("b < 0").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("others"))
    grouped = classes.join(counts, "class", "left").join(stars.withColumnRenamed("node", "class"), "class", "left").select(
        "embedding", "first", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("root", "class").alias("root"),
    )
    named = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = grouped.join(named, "root").select("embedding", "n_links", "component_id")
    linked = rows.where("fine").join(of_class, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, hashing: Hashing, threshold: float, block: int) -> DataFrame:
    """Rows (a, b, n): stars (a, b) of linked classes, and (a, -1, n) with numbers of linked rows."""

    def coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(codes=list(hashing.codes(_unit(frame["embedding"]))))

    kind = classes.schema["embedding"].dataType.simpleString()
    hashed = materialize(classes.select("class", "n", "embedding").mapInPandas(
        coded, f"class long, n long, embedding {kind}, codes array<int>"
    ), "codes")
    member = hashed.select("class", F.posexplode("codes").alias("table", "code"))
    # Blocks of a bucket: as many as its size asks for, filled by the hash of the class.
    crowded = member.groupBy("table", "code").agg(F.count("*").alias("m")).where(F.col("m") > 1).select(
        "table", "code", F.ceil(F.col("m") / block).cast("int").alias("blocks")
    )
    spots = hashed.select("*", F.posexplode("codes").alias("table", "code")).join(crowded, ["table", "code"]).withColumn(
        "own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    )
    # A block meets itself and every other block of its bucket once.
    meetings = spots.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "table", "class", "n", "embedding", "codes", "own",
        F.xxhash64("table", "code", F.least("own", "other"), F.greatest("own", "other")).alias("meeting"),
        (F.col("own") == F.col("other")).alias("inner"),
    )

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(frames, "meeting"):
            table = int(group["table"].iloc[0])
            names, weights = group["class"].to_numpy(), group["n"].to_numpy()
            unit, codes = _unit(group["embedding"]), np.array(group["codes"].tolist())
            own = group["own"].to_numpy()
            left = np.flatnonzero(own == own.min())
            right = left if group["inner"].iloc[0] else np.flatnonzero(own != own.min())
            if not len(left) or not len(right):
                continue
            near = unit[left] @ unit[right].T >= threshold
            if group["inner"].iloc[0]:
                near &= ~np.eye(len(left), dtype=bool)
            x, y = np.nonzero(near)
            if table and len(x):
                new = ~(codes[left[x], :table] == codes[right[y], :table]).any(axis=1)
                x, y = x[new], y[new]
            if not len(x):
                continue
            counts = np.zeros(len(group), np.int64)
            np.add.at(counts, left[x], weights[right[y]])
            if not group["inner"].iloc[0]:
                np.add.at(counts, right[y], weights[left[x]])
            hit = np.flatnonzero(counts)
            a, b = _stars(left[x], right[y], len(group))
            yield pd.DataFrame({
                "a": np.concatenate([names[hit], names[a]]),
                "b": np.concatenate([np.full(len(hit), -1), names[b]]),
                "n": np.concatenate([counts[hit], np.zeros(len(a), np.int64)]),
            })

    return meetings.repartition("meeting").sortWithinPartitions("meeting").mapInPandas(compare, "a long, b long, n long")


def _stars(x: np.ndarray, y: np.ndarray, size: int):
    """The links of a block as stars of its connected groups."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if (root == before).all():
            break
    others = np.flatnonzero(root != np.arange(size))
    return root[others], others


def scaled(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, values): floor(scale * x) of every component, of usable vectors, once each."""
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * scale).cast("long"))
    return vectors.where(usable()).select("vec_id", whole.alias("values")).distinct()


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, query_block: int = 512, block: int = 4_096) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer inner products of every query, ties
    to the smaller vec_id, by the threshold algorithm over sorted lists of each dimension.

    Queries and candidates, both (vec_id, values), are dealt into blocks by hash, and a task holds
    one block of each. There every dimension has a list of the candidates in its order. A query
    reads all lists from the end that its sign asks for, step by step, scores what it sees for the
    first time, and stops as soon as the sum of what the lists could still give cannot reach its
    k-th best. The best of each block meet by query.

    Defined results: a candidate with the query's vec_id is left out. Queries and candidates of
    different lengths do not meet. Fewer than k candidates give fewer rows. Rows that repeat both
    vec_id and vector count once. Null ids take no part.
    """
    queries = materialize(queries.where("vec_id is not null"), "queries")
    candidates = materialize(candidates.where("vec_id is not null"), "candidates")
    query_blocks = max(1, -(-queries.count() // query_block))
    blocks = max(1, -(-candidates.count() // block))
    size = F.size("values").alias("size")
    left = queries.select("vec_id", "values", size, F.lit(True).alias("query"), F.pmod(F.xxhash64("vec_id", "values"), F.lit(query_blocks)).alias("q"))
    right = candidates.select("vec_id", "values", size, F.lit(False).alias("query"), F.pmod(F.xxhash64("vec_id", "values"), F.lit(blocks)).alias("c"))
    left = left.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    right = right.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<long>")))
    met = left.unionByName(right).withColumn("meeting", F.xxhash64("size", "q", "c"))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(frames, "meeting"):
            asks = group["query"].to_numpy()
            if not asks.any() or asks.all():
                continue
            lists = SortedLists(group["vec_id"].to_numpy()[~asks], np.array(group["values"][~asks].tolist()))
            rows = []
            for query_id, values in zip(group["vec_id"][asks], group["values"][asks]):
                ids, scores = lists.best(np.asarray(values), k, query_id)
                rows += [(query_id, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
            yield pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    found = met.drop("q", "c", "size").repartition("meeting").sortWithinPartitions("meeting").mapInPandas(
        search, "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


class SortedLists:
    """The candidates of a block in the order of each dimension."""

    FIRST_STEP = 8

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        # Products of floats are exact up to 2^53; anything larger is computed with Python's numbers.
        self.exact = np.abs(values).max(initial=0) < 1 << 23
        self.values = values.astype(np.float64) if self.exact else values.astype(object)
        self.lists = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(values, self.lists, axis=0)

    def best(self, query: np.ndarray, k: int, query_id):
        """Ids and scores of the k best, ties to the smaller id."""
        n = len(self.ids)
        exact = self.exact and np.abs(query).max(initial=0) < 1 << 23
        weights = query.astype(np.float64) if exact else query.astype(object)
        used = np.flatnonzero(query)
        seen = np.zeros(n, bool)
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64 if exact else object)
        depth, step = 0, self.FIRST_STEP
        own = self.ids == query_id
        while depth < n:
            upto = min(n, depth + step)
            if len(used):
                up = used[query[used] < 0]
                down = used[query[used] > 0]
                fresh = np.concatenate([
                    self.lists[depth:upto, up].ravel(), self.lists[n - upto:n - depth, down].ravel()
                ])
            else:
                fresh = np.arange(depth, upto)
            hit = np.zeros(n, bool)
            hit[fresh] = True
            fresh = np.flatnonzero(hit & ~seen)
            seen |= hit
            fresh = fresh[~own[fresh]]
            if len(fresh):
                products = self.values[fresh] @ weights
                rows = np.concatenate([rows, fresh])
                scores = np.concatenate([scores, products.astype(np.int64) if exact else products])
                keep = np.lexsort((self.ids[rows], -scores))[:k]
                rows, scores = rows[keep], scores[keep]
            depth, step = upto, step * 2
            if len(rows) == k and len(used) and depth < n:
                # No candidate that is still unseen can have more than this in any dimension.
                bound = sum(int(query[d]) * int(self.sorted[depth, d]) for d in up) + sum(
                    int(query[d]) * int(self.sorted[n - depth - 1, d]) for d in down
                )
                if scores[-1] > bound:
                    break
        return self.ids[rows], scores
