"""Toxicity by the nearest labelled examples.

Documents are TF-IDF vectors, and the score of a document comes from the labelled examples nearest
to it by exact cosine. A document with a selected term (one that tells the label) is compared over
the selected terms, in an inverted index whose postings are cut into blocks: a block is opened only
if the largest weights in it could still beat the k-th neighbour. Every other document is compared
with all examples over all words that any example has. The neighbours vote with their cosine, and
the vote is turned into a probability by an isotonic fit of the examples' own votes, each without
itself; each of the two searches has its own fit.

Defined results: a null text counts as empty. Words that no example has are not in the vectors. A
text without any word of the examples has no neighbours and gets the share of toxic examples among
the examples without a word, or among all if there is none such. Equal cosines are taken in the
order of the example's id. Repeated rows are scored each by itself. Without any example every score
is 0. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.shared import labelled_sample, segments

WORD = re.compile(r"[^\W_]+")
#: What WORD leaves out of plain text, as blanks.
PLAIN = {c: " " for c in range(128) if not chr(c).isalnum()}
PLAIN_BYTES = bytes(32 if c in PLAIN else c for c in range(256))


@dataclass(frozen=True)
class Settings:
    """`examples` bounds the labelled sample, `vocabulary` the number of selected terms.

    A term is selected if at least `support` different texts of the sample have it, its chi-square
    with the label reaches `association`, and it moves the odds of the label by the factor `odds`
    (words of every text have some association, but tell nothing of a single text).
    """

    examples: int = 20_000
    vocabulary: int = 4_096
    support: int = 5
    association: float = 30.0
    odds: float = 8.0
    neighbours: int = 15
    block: int = 64


#: Texts that are compared with all examples at once; a word of more than one example in DENSE has a
#: row over all examples, for the DENSE_WORDS most common of them.
TOGETHER, DENSE, DENSE_WORDS = 256, 10, 256
#: More than single precision can put a sum of DENSE_WORDS parts of a cosine off, twice.
SINGLE = 1e-4
#: Values of which the largest stands for all.
STRETCH = 64
#: Blocks that are opened at once at first; after them twice as many, and so on.
OPENED = 8
#: Word numbers that are held before they are counted.
HELD = 1 << 20


def lower_words(piece: str) -> list[str]:
    """The lower-case words of a piece of text, in order."""
    piece = piece.lower()
    if piece.isascii():
        return piece.translate(PLAIN).split()
    # Blanks and plain characters end a word in any case; the pattern is left what may hold other signs.
    words = piece.encode("utf-8", "surrogatepass").translate(PLAIN_BYTES).decode("utf-8", "surrogatepass").split()
    if "".join(words).isalnum():
        return words
    return [x for w in words for x in ((w,) if w.isalnum() else WORD.findall(w))]


def term_counts(text: str | None) -> Counter:
    """Counts of the lower-case words of a whole text."""
    counts: Counter = Counter()
    for piece in segments(text or ""):
        counts.update(lower_words(piece))
    return counts


def numbered(text: str | None, numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of a whole text that have one, rising, and their counts."""
    terms, tf = [], []
    for piece in segments(text or ""):
        # Counted first, so that every different word is looked up once.
        counts = Counter(lower_words(piece))
        found = np.fromiter(map(numbers.get, counts, repeat(-1)), np.int64, len(counts))
        known = found >= 0
        terms.append(found[known])
        tf.append(np.fromiter(counts.values(), float, len(counts))[known])
    if len(terms) == 1:
        order = np.argsort(terms[0])
        return terms[0][order], tf[0][order]
    found, place = np.unique(np.concatenate(terms), return_inverse=True)
    return found, np.bincount(place, np.concatenate(tf), minlength=len(found))


def copy_key(text: str | None) -> str:
    """Digest of a whole text in lower case with its blanks made equal: only true copies share it."""
    words = " ".join((text or "").lower().split())
    return hashlib.blake2b(words.encode("utf-8", "replace"), digest_size=16).hexdigest()


def least_of(values: np.ndarray, k: int) -> float:
    """A number that at least k of the values reach, near the k-th largest of them; 0 if there are fewer."""
    if len(values) <= k:
        return 0.0
    if len(values) >= 4 * k * STRETCH:
        # The k-th largest of the largest of every stretch.
        whole = len(values) // STRETCH * STRETCH
        values = values[:whole].reshape(-1, STRETCH).max(axis=1)
    return np.partition(values, -k)[-k]


class Index:
    """Inverted index of unit vectors in blocks, with the largest weight of each term and block."""

    def __init__(self, ids, labels, vectors, idf, block: int):
        weighted = [self.unit(terms, tf, idf) for terms, tf in vectors]
        # Examples that share their heaviest term stand together, so that few blocks have high bounds.
        lead = [int(t[np.argmax(w)]) for (t, _), w in zip(vectors, weighted)]
        order = sorted(range(len(ids)), key=lambda i: (lead[i], ids[i]))
        self.ids = np.array([ids[i] for i in order], dtype=np.int64)
        self.labels = np.array([labels[i] for i in order], dtype=np.int8)
        self.block, self.idf = block, idf
        self.blocks = -(-len(order) // block)
        terms = np.concatenate([vectors[i][0] for i in order] or [np.empty(0, np.int64)])
        weights = np.concatenate([weighted[i] for i in order] or [np.empty(0)])
        rows = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        by_term = np.lexsort((rows, terms))
        self.rows, self.weights = rows[by_term], weights[by_term]
        edges = np.arange(len(idf))[:, None] * np.int64(max(self.blocks, 1)) + np.arange(max(self.blocks, 1))
        keys = terms[by_term] * np.int64(max(self.blocks, 1)) + self.rows // block
        self.begin = np.searchsorted(keys, edges, "left").astype(np.int64)
        self.end = np.searchsorted(keys, edges, "right").astype(np.int64)
        self.top = np.zeros(edges.shape)
        np.maximum.at(self.top, (terms[by_term], self.rows // block), self.weights)

    @staticmethod
    def unit(terms, tf, idf) -> np.ndarray:
        weights = (1.0 + np.log(tf)) * idf[terms]
        return weights / np.sqrt(np.dot(weights, weights))

    def nearest(self, terms, tf, k: int, without: int | None = None):
        """Row numbers and cosines of the k nearest examples, ties by example id.

        `without` is the id of an example that is not a neighbour (its own vote).
        """
        query = self.unit(terms, tf, self.idf)
        bounds = query @ self.top[terms]
        found_rows, found_cosines = np.empty(0, np.int64), np.empty(0)
        order = np.argsort(-bounds, kind="stable")[:np.count_nonzero(bounds > 0)]
        at, some = 0, OPENED
        while at < len(order):
            # Rounding may put a sum a little above its bound; equal cosines are decided by the id.
            if len(found_rows) == k and bounds[order[at]] < found_cosines[-1] - 1e-9:
                break
            opened = order[at:at + some]
            begins, ends = self.begin[np.ix_(terms, opened)].ravel(), self.end[np.ix_(terms, opened)].ravel()
            sizes = ends - begins
            posts = np.arange(sizes.sum()) + np.repeat(ends - np.cumsum(sizes), sizes)
            sums = np.bincount(self.rows[posts], self.weights[posts] * np.repeat(np.repeat(query, len(opened)), sizes))
            rows = np.flatnonzero(sums)
            cosines = np.round(sums[rows], 9)
            if without is not None:
                keep = self.ids[rows] != without
                rows, cosines = rows[keep], cosines[keep]
            rows = np.concatenate([found_rows, rows])
            cosines = np.concatenate([found_cosines, cosines])
            best = np.lexsort((self.ids[rows], -cosines))[:k]
            found_rows, found_cosines = rows[best], cosines[best]
            at, some = at + some, 2 * some
        return found_rows, found_cosines

    def vote(self, rows, cosines) -> float:
        return float(np.dot(cosines, self.labels[rows]) / cosines.sum())


class WholeIndex:
    """Unit vectors of all examples over all their words; cosines with every example at once.

    The examples come in the order of their ids: `terms` and `tf` end to end, `sizes` words each. The
    postings of a word stand in the order of its count, so that one number serves all that share it, and
    the length of an example divides once, after its sum is complete. Common words are summed in single
    precision for all examples, and then in double precision for those that may be among the nearest.
    """

    def __init__(self, ids, labels, sizes, terms, tf, idf):
        self.ids, self.labels, self.idf = ids, labels, idf
        rows = np.repeat(np.arange(len(ids), dtype=np.min_scalar_type(len(ids))), sizes)
        edges, squares = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), np.zeros(len(ids))
        # Some examples at once, so that nothing is as long as the postings.
        for at in range(0, len(ids), TOGETHER):
            end = min(len(ids), at + TOGETHER)
            part = slice(edges[at], edges[end])
            w = (1.0 + np.log(tf[part].astype(float))) * idf[terms[part]]
            squares[at:end] = np.bincount(rows[part].astype(np.int64) - at, w * w, minlength=end - at)
        self.scale = 1.0 / np.sqrt(np.where(squares > 0, squares, 1.0))
        order = np.lexsort((tf, terms))
        self.rows = rows[order]
        del rows
        terms, tf = terms[order], tf[order]
        del order
        # A run: the postings of one word and one count.
        first = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (tf[1:] != tf[:-1])])[:len(terms)])
        self.edges = np.append(first, len(terms))
        self.counted = 1.0 + np.log(tf[first].astype(float))
        self.runs = np.searchsorted(terms[first], np.arange(len(idf) + 1))
        self.begin = self.edges[self.runs]
        many = np.diff(self.begin)
        common = np.argsort(-many, kind="stable")[:DENSE_WORDS]
        common = common[many[common] * DENSE > len(ids)]
        self.place = np.full(len(idf), -1, np.int32)
        self.place[common] = np.arange(len(common))
        # What a count adds, by its code; code 0 is a word that an example does not have.
        counts = np.unique(tf[first])
        self.added = np.concatenate([[0.0], 1.0 + np.log(counts.astype(float))])
        self.codes = np.zeros((len(common), len(ids)), np.min_scalar_type(len(counts)))
        self.dense = np.empty(self.codes.shape, np.float32)
        for i, term in enumerate(common):
            part = slice(self.begin[term], self.begin[term + 1])
            self.codes[i, self.rows[part]] = 1 + np.searchsorted(counts, tf[part])
            self.dense[i] = self.added[self.codes[i]] * self.scale

    def _spread(self, terms, weights) -> np.ndarray:
        """For each posting of the words: the word's weight times what its count adds."""
        begins, runs = self.runs[terms], self.runs[terms + 1] - self.runs[terms]
        at = np.arange(runs.sum()) + np.repeat(begins - np.cumsum(runs) + runs, runs)
        return np.repeat(np.repeat(weights, runs) * self.counted[at], self.edges[at + 1] - self.edges[at])

    def _rare(self, terms, weights) -> np.ndarray:
        """The sums of some words for every example."""
        spans = list(map(slice, self.begin[terms].tolist(), self.begin[terms + 1].tolist()))
        if not spans:
            return np.zeros(len(self.ids))
        rows = np.concatenate([self.rows[x] for x in spans])
        return np.bincount(rows, self._spread(terms, weights), minlength=len(self.ids))

    def nearest(self, vectors, k: int, without=None):
        """For each (terms, tf): example numbers and cosines of the k nearest, ties by example id.

        `without` has for each vector the number of an example that is not a neighbour.
        """
        weights = [Index.unit(terms, tf, self.idf) * self.idf[terms] for terms, tf in vectors]
        common = np.zeros((len(vectors), len(self.dense)))
        for i, (terms, _) in enumerate(vectors):
            at = self.place[terms]
            common[i, at[at >= 0]] = weights[i][at >= 0]
        for i, (about, (terms, _)) in enumerate(zip(common.astype(np.float32) @ self.dense, vectors)):
            rare = self.place[terms] < 0
            sums = self._rare(terms[rare], weights[i][rare])
            sums *= self.scale
            about = about + sums
            if without is not None:
                about[without[i]] = 0.0
            # Every example that single precision cannot rule out; cosines are compared to nine decimals.
            least = least_of(about, k) - SINGLE
            near = np.flatnonzero(about >= least if least > 0 else about > 0)
            held = np.flatnonzero(common[i])
            exact = common[i][held] @ self.added[self.codes[np.ix_(held, near)]]
            close = np.round(exact * self.scale[near] + sums[near], 9)
            best = np.argsort(-close, kind="stable")[:k]
            best = best[close[best] > 0]
            yield near[best], close[best]

    vote = Index.vote


def isotonic(votes: np.ndarray, labels: np.ndarray):
    """Points of a rising step fit of the label on the vote (pool adjacent violators), smoothed."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []
    for vote, label in zip(votes[order], labels[order]):
        pools.append([vote, vote, 1.0, float(label)])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    xs = [x for low, high, _, _ in pools for x in (low, high)]
    ys = [(total + 0.5) / (n + 1.0) for _, _, n, total in pools for _ in range(2)]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


@dataclass
class Examples:
    """The labelled examples in the order of their ids, as numbers end to end: `sizes` words each, their
    `terms` and counts `tf`. `lines` has all their words, common ones first, one a line; `chosen` are the
    selected ones. This is what travels; dictionaries and indexes are built where they are used.
    """

    lines: bytes
    chosen: list[str]
    ids: np.ndarray
    labels: np.ndarray
    sizes: np.ndarray
    terms: np.ndarray
    tf: np.ndarray
    idf: np.ndarray
    block: int

    def __getstate__(self):
        return {f: getattr(self, f) for f in self.__dataclass_fields__}

    @cached_property
    def words(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.lines.decode().split("\n"))} if self.lines else {}

    @cached_property
    def vocabulary(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.chosen)}

    @cached_property
    def edges(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    @cached_property
    def number(self) -> np.ndarray:
        """Of each word its number among the selected ones, or -1."""
        number = np.full(len(self.idf), -1)
        number[[self.words[t] for t in self.chosen]] = np.arange(len(self.chosen))
        return number

    def vector(self, i: int):
        part = slice(self.edges[i], self.edges[i + 1])
        return self.terms[part].astype(np.int64), self.tf[part].astype(float)

    def narrow(self, i: int):
        """The vector over the selected terms."""
        terms, tf = self.vector(i)
        kept = self.number[terms] >= 0
        return self.number[terms[kept]], tf[kept]

    def for_scoring(self) -> Examples:
        """Builds both indexes and lets go of what only votes need."""
        if self.terms is not None:
            self.index, self.whole  # noqa: B018
            self.terms = self.tf = None
        return self

    @cached_property
    def index(self) -> Index:
        vectors = [(i, self.narrow(i)) for i in range(len(self.ids))]
        vectors = [(i, v) for i, v in vectors if len(v[0])]
        return Index(
            [self.ids[i] for i, _ in vectors], [self.labels[i] for i, _ in vectors], [v for _, v in vectors],
            self.idf[[self.words[t] for t in self.chosen]], self.block,
        )

    @cached_property
    def whole(self) -> WholeIndex:
        return WholeIndex(self.ids, self.labels, self.sizes, self.terms, self.tf, self.idf)

    def votes(self, numbers, k: int) -> Iterator[tuple[bool, float, int]]:
        """Of examples: whether they have a selected term, the vote of the others on them, and the label.
        Examples without a word, or without a neighbour, have none."""
        others = []
        for i in numbers:
            narrow = self.narrow(i)
            if len(narrow[0]):
                near = self.index.nearest(*narrow, k, without=self.ids[i])
                if len(near[0]):
                    yield True, self.index.vote(*near), int(self.labels[i])
            elif self.sizes[i]:
                others.append(i)
        for begin in range(0, len(others), TOGETHER):
            part = others[begin:begin + TOGETHER]
            for i, near in zip(part, self.whole.nearest([self.vector(i) for i in part], k, part)):
                if len(near[0]):
                    yield False, self.whole.vote(*near), int(self.labels[i])


@dataclass
class Model:
    """`points` is the fit of the votes over the selected terms, `whole_points` of those over all words;
    `shared` has the examples for the tasks."""

    examples: Examples
    points: tuple[np.ndarray, np.ndarray]
    whole_points: tuple[np.ndarray, np.ndarray]
    base: float
    settings: Settings
    shared: Broadcast | None = None

    words = property(lambda self: self.examples.words)
    vocabulary = property(lambda self: self.examples.vocabulary)
    index = property(lambda self: self.examples.index)
    whole = property(lambda self: self.examples.whole)

    def score(self, text: str | None):
        """Score, and the ids and cosines of the neighbours that gave it."""
        return self.scores([text])[0]

    def scores(self, texts) -> list[tuple]:
        found: list[tuple] = [(self.base, [], [])] * len(texts)
        waiting: list[tuple[int, tuple]] = []
        for i, text in enumerate(texts):
            terms, tf = numbered(text, self.words)
            number = self.examples.number[terms]
            chosen = number >= 0
            if chosen.any():
                near = self.index.nearest(number[chosen], tf[chosen], self.settings.neighbours)
                found[i] = self._judged(self.index, near, self.points)
            elif len(terms):
                waiting.append((i, (terms, tf)))
            if len(waiting) == TOGETHER:
                self._settle(waiting, found)
                waiting = []
        if waiting:
            self._settle(waiting, found)
        return found

    def _settle(self, waiting, found) -> None:
        for (i, _), near in zip(waiting, self.whole.nearest([v for _, v in waiting], self.settings.neighbours)):
            if len(near[0]):
                found[i] = self._judged(self.whole, near, self.whole_points)

    @staticmethod
    def _judged(index, near, points):
        rows, cosines = near
        return float(np.interp(index.vote(rows, cosines), *points)), index.ids[rows].tolist(), cosines.tolist()


def _fitted(votes: list[tuple[float, int]]):
    return isotonic(*map(np.array, zip(*votes))) if votes else (np.array([0.0, 1.0]), np.array([0.0, 1.0]))


def _sample_terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts = [term_counts(t) for t in frame["text"]]
        yield pd.DataFrame({
            "doc_id": frame["doc_id"], "label": frame["label"],
            "copy": [copy_key(t) for t in frame["text"]], "terms": [list(c) for c in counts],
        })


def _joined(words: pa.ChunkedArray) -> bytes:
    """The words, one a line, without a Python object for each."""
    lists = (pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in words.chunks if len(c))
    return b"\n".join(pc.binary_join(x, "\n")[0].as_buffer().to_pybytes() for x in lists)


def _in_order(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Ids, labels, sizes, terms and counts of the examples in the order of their ids. Every list is
    copied once, to its place."""
    order = np.argsort(table["doc_id"].to_numpy(), kind="stable")
    ids, labels = (table[c].to_numpy()[order] for c in ("doc_id", "label"))
    sizes = pc.list_value_length(table["terms"]).to_numpy()
    begins = np.empty(len(order), np.int64)
    begins[order] = np.cumsum(sizes[order]) - sizes[order]
    most = max((pc.max(c.flatten()).as_py() or 0 for c in table["tf"].chunks), default=0)
    flat = []
    for column, kind in (("terms", np.int32), ("tf", np.min_scalar_type(most))):
        out, i = np.empty(int(sizes.sum()), kind), 0
        for chunk in table[column].chunks:
            values, at = chunk.flatten().to_numpy(), 0
            for size in sizes[i:i + len(chunk)].tolist():
                out[begins[i]:begins[i] + size] = values[at:at + size]
                i, at = i + 1, at + size
        flat.append(out)
    return ids, labels, sizes[order], *flat


def fit(
    documents: DataFrame, labels: DataFrame, label: str, learnable: Column,
    settings: Settings = Settings(),
) -> Model:
    """Selects terms and indexes a bounded sample of labelled rows; weighs terms by all documents.

    `documents` has doc_id and text, `labels` doc_id and the label column; `learnable` says which
    rows of `labels` may be learnt from.
    """
    spark = documents.sparkSession
    sample = labelled_sample(documents, labels, label, learnable, settings.examples).persist()
    n, positive = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    seen = sample.mapInPandas(
        _sample_terms, "doc_id long, label int, copy string, terms array<string>"
    )
    # Copies of one text count once, for a term as for the totals.
    texts = seen.groupBy("copy").agg(
        F.max("label").alias("label"), F.max_by("terms", F.struct("label", "doc_id")).alias("terms")
    ).persist()
    different, different_toxic = texts.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    by_term = (
        texts.select("label", F.explode("terms").alias("term"))
        .groupBy("term").agg(F.count("*").alias("n"), F.sum("label").alias("p"))
        .where(F.col("n") >= settings.support)
    )
    total, toxic, c, p = F.lit(float(different)), F.lit(float(different_toxic)), F.col("n"), F.col("p")
    expected = c * toxic * (total - c) * (total - toxic)
    chi_square = total * F.pow(p * total - c * toxic, F.lit(2.0)) / F.nullif(expected, F.lit(0.0))
    ratio = (p + 0.5) * (total - toxic - c + p + 0.5) / ((c - p + 0.5) * (toxic - p + 0.5))
    terms = sorted(
        r["term"] for r in by_term.withColumns({"x": chi_square, "odds": ratio})
        .where((F.col("x") >= settings.association) & ((F.col("odds") >= settings.odds) | (F.col("odds") <= 1 / settings.odds)))
        .orderBy(F.col("x").desc(), "term").limit(settings.vocabulary).collect()
    )
    # Bounded by the words of the sample; as one text, which is small beside a set of strings. Common
    # words come first, so that what is looked up most lies together.
    lines = _joined(
        texts.select(F.explode("terms").alias("term")).groupBy("term").count()
        .orderBy(F.col("count").desc(), "term").select("term").toArrow()["term"]
    )
    texts.unpersist()
    shared = spark.sparkContext.broadcast(lines)

    def numbers() -> dict[str, int]:
        return {w: i for i, w in enumerate(shared.value.decode().split("\n"))} if shared.value else {}

    def document_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total, held = numbers(), 0, []
        counted = np.zeros(len(known), np.int64)
        for frame in frames:
            total += len(frame)
            for text in frame["text"]:
                found: set = set()
                for piece in segments(text or ""):
                    found.update(map(known.get, set(lower_words(piece))))
                found.discard(None)
                held.extend(found)
                if len(held) >= HELD:
                    counted += np.bincount(held, minlength=len(known))
                    held = []
        if held:
            counted += np.bincount(held, minlength=len(known))
        seen = np.flatnonzero(counted)
        yield pd.DataFrame({"term": np.concatenate([[-1], seen]), "n": np.concatenate([[total], counted[seen]])})

    def example_vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = numbers()
        for frame in frames:
            vectors = [numbered(x, known) for x in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "label": frame["label"],
                "terms": [t.astype(np.int32) for t, _ in vectors], "tf": [n.astype(np.int32) for _, n in vectors],
            })

    # One row per word of the bounded sample comes back, counted over all documents.
    counts = (
        documents.select("text").mapInPandas(document_counts, "term int, n long")
        .groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    )
    term, times = counts["term"].to_numpy(), counts["n"].to_numpy()
    size = lines.count(b"\n") + 1 if lines else 0
    total, rows_with = int(times[term < 0].sum()), np.zeros(size)
    rows_with[term[term >= 0]] = times[term >= 0]
    idf = np.log((1 + total) / (1 + rows_with)) + 1.0
    table = sample.mapInPandas(
        example_vectors, "doc_id long, label int, terms array<int>, tf array<int>"
    ).toArrow()  # bounded by `examples`
    sample.unpersist()
    examples = Examples(lines, terms, *_in_order(table), idf, settings.block)
    ids, marks, sizes = examples.ids, examples.labels, examples.sizes
    del table, counts
    pa.default_memory_pool().release_unused()
    known = spark.sparkContext.broadcast(examples)

    def leave_one_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(known.value.votes(frame["id"], settings.neighbours), columns=["chosen", "vote", "label"])

    # Two numbers for each example come back; the searches are the tasks' work.
    voted = spark.range(len(ids)).mapInPandas(leave_one_out, "chosen boolean, vote double, label int").toArrow()
    chosen, vote, mark = (voted[c].to_numpy() for c in ("chosen", "vote", "label"))
    fits = [_fitted(list(zip(vote[chosen == c].tolist(), mark[chosen == c].tolist()))) for c in (True, False)]
    shared.unpersist()
    empty = marks[sizes == 0]
    base = (float(empty.sum()) + 0.5) / (len(empty) + 1.0) if len(empty) else (float(positive) / n if n else 0.0)
    return Model(examples, *fits, base, settings, known)


def scorer(spark, model: Model):
    """Column function: text -> struct of score and evidence (ids and cosines of the neighbours)."""
    shared, rest = model.shared, (model.points, model.whole_points, model.base, model.settings)

    @F.pandas_udf("score double, neighbours array<long>, cosines array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = Model(shared.value.for_scoring(), *rest)
        for texts in batches:
            yield pd.DataFrame(fitted.scores(list(texts)), columns=["score", "neighbours", "cosines"])

    return score
