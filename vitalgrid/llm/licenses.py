"""License scans: winnowed template fingerprints pick candidates, banded alignment proves them.

A text is its lower-case words. Of each run of `WINDOW` five-word shingles of a template the one
with the smallest code goes into an inverted index; all shingles of a document are looked up, so
that a template piece of WINDOW + SHINGLE - 1 words that a document repeats is always found. Hits
on near diagonals are one candidate, and the template is aligned with the document's words in a
band around them, again and again over the words that are left, until no piece is found. Pieces that
advance in the template and in the document are chained, whatever stands between them. The share of
the template's words that a chain matches is the coverage.

Templates are a parameter, broadcast to the tasks; their size is checked. Texts are scanned one by
one, whole, without any shuffle.

Defined results: one row for each document row and license whose best coverage reaches the least
one; documents without a license have no row. Null and empty texts have none. Spans are character
places [begin, end) in order, one for each piece; repeated notices give a span each, and copies of a
row repeat its rows. Templates of fewer than five words match as a whole sequence. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.license_texts import TEMPLATES
from vitalgrid.llm.shared import BROADCAST_BYTES

WORD = re.compile(r"[^\W_]+")
SHINGLE, WINDOW = 5, 4
BAND = 16
COVERAGE = 0.8
GAP = 0.5
BASE = np.uint64(0x100000001B3)  # the prime of the FNV hash
SCHEMA = "doc_id string, license string, coverage double, spans array<struct<begin:long,end:long>>"


def _shingles(ids: np.ndarray, size: int) -> np.ndarray:
    """Codes of all runs of `size` words."""
    codes = np.zeros(max(0, len(ids) - size + 1), np.uint64)
    for j in range(size):
        codes = (codes ^ ids[j:j + len(codes)]) * BASE
        codes ^= codes >> np.uint64(31)
    return codes


def winnow(codes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest code of each window, the last of equal ones."""
    if len(codes) <= window:
        return np.array([len(codes) - 1 - int(np.argmin(codes[::-1]))]) if len(codes) else np.empty(0, int)
    views = np.lib.stride_tricks.sliding_window_view(codes, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


class Scanner:
    def __init__(self, templates: dict[str, list[str]]):
        self.vocabulary: dict[str, int] = {}
        self.templates: list[tuple[str, np.ndarray]] = []
        self.index: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for name, texts in templates.items():
            for text in texts:
                words = WORD.findall(text.lower())
                if not words:
                    continue
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint64)
                size = min(SHINGLE, len(ids))
                codes = _shingles(ids, size)
                for at in winnow(codes):
                    self.index[size][int(codes[at])].append((len(self.templates), int(at)))
                self.templates.append((name, ids))
        self.known = {size: np.array(sorted(codes), np.uint64) for size, codes in self.index.items()}
        self.index = {size: dict(codes) for size, codes in self.index.items()}

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, lowest diagonal, highest diagonal) of the regions that share a fingerprint."""
        diagonals = defaultdict(list)
        for size, known in self.known.items():
            if len(ids) < size:
                continue
            outside = np.concatenate([[0], np.cumsum(ids == 0)])
            begins = np.flatnonzero(outside[size:] == outside[:-size])
            if not len(begins):
                continue
            windows = np.lib.stride_tricks.sliding_window_view(ids, size)[begins]
            codes = np.zeros(len(begins), np.uint64)
            for j in range(size):
                codes = (codes ^ windows[:, j]) * BASE
                codes ^= codes >> np.uint64(31)
            for i in np.flatnonzero(np.isin(codes, known)):
                for template, at in self.index[size][int(codes[i])]:
                    diagonals[template].append(int(begins[i]) - at)
        found = []
        for template, values in diagonals.items():
            values.sort()
            # A dense run of notices is cut, so that no band is much wider than the template is long.
            widest = max(len(self.templates[template][1]), 2 * BAND)
            low = high = values[0]
            for value in values[1:]:
                if value - high > BAND or value - low > widest:
                    found.append((template, low, high))
                    low = value
                high = value
            found.append((template, low, high))
        return found

    def scan(self, text: str | None) -> dict[str, tuple[float, list[tuple[int, int]]]]:
        """Best coverage and character spans of every license in a whole text."""
        text = text or ""
        words = WORD.findall(text.lower())
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
        candidates = self.candidates(ids)
        if not candidates:
            return {}
        places = self._places(text)
        pieces = defaultdict(set)
        for template, low_diagonal, high_diagonal in candidates:
            words = self.templates[template][1]
            masked = []
            while True:
                matched, begin, end = align(words, ids, low_diagonal, high_diagonal)
                if len(matched) < min(SHINGLE, len(words)):
                    break
                pieces[template].add((begin, end, tuple(matched)))
                masked.append((begin, ids[begin:end + 1].copy()))
                ids[begin:end + 1] = 0  # no word of a template
            for begin, own in masked:
                ids[begin:begin + len(own)] = own
        regions = defaultdict(list)
        for template, parts in pieces.items():
            name, words = self.templates[template]
            for matched, spans in chains(parts, len(words)):
                regions[name].append((matched / len(words), [(places[b][0], places[e][1]) for b, e in spans]))
        found = {}
        for name, parts in regions.items():
            # Of overlapping regions of one license the one that covers most is told.
            kept: list[tuple[int, int]] = []
            for _, spans in sorted(parts, key=lambda p: (-p[0], p[1][0][0] - p[1][-1][1], p[1][0][0])):
                if all(_free(kept, *span) for span in spans):
                    for span in spans:
                        insort(kept, span)
            found[name] = (max(p[0] for p in parts), kept)
        return found

    @staticmethod
    def _places(text: str) -> list[tuple[int, int]]:
        """Character places of the words; lower case may be longer than the text it comes from."""
        low = text.lower()
        spots = [(m.start(), m.end()) for m in WORD.finditer(low)]
        if len(low) == len(text):
            return spots
        origin = [i for i, c in enumerate(text) for _ in c.lower()]
        return [(origin[b], origin[e - 1] + 1) for b, e in spots]


def _free(kept: list[tuple[int, int]], begin: int, end: int) -> bool:
    """Whether a span overlaps none of the sorted, disjoint ones."""
    at = bisect_left(kept, (begin, end))
    return (at == 0 or kept[at - 1][1] <= begin) and (at == len(kept) or kept[at][0] >= end)


def chains(pieces: set[tuple[int, int, tuple[int, ...]]], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Matched words and document spans of the chains that cover enough of a template of `size` words.

    Pieces are (first, last place in the document, matched template words in order). In a chain both
    advance; words that two pieces share, by chance at their ends, count once. A chain that covers
    enough ends where the pieces after it cover enough by themselves: there the template begins anew.
    """
    found = []

    def close(link):
        spans = []
        total = link[0]
        while link:
            spans.append(link[1])
            link = link[3]
        found.append((total, spans[::-1]))

    def grown(links, begin, end, matched):
        link = (len(matched), (begin, end), matched[0], None)
        for at, before in links.items():
            if before[2] < matched[0] and at < matched[-1] and matched[0] > at - BAND and begin > before[1][1]:
                total = before[0] + sum(w > at for w in matched)
                if total > link[0]:
                    link = (total, (begin, end), matched[0], before)
        return link

    def keep(links, link, last):
        # Of chains that match equally many words the later one leaves the smaller gap.
        if last not in links or link[0] >= links[last][0]:
            links[last] = link

    # Both are last template word -> (matched words, span, first template word, link before).
    best: dict[int, tuple] = {}
    after: dict[int, tuple] = {}  # of the pieces behind a chain that covers enough
    full = None
    for begin, end, matched in sorted(pieces):
        link = grown(best, begin, end, matched)
        if full is None or link[0] > full[0] or begin <= full[1][1]:
            keep(best, link, matched[-1])
            if link[0] / size >= COVERAGE and (full is None or link[0] > full[0]):
                full, after = link, {}
            continue
        link = grown(after, begin, end, matched)
        keep(after, link, matched[-1])
        if link[0] / size >= COVERAGE:
            close(full)
            best, after, full = after, {}, link
    if full is not None:
        close(full)
    return found


def align(template: np.ndarray, ids: np.ndarray, low: int, high: int):
    """Matched template words and the first and last matched place of the best alignment of a template within
    the band of diagonals. A match counts 1, a word without a partner costs GAP on either side."""
    low, width = low - BAND, high - low + 2 * BAND + 1
    score = np.zeros((len(template) + 1, width + 1))
    steps = np.arange(width + 1) * GAP
    offset = np.arange(width)
    same = np.zeros((len(template), width), bool)
    for i, word in enumerate(template):
        places = i + low + offset
        inside = (places >= 0) & (places < len(ids))
        same[i, inside] = ids[places[inside]] == word
        # In band coordinates a diagonal step keeps the column, a skipped template word comes from the right.
        best = np.maximum(score[i, :-1] + np.where(same[i], 1.0, -2 * GAP), score[i, 1:] - GAP)
        best = np.maximum(best, 0.0)
        score[i + 1, :-1] = np.maximum.accumulate(best + steps[:-1]) - steps[:-1]
    i, j = (int(v) for v in np.unravel_index(np.argmax(score), score.shape))
    matched, begin, end = [], None, None
    while i > 0 and score[i, j] > 0:
        here = score[i, j]
        if j < width and same[i - 1, j] and here == score[i - 1, j] + 1.0:
            matched.append(i - 1)
            begin = i - 1 + low + j
            end = begin if end is None else end
            i -= 1
        elif j > 0 and here == score[i, j - 1] - GAP:
            j -= 1
        elif j < width and here == score[i - 1, j + 1] - GAP:
            i, j = i - 1, j + 1
        else:
            i -= 1
    return matched[::-1], begin, end


def scan(documents: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, license, coverage, spans) of every license in every row of (doc_id, text)."""
    templates = TEMPLATES if templates is None else templates
    if sum(len(t) for texts in templates.values() for t in texts) * 64 > BROADCAST_BYTES:
        raise ValueError("the templates are too large to be sent to every task; scan with parts of them")
    shared = documents.sparkSession.sparkContext.broadcast(templates)

    def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(shared.value)
        for frame in frames:
            rows = [
                (doc_id, name, coverage, [{"begin": b, "end": e} for b, e in spans])
                for doc_id, text in zip(frame["doc_id"], frame["text"])
                for name, (coverage, spans) in sorted(scanner.scan(text).items())
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "license", "coverage", "spans"])

    named = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return named.mapInPandas(scanned, SCHEMA).withColumn("doc_id", F.col("doc_id").cast("long"))
