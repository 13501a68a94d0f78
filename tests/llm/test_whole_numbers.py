"""Clustering and coding of vectors, and the family of suffix arrays, against plain versions."""

import hashlib
import math

import corpus
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitalgrid.llm import centroids, codes, integers, suffixes

VECTORS = "vec_id long, embedding array<float>, label int"
ODD = [(900, None, 1), (901, [], 1), (902, [float("nan")] * 64, 1), (903, [None] * 64, 2), (904, [float("inf")] + [0.0] * 63, 2)]


def _vectors(count=150, size=64, seed=4):
    random = np.random.default_rng(seed)
    middle = random.normal(0, 0.3, (7, size))
    rows = (middle[random.integers(0, 7, count)] + random.normal(0, 0.05, (count, size))).astype(np.float32)
    return [(int(i), r.tolist(), int(i) % 3 or None) for i, r in enumerate(rows)]


def _floor(rows, scale):
    return [(i, [math.floor(scale * float(np.float32(x))) for x in v], l) for i, v, l in rows if v and all(x is not None and math.isfinite(x) for x in v)]


def _apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def _plain_clusters(rows, clusters=16, rounds=3):
    kept = [(i, v) for i, v, _ in _floor(rows, 64) if len(v) == 64]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in order[:clusters]]

    def near(v):
        return min((_apart(v, c), i) for i, c in enumerate(centers))

    for _ in range(rounds):
        found = [near(v)[1] for _, v in kept]
        for i in range(len(centers)):
            mine = [v for (_, v), c in zip(kept, found) if c == i]
            if mine:
                centers[i] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *near(v)) for i, v in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    total = min(sum(d for _, d, _ in last), integers.SATURATED)
    return sorted((
        (i, c, min(d, integers.SATURATED), min(sum(e for _, e, b in last if b == c), integers.SATURATED), total, digest[c])
        for i, d, c in last
    ), key=repr)


@pytest.mark.parametrize("rows", [
    _vectors() + ODD + [(3, [0.5] * 64, 1), (None, [0.25] * 64, 1), (906, [1.0, 2.0], 1), (907, [0.0] * 64, None)] + _vectors()[:4],
    _vectors(9), [(1, [1e12] * 64, 1), (2, [-1e12] * 63 + [3e18], 1), (3, [1e30] * 64, 2), (4, [0.0] * 64, 2)],
])
def test_clusters_are_those_of_plain_rounds(spark, rows):
    table = spark.createDataFrame(rows, VECTORS).withColumns({"cluster": F.lit("x"), "values": F.lit(1), "rest": F.lit(2)})
    got = centroids.cluster(table)
    fitting = [r for r in rows if not (r[1] and any(x is not None and 64 * abs(x) >= integers.LARGEST for x in r[1]))]
    assert corpus.rows_of(got.drop("compared")) == _plain_clusters(fitting)


def test_most_centroids_are_ruled_out_by_the_bound(spark):
    table = spark.createDataFrame(_vectors(600), VECTORS)
    compared = centroids.cluster(table).agg(F.sum("compared")).first()[0]
    assert compared < 600 * 16 / 2


def test_clusters_of_nothing(spark):
    none = spark.createDataFrame(ODD, VECTORS)
    assert centroids.cluster(none).count() == 0 and codes.compress(none).count() == 0


def _plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = _floor(rows, 256)
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    cut = [
        (i, [(v + [0] * (width * parts))[p * width:(p + 1) * width] for p in range(parts)], l) for i, v, l in kept
    ]
    first = sorted(cut, key=lambda r: (r[0] is None, r[0] or 0, sum(r[1], [])))[:entries]
    books = [[r[1][p] for r in first] for p in range(parts)]

    def near(p, v):
        return min((_apart(v, e), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            found = [near(p, r[1][p])[1] for r in cut]
            books[p] = [
                [sum(x) // len(mine) for x in zip(*mine)] if (mine := [r[1][p] for r, f in zip(cut, found) if f == e]) else old
                for e, old in enumerate(books[p])
            ]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [(i, [near(p, v[p]) for p in range(parts)], l) for i, v, l in cut]
    error = [min(sum(d for d, _ in c), integers.SATURATED) for _, c, _ in coded]
    of_label = {}
    for (_, _, label), e in zip(coded, error):
        of_label[label] = of_label.get(label, 0) + e
    return sorted((
        (i, "".join(f"{e:02x}" for _, e in c), error[n], min(of_label[l], integers.SATURATED), digest)
        for n, (i, c, l) in enumerate(coded)
    ), key=repr)


@pytest.mark.parametrize("rows", [
    _vectors() + ODD + [(3, [0.5] * 64, 1), (None, [0.25] * 64, 1), (907, [0.0] * 64, None)] + _vectors()[:4],
    _vectors(9), [(i, v[:50] if i % 2 else v[:33], l) for i, v, l in _vectors(80)],
    [(1, [1e12] * 16, 1), (2, [-1e12] * 16, 1), (4, [5.0] * 16, 2)],
])
def test_codes_are_those_of_plain_rounds(spark, rows):
    table = spark.createDataFrame(rows, VECTORS).withColumns({"code": F.lit("x"), "values": F.lit(1), "error": F.lit(2)})
    assert corpus.rows_of(codes.compress(table)) == _plain_codes(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(0, 10 ** 6))
def test_hadamard_search_is_exact_and_leaves_early(width, seed):
    random = np.random.default_rng(seed)
    parts, entries = random.integers(-40, 40, (30, width)), random.integers(-40, 40, (12, width))
    signs = codes.sequency_matrix(width)
    assert (signs @ signs.T == len(signs) * np.eye(len(signs))).all()
    assert ((signs[:, 1:] != signs[:, :-1]).sum(axis=1) == np.arange(len(signs))).all()
    entry, distance, steps = codes.nearest_entries(parts, entries, signs)
    apart = ((parts[:, None] - entries) ** 2).sum(axis=2)
    assert (entry == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    assert steps <= 30 * 12 * len(signs)


# Repeated passages -------------------------------------------------------------------------


def _plain_repeats(rows, length):
    first = {}
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for doc_id, text in texts:
        if doc_id is not None:
            for p in range(len(text) - length + 1):
                s = text[p:p + length]
                first[s] = min(first.get(s, doc_id), doc_id)
    found = []
    for doc_id, text in texts:
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            if doc_id is not None and first[text[p:p + length]] < doc_id:
                gone[p:p + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        found.append((doc_id, len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def _passages(seed=3, count=60):
    random = np.random.default_rng(seed)
    words = [f"{chr(97 + i % 26)}{i}ä" for i in range(300)]
    shared = [" ".join(random.choice(words, 30)) for _ in range(6)]
    rows = []
    for i in range(count):
        pieces = [" ".join(random.choice(words, int(random.integers(1, 40)))) for _ in range(4)]
        for p in range(3):
            if random.random() < 0.5:
                text = shared[random.integers(0, 6)]
                a, b = sorted(random.integers(0, len(text), 2))
                pieces.insert(p, text[a:b] if random.random() < 0.4 else text)
        rows.append((i * 7 % count, " ".join(pieces), "en", "a", 0))
    return rows


@pytest.mark.parametrize("crowd, batches", [(2_048, 4), (3, 5), (3, 1)])
def test_removed_bytes_are_those_of_a_plain_search(spark, crowd, batches):
    same = _passages()[5]
    rows = _passages() + [
        (100, same[1], "en", "a", 0), (101, same[1], "en", "a", 0), (101, same[1], "en", "a", 0), (same[0], "z" + same[1], "en", "a", 0),
        (None, same[1], "en", "a", 0), (102, "ab" * 400, "en", "a", 0), (103, "ab" * 100 + "c" + "ab" * 60, "en", "a", 0), (104, "y" * 49, "en", "a", 0), (105, "y" * 49, "en", "a", 0),
        (106, "y" * 50, "en", "a", 0), (107, "x" * 7 + "y" * 51, "en", "a", 0),
    ]
    got = suffixes.remove_repeats(corpus.documents(spark, rows, extra=True), 50, batches, crowd)
    assert corpus.rows_of(got) == _plain_repeats(rows, 50)


def test_odd_texts_and_no_texts(spark):
    rows = corpus.edge_rows()
    assert corpus.rows_of(suffixes.remove_repeats(corpus.documents(spark))) == _plain_repeats(rows, 50)
    assert suffixes.remove_repeats(corpus.documents(spark, []).limit(0)).count() == 0


def test_levels_merge_geometrically(spark):
    family = suffixes.Family(spark, 3)
    text = b"the same passage of more than fifty bytes in all of these documents"
    sizes, found = [], []
    for i in range(8):
        rows = spark.createDataFrame([(i, bytearray(text + bytes([65 + i]) * 60))], "doc_id long, bytes binary")
        spots = suffixes.spots_of_documents(family.add(suffixes.suffixes(rows, 50, 3)), 2)
        found.append(sorted(r["doc_id"] for r in spots.collect()))
        sizes.append([n for n, _ in family.levels])
    # A batch is found with all batches before it, whatever level they are in.
    assert found == [[]] + [list(range(i + 1)) for i in range(1, 8)]
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1], [4, 1, 1], [4, 2, 1], [4, 2, 1, 1]]
    for _, level in family.levels:
        for row in level.read().collect():  # arrays in the order of the suffixes
            high, low, _, _ = suffixes._columns(row[1:])
            assert sorted(zip(high.tolist(), low.tolist())) == list(zip(high.tolist(), low.tolist()))
    family.drop()
    assert family.levels == []


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="ab ", min_size=50, max_size=200))
def test_every_string_has_one_marker_that_depends_on_it_alone(text):
    data = np.frombuffer(text.encode(), np.uint8)
    place, first, last = suffixes.markers(data, 50)
    assert first[0] == 0 and last[-1] == len(data) - 50 and (first[1:] == last[:-1] + 1).all()
    # The same for texts end to end, none of whose strings crosses a seam.
    pair = suffixes.markers(np.concatenate([data, data]), 50, np.array([0, len(data)]))
    assert all((np.concatenate([x, x + len(data)]) == y).all() for x, y in zip((place, first, last), pair))
    assert all((x == y).all() for x, y in zip((place, first, last), suffixes._unpacked(suffixes._packed(place, first, last))))
    at = dict()
    for p, a, b in zip(place, first, last):
        for i in range(a, b + 1):
            assert i <= p <= i + 50 - suffixes.GRAM
            assert at.setdefault(text[i:i + 50], p - i) == p - i
