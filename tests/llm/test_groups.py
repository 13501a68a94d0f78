"""SimHash and vector near-duplicates against all pairs, and connected components."""

import math
import random

import corpus
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vitalgrid.llm import simhash, vectors
from vitalgrid.llm.components import components

SF = "/root/testdata/sf0.01"


def _roots(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (200, 300), (-5, 250)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    want = _roots({n for p in pairs for n in p}, pairs)
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_components(rows):
    """rows: (doc_id, fingerprint); the smallest doc_id of each row's component."""
    prints = sorted({f for _, f in rows})
    pairs = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if (a ^ b).bit_count() <= 3]
    root = _roots(prints, pairs)
    named = {}
    for doc_id, f in rows:
        if doc_id is not None:
            named[root[f]] = min(doc_id, named.get(root[f], doc_id))
    return [(doc_id, f"{f:016x}", named.get(root[f])) for doc_id, f in rows]


@pytest.mark.parametrize("extra", [False, True])
def test_fingerprints_and_components_of_edge_rows(spark, extra):
    rows = [(r[0], _plain_fingerprint(r[1])) for r in corpus.edge_rows()]
    assert corpus.rows_of(simhash.simhash(corpus.documents(spark, extra=extra))) == sorted(_brute_components(rows), key=repr)
    assert simhash.simhash(corpus.documents(spark, [])).count() == 0


def test_fingerprint_is_the_hash_that_spark_has(spark):
    text = "Alpha BETA gamma"
    want = spark.range(1).select(F.xxhash64(F.lit("alpha beta gamma"))).first()[0]
    assert simhash.fingerprint(text) == want % (1 << 64)


def test_very_long_texts_are_hashed_whole(monkeypatch):
    text = corpus.long_text(3_000)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SEGMENT_CHARS", 100)
    assert simhash.fingerprint(text) == whole == _plain_fingerprint(text)


def _clustered_prints(n, seed):
    generator = random.Random(seed)
    prints = set()
    for _ in range(n):
        base = generator.getrandbits(64)
        prints.add(base)
        for _ in range(generator.randrange(12)):
            near = base
            for _ in range(generator.randrange(1, 6)):
                near ^= 1 << generator.randrange(64)
            prints.add(near)
            base = near if generator.random() < 0.3 else base
    return sorted(prints)


@pytest.mark.parametrize("crowd", [2_048, 3])
def test_links_are_those_of_all_pairs(spark, crowd):
    prints = _clustered_prints(60, 4) + [0xFFFFFFFF00000000 | 7 << 20 | i for i in range(64)]
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    edges = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"), crowd)
    got = dict(map(tuple, components(edges).collect()))
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) % (1 << 64)).bit_count() <= 3]
    want = _roots(signed, pairs)
    assert {s: got.get(s, s) for s in signed} == want
    assert len(pairs) > 100


def test_representatives_keep_one_row_of_each_component(spark):
    rows = corpus.edge_rows() + [(20, "the same words again and again", "xx", "z", 2)]
    documents = corpus.documents(spark, rows, extra=True)
    kept = simhash.representatives(documents)
    assert kept.columns == documents.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    named = {c for _, _, c in _brute_components([(r[0], _plain_fingerprint(r[1])) for r in rows])}
    assert ids == sorted(named, key=repr)


def _brute_vectors(rows, threshold=0.95):
    fine = [r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(x for x in r[1]) for r in rows]
    unit = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) if f else None for r, f in zip(rows, fine)]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
        if fine[i] and fine[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold
    ]
    root = _roots(range(len(rows)), pairs)
    links = [sum(i in p for p in pairs) for i in range(len(rows))]
    members = {}
    for i, r in root.items():
        members.setdefault(r, []).append(rows[i][0])
    named = {r: min((m for m in ms if m is not None), default=None) for r, ms in members.items()}
    return sorted(((rows[i][0], links[i], named[root[i]], rows[i][0] == named[root[i]]) for i in range(len(rows))), key=repr)


def _cluster_vectors(n, size, seed):
    generator = np.random.default_rng(seed)
    rows, i = [], 0
    while i < n:
        base = generator.standard_normal(size)
        for _ in range(generator.integers(1, 9)):
            noise = generator.uniform(0, 0.4) * generator.standard_normal(size)
            rows.append((i, (base + noise).astype(np.float32).tolist()))
            i += 1
    return rows


@pytest.mark.parametrize("block", [512, 8])
def test_vector_links_are_those_of_all_pairs(spark, block):
    rows = _cluster_vectors(300, 16, 1) + [(1_000 + i, [1.0] + [0.0] * 15) for i in range(40)]
    rows += [(2_000, None), (2_001, [0.0] * 16), (2_002, [1.0] + [None] * 15), (2_003, [float("nan")] * 16),
             (2_004, [float("inf")] + [0.0] * 15), (2_005, []), (2_006, [1.0, 2.0]), (2_007, [2.0, 4.0]),
             (None, [1.0] + [0.0] * 15), (5, [1.0] + [0.0] * 15)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"n_links": F.lit(1), "class": F.lit("x")})
    got = corpus.rows_of(vectors.near_duplicates(table, block=block))
    want = _brute_vectors(rows)
    assert got == want
    assert vectors.near_duplicates(table.limit(0)).count() == 0


def test_recall_of_the_registered_parameters():
    """The hashing finds far more than nine tenths of the pairs at the threshold itself."""
    generator = np.random.default_rng(0)
    for rows in (1_000, 100_000, 10_000_000):
        hashing = vectors.Hashing(rows, 64, 0.95)
        x = generator.standard_normal((4_000, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        away = generator.standard_normal((4_000, 64))
        away -= (away * x).sum(axis=1, keepdims=True) * x
        away /= np.linalg.norm(away, axis=1, keepdims=True)
        y = 0.95 * x + math.sqrt(1 - 0.95 ** 2) * away
        found = (hashing.codes(x) == hashing.codes(y)).any(axis=1).mean()
        assert found >= 0.99
