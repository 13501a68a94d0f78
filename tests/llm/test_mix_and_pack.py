"""Mixing, packing and the pipeline."""

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import corpus
import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from vitalgrid.llm import mixing, packing, tokens

SF = "/root/testdata/sf0.001"


def _plain_targets(sizes, weights, epochs):
    """Water-filling step by step: clamp what is above its cap, reshare the rest by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, clamped = Fraction(sum(sizes.values())), {}
    while True:
        rest = [s for s in order if s not in clamped]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > epochs * sizes[s]]
        if not above:
            return {**clamped, **share}
        for s in above:
            clamped[s] = Fraction(epochs * sizes[s])
            left -= clamped[s]


@pytest.mark.parametrize("extra", [False, True])
def test_mix_meets_its_targets(spark, extra):
    rows = [(i, "w " * (i % 37), None, f"s{i % 5}" if i % 5 else None, None) for i in range(600)]
    rows += [(10_000 + i, "x y z", None, "tiny", None) for i in range(3)] + corpus.edge_rows()
    got = mixing.mix(corpus.documents(spark, rows, extra)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    targets = _plain_targets(sizes, mixing.WEIGHTS, mixing.EPOCHS)
    # Sources of one weight have one target; their sizes tell them apart.
    known = {(round(float(t), 6), sizes[s]): s for s, t in targets.items()}
    assert len(known) == len(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = known[round(r["target"], 6), r["source_size"]]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s, target in targets.items():
        assert abs(taken[s] - target) <= largest[s]
    again = mixing.mix(corpus.documents(spark, rows, extra).repartition(5))
    assert corpus.rows_of(again) == sorted(map(tuple, got), key=repr)


def test_mixed_documents_repeat_whole_rows(spark):
    documents = corpus.documents(spark, extra=True)
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns and mixed.dtypes == documents.dtypes
    want = Counter()
    for r in mixing.mix(documents).collect():
        want[r["doc_id"], r["size"]] += r["taken"]
    got = Counter()
    for r in mixed.collect():
        size = len((r["text"] or "").encode().split())
        got[r["doc_id"], size] += size
    assert +got == +want
    assert mixing.mixed_documents(corpus.documents(spark, [])).count() == 0
    assert mixing.mix(corpus.documents(spark, [])).count() == 0


def _reference():
    tokenizer = Tokenizer.from_file(tokens.default_vocabulary())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_tokens_are_the_tokenizers(spark, folder, monkeypatch):
    plain = _reference()
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    texts += [r[1] for r in corpus.edge_rows()] + [
        "don't can't I'LL 'tis it's. it's! a's' 's", "ab12 3.14,5 x_y--z", "ſ K Å µ ª º ß ẞ", "a\u0301b é\u0301. ne\u0301.", "!!!wow!!! a.b.c. ..x", "<|startoftext|>. |<|endoftext|>|",
        "tab\tand\u00a0nbsp\u2003em \x1c\x85", "日本語 テキスト。 한국어", "ǅ ŉ ΰ ffi", "a.\u0301 b;\u0300c", "Ω'S ω'd", "é'll É'RE",
    ]
    own = tokens.Tokens(tokens.default_vocabulary())
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == plain(text), text
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    monkeypatch.setattr(tokens, "SEGMENT_CHARS", 50)
    small = tokens.Tokens(tokens.default_vocabulary())
    for text in texts[-30:]:
        assert np.frombuffer(small.encode(text), "<u4").tolist() == plain(text)


def _check_packing(rows, documents, capacity):
    plain = _reference()
    want = Counter()
    for doc_id, text in documents:
        ids = np.array(plain(text) + [packing.END], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(k[3] * n for k, n in want.items()) // capacity)


@pytest.mark.parametrize("extra", [False, True])
def test_packing_of_edge_rows(spark, extra):
    rows = packing.pack(corpus.documents(spark, extra=extra)).collect()
    used, bound = _check_packing(rows, [r[:2] for r in corpus.edge_rows()], packing.CAPACITY)
    assert used == bound
    assert packing.pack(corpus.documents(spark, [])).count() == 0
    only_full = packing.pack(corpus.documents(spark, [(1, "the " * 4_095, None, None, None)]))
    assert [(r["length"], r["offset"]) for r in only_full.collect()] == [(4_096, 0)]


def _best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= length), default=None)
        if fit is None:
            gaps.append(capacity - length)
        else:
            gaps[gaps.index(fit)] -= length
    return len(gaps)


def test_packing_is_about_as_tight_as_best_fit(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(documents).collect()
    used, bound = _check_packing(rows, [(r["doc_id"], r["text"]) for r in documents.collect()], packing.CAPACITY)
    full = sum(r["length"] == packing.CAPACITY for r in rows)
    best = full + _best_fit_decreasing([r["length"] for r in rows if r["length"] < packing.CAPACITY], packing.CAPACITY)
    assert bound <= used <= max(best, 1.01 * bound)


def test_successor_sweep_gives_the_longest_first_the_smallest_place():
    waiting, places = np.zeros(11, int), np.zeros(11, int)
    waiting[[3, 5, 9]] = 2, 1, 1
    places[[4, 6, 8, 10]] = 1, 1, 1, 1
    assert packing.successors(waiting, places) == [(9, 0, 1, 10, 0), (5, 0, 1, 6, 0), (3, 0, 1, 4, 0), (3, 1, 1, 8, 0)]


def _plain_pipeline(spark, folder):
    """The stages with the same models, but links of all pairs and mixing by sorting."""
    from test_groups import _brute_components, _plain_fingerprint

    from vitalgrid.llm import queries

    documents = spark.read.parquet(f"{folder}/documents.parquet")
    toxic = queries.toxicity_model(spark, documents, folder)
    rows = [r for r in documents.collect() if toxic.score(r["text"])[0] < queries.TOXIC_CUT]
    kept = spark.createDataFrame(rows, documents.schema)
    poor = queries.quality_model(spark, kept, folder)
    rows = [r for r in rows if poor.score(r["text"]) >= queries.QUALITY_CUT]
    components = {i: c for i, _, c in _brute_components([(r["doc_id"], _plain_fingerprint(r["text"])) for r in rows])}
    rows = [r for r in rows if components[r["doc_id"]] == r["doc_id"]]
    mixed = Counter()
    for r in mixing.mix(spark.createDataFrame(rows, documents.schema)).collect():
        mixed[r["doc_id"]] = r["taken"] // r["size"] if r["size"] else 0
    return [(r["doc_id"], r["text"]) for r in rows for _ in range(mixed[r["doc_id"]])]


def test_pipeline_is_its_stages_one_after_the_other(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    used, bound = _check_packing(got, _plain_pipeline(spark, SF), packing.CAPACITY)
    assert used <= 1.02 * bound + 1
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "mixing", "packing"]


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        documents = corpus.documents(spark, extra=True)
        for table in (documents, documents.limit(0)):
            out = stage(spark, table, SF)
            if name != "packing":
                assert out.columns == documents.columns
            out.count()
