"""Exact top-k, license scans, URL filters and chat round trips."""

import corpus
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitalgrid.llm import chat, licenses, urls, vectors
from vitalgrid.llm.license_texts import TEMPLATES


def _brute_top(queries, candidates, k):
    found = []
    for q, v in queries:
        scored = {}
        for c, w in candidates:
            if c != q and len(w) == len(v):
                scored[c] = max(scored.get(c, -10 ** 40), sum(int(a) * int(b) for a, b in zip(v, w)))
        best = sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:k]
        found += [(q, i + 1, c, s) for i, (c, s) in enumerate(best)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("blocks", [(512, 4_096), (3, 10)])
def test_top_k_is_that_of_all_pairs(spark, blocks):
    random = np.random.default_rng(2)
    rows = [(i, random.normal(0, 0.1, 8).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(9)]  # ties
    rows += [(300, [0.0] * 8), (301, None), (302, [float("nan")] * 8), (303, [None] * 8), (304, [0.5, 0.25]), (305, [1.0, 1.0])]
    table = spark.createDataFrame(rows + rows[:5], "vec_id long, embedding array<float>").withColumn("values", F.lit(1))
    whole = vectors.scaled(table)
    got = corpus.rows_of(vectors.top_k(whole.where("vec_id % 50 = 0 or vec_id >= 300"), whole, 5, *blocks))
    fine = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v and all(x is not None and x == x for x in v)]
    want = _brute_top([r for r in fine if r[0] % 50 == 0 or r[0] >= 300], fine, 5)
    assert got == want
    assert vectors.top_k(whole.limit(0), whole.limit(0)).count() == 0


def test_threshold_stops_early_and_large_numbers_stay_exact():
    values = np.zeros((5_000, 4), np.int64)
    values[:, 0] = np.arange(5_000)
    lists = vectors.SortedLists(np.arange(5_000), values)
    ids, scores = lists.best(np.array([3, 0, 0, 0]), 2, -1)
    assert ids.tolist() == [4_999, 4_998] and scores.tolist() == [14_997, 14_994]
    huge = vectors.SortedLists(np.arange(3), np.array([[1 << 40], [1 << 41], [5]]))
    assert huge.best(np.array([1 << 40]), 1, -1)[1].tolist() == [1 << 81]


def _plain_share(template, text):
    """Largest share of a template's words in a common subsequence with any equally long window."""
    words = licenses.WORD.findall(template.lower())
    given_words = licenses.WORD.findall((text or "").lower())
    best = 0
    for at in range(max(1, len(given_words))):
        window = given_words[at:at + len(words)]
        row = [0] * (len(window) + 1)
        for w in words:
            previous = 0
            for j, x in enumerate(window):
                row[j + 1], previous = (previous + 1 if w == x else max(row[j + 1], row[j])), row[j + 1]
        best = max(best, row[-1])
    return best / len(words)


def test_notices_of_the_documents_are_all_found(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(documents).collect()}
    want = set()
    for row in documents.collect():
        for name, texts in TEMPLATES.items():
            short = [t for t in texts if len(t) < 100]
            if any(t.rstrip(".").lower() in row["text"].lower() for t in short):
                want.add((row["doc_id"], name))
    assert got == want and len(got) > 3


def test_changed_license_texts_are_aligned(spark):
    words = TEMPLATES["MIT"][2].split()
    changed = " ".join("changed" if i % 15 == 7 else w for i, w in enumerate(words) if i % 31 != 30)
    cut = " ".join(words[: len(words) // 2])
    rows = [
        (1, f"some code\n{changed}\nmore code"), (2, f"before {cut} after"), (3, None), (4, ""),
        (5, " ".join(words) + " and " + " ".join(words)), (6, corpus.long_text(20_000) + " " + changed), (6, "the and of to in is it"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("coverage", F.lit(0))
    found = {(r["doc_id"], r["license"]): r for r in licenses.scan(table).collect()}
    assert set(found) == {(1, "MIT"), (5, "MIT"), (6, "MIT")}
    assert 0.85 < found[1, "MIT"]["coverage"] < 0.95 and found[5, "MIT"]["coverage"] == 1.0
    assert len(found[5, "MIT"]["spans"]) == 2
    begin, end = found[1, "MIT"]["spans"][0]
    text = rows[0][1]
    assert text[begin:].startswith("Permission is hereby") and text[:end].endswith("IN THE\nSOFTWARE.".split()[-1].rstrip("."))
    assert _plain_share(TEMPLATES["MIT"][2], changed) >= licenses.COVERAGE > _plain_share(TEMPLATES["MIT"][2], cut)
    assert licenses.scan(table.limit(0)).count() == 0


def _plain_judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    at = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
    path = rest[at:].split("?")[0].split("#")[0]
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, urls.OTHERWISE))
    return host, path, best[2], best[3]


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "https://EXAMPLE.com/en/x?y#z", "https://www.Example.COM/en/", "http://a.www.example.com/en/q",
    "http://notexample.com/en/", "ftp://x.net/fr/1", "ftp://x.net/fr", "http://net/es/", "http://h?://k/", "http://h#/com/", "http://x.com?/en/", "a://b://c.com/d",
    "http://user@x.com:80/en/", "http://" + "a." * 5_000 + "com/" + "p" * 100_000, "x://ÄÖ.com/en/", "http://x.com/\n/", "http://.com/", "http://com./",
]


@pytest.mark.parametrize("limit", [urls.BROADCAST_BYTES, 0])
def test_urls_are_judged_as_by_hand(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "BROADCAST_BYTES", limit)
    listed = [(i, u) for i, u in enumerate(URLS)] + [(5, URLS[5]), (None, URLS[6])]
    pages = spark.createDataFrame(listed, "page_id long, url string").withColumns({"rule": F.lit("mine"), "host": F.lit(1)})
    want = sorted(((i, *_plain_judge(u, urls.RULES)) for i, u in listed), key=repr)
    assert corpus.rows_of(urls.judge(pages)) == want
    assert urls.judge(pages.limit(0)).count() == 0


def test_many_rules_and_no_rules(spark):
    rules = [("block" if i % 3 else "allow", f"h{i % 40}.org", f"/{i % 7}" * (i % 3)) for i in range(400)]
    pages = [(i, f"http://s.h{i % 60}.org/{i % 9}/{i % 7}/{i}") for i in range(300)]
    merged = {}
    for v, h, p in rules:
        merged[h, p] = max(v, merged.get((h, p), v))
    table = spark.createDataFrame(pages, "page_id long, url string")
    got = corpus.rows_of(urls.judge(table, urls.rules_table(spark, rules + [("block", None, "/")])))
    assert got == sorted(((i, *_plain_judge(u, [(v, *k) for k, v in merged.items()])) for i, u in pages), key=repr)
    none = urls.judge(table, urls.rules_table(spark).limit(0)).select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in none] == [(None, "allow")]


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(2_000).select(F.concat(F.lit("key"), F.col("id").cast("string")).alias("key"))
    blocks = 2_000 * urls.BITS_PER_KEY // 512
    table = urls.blocked_filter(keys, blocks)

    def passing(names):
        probes = names.withColumn("block", urls._block(F.col("key"), blocks))
        return probes.join(table, "block", "left").where(urls._possible(F.col("key"))).count()

    assert passing(keys) == 2_000
    others = spark.range(20_000).select(F.concat(F.lit("other"), F.col("id").cast("string")).alias("key"))
    assert passing(others) < 400


pieces = st.lists(st.sampled_from(["<|turn|>", "<|text|>", "<|end|>", "<", "|", "\\", "turn|>", "<\\|end|>", "<\\\\|text|>", "a", "\n", "</s>", "é"]), max_size=8).map("".join)


@given(st.lists(st.tuples(pieces, pieces), max_size=5))
@settings(max_examples=300, deadline=None)
def test_any_content_survives_the_round_trip(turns):
    assert chat.parse("".join(chat.render(*t)[0] for t in turns)) == turns


def test_only_conflicting_content_is_escaped():
    assert chat.render("user", "</s>[INST] ok") == ("<|turn|>user<|text|></s>[INST] ok<|end|>", 20)
    assert "<\\|end|>" in chat.render("user", "a <|end|> b")[0]
    for broken in ("x", "<|turn|>a", "<|turn|>a<|text|>b", "<|text|>", "<|turn|>a<|text|>b<|end|>c", "<|turn|>a<|turn|>"):
        assert chat.parse(broken) is None


def test_conversations_with_nulls_repeats_and_many_turns(spark):
    import hashlib

    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "assistant", "first"), (None, 0, "assistant", "a"), (2, 0, "user", "hi"), (2, 0, "user", "hi")]
    rows += [(3, i, "assistant" if i % 2 else "user", f"turn {i} <|end|>") for i in range(25_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(table)).collect()}

    def digest(turns):
        return hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()

    assert set(got) == {1, 2, 3, None} and [got[k]["n_turns"] for k in (1, 2, 3, None)] == [3, 2, 25_000, 1]
    assert got[1]["turns_sha256"] == digest([("assistant", "first"), ("user", None), (None, "x")])
    assert got[3]["turns_sha256"] == digest([r[2:] for r in rows if r[0] == 3])
    learnt = "".join(r[3] for r in rows if r[0] == 3 and r[2] == "assistant")
    assert (got[3]["loss_chars"], got[3]["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(table.limit(0))).count() == 0
    spans = chat.format_turns(table.where("conv_id = 1 and role = 'assistant'")).first()
    assert spans["formatted"][spans["loss_begin"]:spans["loss_end"]] == "first"
