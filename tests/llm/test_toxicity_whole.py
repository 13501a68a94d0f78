"""Toxicity: every labelled row counts, and every text has neighbours."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from vitalgrid.llm import toxicity


def _rows(spark, texts):
    rows = [(i, text, label) for i, (text, label) in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return table.select("doc_id", "text"), table.select("doc_id", "toxic")


def test_texts_that_share_a_word_all_count(spark):
    # The word with the lowest crc32 stands in every text.
    common = min((f"c{i}" for i in range(20_000)), key=lambda w: zlib.crc32(w.encode()))
    texts = [(f"{common} vile p{i}", 1) for i in range(20)] + [(f"{common} calm q{i}", 0) for i in range(20)]
    model = toxicity.fit(*_rows(spark, texts), "toxic", F.lit(True))
    assert set(model.vocabulary) == {"vile", "calm"}
    assert model.score("vile")[0] > 0.9 and model.score("calm")[0] < 0.1


def test_copies_count_once_for_terms_and_totals(spark):
    texts = [("Vile  again", 1), ("vile again", 1)] * 10 + [(f"calm q{i}", 0) for i in range(20)]
    model = toxicity.fit(*_rows(spark, texts), "toxic", F.lit(True))
    assert "vile" not in model.vocabulary and "again" not in model.vocabulary


def test_texts_without_a_selected_term_are_searched_over_all_words(spark):
    texts = [(f"calm day number{i} in town", 0) for i in range(30)] + [("rareword bites deep", 1), ("rareword stings much", 1)]
    model = toxicity.fit(*_rows(spark, texts), "toxic", F.lit(True))
    assert "rareword" not in model.vocabulary
    toxic, near, cosines = model.score("a rareword here")
    assert near == [30, 31] and min(cosines) > 0 and toxic > model.score("number3 in town")[0]
    assert model.score("nothing known") == (2 / 32, [], [])


def test_whole_search_is_exact():
    random = np.random.default_rng(4)
    n, words = 150, 60
    idf = random.uniform(1, 5, words)

    def vector():
        terms = np.sort(random.choice(words, random.integers(1, 30), replace=False))
        return terms, random.integers(1, 4, len(terms)).astype(float)

    vectors = [vector() for _ in range(n - 20)]
    vectors += vectors[:20]  # ties
    index = toxicity.WholeIndex(
        np.arange(n) * 3, np.arange(n) % 2, [len(t) for t, _ in vectors],
        np.concatenate([t for t, _ in vectors]), np.concatenate([f for _, f in vectors]), idf,
    )
    assert 0 < len(index.dense)
    plain = np.zeros((n, words))
    for i, (t, f) in enumerate(vectors):
        plain[i, t] = (1 + np.log(f)) * idf[t]
    plain /= np.linalg.norm(plain, axis=1)[:, None]
    for i, (rows, cosines) in enumerate(index.nearest(vectors, 7, list(range(n)))):
        want = np.round(plain @ plain[i], 9)
        want[i] = 0
        best = [j for j in np.lexsort((np.arange(n), -want))[:7] if want[j] > 0]
        assert np.allclose(cosines, want[best], atol=2e-9) and len(rows) == len(best)
        assert np.allclose(want[rows], want[best], atol=2e-9)


def test_postings_of_one_count_share_a_number():
    words, n = 40, 300
    sizes, terms = [words] * n, np.tile(np.arange(words), n)
    index = toxicity.WholeIndex(np.arange(n), np.arange(n) % 2, sizes, terms, 1 + terms % 3, np.ones(words))
    arrays = [a for name, a in vars(index).items() if isinstance(a, np.ndarray) and name != "dense"]
    assert max(len(a) for a in arrays if a.dtype == np.float64) <= n < len(terms)


def test_every_different_word_is_looked_up_once():
    class Counting(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

    words = Counting({"a": 0, "b": 1, "été": 2})
    terms, tf = toxicity.numbered("B a b, x_B a! été " * 50, words)
    assert terms.tolist() == [0, 1, 2] and tf.tolist() == [100.0, 150.0, 50.0] and words.asked == 4


def test_only_what_single_precision_leaves_is_summed_again():
    # Close cosines over common words: single precision alone cannot order them.
    n, words = 3000, 400
    random = np.random.default_rng(5)
    tf = random.integers(1, 4, (n, words))
    index = toxicity.WholeIndex(
        np.arange(n), np.arange(n) % 2, [words] * n, np.tile(np.arange(words), n), tf.ravel().astype(np.uint8), np.ones(words)
    )
    assert index.dense.dtype == np.float32 and index.rows.dtype == np.uint16 and index.counted.dtype == np.float64
    plain = 1 + np.log(tf.astype(float))
    plain /= np.linalg.norm(plain, axis=1)[:, None]
    for i, (rows, cosines) in enumerate(index.nearest([(np.arange(words), tf[i].astype(float)) for i in range(5)], 7, list(range(5)))):
        want = np.round(plain @ plain[i], 9)
        want[i] = 0
        assert rows.tolist() == np.lexsort((np.arange(n), -want))[:7].tolist() and np.allclose(cosines, want[rows], atol=2e-9)


def test_examples_come_to_their_places():
    import pyarrow as pa

    parts = [([7, 3], [1, 0], [[4, 5], []], [[1, 300], []]), ([5, 1], [0, 1], [[2], [0, 9]], [[2], [1, 1]])]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in part], ["doc_id", "label", "terms", "tf"]) for part in parts]
    ids, labels, sizes, terms, tf = toxicity._in_order(pa.Table.from_batches(batches))
    assert ids.tolist() == [1, 3, 5, 7] and labels.tolist() == [1, 0, 0, 1] and sizes.tolist() == [2, 0, 1, 2]
    assert terms.tolist() == [0, 9, 2, 4, 5] and tf.tolist() == [1, 1, 2, 1, 300] and tf.dtype == np.uint16
    assert toxicity._joined(pa.chunked_array([["a", "é"], [], ["c"]], pa.string())) == "a\né\nc".encode()
    assert toxicity._joined(pa.chunked_array([], pa.string())) == b""


def test_words_with_other_signs_are_those_of_the_pattern():
    for text in ("Été—l’été_x «y» ﬁn² a\u00a0b\u2028c ١٢ e\u0301t", "é", "—", "naïve café"):
        assert toxicity.lower_words(text) == toxicity.WORD.findall(text.lower())


def test_plain_words_are_those_of_the_pattern():
    plain = "".join(map(chr, range(128))) * 2 + " Ab_c-9"
    for text in (plain, plain + "é", "", "_"):
        assert toxicity.lower_words(text) == toxicity.WORD.findall(text.lower())
