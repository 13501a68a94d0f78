"""Small tables for the tests of the corpus operators."""

from __future__ import annotations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use for names of their own; inputs may have them too.
EXTRA = {
    "score": 1.5, "fp": 7, "size": "big", "rank": 3, "row": "x", "hash": "0", "target": 2, "times": 9, "length": 4,
    "sequence_id": 5, "root": 6, "label": 1, "held_out": True, "_row": 1, "_times": 2, "whole": 3, "last": "z",
    "host": "h", "verdict": "v", "key": "k", "component_id": 0, "source_size": 8, "part": 1, "at": 2, "c0": 1,
}


def long_text(words: int = 30_000) -> str:
    return " ".join(f"w{(i * 7919) % 4999}" for i in range(words))


def edge_rows() -> list[tuple]:
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4), (4, "one", "en", "b", 3),
        (5, "one two", "en", "b", 7), (6, long_text(), "en", "c", 1), (7, "x" * 300_000, "en", "c", 300_000),
        (8, "the same words again and again", "en", "a", 1), (9, "the same words again and again", "en", "b", 1),
        (9, "the same words again and again", "en", "b", 1), (None, "no id at all", "en", "a", 1),
        (10, "Größe élan ñandú İstanbul ΑΣ \u0301 e\u0301 😀 <|endoftext|> it's", "de", "c", 1),
    ]


def documents(spark, rows=None, extra: bool = False):
    table = spark.createDataFrame(edge_rows() if rows is None else rows, DOCUMENTS)
    if extra:
        from pyspark.sql import functions as F

        table = table.withColumns({name: F.lit(value) for name, value in EXTRA.items()})
    return table


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
