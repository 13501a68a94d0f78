"""Chat formatting by a grammar round trip.

A turn is `<|turn|>` role `<|text|>` text `<|end|>`. A deterministic parser reads the rendered text
back; where it does not find the same role and text, the control strings in the content are escaped
by one backslash after the `<` (one more, if they have some), which the parser takes off again.
The grammar has no nesting and every turn ends itself, so turns are rendered row by row, and a
conversation is read back as a stream in the order of its turns, whatever its length.

Defined results: null roles and texts are empty. Turns come in the order of the turn number, nulls
first, then of the rendered text; repeated rows stay. Rows without a conv_id are one conversation.
An empty table has no conversations. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNT = "assistant"
CONTROL = re.compile(r"<(\\*)\|(turn|text|end)\|>")
ESCAPED = re.compile(r"<\\(\\*)\|(turn|text|end)\|>")


def escape(content: str) -> str:
    return CONTROL.sub(r"<\\\1|\2|>", content)


def unescape(content: str) -> str:
    return ESCAPED.sub(r"<\1|\2|>", content)


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """Roles and texts of a rendered text; None if it is not of the grammar."""
    turns, role, at, wanted, start = [], "", 0, TURN, 0
    for match in CONTROL.finditer(rendered):
        if match[1]:
            continue  # escaped content
        marker = match[0]
        if marker != wanted or (marker == TURN and match.start() != at):
            return None
        if marker == TURN:
            wanted = TEXT
        elif marker == TEXT:
            role, wanted = unescape(rendered[start:match.start()]), END
        else:
            turns.append((role, unescape(rendered[start:match.start()])))
            wanted, at = TURN, match.end()
        start = match.end()
    return turns if wanted == TURN and at == len(rendered) else None


def render(role: str, text: str) -> tuple[str, int]:
    """The rendered turn and where its text begins. Content is escaped until the parser agrees."""
    own_role, own_text = role, text
    while True:
        head = f"{TURN}{own_role}{TEXT}"
        rendered = f"{head}{own_text}{END}"
        if parse(rendered) == [(role, text)]:
            return rendered, len(head)
        escaped = escape(role) if CONTROL.search(role) else role, escape(text) if CONTROL.search(text) else text
        if escaped == (own_role, own_text):
            raise ValueError("a turn does not survive its own grammar")
        own_role, own_text = escaped


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, formatted, loss_begin, loss_end): the rendered turns, whose concatenation in
    order is the conversation, and the places of learnt text in them (null: none)."""

    def rendered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for role, text in zip(frame["role"], frame["text"]):
                line, begin = render(role, text)
                learnt = role == LEARNT
                rows.append((line, begin if learnt else -1, len(line) - len(END) if learnt else -1))
            found = pd.DataFrame(rows, columns=["formatted", "loss_begin", "loss_end"])
            yield pd.concat([frame[["conv_id", "turn"]].reset_index(drop=True), found], axis=1)

    # Ids travel as text: a null would turn the numbers of a batch into floating-point ones.
    turns = conversations.select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    found = turns.mapInPandas(rendered, "conv_id string, turn string, formatted string, loss_begin long, loss_end long")
    return found.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "formatted",
        *(F.when(F.col(c) >= 0, F.col(c)).alias(c) for c in ("loss_begin", "loss_end")),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What the rendered turns say, one row a conversation. A conversation passes as a stream: its
    digests need its turns in order, but none of them is kept."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        current, state = None, None

        def row():
            return (current[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for frame in frames:
            rows = []
            for conv_id, line in zip(frame["conv_id"], frame["formatted"]):
                if current is None or current[0] != conv_id:
                    if current is not None:
                        rows.append(row())
                    current, state = (conv_id,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(line):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == LEARNT:
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(line)
            yield pd.DataFrame(rows, columns=columns)
        if current is not None:
            yield pd.DataFrame([row()], columns=columns)

    ordered = formatted.select(
        F.col("conv_id").cast("string").alias("conv_id"), "turn", "formatted"
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted").select("conv_id", "formatted")
    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInPandas(read, schema).withColumn("conv_id", F.col("conv_id").cast("long"))
