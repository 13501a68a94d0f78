"""Token ids of whole texts from a public vocabulary file, word by word.

The vocabulary's rules never look across a blank, so the ids of a text are those of its chunks
between blanks, one after the other; the ids of a chunk are remembered. Of a chunk that ends in
plain punctuation after a Latin letter, both parts are looked up by themselves: no rule of the
vocabulary reaches over that place. A chunk of Latin letters goes to the vocabulary's model
directly, in lower case and byte form; all others go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

from vitalgrid.llm.shared import SEGMENT_CHARS

LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
WORD = re.compile(f"[{LATIN}]+")
BEFORE_TAIL = re.compile(f"(.*[{LATIN}])([.,;:!?$%&*#|]+)", re.DOTALL)
LONGEST_KEPT = 64
REMEMBERED = 250_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _stretches(text: str) -> Iterator[str]:
    """The text in parts of about a million characters, cut at blanks only."""
    begin = 0
    while len(text) - begin > SEGMENT_CHARS:
        cut = text.find(" ", begin + SEGMENT_CHARS)
        if cut < 0:
            break
        yield text[begin:cut]
        begin = cut + 1
    yield text[begin:]


class Tokens:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core already
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [c for c in map(chr, range(0xC0, 0x100)) if WORD.fullmatch(c)]
        self.byte_form = {ord(c): as_bytes.pre_tokenize_str(c)[0][0] for c in letters}
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _remember(self, known: dict[str, bytes], key: str, ids) -> bytes:
        found = np.asarray(ids, "<u4").tobytes()
        if len(key) <= LONGEST_KEPT:
            if len(known) >= REMEMBERED:
                known.clear()
            known[key] = found
        return found

    def _part(self, part: str) -> bytes:
        if WORD.fullmatch(part):
            part = part.lower()
            found = self.words.get(part)
            if found is None:
                form = part if part.isascii() else part.translate(self.byte_form)
                found = self._remember(self.words, part, [t.id for t in self.model.tokenize(form)])
            return found
        found = self.words.get(part)
        if found is None:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
            found = self._remember(self.words, part, ids)
        return found

    def _chunk(self, chunk: str) -> bytes:
        cut = BEFORE_TAIL.fullmatch(chunk)
        found = self._part(cut[1]) + self._part(cut[2]) if cut else self._part(chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self.chunks) >= REMEMBERED:
                self.chunks.clear()
            self.chunks[chunk] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        parts = []
        for stretch in _stretches((text or "").replace("\n", " ")):
            chunks = stretch.split(" ")
            known = list(map(self.chunks.get, chunks))
            if None in known:
                known = [self._chunk(c) if ids is None else ids for c, ids in zip(chunks, known)]
            parts.extend(known)
        return b"".join(parts)


_loaded: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """One tokenizer for each vocabulary file and worker, with what it remembers."""
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]
