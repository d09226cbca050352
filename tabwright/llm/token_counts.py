"""Token counts by a compiled finite-state transducer over chunks of text.

White space ends a word, and no token of a word-level BPE file reaches over white space. The
tokenizer is compiled to a transducer with two kinds of states, *outside* a word and *inside* one
(which remembers the word read so far). The transition that closes a word emits the number of its
tokens. These numbers are the annotation of the transducer: for the vocabulary's own words they
are 1 from the start; every other word is annotated when it is first met, by the tokenizer library,
which encodes it. A text that holds white space on which the library may differ (``UNSURE_WHITE``)
does not pass the transducer: the library encodes it whole.

A chunk of text acts on the states as a map. Its form is short: the characters before the first
white space (they lengthen the open word), the tokens emitted in between, and the characters after
the last white space (the word left open). Such maps compose associatively, so the chunks of a
long text are mapped one by one and combined by a prefix scan.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabwright.llm.common import slices
from tabwright.llm.encode import LETTERS, NUMBERS, PLAIN, WHITE, Memory, keep_only

#: Characters of a chunk; longer texts are cut wherever this ends.
CHUNK_CHARS = 1 << 16

#: Code points that some libraries hold for white space and others do not.
UNSURE_WHITE = re.compile(
    "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
#: Fixed value: the pre-tokeniser's pattern, over the plain classes.
PIECE = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{WHITE}{LETTERS}{NUMBERS}]+")
PLAIN_WORD = re.compile(f"[{PLAIN}]*")


class ChunkMap(NamedTuple):
    """What a chunk does to the state: ``closed`` tells whether it holds white space.

    Not closed: ``head`` lengthens the open word, nothing is emitted. Closed: ``head`` ends the
    open word, ``count`` tokens follow, and ``tail`` is the word left open.
    """

    closed: bool
    head: str
    count: int
    tail: str


IDENTITY = ChunkMap(False, "", 0, "")


class CountTransducer:
    """The compiled tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = tuple(t["content"] for t in spec["added_tokens"])
        self.pieces = Memory(self.whole)
        end = spec["model"].get("end_of_word_suffix")
        for token in spec["model"]["vocab"] if end else ():
            word = token.removesuffix(end)
            if word != token and word.isascii() and word.isalpha():
                self.pieces[word] = 1
        self.words = Memory(self.annotate)
        self.words[""] = 0

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def annotate(self, word: str) -> int:
        """Tokens of a word, which holds no white space."""
        lower = word.replace("Σ", "σ").lower()  # the file knows no final sigma
        if (not PLAIN_WORD.fullmatch(word) or not PLAIN_WORD.fullmatch(lower)
                or not unicodedata.is_normalized("NFC", word)
                or any(s in word for s in self.specials)):
            return self.whole(word)
        return sum(map(self.pieces.__getitem__, PIECE.findall(lower)))

    def chunk_map(self, chunk: str) -> ChunkMap:
        words = chunk.split()
        if not words:
            return ChunkMap(True, "", 0, "") if chunk else IDENTITY
        head = "" if chunk[0].isspace() else words[0]
        if head and len(words) == 1 and not chunk[-1].isspace():
            return ChunkMap(False, head, 0, "")
        tail = "" if chunk[-1].isspace() else words[-1]
        inner = words[bool(head):len(words) - bool(tail)]
        return ChunkMap(True, head, sum(map(self.words.__getitem__, inner)), tail)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """First ``a``, then ``b``."""
        if not a.closed:
            return ChunkMap(b.closed, a.head + b.head, b.count, b.tail)
        if not b.closed:
            return ChunkMap(True, a.head, a.count, a.tail + b.head)
        return ChunkMap(True, a.head, a.count + self.words[a.tail + b.head] + b.count, b.tail)

    def scan(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """Inclusive prefix scan: neighbours are paired, the pairs scanned, the rest filled in."""
        if len(maps) < 2:
            return maps
        pairs = self.scan([self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])])
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(pairs[i // 2] if i % 2 else self.compose(pairs[i // 2 - 1], maps[i]))
        return out

    def emitted(self, done: ChunkMap) -> int:
        """Tokens after the text's end, which closes the last word."""
        return self.words[done.head] + done.count + self.words[done.tail]

    def count(self, text: str | None, chunk_chars: int = CHUNK_CHARS) -> tuple[int, list[int]]:
        """Tokens of a text, and of each prefix that ends with a chunk."""
        if not text:
            return 0, []
        if UNSURE_WHITE.search(text):
            return self.whole(text), []
        maps = [self.chunk_map(text[i:i + chunk_chars]) for i in range(0, len(text), chunk_chars)]
        after = [self.emitted(m) for m in self.scan(maps)]
        return after[-1], after[:-1]


_COMPILED: dict[str, CountTransducer] = {}


def compiled(path: str) -> CountTransducer:
    """One transducer a file and worker, so that its annotations last over tasks."""
    if path not in _COMPILED:
        _COMPILED[path] = CountTransducer(path)
    return _COMPILED[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048,
                 chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Token count of every text: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``
    (more than ``limit`` tokens) and ``chunk_tokens``, the tokens of the prefixes at the chunk ends
    of a long text (empty for one chunk, and for texts with unsure white space, which the library
    counts whole).

    ``tokenizer`` is a tokenizers file whose pre-tokeniser drops white space; special strings in
    a text count as the library counts them. A null or empty text has no bytes and no tokens;
    every row counts on its own, whatever its ``doc_id``; an empty table gives no rows; other
    columns are ignored.
    """
    def count_part(batches):
        transducer = compiled(tokenizer)
        keep_only(transducer.pieces, transducer.words)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            counts = [transducer.count(t, chunk_chars) for t in texts]
            total = np.array([c[0] for c in counts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len((t or "").encode()) for t in texts],
                                                  pa.int64()),
                 pa.array(total), pa.array(total > limit),
                 pa.array([c[1] for c in counts], pa.list_(pa.int64()))],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "chunk_tokens"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        count_part, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, "
                    "chunk_tokens array<long>")
