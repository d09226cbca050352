"""Ids of texts as the tokenizers library gives them, with a memory of pieces already encoded.

A byte-level BPE file cuts a text into pieces (a word with the blank before it, a number, a run
of other characters, white space) and merges inside a piece only. A piece therefore has the same
ids wherever it stands, and the library needs to encode each different piece once per worker.
Texts in which this cannot be told from plain character classes go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import slices

#: Code points whose class (letter, number, white space, other) is old enough to be the same in
#: every library; texts with any other code point are encoded whole.
PLAIN_RANGES = ((0x20, 0x7E), (0xA1, 0x24F), (0x370, 0x3FF), (0x400, 0x52F), (0x2010, 0x2027),
                (0x2030, 0x205E), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5),
                (0xAC00, 0xD7A3))

#: Pieces kept in a worker's memory; beyond it new pieces are encoded without being kept.
MEMORY_PIECES = 600_000
#: Characters of the longest piece that is kept.
MEMORY_CHARS = 64


def char_class(kind: str) -> str:
    """Ranges of the plain code points whose Unicode category begins with ``kind``."""
    spans: list[list[int]] = []
    for low, high in PLAIN_RANGES:
        for c in range(low, high + 1):
            if unicodedata.category(chr(c))[0] == kind:
                if spans and spans[-1][1] == c - 1:
                    spans[-1][1] = c
                else:
                    spans.append([c, c])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in spans)


LETTERS, NUMBERS = char_class("L"), char_class("N")
PLAIN = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in PLAIN_RANGES)
WHITE = " \t-\r"
#: Fixed value: the pre-tokeniser's pattern of byte-level BPE, over the plain classes.
PIECE = re.compile(
    f" ?[{LETTERS}]+| ?[{NUMBERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{WHITE}{LETTERS}{NUMBERS}]+"
    f"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
NOT_PLAIN = re.compile(f"[^{PLAIN}{WHITE}]")
#: Fixed value: how byte-level files write bytes as characters. Visible Latin-1 characters stand
#: for themselves, the other bytes for the characters from 256 on.
VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in VISIBLE)}


class Memory(dict):
    """Remembers ``make(key)`` for short keys; once ``most`` are kept (MEMORY_PIECES by default), new
    ones are made and not kept."""

    all: ClassVar[list[Memory]] = []

    def __init__(self, make, most: int | None = None):
        super().__init__()
        self.make, self.most = make, most
        Memory.all.append(self)

    def __missing__(self, key):
        value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) < (self.most or MEMORY_PIECES) and len(key) <= MEMORY_CHARS:
            self[key] = value


def keep_only(*memories: Memory) -> None:
    """Forget what other operators remember in this worker, which runs tasks of all of them."""
    for memory in Memory.all:
        if not any(memory is kept for kept in memories):
            memory.clear()


class PieceEncoder:
    """Encodes texts to little-endian ids, as ``encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = tuple(t["content"] for t in spec["added_tokens"])
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        pre, normalizer = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        #: Whether the file cuts texts as PIECE does, into bytes written as characters.
        self.by_piece = (normalizer is None and pre.get("type") == "ByteLevel"
                         and pre.get("use_regex") and not pre.get("add_prefix_space"))
        self.merge, self.pieces = self.library.model.tokenize, Memory(self.piece)

    def whole(self, text: str) -> bytes:
        """Ids of a text by the library itself."""
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of one piece by the library's model, which takes bytes as characters."""
        written = piece.encode().decode("latin-1").translate(BYTE_CHARS)
        return np.array([t.id for t in self.merge(written)], self.dtype).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a text (None: no ids)."""
        if not text:
            return b""
        if not self.by_piece or NOT_PLAIN.search(text) or any(s in text for s in self.specials):
            return self.whole(text)
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(text)))


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder a file and worker, so that its memory lasts over tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode_ordered(docs: DataFrame, tokenizer: str, end_id: int, parts: int) -> DataFrame:
    """Ids of all documents in ascending ``doc_id`` order, cut into ``parts`` ranges of ids.

    Returns ``part`` (number of the range), ``local_start`` (ids before the document within its
    range), ``doc_id``, ``ids`` (little-endian, ``end_id`` last) and ``n_tokens``. Rows of one
    ``doc_id`` follow each other by their text's hash and text, and may spread over several ranges;
    rows without a ``doc_id`` come first; a null text has the end id alone. The first pass of a
    two-pass prefix sum: write it before reading it twice.
    """
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "text_hash", "text")]
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.xxhash64("text").alias("text_hash"))
            .repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)
            .select("doc_id", "text"))

    def encode_part(batches):
        encode = encoder(tokenizer)
        keep_only(encode.pieces)
        end = np.array([end_id], encode.dtype).tobytes()
        part, start, width = TaskContext.get().partitionId(), 0, encode.dtype.itemsize
        for batch in slices(batches):
            ids = [encode.encode(t) + end for t in batch.column("text").to_pylist()]
            counts = np.array([len(x) // width for x in ids], np.int64)
            starts = start + np.cumsum(counts) - counts
            start += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part, np.int32)), pa.array(starts),
                 batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(counts)],
                names=["part", "local_start", "doc_id", "ids", "n_tokens"])

    return rows.mapInArrow(
        encode_part, "part int, local_start long, doc_id long, ids binary, n_tokens long")
