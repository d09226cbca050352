"""Packing by concatenating and cutting: one stream of ids, fixed windows, boundary records."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scratch import materialise
from tabwright.llm.common import offsets_of_parts, part_count, slices
from tabwright.llm.encode import encode_ordered, encoder

#: Tokens of a sequence.
WINDOW = 1024


def cut(starts: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Cut spans of a stream at the multiples of ``window``.

    Returns for every piece the index of its span, its start within the span, its length, its
    window and its offset there. A span without tokens has no piece.
    """
    ends = starts + counts
    pieces = np.where(counts > 0, (ends - 1) // window - starts // window + 1, 0)
    owner = np.repeat(np.arange(len(starts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    window_no = starts[owner] // window + nth
    begin = np.maximum(starts[owner], window_no * window)
    end = np.minimum(ends[owner], (window_no + 1) * window)
    return owner, begin - starts[owner], end - begin, window_no, begin - window_no * window


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW,
         parts: int | None = None) -> DataFrame:
    """Pieces of documents in sequences of ``window`` ids, in ascending ``doc_id`` order.

    The documents' ids, each followed by ``end_id``, form one stream. A first pass encodes them
    and adds up the ids of each range of documents; running sums over these totals place every
    document in the stream, and a second pass cuts it at the multiples of ``window``. All
    sequences but the last are full, so the padding of the whole table is less than one window.

    One row a piece: ``doc_id``, ``start`` (its document's ids before it), ``length``, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` there, and the
    boundary record: ``begins`` and ``ends`` tell whether the document begins or ends in it.

    A null or empty text is its end id alone; rows with a repeated or null ``doc_id`` are packed
    each on its own; an empty table has no pieces; other columns are ignored. ``parts`` ranges
    are encoded side by side (default: the session's shuffle partitions).
    """
    encoded = materialise(
        encode_ordered(docs, tokenizer, end_id, parts or part_count(docs)), "packing-ids")
    totals = encoded.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row a range of documents, whatever their number.
    offsets = F.broadcast(offsets_of_parts(totals, "part", "total", "part_start"))
    placed = encoded.join(offsets, "part").select(
        "doc_id", "ids", "n_tokens",
        (F.col("part_start") + F.col("local_start")).alias("at"))

    def cut_part(batches):
        dtype = encoder(tokenizer).dtype
        for batch in slices(batches):
            at = batch.column("at").to_numpy(zero_copy_only=False)
            counts = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            owner, start, length, window_no, offset = cut(at, counts, window)
            ids = [np.frombuffer(x, dtype).astype("<u4") for x in batch.column("ids").to_pylist()]
            total = counts[owner]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(start), pa.array(length),
                 pa.array([ids[o][s:s + n].tobytes() for o, s, n in zip(owner, start, length)],
                          pa.binary()),
                 pa.array(total), pa.array(window_no), pa.array(offset),
                 pa.array(start == 0), pa.array(start + length == total)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                       "begins", "ends"])

    return placed.mapInArrow(
        cut_part, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                  "sequence_id long, offset long, begins boolean, ends boolean")
