"""Benchmark passages in documents: SimHash windows, multi-index Hamming blocks, exact check.

Every item of a benchmark gets a fingerprint of its weighted five-word shingles. In a document,
windows of an item's length in words get theirs, at every position. Blocks of the items'
fingerprints, with all values near them, form an index that finds every item within the radius of
a window. Candidates count if the weighted Jaccard similarity of their shingles reaches the limit.

An item of under five words is one shingle, looked up among the windows of its number of words.

A window that shares no shingle with any item of its length has similarity 0 with all of them.
Such windows need no fingerprint, and nearly all windows of a corpus are of this kind.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import free_name, slices, with_field
from tabwright.llm.encode import Memory, keep_only

SHINGLE = 5
#: Least similarity of a match.
SIMILAR = 0.8
#: Differing bits of the 64 up to which a window is compared with an item: all that two bits in
#: each block are sure to find. At similarity 0.8 and equal weights the cosine is 0.89 or more, so
#: 9.6 bits of 64 differ on average (deviation 2.9); with unequal weights more may differ.
RADIUS = 23
#: Blocks of a fingerprint, 8 bits each.
BLOCKS = 8
#: Items handled in one pass over the documents; a larger benchmark takes several passes.
ITEMS_AT_ONCE = 50_000

PUNCTUATION = b".,;:!?\"'()[]{}<>*#$%&|_`~^+=/\\-"
WORD = re.compile(r"\S+")
_WORDS = Memory(xxhash.xxh64_intdigest, 300_000)


def word_hashes(text: str) -> np.ndarray:
    """Hashes of a text's words, lower-cased and without ASCII punctuation."""
    words = text.lower().encode("utf-8", "replace").translate(None, PUNCTUATION).split()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hash of the ``width`` words from each position on; a shorter text is one shingle."""
    if not len(words):
        return words
    width = min(width, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = out * np.uint64(0xBF58476D1CE4E5B9) + words[k:len(words) - width + 1 + k]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of a shingle."""
    return np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little").astype(np.int64) * 2 - 1


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """SimHash of weighted sums of signs, one row each."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


def near_bytes(radius: int) -> np.ndarray:
    """All 8-bit masks with at most ``radius`` bits."""
    return np.array([sum(1 << b for b in bits) for n in range(radius + 1)
                     for bits in itertools.combinations(range(8), n)], np.uint8)


@dataclass
class Benchmark:
    """Items with their shingle weights, fingerprints and the index of their blocks."""

    items: list[int]
    sizes: np.ndarray
    bags: list[dict[int, int]]
    prints: np.ndarray
    weights: dict[int, int]       #: of the shingles that two or more items have
    unseen: int                   #: weight of all others
    shingles: np.ndarray          #: all shingles of items, sorted
    owners: list[np.ndarray]      #: sizes of the items that hold each
    index: list[list[np.ndarray]]  #: by block and value: the items near it
    short: dict[int, dict[int, list[int]]]  #: items of under five words, by words and shingle


def weight_of(rarity: float) -> int:
    """Weight of a shingle; whole numbers, so that sums over windows are exact."""
    return max(1, round(256 * math.log(1 + rarity)))


def count_shared(items: DataFrame) -> tuple[int, dict[int, int]]:
    """Number of the items with words, and of those that have a shingle, for each shingle of two or
    more. Shingles of one item weigh as much as those of none and need no entry."""
    def shingles(batches):
        keep_only(_WORDS)
        for batch in slices(batches):
            sets = [np.unique(shingle_hashes(word_hashes(t or "")))
                    for t in batch.column("text").to_pylist()]
            cells = np.concatenate(sets).view(np.int64)
            worded = pa.nulls(sum(len(s) > 0 for s in sets), pa.int64())  # one null an item
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(cells), worded])],
                                             names=["shingle"])

    counts = (items.select("text").mapInArrow(shingles, "shingle long").groupBy("shingle")
              .agg(F.count(F.lit(1)).alias("n")).where("shingle is null or n > 1").toArrow())
    held = dict(zip(counts.column("shingle").to_pylist(), counts.column("n").to_pylist()))
    total = held.pop(None, 0)
    return total, {s % (1 << 64): n for s, n in held.items()}


def compile_benchmark(rows: list[tuple[int, str | None]],
                      shared: tuple[int, dict[int, int]] | None = None) -> Benchmark:
    """Weights, fingerprints and block index of ``(item_id, text)`` rows; items without words are
    left out. A shingle weighs the more, the fewer items have it.

    ``shared`` counts the items of the whole benchmark (see :func:`count_shared`); without it the
    rows are the whole benchmark.
    """
    hashed = [(i, word_hashes(t or "")) for i, t in rows]
    hashed = [(i, w) for i, w in hashed if len(w)]
    runs = [shingle_hashes(w) for _, w in hashed]
    sets = [np.unique(r) for r in runs]
    if shared is None:
        held = Counter(s for found in sets for s in found.tolist())
        shared = len(sets), {s: n for s, n in held.items() if n > 1}
    total, held = shared
    unseen = weight_of(max(1, total))
    weights = {s: weight_of(total / n) for s, n in held.items()}
    bags = [{s: weights.get(s, unseen) for s in found.tolist()} for found in sets]
    prints = np.concatenate([fingerprint(
        (signs(r) * np.array([weights.get(s, unseen) for s in r.tolist()])[:, None]).sum(0)[None])
        for r in runs]) if runs else np.zeros(0, np.uint64)
    by_shingle: dict[int, set[int]] = {}
    for (_, w), found in zip(hashed, sets):
        for s in found.tolist():
            by_shingle.setdefault(s, set()).add(len(w))
    short: dict[int, dict[int, list[int]]] = {}
    for k, ((_, w), found) in enumerate(zip(hashed, sets)):
        if len(w) < SHINGLE:
            short.setdefault(len(w), {}).setdefault(int(found[0]), []).append(k)
    order = sorted(by_shingle)
    blocks = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
    masks = near_bytes(RADIUS // BLOCKS)
    index = []
    for b in range(BLOCKS):
        near = blocks[:, b][:, None] ^ masks[None, :]
        index.append([np.flatnonzero((near == v).any(axis=1)) for v in range(256)])
    return Benchmark([i for i, _ in hashed], np.array([len(w) for _, w in hashed], np.int64), bags,
                     prints, weights, unseen,
                     np.array(order, np.uint64),
                     [np.array(sorted(by_shingle[s])) for s in order], index, short)


def windows_near(hits: np.ndarray, size: int, words: int) -> np.ndarray:
    """Starts of the windows of ``size`` words that hold a shingle beginning at one of ``hits``."""
    last = max(0, words - size)
    width = min(SHINGLE, size)
    near = (hits[:, None] - np.arange(size - width + 1)[None, :]).ravel()
    return np.unique(np.clip(near, 0, last))


def similarity(bench: Benchmark, window: np.ndarray, item: int) -> float:
    """Weighted Jaccard similarity of the shingles of a window and an item."""
    bag, shared, total = bench.bags[item], 0, 0
    for s in set(window.tolist()):
        if s in bag:
            shared += bag[s]
        else:
            total += bench.weights.get(s, bench.unseen)
    return shared / (total + sum(bag.values()))


def candidates(bench: Benchmark, prints: np.ndarray, of_size: np.ndarray) -> tuple:
    """(window, item) pairs within the radius, for items marked in ``of_size``: some block of the
    two differs by at most RADIUS / BLOCKS bits, so the blocks' index has them all."""
    blocks = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
    pairs = []
    for w in range(len(prints)):
        near = np.unique(np.concatenate([bench.index[b][blocks[w, b]] for b in range(BLOCKS)]))
        near = near[of_size[near]]
        apart = np.bitwise_count(bench.prints[near] ^ prints[w])
        pairs += [(w, int(i), int(d)) for i, d in zip(near, apart) if d <= RADIUS]
    return pairs


def short_matches(bench: Benchmark, words: np.ndarray) -> dict[int, tuple]:
    """First window equal to each item of under five words: its one shingle is there or not."""
    best = {}
    for size, items in bench.short.items():
        if size <= len(words):
            found = shingle_hashes(words, size)
            places = np.flatnonzero(np.isin(found, np.array(list(items), np.uint64)))
            kinds, first = np.unique(found[places], return_index=True)
            for s, at in zip(kinds.tolist(), places[first].tolist()):
                best |= {k: (bench.items[k], 1.0, 0, at, at + size) for k in items[s]}
    return best


def matches(bench: Benchmark, text: str | None, similar: float) -> list[tuple]:
    """Best window of each item that a text holds: item, similarity, differing bits, first and
    end word. Ties go to the first window."""
    words = word_hashes(text or "")
    if not len(words) or not len(bench.shingles):
        return []
    best: dict[int, tuple] = short_matches(bench, words)
    found = shingle_hashes(words)
    at = np.searchsorted(bench.shingles, found)
    at[at == len(bench.shingles)] = 0
    hits = np.flatnonzero(bench.shingles[at] == found)
    by_size: dict[int, list[int]] = {}
    for h in hits.tolist():
        for size in bench.owners[at[h]].tolist():
            by_size.setdefault(size, []).append(h)
    for size, places in by_size.items():
        starts = windows_near(np.array(places), size, len(words))
        span = max(1, min(size, len(words)) - min(SHINGLE, len(words), size) + 1)
        low, high = int(starts[0]), int(starts[-1]) + span
        part = found[low:high]
        kinds, inverse = np.unique(part, return_inverse=True)
        weight = np.array([bench.weights.get(s, bench.unseen) for s in kinds.tolist()])
        sums = np.zeros((len(part) + 1, 64), np.int64)
        np.cumsum(signs(part) * weight[inverse][:, None], axis=0, out=sums[1:])
        prints = fingerprint(sums[starts - low + span] - sums[starts - low])
        for w, item, apart in candidates(bench, prints, bench.sizes == size):
            start = int(starts[w])
            like = similarity(bench, found[start:start + span], item)
            if like >= similar and (item not in best or like > best[item][1]):
                best[item] = (bench.items[item], like, apart, start, min(start + size, len(words)))
    return [best[i] for i in sorted(best)]


def source_span(text: str, first: int, end: int) -> tuple[int, int]:
    """Code points from the first word to the last one of a window."""
    kept = [m.span() for m in WORD.finditer(text)
            if m[0].lower().encode("utf-8", "replace").translate(None, PUNCTUATION).split()]
    return kept[first][0], kept[min(end, len(kept)) - 1][1]


MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()),
                            ("hamming", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def mark_benchmark(docs: DataFrame, benchmark: DataFrame, name: str = "matches",
                   similar: float = SIMILAR) -> DataFrame:
    """Adds to every row of ``docs`` (any columns, among them ``text``) the column ``name``: the
    benchmark items that its text holds, each with ``item_id``, ``similarity``, ``hamming``, and
    ``start`` and ``end`` (code points) of the best window.

    The benchmark (``item_id``, ``text``) is the stated query set; it is sent to all tasks in blocks
    of about ``ITEMS_AT_ONCE`` items, each compared with all documents. Weights are those of the
    whole benchmark: with every block go the counts of all shingles that several items have.

    Null and empty texts, on either side, match nothing; repeated documents or items match each on
    their own; items of under five words match where they stand word by word; without items nothing matches; an empty
    table gives no rows; a column called ``name`` is replaced.
    """
    spark, rows = docs.sparkSession, docs.drop(name)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    passes = max(1, -(-items.count() // ITEMS_AT_ONCE))
    shared = count_shared(items) if passes > 1 else None
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    kind = ("array<struct<item_id: long, similarity: double, hamming: int, start: int, end: int>>")
    parts = []
    for k in range(passes):
        asked = sorted(items.where(block == k).collect(),
                       key=lambda r: (r.item_id is not None, r.item_id, r.text or ""))
        sent = spark.sparkContext.broadcast(
            compile_benchmark([(r.item_id, r.text) for r in asked], shared))

        def scan(batches, sent=sent):
            keep_only(_WORDS)
            for batch in slices(batches):
                found = []
                for text in batch.column("text").to_pylist():
                    found.append([
                        dict(zip(("item_id", "similarity", "hamming", "start", "end"),
                                 (item, like, apart, *source_span(text, first, end))))
                        for item, like, apart, first, end in matches(sent.value, text, similar)])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, MATCH)],
                    names=[*batch.schema.names, part])

        parts.append(part := free_name(rows, f"{name}_{k}"))
        rows = rows.mapInArrow(scan, with_field(rows, part, kind))
    return rows.select(*[c for c in docs.columns if c.lower() != name.lower()],
                       F.concat(*parts).alias(name))


def find_benchmark(docs: DataFrame, benchmark: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Documents that hold benchmark items, one row a document and item: ``doc_id``, ``item_id``,
    ``similarity``, ``hamming``, ``start`` and ``end`` (see :func:`mark_benchmark`)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = mark_benchmark(rows, benchmark, "matches", similar)
    return marked.select("doc_id", F.inline("matches"))
