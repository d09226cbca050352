"""Binary id store with a minimal perfect hash index.

A store is a Parquet folder of blocks in ascending ``doc_id`` order. A block holds the raw ids of
consecutive documents (``payload``), their keys, and its index: ``seeds`` (one a bucket), and for
every slot the ``fingerprints``, ``offsets`` and ``lengths`` of the document hashed to it. A key is
a ``doc_id`` and its number among equal ones of the block, so repeated ids stay apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.scratch import scratch_path
from tabwright.llm.common import offsets_of_parts, part_count
from tabwright.llm.encode import encode_ordered, encoder

#: Ids of a block, unless one document is longer.
BLOCK_TOKENS = 1 << 18
#: Keys that share a seed on average.
BUCKET_KEYS = 4
#: Seeds tried at a time for one bucket.
TRIES = 64

BLOCKS = ("part int, block int, local_start long, first_id long, last_id long, n_docs long, "
          "n_tokens long, width int, keys binary, null_keys long, payload binary, salt long, "
          "seeds binary, fingerprints binary, offsets binary, lengths binary")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads close ones (the finaliser of splitmix64)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hashes(ids: np.ndarray, nth: np.ndarray, null: np.ndarray, salt: int) -> np.ndarray:
    words = ids.astype(np.int64).view(np.uint64) ^ mix(nth.astype(np.uint64) * np.uint64(2)
                                                       + null.astype(np.uint64))
    return mix(words ^ mix(np.array([salt], np.uint64)))


def slots(hashes: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """Slots of hashed keys. A negative seed names its bucket's only slot."""
    seed = seeds[(hashes % np.uint64(len(seeds))).astype(np.int64)]
    hashed = mix(hashes ^ mix(seed.astype(np.uint64))) % np.uint64(size)
    return np.where(seed < 0, -1 - seed, hashed.astype(np.int64))


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def perfect_seeds(hashes: np.ndarray) -> np.ndarray:
    """Seeds that send different hashes to different slots of 0 to their number.

    Buckets are placed from the fullest on; those with one key are given the slots that are left.
    """
    size = len(hashes)
    buckets = (size + BUCKET_KEYS - 1) // BUCKET_KEYS
    seeds, taken = np.zeros(max(1, buckets), np.int32), np.zeros(size, bool)
    owner = (hashes % np.uint64(max(1, buckets))).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    bounds = np.searchsorted(owner[order], np.arange(buckets + 1))
    counts = np.diff(bounds)
    for b in np.argsort(-counts, kind="stable"):
        if counts[b] < 2:
            break
        keys, tried = hashes[order[bounds[b]:bounds[b + 1]]], 0
        while True:
            seed = np.arange(tried, tried + TRIES, dtype=np.uint64)
            spots = (mix(keys[None, :] ^ mix(seed)[:, None]) % np.uint64(size)).astype(np.int64)
            ordered = np.sort(spots, axis=1)
            good = ~taken[spots].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                first = int(np.argmax(good))
                seeds[b] = tried + first
                taken[spots[first]] = True
                break
            tried += TRIES
    single = np.flatnonzero(counts == 1)
    seeds[single] = -1 - np.flatnonzero(~taken)
    return seeds


def ordinals(ids: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Number of each key among equal neighbours."""
    change = np.ones(len(ids), bool)
    change[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
    return np.arange(len(ids)) - np.maximum.accumulate(np.where(change, np.arange(len(ids)), 0))


def block_index(hashes: np.ndarray, lengths: np.ndarray) -> dict:
    seeds = perfect_seeds(hashes)
    spot = slots(hashes, seeds, len(hashes))
    by_slot = np.argsort(spot)
    offsets = np.cumsum(lengths) - lengths
    return {"seeds": seeds.tobytes(), "fingerprints": fingerprints(hashes)[by_slot].tobytes(),
            "offsets": offsets[by_slot].astype("<u4").tobytes(),
            "lengths": lengths[by_slot].astype("<u4").tobytes()}


def make_block(part: int, block: int, start: int, ids: list, payloads: list,
               width: int) -> dict:
    """One block of documents in order."""
    null = np.array([i is None for i in ids])
    keys = np.array([i or 0 for i in ids], np.int64)
    nth = ordinals(keys, null)
    lengths = np.array([len(p) // width for p in payloads], np.int64)
    salt = 0
    while len(np.unique(hashes := key_hashes(keys, nth, null, salt))) < len(hashes):
        salt += 1
    row = {"part": part, "block": block, "local_start": start, "first_id": ids[0],
           "last_id": ids[-1], "n_docs": len(ids), "n_tokens": int(lengths.sum()),
           "width": width, "keys": np.stack([keys, nth]).tobytes(),
           "null_keys": int(null.sum()), "payload": b"".join(payloads), "salt": salt}
    return row | block_index(hashes, lengths)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0,
                parts: int | None = None) -> None:
    """Encode all documents and write their store to ``path``, a folder that Spark can reach.

    Documents are in ascending ``doc_id`` order (null ids first, equal ids by the text's hash and
    text); a null or empty text is its end id alone; an empty table gives a store without blocks.
    """
    encoded = encode_ordered(docs, tokenizer, end_id, parts or part_count(docs))
    schema = docs.sparkSession.createDataFrame([], BLOCKS).schema
    names = schema.names

    def blocks_of_part(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow, width = to_arrow_schema(schema), encoder(tokenizer).dtype.itemsize
        ids, payloads, size, number, start, part = [], [], 0, 0, 0, 0

        def flush():
            nonlocal ids, payloads, size, number, start
            row = make_block(part, number, start, ids, payloads, width)
            number, start = number + 1, start + size
            ids, payloads, size = [], [], 0
            return pa.RecordBatch.from_pylist([{n: row[n] for n in names}], schema=arrow)

        for batch in batches:
            for row_part, doc_id, payload, count in zip(
                    *(batch.column(c).to_pylist() for c in ("part", "doc_id", "ids", "n_tokens"))):
                if ids and size + count > BLOCK_TOKENS:
                    yield flush()
                part = row_part
                ids.append(doc_id)
                payloads.append(payload)
                size += count
        if ids:
            yield flush()

    encoded.mapInArrow(blocks_of_part, BLOCKS).write.parquet(path)


def find(block: dict, ids: np.ndarray, nth: np.ndarray, null: np.ndarray) -> tuple:
    """Constant-time look-up of keys in a block: found, first id and number of ids of each."""
    seeds = np.frombuffer(block["seeds"], np.int32)
    hashes = key_hashes(ids, nth, null, block["salt"])
    spot = slots(hashes, seeds, block["n_docs"])
    found = np.frombuffer(block["fingerprints"], np.uint32)[spot] == fingerprints(hashes)
    return (found, np.frombuffer(block["offsets"], "<u4")[spot].astype(np.int64),
            np.frombuffer(block["lengths"], "<u4")[spot].astype(np.int64))


def payload_ids(block: dict) -> np.ndarray:
    return np.frombuffer(block["payload"], f"<u{block['width']}")


def block_starts(blocks: DataFrame) -> DataFrame:
    """Blocks with ``block_start``, the ids of all documents before them."""
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row a range of documents, whatever their number.
    offsets = F.broadcast(offsets_of_parts(totals, "part", "total", "part_start"))
    return blocks.join(offsets, "part").withColumn(
        "block_start", F.col("part_start") + F.col("local_start"))


FOUND = "doc_id long, start long, n_tokens long, ids binary"


def found_rows(ids, nth, null, start, blocks: dict, keep) -> pa.RecordBatch:
    found, offset, length = find(blocks, ids, nth, null)
    keep = np.flatnonzero(found & keep)
    data = payload_ids(blocks)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[keep], mask=null[keep]), pa.array(start + offset[keep]), pa.array(length[keep]),
         pa.array([data[o:o + n].astype("<u4").tobytes()
                   for o, n in zip(offset[keep], length[keep])], pa.binary())],
        names=["doc_id", "start", "n_tokens", "ids"])


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a store, each looked up by its key: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                keys, nth = np.frombuffer(block["keys"], np.int64).reshape(2, -1)
                null = np.arange(len(keys)) < block["null_keys"]
                yield found_rows(keys, nth, null, block["block_start"], block,
                                 np.ones(len(keys), bool))

    return block_starts(spark.read.parquet(path)).mapInArrow(read, FOUND)


def look_up(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Documents with the given ids (a list the caller holds): the columns of :func:`read_store`.

    The blocks' ranges of ids leave the few blocks that can hold a key; there the index gives the
    place of each key, and the fingerprint rejects ids that are not stored.
    """
    wanted = np.array(sorted(set(doc_ids)), np.int64)
    near = F.lit(False)
    for low, high in [(int(c[0]), int(c[-1])) for c in np.array_split(wanted, 64) if len(c)]:
        near = near | ((F.col("first_id").isNull() | (F.col("first_id") <= high))
                       & (F.col("last_id") >= low))

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                low = block["first_id"] if block["first_id"] is not None else -(1 << 63)
                near = wanted[(wanted >= low) & (wanted <= block["last_id"])]
                nth = 0
                while len(near):  # equal ids have the numbers from 0 on
                    at, null = np.full(len(near), nth), np.zeros(len(near), bool)
                    found, _, _ = find(block, near, at, null)
                    yield found_rows(near, at, null, block["block_start"], block, found)
                    near, nth = near[found], nth + 1

    return block_starts(spark.read.parquet(path)).where(near).mapInArrow(read, FOUND)


def store_path(spark: SparkSession) -> str:
    return scratch_path(spark, "id-store")
