"""N-gram Jaccard join: documents whose five-word shingles overlap by four fifths, and their groups.

Two sets of sizes x >= y link only if they share T = 4 (x + y) / 9 shingles: for every set a
T-occurrence query over inverted lists, answered as DivideSkip does. Shingles have one common order
that begins with rare ones; the L longest lists of a set (LONG of its size) are not merged.

- *Short lists.* At most L of the shared shingles are missing from the short lists of either set, so a
  partner occurs in T - L of the short lists of the larger set or more. Every list tells each of its
  members the smaller ones in it, the parts of one member are merged by a heap, and partners that
  occur often enough are kept, each once.
- *Long lists.* For these few the whole sets are compared by binary search of one in the other, which
  probes the long lists and is exact; before, bitmaps of the sets rule out pairs without reading them.
- Equal sets are one *node* (the smallest ``doc_id`` that has it), so copies cost nothing further.
- The order comes from a bounded list of counts taken over all texts. It decides how long the lists
  are, never which links are found.
- A first round compares each list's members with one of them. Members of one group are connected
  then, and only lists that still hold several groups are merged; pairs within a group are not needed.
- A list of more than BLOCK members is cut into blocks, and pairs of blocks are merged apart.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scratch import materialise
from tabwright.llm.common import discard, part_count, slices
from tabwright.llm.encode import Memory, keep_only

WORDS = 5
#: Shingles at most whose counts order the lists, and the count from which they are worth it.
FREQUENT, LEAST_COUNT = 1 << 18, 16
#: Shingles of distinct sets that a task counts together.
COUNTED_TOGETHER = 2_000_000
#: Share of a set's size that its long lists have; four fifths would leave one occurrence to ask for.
LONG = 0.75
#: Members of a list that are merged at a time, and up to which plain loops are faster than numpy.
BLOCK, FEW = 1 << 16, 32
#: Members that one row tells of.
TOLD = 1 << 10
#: Bits at most of the bitmap of documents whose sets are looked up (sent to all tasks).
LOOKUP_BITS = 1 << 27

_WORDS = Memory(xxhash.xxh64_intdigest, 300_000)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles, A-Z in lower case; a shorter text is one
    shingle of all its words, and a text without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[k:len(words) - width + 1 + k]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return np.unique(out)


def needed(x, y):
    """Least shared shingles of two sets with 100 * intersection >= 80 * union."""
    return -(-4 * (x + y) // 9)


def long_lists(size: int, share: float) -> int:
    """Number of the longest lists that a set does not merge (always under ``needed``)."""
    return int(share * size)


def bitmap(found: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each of some 2 to 4 bits a shingle."""
    bits = max(64, 1 << int(2 * len(found) - 1).bit_length())
    at = ((found >> np.uint64(17)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def may_link(a: bytes, size_a: int, b: bytes, size_b: int) -> bool:
    """False only if too few shingles can be shared: every bit in which the two parities differ
    stands for at least one shingle that is in one set only."""
    if 5 * min(size_a, size_b) < 4 * max(size_a, size_b):
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    apart = int(np.bitwise_count(x ^ y).sum())
    return (size_a + size_b - apart) // 2 >= needed(size_a, size_b)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Shingles of the shorter set found in the longer one by binary search."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(long, short)
    at[at == len(long)] = 0
    return int((long[at] == short).sum())


def described(docs: DataFrame) -> DataFrame:
    """Size and 128-bit name of every document's set, and counts of shingles that several sets of a
    task share (on some rows, else null)."""
    def describe(batches):
        keep_only(_WORDS)
        seen: dict[bytes, np.ndarray] = {}
        held = 0
        for batch in slices(batches):
            sizes, names = [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                name = xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None
                sizes.append(len(found))
                names.append(name)
                if name and name not in seen:
                    seen[name] = found
                    held += len(found)
            often, times = [None] * len(sizes), [None] * len(sizes)
            if held >= COUNTED_TOGETHER and sizes:
                often[0], times[0] = several(seen)
                seen, held = {}, 0
            yield rows_of(batch.column("doc_id"), sizes, names, often, times)
        if seen:
            often, times = several(seen)
            yield rows_of(pa.nulls(1, pa.int64()), [None], [None], [often], [times])

    def several(seen):
        kinds, counts = np.unique(np.concatenate(list(seen.values())), return_counts=True)
        return kinds[counts > 1].view(np.int64), counts[counts > 1].astype(np.int32)

    def rows_of(ids, sizes, names, often, times):
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
             pa.array(often, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
            names=["doc_id", "n_shingles", "set_name", "often", "times"])

    return docs.mapInArrow(describe, "doc_id long, n_shingles long, set_name binary, "
                                     "often array<long>, times array<int>")


def frequent_shingles(described_rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts (at most FREQUENT)."""
    counted = (described_rows.where("often is not null")
               .select(F.explode(F.arrays_zip("often", "times")).alias("c"))
               .groupBy(F.col("c.often").alias("shingle")).agg(F.sum("c.times").alias("n"))
               .where(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "shingle").limit(FREQUENT)
               .toArrow())
    kinds = counted.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(kinds)
    return kinds[order], counted.column("n").to_numpy()[order]


def short_lists(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Of every set: size, bitmap, name and the shingles of its short lists, rare ones first, each
    with the number of blocks that its list is cut into."""
    sent, block, share = docs.sparkSession.sparkContext.broadcast(frequent), BLOCK, LONG

    def take(batches):
        keep_only(_WORDS)
        kinds, counts = sent.value
        for batch in slices(batches):
            sizes, names, maps, heads, cuts = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                n = len(found)
                rank = np.zeros(n, np.int64)
                if n and len(kinds):
                    at = np.searchsorted(kinds, found)
                    at[at == len(kinds)] = 0
                    rank = np.where(kinds[at] == found, counts[at], 0)
                # ``found`` is sorted, so a stable sort by count orders equal counts by hash.
                order = np.argsort(rank, kind="stable")[:n - long_lists(n, share)]
                heads.append(found[order].view(np.int64))
                cuts.append((rank[order] // block + 1).astype(np.int32) if rank.any() else None)
                sizes.append(n)
                maps.append(bitmap(found) if n else None)
                names.append(xxhash.xxh3_128_digest(found.tobytes()) if n else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(names, pa.binary()),
                 pa.array(maps, pa.binary()), pa.array(heads, pa.list_(pa.int64())),
                 pa.array(cuts, pa.list_(pa.int32()))],
                names=["node", "size", "set_name", "bits", "heads", "cuts"])

    return docs.mapInArrow(take, "node long, size int, set_name binary, bits binary, "
                                 "heads array<long>, cuts array<int>")


def listed(sets: DataFrame) -> DataFrame:
    """Inverted lists with two members or more: ``shingle``, ``node``, ``size``, ``cuts`` and ``block``
    (number of blocks, and which the member is in), and ``first``, the smallest node of about the same
    size in the block."""
    entries = sets.select("node", "size", "cuts", F.posexplode("heads").alias("at", "shingle"))
    cuts = F.coalesce(F.get("cuts", F.col("at")), F.lit(1))
    level = F.floor(F.log(1.25, F.col("size").cast("double"))).cast("int")
    entries = entries.select("shingle", "node", "size", level.alias("level"), cuts.alias("cuts")) \
        .withColumn("block", F.when(F.col("cuts") > 1, F.pmod(F.xxhash64("node"), "cuts"))
                    .otherwise(0).cast("int"))
    return entries.repartition("shingle", "block").selectExpr(
        "shingle", "node", "size", "cuts", "block",
        "count(1) over (partition by shingle, block) as members",
        "min(node) over (partition by shingle, block, level) as first").where(
        "members > 1 or cuts > 1").drop("members")


def plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that their bitmaps do not rule out."""
    side = sets.select("node", "size", "bits")
    both = (pairs.join(side.toDF("a", "size_a", "bits_a"), "a")
            .join(side.toDF("b", "size_b", "bits_b"), "b"))

    def keep(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist()
                       for c in ("bits_a", "size_a", "bits_b", "size_b")]
            chosen = [may_link(*row) for row in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(chosen, pa.bool_()))

    return both.select("a", "b", "size_a", "bits_a", "size_b", "bits_b").mapInArrow(
        keep, "a long, b long")


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Shingle sets of the documents that are among ``nodes`` (and a few others).

    A bitmap of the nodes' hashes goes to all tasks; its size follows their number up to
    LOOKUP_BITS, and beyond that more documents pass it. The join that follows is exact.
    """
    spark = docs.sparkSession
    count = nodes.count()
    bits = min(LOOKUP_BITS, max(1 << 16, 1 << (16 * count).bit_length()))
    bit = F.pmod(F.xxhash64(F.col("node")), F.lit(bits))
    words = (nodes.select(bit.alias("bit"))
             .groupBy((F.col("bit") / 32).cast("long").alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                           (F.col("bit") % 32).cast("int"))).alias("mask"))
             .toArrow())
    table = np.zeros(bits // 32, np.uint32)
    table[words.column("word").to_numpy()] = words.column("mask").to_numpy().astype(np.uint32)
    sent = spark.sparkContext.broadcast(table)

    def take(batches):
        keep_only(_WORDS)
        for batch in slices(batches):
            bit = batch.column("bit").to_numpy(zero_copy_only=False)
            asked = np.flatnonzero(sent.value[bit // 32] >> (bit % 32).astype(np.uint32) & 1)
            part = batch.take(pa.array(asked))
            found = [shingles(t).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.binary())],
                                             names=["node", "set"])

    asked = docs.where("doc_id is not null").select(
        "doc_id", "text", F.pmod(F.xxhash64(F.col("doc_id")), F.lit(bits)).alias("bit"))
    return asked.mapInArrow(take, "node long, set binary")


def linked(docs: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among candidate pairs (a < b), by the exact overlap of their sets."""
    pairs = materialise(plausible(pairs, sets), "ngram-plausible")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    found = materialise(sets_of(docs, nodes).join(nodes, "node", "left_semi"), "ngram-sets")
    both = (pairs.join(found.toDF("b", "set_b"), "b").join(found.toDF("a", "set_a"), "a"))

    def keep(batches):
        for batch in slices(batches):
            chosen = []
            for a, b in zip(*(batch.column(c).to_pylist() for c in ("set_a", "set_b"))):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                chosen.append(shared(x, y) >= max(1, needed(len(x), len(y))))
            yield batch.select(["a", "b"]).filter(pa.array(chosen, pa.bool_()))

    links = materialise(both.select("a", "b", "set_a", "set_b").mapInArrow(keep, "a long, b long"),
                        "ngram-links")
    discard(pairs, found)
    return links


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``links`` (a, b): ``node``, ``component``.

    Every round points each node to its smallest neighbour or itself, follows the pointers a few
    steps, and contracts the links; those left connect different ends. Written between rounds.
    """
    labels = None
    links = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .where("a < b").distinct(), "ngram-edges")
    while not links.isEmpty():
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = ends.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("component"))
        for _ in range(2):
            step = materialise(step, "ngram-step")
            step = step.select("node", F.col("component").alias("via")).join(
                step.toDF("via", "component"), "via").select("node", "component")
        step = materialise(step, "ngram-step")
        labels = step if labels is None else materialise(
            labels.withColumnRenamed("component", "via")
            .join(step.toDF("via", "further"), "via", "left")
            .select("node", F.coalesce("further", "via").alias("component")), "ngram-labels")
        links = materialise(
            links.join(step.toDF("a", "x"), "a").join(step.toDF("b", "y"), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .where("a < b").distinct(), "ngram-edges")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``component``: the label of their ``node``, or the node itself."""
    return rows.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def smaller_members(members: list[tuple], both: bool) -> Iterator[tuple[int, int, list, list]]:
    """Of one list, or of two blocks of it (``both``): each member with its size, and nodes and sizes
    of the members that are not larger, at least four fifths of its size and in another group.

    ``members`` are (size, node, group, block).
    """
    members.sort()
    if len(members) <= FEW:
        for k, (x, node, group, block) in enumerate(members):
            found = [(other, y) for y, other, g, b in members[:k]
                     if g != group and 5 * y >= 4 * x and (not both or b != block)]
            if found:
                found.sort()
                yield node, x, *map(list, zip(*found))
        return
    sizes, nodes, groups, blocks = (np.array(c, np.int64) for c in zip(*members))
    low = np.searchsorted(5 * sizes, 4 * sizes)
    for k in np.flatnonzero(low < np.arange(len(sizes))).tolist():
        part = slice(low[k], k)
        fits = groups[part] != groups[k]
        if both:
            fits &= blocks[part] != blocks[k]
        if fits.any():
            found, its = nodes[part][fits], sizes[part][fits]
            order = np.argsort(found)
            yield int(nodes[k]), int(sizes[k]), found[order].tolist(), its[order].tolist()


def told(mixed: DataFrame) -> DataFrame:
    """For every member of a list the smaller members (see above), one row a list and member."""
    def run(batches):
        for key, rows in grouped(batches, 3):
            if len({group for _, _, group, _ in rows}) > 1:
                for node, x, found, its in smaller_members(rows, key[1] != key[2]):
                    for k in range(0, len(found), TOLD):
                        yield node, x, found[k:k + TOLD], its[k:k + TOLD]

    rows = mixed.repartition(part_count(mixed), "shingle", "low", "high").sortWithinPartitions(
        "shingle", "low", "high").select("shingle", "low", "high", "size", "node", "component", "block")
    return rows.mapInArrow(lambda b: emitted(run(b)), "node long, size int, smaller array<long>, "
                                                    "sizes array<int>")


def grouped(batches, keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Neighbouring rows with equal first columns: those values, and the rows' other values."""
    key, rows = None, []
    for batch in slices(batches):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def emitted(rows: Iterator[tuple[int, int, list, list]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 + len(row[2])
        if size >= 16 * TOLD:
            yield told_batch(held)
            held, size = [], 0
    yield told_batch(held)


def told_batch(rows: list[tuple]) -> pa.RecordBatch:
    nodes, sizes, smaller, its = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()),
         pa.array(smaller, pa.list_(pa.int64())), pa.array(its, pa.list_(pa.int32()))],
        names=["node", "size", "smaller", "sizes"])


def occurring(lists: DataFrame) -> DataFrame:
    """Pairs (a < b) whose smaller set occurs in enough short lists of the larger one."""
    share = LONG

    def merge(batches):
        out_a, out_b = [], []
        for (node, x), rows in grouped(batches, 2):
            merged = heapq.merge(*(zip(nodes, sizes) for nodes, sizes in rows))
            longest = long_lists(x, share)
            for (other, y), times in groupby(merged):
                if sum(1 for _ in times) >= needed(x, y) - longest:
                    out_a.append(min(node, other))
                    out_b.append(max(node, other))
            if len(out_a) >= 16 * TOLD:
                yield pa.RecordBatch.from_arrays([pa.array(out_a), pa.array(out_b)], names=["a", "b"])
                out_a, out_b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())],
                                         names=["a", "b"])

    return (lists.repartition(part_count(lists), "node").sortWithinPartitions("node")
            .select("node", "size", "smaller", "sizes").mapInArrow(merge, "a long, b long"))


def other_pairs(lists: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs that are not yet in one group and share enough short lists; also a written table that
    they come from."""
    marked = materialise(labelled(lists.drop("first"), labels), "ngram-lists")
    mixed = marked.groupBy("shingle").agg(F.min("component").alias("a"),
                                          F.max("component").alias("b")).where("a < b")
    rows = marked.join(mixed.select("shingle"), "shingle", "left_semi")
    # A member of a list in several blocks goes to every pair of blocks with its own in it.
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    rows = rows.select("*", other).select(
        "shingle", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "size", "node", "component", "block")
    return occurring(told(rows)), marked


def similar_groups(docs: DataFrame) -> DataFrame:
    """Groups of similar documents: ``doc_id``, ``n_shingles`` and ``component_id``, one row a row of
    ``docs``.

    Documents link when their sets of five-word shingles have 100 * intersection >= 80 * union;
    ``component_id`` is the smallest ``doc_id`` that links lead to. A null or empty text, or one of
    white space, has no shingles and links with nothing; a long text is held as its shingles' hashes,
    eight bytes a word. Rows of one ``doc_id`` are one document with
    several texts and belong to one group. A row without a ``doc_id`` belongs to the group of rows
    with an equal set, else to none (null). An empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = materialise(described(docs), "ngram-sizes")
    frequent = frequent_shingles(rows)
    rows = rows.where("n_shingles is not null").select("doc_id", "n_shingles", "set_name")
    names = materialise(rows.where("set_name is not null").groupBy("set_name")
                        .agg(F.min("doc_id").alias("node")).where("node is not null"),
                        "ngram-nodes")
    sets = materialise(
        short_lists(docs.where("doc_id is not null"), frequent)
        .join(names, ["node", "set_name"], "left_semi").dropDuplicates(["node", "set_name"]),
        "ngram-heads")
    lists = materialise(listed(sets), "ngram-lists")
    stars = (lists.where("first <> node").select(F.col("first").alias("a"), F.col("node").alias("b"))
             .distinct())
    first = linked(docs, stars, sets)
    labels = materialise(components(first), "ngram-labels")
    others, mixed = other_pairs(lists, labels)
    more = linked(docs, others, sets)
    discard(lists, mixed, sets)
    named = rows.join(names, "set_name", "left")
    # Rows of one document with different sets: each is linked with the document's smallest node.
    several = (named.where("doc_id is not null").groupBy("doc_id")
               .agg(F.min("node").alias("a"), F.max("node").alias("top")).where("a < top"))
    same = (named.select("doc_id", F.col("node").alias("b")).join(several, "doc_id")
            .select("a", "b").distinct())
    labels = materialise(components(first.unionByName(more).unionByName(same)), "ngram-labels")
    return (labelled(named, labels)
            .select("doc_id", "n_shingles",
                    F.coalesce("component", "doc_id").alias("component_id")))
