"""Merkle manifest of a data set, with proofs for all its rows by octopus multiproofs.

Rows of a group (a source), in order, are the leaves of a tree of runs of three; the roots of the
groups, in order, are the leaves of the top tree. The manifest is the written table of all nodes.

Building: leaves are sorted over ranges of groups and keys, and two passes of prefix sums number them.
Aligned blocks of 3^HEIGHT neighbours are hashed upwards in a stream, whatever group they are of, and
the tops of the blocks are the leaves of the next round: three rounds reach 10^11 rows.

Proving: a *leaf partition* is a stretch of at most PIECE leaves in order. It works out which nodes of
the tree its proofs need that it cannot derive from its own leaves, level by level: the members of the
runs of what it has, less what it has. These few coordinates are fetched in one join; the shared
interior nodes are hashed once; and the proof of a node is its siblings followed by the proof of its
parent, so that single proofs are cut out of shared ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.columns import name as quoted
from tabwright.functions.scratch import materialise
from tabwright.llm.common import offsets_of_parts, part_count, slices

ARITY = 3
#: Levels that one task hashes over a block, so that a block has 3^HEIGHT nodes at most.
HEIGHT = 8
#: Leaves of a leaf partition at most (a power of two), and bytes of a digest.
PIECE, WIDTH = 1 << 14, 32
#: Number of the top tree; those of the groups count from 0.
TOP = -1
#: Columns of a leaf that the operator adds; carried columns must be called otherwise.
OWN = ("place", "tree", "idx", "size", "piece", "subroot", "root", "proof", "folded_root")
NODE = "tree long, level int, idx long, size long, digest binary"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 (binary) of the values: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    values = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
              for c in (column.cast("string") for column in columns)]
    return F.unhex(F.sha2(F.concat(*values), 256))


def joint_digest(digests: bytes) -> bytes:
    """Digest of a run, from its members one after the other; they are hashed as lower-case hex."""
    return hashlib.sha256(digests.hex().encode()).digest()


@dataclass
class Manifest:
    """``leaves`` (numbered, with carried columns), ``nodes`` of all trees, number of groups."""

    leaves: DataFrame
    nodes: DataFrame
    groups: int


def numbered(leaves: DataFrame, group: str, key: str) -> DataFrame:
    """Leaves with ``tree`` (number of the group), ``idx`` in it, its ``size`` and their ``piece``.

    Order is by group (nulls first, UTF-8 bytewise), key (nulls first) and digest; rows equal in all
    of them are interchangeable, and a fourth sort key spreads them over ranges.
    """
    spark = leaves.sparkSession
    order = [quoted(c).asc_nulls_first() for c in (group, key)] + [F.col("leaf")]
    salted = leaves.withColumn("place", F.monotonically_increasing_id())
    placed = materialise(
        salted.repartitionByRange(part_count(leaves), *order, F.col("place"))
        .sortWithinPartitions(*order, "place")
        .withColumn("place", F.monotonically_increasing_id()), "merkle-placed")
    totals = materialise(
        placed.groupBy(quoted(group).alias("own_group"),
                       F.shiftright("place", 33).cast("int").alias("part"))
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-totals")
    groups = totals.groupBy("own_group").agg(
        F.min("part").alias("part"), F.min("first").alias("first"), F.sum("n").alias("size"))
    before = offsets_of_parts(groups.groupBy("part").agg(F.count(F.lit(1)).alias("n")),
                              "part", "n", "before")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("first")) - 1
    groups = (groups.withColumn("rank", rank).join(before, "part")
              .select("own_group", "size", (F.col("before") + F.col("rank")).alias("tree")))
    earlier = Window.partitionBy("own_group").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = totals.select(
        "own_group", "part",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    pieces = starts.alias("s").join(
        groups.alias("g"), F.col("s.own_group").eqNullSafe(F.col("g.own_group"))).select(
        "s.own_group", F.col("part").alias("own_part"), "shift", "size", "tree")
    joined = placed.join(
        pieces, quoted(group).eqNullSafe(F.col("own_group"))
        & (F.shiftright("place", 33) == F.col("own_part")))
    return materialise(joined.select(
        *map(quoted, leaves.columns), "tree", (F.col("place") + F.col("shift")).alias("idx"), "size",
        F.shiftright("place", PIECE.bit_length() - 1).alias("piece")), "merkle-leaves")


def climb(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """Nodes above a stream of blocks sorted by tree and place, up to so many levels higher.

    Holds at most three digests a level, however many nodes pass.
    """
    runs = [b""] * levels
    for batch in slices(batches):
        out = []
        for tree, level, at, size, digest in zip(*(c.to_pylist() for c in batch.columns)):
            for height in range(levels):
                if size == 1:
                    break
                runs[height] += digest
                if at % ARITY + 1 < ARITY and at + 1 < size:
                    break
                digest, runs[height] = joint_digest(runs[height]), b""
                at, size = at // ARITY, -(-size // ARITY)
                out.append((tree, level + height + 1, at, size, digest))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, NODE_TYPES)],
            names=batch.schema.names)


NODE_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())


def all_nodes(base: DataFrame) -> DataFrame:
    """Nodes of the trees whose level 0 is ``base``, that level included. Each round is written."""
    nodes, level, height = base, 0, HEIGHT
    while True:
        block = F.floor(F.col("idx") / ARITY ** height)
        rows = (base.where("size > 1").repartition(part_count(base), "tree", block)
                .sortWithinPartitions("tree", "idx"))
        above = materialise(rows.mapInArrow(lambda b: climb(b, height), NODE), "merkle-nodes")
        nodes, level = nodes.unionByName(above), level + height
        base = above.where(F.col("level") == level)
        if base.where("size > 1").isEmpty():
            return nodes


def build(leaves: DataFrame, group: str = "source", key: str = "doc_id") -> Manifest:
    """Manifest of the rows of ``leaves``: a group, a key, ``leaf`` (32 bytes) and columns to carry.

    A null group is a group of its own and comes first, so do null keys in a group; repeated rows are
    leaves each, in the order of their digests; an empty table has no nodes.
    """
    clash = {c.lower() for c in leaves.columns}.intersection(OWN)
    if clash:
        raise ValueError(f"columns with reserved names: {', '.join(sorted(clash))}")
    placed = numbered(leaves, group, key)
    level = F.lit(0).cast("int").alias("level")
    nodes = all_nodes(placed.select("tree", level, "idx", "size", F.col("leaf").alias("digest")))
    tops = nodes.where("size = 1").select("tree", "digest")
    groups = tops.count()
    top = all_nodes(materialise(tops.select(
        F.lit(TOP).cast("long").alias("tree"), level, F.col("tree").alias("idx"),
        F.lit(groups).cast("long").alias("size"), "digest"), "merkle-tops"))
    return Manifest(placed, nodes.unionByName(top), groups)


def sizes_above(size: int) -> list[int]:
    """Numbers of nodes by level, from ``size`` leaves up to the one root."""
    sizes = [size]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def members(runs: np.ndarray, size: int) -> np.ndarray:
    found = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
    return found[found < size]


def missing(places: np.ndarray, size: int) -> list[np.ndarray]:
    """Places by level, below the root, that proofs of the leaves at ``places`` need and these leaves
    do not give. No node is among them that can be derived, so the union is minimal."""
    need, have = [], np.unique(places)
    for count in sizes_above(size)[:-1]:
        runs = np.unique(have // ARITY)
        need.append(np.setdiff1d(members(runs, count), have, assume_unique=True))
        have = runs
    return need


def trees_of(tree: np.ndarray, idx: np.ndarray, size: np.ndarray,
             groups: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """Tree, places and size of every group among some leaves, the top tree first."""
    kinds, first = np.unique(tree, return_index=True)
    yield TOP, kinds, groups
    order = np.argsort(tree, kind="stable")
    for t, start, places in zip(kinds.tolist(), first.tolist(),
                                np.split(idx[order], np.searchsorted(tree[order], kinds)[1:])):
        yield t, places, int(size[start])


def expanded(nodes: dict[tuple[int, int, int], bytes], tree: int, places: np.ndarray, size: int,
             above: bytes) -> dict[int, bytes]:
    """Proofs of the leaves at ``places``, with ``above`` (the proof of the tree's root) at the end.

    Adds the interior nodes that they share to ``nodes``.
    """
    sizes, levels = sizes_above(size), [np.unique(places)]
    for level, count in enumerate(sizes[:-1]):
        runs = np.unique(levels[-1] // ARITY)
        for run in runs.tolist():
            nodes[tree, level + 1, run] = joint_digest(b"".join(
                nodes[tree, level, i] for i in range(ARITY * run, min(ARITY * run + ARITY, count))))
        levels.append(runs)
    proofs = {0: above}
    for level in range(len(sizes) - 2, -1, -1):
        below = {}
        for i in levels[level].tolist():
            run = range(i - i % ARITY, min(i - i % ARITY + ARITY, sizes[level]))
            below[i] = b"".join(nodes[tree, level, j] for j in run if j != i) + proofs[i // ARITY]
        proofs = below
    return proofs


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """Every row of ``leaves`` (rows of ``manifest.leaves``, all by default) with ``subroot``, ``root``
    and ``proof``: the digests of its siblings, 32 bytes each, level by level, left to right, up to the
    root of its group and on to the root of all."""
    rows, groups = manifest.leaves if leaves is None else leaves, manifest.groups

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = [(tree, level, place)
               for tree, places, size in trees_of(*numbers(table), groups)
               for level, need in enumerate(missing(places, size)) for place in need.tolist()]
        columns = list(zip(*out)) or [[]] * 3
        return pa.table([pa.array([key[0].as_py()] * len(out), pa.int64()),
                         pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                         pa.array(columns[2], pa.int64())],
                        names=["piece", "tree", "level", "idx"])

    def numbers(table: pa.Table) -> list[np.ndarray]:
        return [table.column(c).to_numpy() for c in ("tree", "idx", "size")]

    def expand(table: pa.Table, fetched: pa.Table) -> pa.Table:
        nodes = dict(zip(zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "idx"))),
                         fetched.column("digest").to_pylist()))
        tree, idx, size = numbers(table)
        digests = table.column("leaf").to_pylist()
        for t, i, digest in zip(tree.tolist(), idx.tolist(), digests):
            nodes[t, 0, i] = digest
        trees = list(trees_of(tree, idx, size, groups))
        inner, tops = {}, {}
        for t, places, count in trees[1:]:  # roots of the groups are leaves of the top tree
            inner[t] = expanded(nodes, t, places, count, b"")
            tops[t] = nodes[TOP, 0, t] = nodes[t, len(sizes_above(count)) - 1, 0]
        outer = expanded(nodes, *trees[0], b"")
        root = nodes[TOP, len(sizes_above(groups)) - 1, 0]
        at = tree.tolist()
        proofs = [inner[t][i] + outer[t] for t, i in zip(at, idx.tolist())]
        return (table.append_column("subroot", pa.array([tops[t] for t in at], pa.binary()))
                .append_column("root", pa.array([root] * len(at), pa.binary()))
                .append_column("proof", pa.array(proofs, pa.binary())))

    asked = rows.select("piece", "tree", "idx", "size").groupBy("piece").applyInArrow(
        ask, "piece long, tree long, level int, idx long")
    fetched = asked.join(manifest.nodes.drop("size"), ["tree", "level", "idx"]).select(
        "piece", "tree", "level", "idx", "digest")
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.BinaryType())
                                                  for c in ("subroot", "root", "proof"))])
    return rows.groupBy("piece").cogroup(fetched.groupBy("piece")).applyInArrow(expand, schema)


def fold(digest: bytes, proof: bytes, steps: Sequence[tuple[int, int]]) -> bytes:
    """Root that a leaf and its proof lead to; ``steps`` are its place and the size of its tree, then
    those of its group in the top tree."""
    at = 0
    for place, size in steps:
        while size > 1:
            before = place % ARITY
            end = at + WIDTH * (min(ARITY, size - place + before) - 1)
            cut = at + WIDTH * before
            digest = joint_digest(proof[at:cut] + digest + proof[cut:end])
            at, place, size = end, place // ARITY, -(-size // ARITY)
    return digest


def verify(proofs: DataFrame, groups: int, claimed: str = "leaf") -> DataFrame:
    """Adds ``folded_root``: the root recomputed from the digest in ``claimed`` and the proof alone."""
    def run(batches):
        for batch in slices(batches):
            columns = (batch.column(c).to_pylist() for c in (claimed, "proof", "idx", "size", "tree"))
            folded = [fold(digest, proof, ((i, n), (t, groups)))
                      for digest, proof, i, n, t in zip(*columns)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(folded, pa.binary())],
                                             names=[*batch.schema.names, "folded_root"])

    schema = T.StructType([*proofs.schema.fields, T.StructField("folded_root", T.BinaryType())])
    return proofs.mapInArrow(run, schema)


def hex_of(digest: str) -> Column:
    return F.lower(F.hex(digest))
