"""Merkle manifest against a sequential one: digests, proofs, tampering, missing coordinates."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import merkle
from tabwright.llm.queries import op12_merkle_manifest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Levels of the tree, and the siblings of each leaf up to its root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    proofs = []
    for i in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            first = i - i % 3
            path.append(([*level[first:i]], [*level[i + 1:first + 3]]))
            i //= 3
        proofs.append(path)
    return levels[-1][0], proofs


def brute_force(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for source in sources:
        by_source[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        own[source] = tree([leaf_of(r) for r in by_source[source]])
    root, above = tree([own[s][0] for s in sources])
    out = []
    for k, source in enumerate(sources):
        for row, proof in zip(by_source[source], own[source][1]):
            path = proof + above[k]
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4]:
                changed = (*row[:4], row[4].replace("\n", ""))
            digest = leaf_of(changed)
            for left, right in path:
                digest = h(*left, digest, *right)
            out.append((row[0], leaf_of(row), own[source][0], root,
                        h(*(x for left, right in path for x in left + right)), digest,
                        digest == root))
    return sorted(out, key=str)


def write(spark, tmp_path, rows, extra=""):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", *(extra.split(",") if extra else [])) \
        .write.parquet(path)
    return str(tmp_path)


def answer(spark, folder):
    return sorted((tuple(r) for r in op12_merkle_manifest(spark, folder).collect()), key=str)


def odd_rows():
    rows = [(i, f"s{i % 3}", "en", i, f"line {i}\nnext {i}\n") for i in range(200)]
    rows += [(i, None, None, None, None) for i in range(7)]
    rows += [(None, "s1", "de", 1, "no id\n"), (None, None, None, None, None)]
    rows += [(5, "s1", "en", 5, "same\n")] * 30 + [(5, "s1", "en", 5, "other\n")]
    rows += [(9, "only", "fr", 2, ""), (10, "é", "fr", 2, "ü\n" * 40000), (11, "", "x", 0, "\n")]
    return rows


@pytest.mark.parametrize("height,piece", [(8, 1 << 14), (1, 1), (2, 4)])
def test_query_equals_a_sequential_manifest(spark, tmp_path, monkeypatch, height, piece):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "PIECE", piece)
    rows = odd_rows()
    folder = write(spark, tmp_path, rows, "1 AS tree,'x' AS place,2 AS proof,3 AS own_group")
    assert answer(spark, folder) == brute_force(rows)


def test_one_row_and_no_row(spark, tmp_path):
    rows = [(4, "s", "en", 3, "a\nb")]
    assert answer(spark, write(spark, tmp_path / "one", rows)) == brute_force(rows)
    assert answer(spark, write(spark, tmp_path / "none", [])) == []


def test_many_groups_of_one_row_and_a_hot_one(spark, tmp_path):
    rows = [(i, "hot" if i % 3 == 0 else f"g{i}", "en", i, "t") for i in range(900)]
    assert answer(spark, write(spark, tmp_path, rows)) == brute_force(rows)


def test_verified_is_false_only_where_a_text_lost_lines(spark, sf):
    found = {r.doc_id: r.verified for r in op12_merkle_manifest(spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    changed = {r.doc_id for r in texts
               if zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (r.text or "")}
    assert changed and {d for d, ok in found.items() if not ok} == changed


def test_proofs_of_some_rows_only(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    leaves = docs.select("doc_id", "source", merkle.leaf_digest(
        [F.col(c) for c in COLUMNS]).alias("leaf"))
    manifest = merkle.build(leaves)
    some = merkle.prove(manifest, manifest.leaves.where("doc_id % 17 = 3"))
    rows = merkle.verify(some, manifest.groups).collect()
    assert len(rows) == docs.where("doc_id % 17 = 3").count()
    assert all(r.folded_root == r.root for r in rows)


def test_missing_nodes_are_those_needed_and_no_others():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 4, 9, 10, 26, 27, 28, 100):
        for _ in range(20):
            places = rng.choice(size, rng.integers(1, size + 1), replace=False)
            need = {(lv, i) for lv, n in enumerate(merkle.missing(places, size)) for i in n.tolist()}
            have, wanted = {(0, int(p)) for p in places}, set()
            for level, count in enumerate(merkle.sizes_above(size)[:-1]):
                for _, i in [n for n in have if n[0] == level]:
                    first = i - i % 3
                    wanted |= {(level, j) for j in range(first, min(first + 3, count))}
                    have.add((level + 1, i // 3))
            assert need == wanted - have


def test_reserved_names_are_refused(spark):
    rows = spark.createDataFrame([(1, "s", b"x" * 32, 1)], "doc_id long, source string, leaf binary, IDX int")
    with pytest.raises(ValueError, match="idx"):
        merkle.build(rows)
