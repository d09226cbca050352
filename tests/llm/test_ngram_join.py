import random
import re

import numpy as np
import pytest

from tabwright.llm import ngram_join as N


def brute_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_groups(rows):
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same = rows[i][0] == rows[j][0] and rows[i][0] is not None
            if a and b and (same or 100 * len(a & b) >= 80 * len(a | b)):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if sets[i] and doc_id is not None:
            root = find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted((str(d), len(sets[i]), str(least.get(find(i), d) if sets[i] else d))
                  for i, (d, _) in enumerate(rows))


def found_groups(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id))
                  for r in N.similar_groups(df).collect())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(["new", "odd", "words", "put"])
    return words


def family(rng, size, members, edits):
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40)) for _ in range(size)]
    return [" ".join(edited(rng, base, rng.randrange(edits + 1))) for _ in range(members)]


def test_matches_brute_force(make_docs):
    rng = random.Random(5)
    passage = [f"shared{i}" for i in range(60)]
    texts = [t for _ in range(6) for t in family(rng, 120, 8, 3)]
    texts += family(rng, 150, 40, 2)                                   # a large group
    texts += [" ".join(passage + edited(rng, passage[:25], 12)) for _ in range(25)]
    texts += [t.upper() for t in texts[:5]] + ["short one", "Short\tone", "a b c d e", "x"] * 2
    texts += [None, "", " \n\t", "long " * 5000]
    rng.shuffle(texts)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    assert found_groups(make_docs(rows)) == brute_groups(rows)


@pytest.mark.parametrize("block,long", [(3, 0.7), (1 << 16, 0.3), (10, 0.79)])
def test_lists_in_blocks_and_other_numbers_of_long_lists(make_docs, monkeypatch, block, long):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "LONG", long)
    monkeypatch.setattr(N, "LEAST_COUNT", 2)
    rng = random.Random(block)
    passage = [f"shared{i}" for i in range(80)]
    texts = [" ".join(passage + [f"w{rng.randrange(500)}" for _ in range(rng.randrange(8, 24))])
             for _ in range(60)]
    texts += [t for size in (8, 40, 90) for t in family(rng, size, 20, 4)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found_groups(make_docs(rows)) == brute_groups(rows)


def test_every_member_is_told_of_smaller_ones_of_other_groups():
    rng = random.Random(4)
    for count in (2, 5, N.FEW, N.FEW + 30):
        members = [(rng.randrange(50, 90), n, rng.randrange(4), rng.randrange(2))
                   for n in range(count)]
        for both in (False, True):
            pairs = [tuple(sorted((x, y))) for x, _, found, _ in
                     N.smaller_members(list(members), both) for y in found]
            assert sorted(pairs) == sorted(
                (a, b) for a in range(count) for b in range(a + 1, count)
                for (p, _, g, i), (q, _, h, j) in [(members[a], members[b])]
                if g != h and 5 * min(p, q) >= 4 * max(p, q) and (not both or i != j))


def test_long_texts_link(make_docs):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(200_000)]
    near, far = list(words), list(words)
    near[1000:21000], far[1000:60000] = ["x"], ["y"]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))]
    found = {r.doc_id: r.component_id for r in N.similar_groups(make_docs(rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


def test_repeated_and_null_ids(make_docs):
    one, two = "a b c d e f g", "p q r s t u v"
    rows = [(5, one), (5, one), (5, two), (9, two), (None, one), (None, "no other text at all"),
            (3, None), (3, "")]
    found = {(r.doc_id, r.n_shingles, r.component_id)
             for r in N.similar_groups(make_docs(rows)).collect()}
    assert found == {(5, 3, 5), (9, 3, 5), (None, 3, 5), (None, 1, None), (3, 0, 3)}


def test_empty_table(make_docs):
    assert N.similar_groups(make_docs([])).collect() == []


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    for _ in range(300):
        size = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        cut = a[rng.random(len(a)) > rng.random() * 0.3]
        more = rng.integers(0, 1 << 63, int(rng.integers(0, 40))).astype(np.uint64)
        b = np.unique(np.concatenate([cut, more]))
        if not len(b):
            continue
        both = N.shared(a, b)
        links = 100 * both >= 80 * (len(a) + len(b) - both)
        assert both == len(np.intersect1d(a, b))
        assert links == (both >= N.needed(len(a), len(b)))
        if links:
            assert N.may_link(N.bitmap(a), len(a), N.bitmap(b), len(b))


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
    [(i, 50 - i) for i in range(20)] + [(i, i + 5) for i in range(20)], []])
def test_components(spark, edges):
    found = {r.node: r.component for r in N.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert found == label
