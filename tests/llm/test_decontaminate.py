import random

import numpy as np
import pytest

from tabwright.llm import decontaminate as D


def prose(rng, n):
    return [rng.choice("abcdefgh") + rng.choice("uvwxyz") + str(rng.randrange(30)) for _ in range(n)]


def brute(bench, text, similar):
    found = D.shingle_hashes(D.word_hashes(text))
    best = {}
    for k, item in enumerate(bench.items):
        span = max(1, int(bench.sizes[k]) - D.SHINGLE + 1)
        like = max((D.similarity(bench, found[i:i + span], k)
                    for i in range(max(1, len(found) - span + 1))), default=0)
        if like >= similar:
            best[item] = like
    return best


def test_matches_brute_force():
    rng = random.Random(2)
    items = [(i, " ".join(prose(rng, rng.randrange(3, 60)))) for i in range(40)]
    items.append((40, items[3][1] + " and more words here"))
    bench = D.compile_benchmark(items)
    for _ in range(150):
        words = items[rng.randrange(41)][1].split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "other"
        words = words[rng.randrange(3):]
        text = " ".join(prose(rng, rng.randrange(30)) + words + prose(rng, rng.randrange(30)))
        found = {m[0]: m[1] for m in D.matches(bench, text, 0.8)}
        assert found == pytest.approx(brute(bench, text, 0.8))


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(3)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 500, 20))) for i in range(60)]
    bench = D.compile_benchmark(items)
    prints = bench.prints.copy()
    for row in range(len(prints)):
        for bit in rng.choice(64, int(rng.integers(0, 30)), replace=False):
            prints[row] ^= np.uint64(1) << np.uint64(bit)
    found = {(w, i) for w, i, _ in D.candidates(bench, prints, np.ones(60, bool))}
    apart = np.bitwise_count(prints[:, None] ^ bench.prints[None, :])
    assert found == set(zip(*(x.tolist() for x in np.nonzero(apart <= D.RADIUS))))


@pytest.mark.parametrize("at_once", [50_000, 2])
def test_rows(spark, make_docs, monkeypatch, at_once):
    monkeypatch.setattr(D, "ITEMS_AT_ONCE", at_once)
    rng = random.Random(9)
    texts = [" ".join(prose(rng, 40)) for _ in range(4)]
    benchmark = spark.createDataFrame(
        [(0, texts[0], 1), (1, texts[1], 1), (1, texts[1], 1), (2, None, 1), (3, "", 1),
         (None, texts[2], 1), (5, "only three words", 1)], "item_id long, text string, doc_id int")
    other = " ".join(prose(rng, 60))
    rows = [(1, f"{other} {texts[0]}, {other}"), (1, texts[0].upper()), (2, other), (3, None),
            (4, ""), (None, texts[1]), (5, f"x {texts[2]}"), (6, "Only three words."),
            (7, other + " " + "long " * 20_000 + texts[1])]
    df = make_docs(rows)
    found = D.find_benchmark(df, benchmark).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in found) == sorted(
        [("1", "0"), ("1", "0"), ("None", "1"), ("None", "1"), ("5", "None"), ("6", "5"),
         ("7", "1"), ("7", "1")])
    exact = [r for r in found if r.doc_id == 1]
    assert {r.hamming for r in exact} == {0} and {r.similarity for r in exact} == {1.0}
    assert {rows[0][1][r.start:r.end] for r in exact if r.start} == {f"{texts[0]},"}
    marked = D.mark_benchmark(df, benchmark, "matches")
    assert marked.columns == [*[c for c in df.columns if c != "matches"], "matches"]
    assert D.find_benchmark(make_docs([]), benchmark).collect() == []
    assert D.find_benchmark(df, benchmark.limit(0)).collect() == []


def test_passes_change_no_similarity(spark, make_docs, monkeypatch):
    rng = random.Random(6)
    common = [prose(rng, 14) for _ in range(3)]
    items = [(i, prose(rng, 12) + common[i % 3] + prose(rng, 12) + common[(i + 1) % 3])
             for i in range(12)]
    benchmark = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in items] + [(12, None), (13, " "), (14, " ".join(items[5][1]))],
        "item_id long, text string")
    rows = []
    for i, words in items:
        for at in (2, 20, 45, None):
            edited = list(words)
            if at is not None:
                edited[at] = "other"
            # A passage of other items in place of an own one counts by its global weight.
            rows.append((i, " ".join(prose(rng, 20) + edited + prose(rng, 20))))
            rows.append((i, " ".join(edited[:-5] + common[(i + 2) % 3][:5])))
    df = make_docs(rows)
    found = {}
    for at_once in (50_000, 2):
        monkeypatch.setattr(D, "ITEMS_AT_ONCE", at_once)
        found[at_once] = sorted(map(tuple, D.find_benchmark(df, benchmark, 0.6).collect()))
    assert len(found[2]) > 40 and min(r[2] for r in found[2]) < 0.9
    assert found[2] == found[50_000]


def test_short_items_are_found_inside_longer_texts():
    bench = D.compile_benchmark([(1, "Two words"), (2, "one more short item"), (3, "two words!"),
                                 (4, " ".join(prose(random.Random(1), 30)))])
    text = "A long text has two, words in it, and Two words again; one more short item."
    found = D.matches(bench, text, 0.8)
    assert [(m[0], m[1], m[2]) for m in found] == [(1, 1.0, 0), (2, 1.0, 0), (3, 1.0, 0)]
    assert [text[slice(*D.source_span(text, *m[3:]))] for m in found] == [
        "two, words", "one more short item.", "two, words"]
    assert D.matches(bench, "words two one more short", 0.8) == []
    assert [m[0] for m in D.matches(bench, "two words", 0.8)] == [1, 3]


def test_no_pair_that_reaches_the_limit_is_beyond_the_radius():
    rng = random.Random(12)
    pool = [f"pool{i}" for i in range(400)]
    items = []
    for i in range(400):  # passages that many items share, so that an edit weighs most
        start = 20 * rng.randrange(8)
        items.append((i, " ".join(pool[start:start + 100] + [f"own{i}"])))
    bench = D.compile_benchmark(items)
    for i, text in items:
        words = text.split()
        words[rng.randrange(100)] = f"other{i}"
        found = {m[0]: m[1] for m in D.matches(bench, " ".join(words), 0.8)}
        own = D.similarity(bench, D.shingle_hashes(D.word_hashes(" ".join(words))), i)
        assert own < 0.8 or i in found
