import zlib

import numpy as np

from tabwright.llm import toxicity as T


def test_learns_from_positives_and_unlabelled_rows():
    rng = np.random.default_rng(1)

    def rows(n, toxic):
        return [np.unique(np.append(rng.integers(0, 400, 30), rng.integers(1000, 1004, 2)
                                    if toxic else [])).astype(np.int32) for _ in range(n)]

    kept, weights = T.fit_nnpu(rows(200, True), rows(900, False) + rows(100, True), 0.1,
                               T.Learning())
    model = T.Model(kept, weights[:-1], float(weights[-1]))
    assert set(kept) >= set(range(1000, 1004))

    def sums(found):
        return np.array([weights[:-1][np.isin(kept, r)].sum() + model.bias for r in found])

    assert (sums(rows(200, True)) > 0).mean() > 0.9
    assert (sums(rows(200, False)) > 0).mean() < 0.05


def test_words_of_a_small_language_are_features():
    rng = np.random.default_rng(5)

    def rows(n, low, word=None):
        return [np.unique(np.append(rng.integers(low, low + 300, 20), [] if word is None else word))
                .astype(np.int32) for _ in range(n)]

    positives = rows(985, 0, 5000) + rows(15, 1000, 6000)
    unlabelled = rows(2700, 0) + rows(260, 1000) + rows(40, 0, 5000)
    kept, weights = T.fit_nnpu(positives, unlabelled, 0.1, T.Learning())
    assert {5000, 6000} <= set(kept)
    found = [weights[:-1][np.isin(kept, r)].sum() + weights[-1] > 0 for r in positives]
    assert np.mean(found[-15:]) == 1 and np.mean(found[:-15]) > 0.9


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = T.learn(docs, labels)
    scored = T.score(docs.join(labels, "doc_id").select("doc_id", "text", "toxic"), model)
    tested = scored.where(T.held_out(scored.doc_id)).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in tested)
    toxic = np.array([r.toxic == 1 for r in tested])
    score = np.array([r.score for r in tested])
    ranks = np.argsort(np.argsort(score))
    area = (ranks[toxic].mean() - (toxic.sum() - 1) / 2) / (~toxic).sum()
    found = score >= T.THRESHOLD
    assert area > 0.94
    assert (found & toxic).sum() / toxic.sum() > 0.75
    assert (found & toxic).sum() / found.sum() > 0.8


def test_labels_of_held_out_rows_are_not_read(spark, make_docs):
    rows = [(i, "bad words here" if i % 2 else "good words there") for i in range(60)]
    docs = make_docs(rows)
    open_rows = [(i, i % 2) for i, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    closed = [(i, 1 - i % 2) for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    kind = "doc_id long, toxic int"
    a = T.learn(docs, spark.createDataFrame(open_rows, kind))
    b = T.learn(docs, spark.createDataFrame(open_rows + closed, kind))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_odd_rows(spark, make_docs):
    labels = spark.createDataFrame([(0, 1), (0, 1), (2, None), (None, 1), (3, 0)],
                                   "doc_id long, toxic int")
    docs = make_docs([(0, "bad bad"), (0, "bad bad"), (None, "bad"), (3, None), (4, ""),
                      (5, "word " * 30_000)])
    scored = T.score(docs, T.learn(docs, labels), "toxicity")
    assert set(scored.columns) == set(docs.columns)
    found = scored.collect()
    assert len(found) == 6 and all(0 <= r.toxicity <= 1 for r in found)
    empty = T.score(make_docs([]), T.learn(make_docs([]), labels))
    assert empty.collect() == []
    none = T.learn(docs, labels.where("toxic = 0"))
    assert {r.score < 1e-9 for r in T.score(docs, none).collect()} == {True}
