import os
import shutil

import pytest

import corpus_pipeline as P
from tabwright.llm import decontaminate, pii, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of the small table with odd rows and extra columns, and its other tables."""
    source, made = "/root/testdata/sf0.001", str(tmp_path_factory.mktemp("sf"))
    for name in ("labels", "benchmark"):
        shutil.copy(f"{source}/{name}.parquet", made)
    docs = spark.read.parquet(f"{source}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    leak = spark.read.parquet(f"{source}/benchmark.parquet").first().text
    extra = [(9001, "plain words that say little but are here for a test of rows", "en", "s", 1),
             (9001, "plain words that say little but are here for a test of rows", "en", "s", 1),
             (9002, None, "en", "s", None), (9003, "", None, None, 0),
             (None, "a row without a number that no other row repeats", "en", "s", 3),
             (None, "a row without a number that no other row repeats", "en", "s", 3),
             (9004, f"Before it. {leak} After it.", "en", "s", 9),
             (9005, "write to jane (at) example (dot) org or +1 234 567 8901 soon", "en", "s", 9)]
    spark.createDataFrame([(*r, "n", 1) for r in rows + extra],
                          "doc_id long, text string, lang string, source string, n_chars long, "
                          "found string, toxicity int").write.parquet(f"{made}/documents.parquet")
    return made


def test_stages_in_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, steps = docs.columns, []
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns, name
        steps.append([(r.doc_id, r.text) for r in docs.collect()])
    start = [(r.doc_id, r.text) for r in spark.read.parquet(
        f"{folder}/documents.parquet").collect()]
    calm, once, clean, hidden = steps
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.learn(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    scores = model.scores([t for _, t in start])
    assert sorted(calm, key=str) == sorted(
        [r for r, s in zip(start, scores) if s < toxicity.THRESHOLD], key=str)
    from tests.llm.test_ngram_join import brute_groups, brute_set
    known = [r for r in calm if r[0] is not None]
    groups = {d: c for d, _, c in brute_groups(known)}
    expected = {int(d) for d, c in groups.items() if d == c}
    assert sorted(d for d, _ in once if d is not None) == sorted(expected)
    assert sum(d is None for d, _ in once) == 1 and (9002, None) in once and (9003, "") in once
    assert all(brute_set(t) for d, t in once if d is None)
    bench = decontaminate.compile_benchmark(
        [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()])
    assert sorted(clean, key=str) == sorted(
        [r for r in once if not decontaminate.matches(bench, r[1], 0.8)], key=str)
    assert 9004 in {d for d, _ in once} and 9004 not in {d for d, _ in clean}
    assert sorted(hidden, key=str) == sorted(
        [(d, pii.redacted(t, pii.all_spans(t)) if t else t) for d, t in clean], key=str)
    assert (9005, "write to [EMAIL] or [PHONE] soon") in hidden


def test_rows_of_one_id_are_documents_of_their_own(spark, folder):
    first = " ".join(f"alpha{i}" for i in range(60))
    second = " ".join(f"omega{i}" for i in range(60))
    rows = [(1, first, {"a": 1}), (1, second, {}), (2, first + " end", {}), (3, second + " end", {}),
            (None, first, {}), (None, "nothing like the others at all", {}), (1, None, {}), (4, "", {}),
            (1, "", {})]
    kept = []
    for parts, order in ((1, rows), (3, rows[::-1])):
        docs = spark.createDataFrame(order, "doc_id long, text string, `a map` map<string, int>")
        docs = P.drop_near_copies(spark, docs.repartition(parts), folder)
        assert docs.columns == ["doc_id", "text", "a map"]
        kept.append(sorted(((r.doc_id, r.text) for r in docs.collect()), key=str))
    assert kept[0] == kept[1] == sorted(
        [(1, first), (1, second), rows[5][:2], (1, None), (4, ""), (1, "")], key=str)


def test_whole_run(spark, folder):
    found = P.run(spark, folder).collect()
    ends = sorted((r.sequence_id * 1024 + r.offset, r.length) for r in found)
    at = 0
    for start, length in ends:
        assert start == at
        at += length
    assert len({r.doc_id for r in found}) > 100


def test_empty_documents(spark, folder, tmp_path):
    for name in ("labels", "benchmark"):
        shutil.copy(os.path.join(folder, f"{name}.parquet"), tmp_path)
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(
        str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []
