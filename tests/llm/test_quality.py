import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tabwright.llm.quality import MEASURES, RULES, covered_words, judge, ranked_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(8)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def texts():
    rng = random.Random(4)
    words = ["alpha", "béta", "#tag", "$5", "x", "中文", "<b>"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(60)]
    made += ["a " * 9, "a " * 8, "a b c d e f g h " * 2, "one two three four five six seven eight "
             "nine one two three four five six seven eight", "same line\nsame line\n\n \nother",
             "x\ty\x0bz\x0cq\rw\xa0v u", "w" * 3000 + " end", "*** " * 30,
             " ".join(f"word{i}" for i in range(20_000))]
    return made + [None, "", " \n\t "]


def test_measures_match_brute_force(make_docs):
    rows = list(enumerate(texts()))
    found = {r.doc_id: r for r in judge(make_docs(rows), RULES, report=True).collect()}
    for i, text in rows:
        expected = brute(text)
        assert {m: found[i][m] for m in MEASURES} == expected, text[:80] if text else text
        passed = not (expected["n_words"] < 20
                      or 100 * expected["n_repeat_words"] > 30 * expected["n_words"]
                      or 100 * expected["n_symbols"] > 30 * expected["word_chars"]
                      or 100 * expected["n_dup_lines"] > 60 * expected["n_lines"]
                      or expected["word_chars"] > 40 * expected["n_words"])
        assert found[i].kept is passed


def test_order_changes_no_verdict(make_docs):
    df = make_docs(list(enumerate(texts())) + [(None, "again"), (7, "again"), (7, "again")])
    ranked = ranked_rules(df)
    assert {r for r, _, _ in ranked} == set(RULES)
    assert all(cost > 0 and 0 <= share <= 1 for _, cost, share in ranked)
    rates = [share / cost for _, cost, share in ranked]
    assert rates == sorted(rates, reverse=True)

    def verdicts(**how):
        return sorted((str(r.doc_id), r.kept) for r in judge(df, **how).collect())

    assert verdicts() == verdicts(rules=RULES) == verdicts(rules=RULES[::-1], report=True)
    named = judge(df, RULES).where("doc_id = 7").collect()
    assert {r.failed for r in named if not r.kept} == {"few_words"}


def test_empty_table(make_docs):
    assert judge(make_docs([])).collect() == []


def test_windows_are_told_apart_by_all_bits_of_their_hashes(spark):
    rows = [([8, 9, 10, 11, 1000],), ([8, 9, 8, -1, -2],)]
    found = spark.createDataFrame(rows, "w array<long>").select(covered_words(F.col("w"))).collect()
    assert [r[0] for r in found] == [0, 10]
