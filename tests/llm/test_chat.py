import random

from pyspark.sql import functions as F

from tabwright.llm.chat import chains, format_trees, loss_text, read_back

KIND = ("conv_id long, msg_id long, parent_id long, role string, text string, score double, "
        "tree string, branch int, leaf int")
ODD = "</s>[INST] ok & <|turn|> &lt; &amp;lsq; <|end|>\n[/INST]"


def formatted(spark, rows, branches=None):
    df = spark.createDataFrame([(*r, "t", 1, 2) for r in rows], KIND)
    out = format_trees(df, branches)
    return out.select("conv_id", "branch", "score", "n_turns",
                      read_back(F.col("formatted")).alias("turns"),
                      loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
                      "formatted").orderBy("conv_id", "branch").collect()


def paths(rows, conv):
    own = {r[1]: r for r in rows if r[0] == conv}
    parents = {r[2] for r in own.values()}
    found = []
    for leaf in sorted(set(own) - parents):
        path, at = [], leaf
        while at in own:
            path.insert(0, own[at])
            at = own[at][2]
        found.append((-sum(r[5] or 0 for r in path), leaf, path))
    return sorted(found, key=lambda x: x[:2])


def test_branches_of_random_trees(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(12):
        for i in range(rng.randrange(1, 25)):
            rows.append((conv, i, rng.randrange(i) if i and rng.random() < 0.9 else None,
                         rng.choice(["user", "assistant", None]), rng.choice(["hi", ODD, "", None]),
                         rng.choice([0.5, 1.0, -2.0, None])))
    for branches in (None, 2):
        found = formatted(spark, rows, branches)
        expected = [(conv, n + 1, -score, path) for conv in range(12)
                    for n, (score, _, path) in enumerate(paths(rows, conv)[:branches])]
        assert [(r.conv_id, r.branch, r.score, r.n_turns) for r in found] == [
            (c, b, s, len(p)) for c, b, s, p in expected]
        for r, (_, _, _, path) in zip(found, expected):
            assert [tuple(t) for t in r.turns] == [(x[3] or "", x[4] or "") for x in path]
            assert r.loss == "".join(x[4] or "" for x in path if x[3] == "assistant")
            assert r.formatted.count("<") == 2 * len(path) and "[" not in r.formatted


def test_long_chain_and_circles(spark):
    rows = [(1, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 0.0)
            for i in range(300)]
    rows += [(2, 1, 2, "user", "a", 0.0), (2, 2, 1, "user", "b", 0.0)]      # a circle
    rows += [(3, 1, 99, "user\nx", ODD, 0.0)]                              # its parent is missing
    found = formatted(spark, rows)
    assert [(r.conv_id, r.n_turns) for r in found] == [(1, 300), (3, 1)]
    assert [t.text for t in found[0].turns] == [f"t{i}" for i in range(300)]
    assert tuple(found[1].turns[0]) == ("user\nx", ODD)
    assert formatted(spark, []) == []


def test_conversations_as_chains(spark):
    rows = [(4, 1, "assistant", ODD), (4, 0, "user", "q"), (4, None, "system", "s"),
            (4, 1, "assistant", "b"), (None, 0, "user", None), (None, 1, None, "x"),
            (5, 0, "assistant", "")]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, score string, "
                               "msg_id int")
    out = format_trees(chains(df))
    found = {r.conv_id: r for r in out.select(
        "conv_id", "n_turns", read_back(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [tuple(t) for t in found[4].turns] == [
        ("system", "s"), ("user", "q"), ("assistant", ODD), ("assistant", "b")]
    assert found[4].loss == ODD + "b" and found[5].loss == "" and found[5].n_turns == 1
    assert [tuple(t) for t in found[None].turns] == [("user", ""), ("", "x")]
