"""Conversation repair against a sequential search over all edits; chunks, fix-ups, odd rows."""

import hashlib
import random
import zlib

import pytest

from tabwright.llm import repair
from tabwright.llm.queries import op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\f\r"


def damage(rows):
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        harm = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if harm == 1:
            text = ""
        elif harm == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        elif harm == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)


def cheapest(rows):
    """(cost, audit, lines) of the best repair, by the best prefix for every state."""
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def grow(best):
        for state in list(best) * 3:
            cost, audit, lines = best[state]
            to = follows[state]
            new = (cost + 5, audit + "I", (*lines, names[to] + ":"))
            best[to] = min(best.get(to, new), new)
        return best

    best = {"": (0, "", ())}
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in grow(best).items():
            options = [(state, 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role and state + role[0] in ("s", "u", "su", "ua", "au"):
                    options.append((role[:1], more, "K", (f"{role}:{text}",)))
                to = follows[state]
                options.append((to, more + 1, "R", (f"{names[to]}:{text}",)))
            for to, price, letter, line in options:
                new = (cost + price, audit + letter, lines + line)
                after[to] = min(after.get(to, new), new)
        best = after
    grow(best)
    return min(best[s] for s in ("", "a") if s in best)


def expected(original):
    out = []
    rows = list(damage(original))
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv),
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, marked = set(), []
        for _, _, role, text in own:
            last = text.rstrip(WHITE)[-1:]
            fault = ("blank" if not last else "duplicate" if (role, text) in seen
                     else "truncated" if last not in ".!?" else "")
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {r[1] for r in own if r[1] is not None}
        cost, audit, lines = cheapest(marked)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au")
                      for a, b in zip(marked, marked[1:]))
        faults = [f for _, _, f in marked]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def answer(spark, tmp_path, rows, extra=()):
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", *extra) \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    return sorted((tuple(r) for r in op13_conversation_repair(spark, str(tmp_path)).collect()), key=str)


def random_talks(rng, conversations, most):
    for conv in range(conversations):
        for turn in range(rng.randint(0, most)):
            role = rng.choice(("user", "assistant") * 6 + ("system", "tool", "", "sys", None))
            text = rng.choice(("Yes.", "No!", "Why?", "cut off", "", " \n", None, f"Text {turn}. ",
                               f"unfinished {turn}", f"more {turn} ok."))
            yield conv, rng.choice((turn, turn, turn + 1, None)), role, text


def test_random_conversations(spark, tmp_path):
    rows = list(random_talks(random.Random(1), 150, 12))
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho.")]
    assert answer(spark, tmp_path, rows, ["1 AS chunk", "'x' AS place", "2 AS edit"]) == expected(rows)


@pytest.mark.parametrize("chunk", [1, 2, 8])
def test_conversations_over_many_chunks(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows = list(random_talks(rng, 6, 60))
    # Rows that are cut off are all deleted: vectors do not converge there, and what comes last
    # decides what the first rows cost.
    rows += [(50, t, "user", f"cut {t}") for t in range(40)] + [(50, 40, "user", "Done.")]
    rows += [(51, t, "system", "Same.") for t in range(50)]
    rows += [(52, t, ("user", "assistant")[t % 2], f"All well {t}.") for t in range(64)]
    assert answer(spark, tmp_path, rows) == expected(rows)


def test_no_rows(spark, tmp_path):
    assert answer(spark, tmp_path, []) == []


def test_a_conversation_that_loses_all_rows(spark, tmp_path):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert answer(spark, tmp_path, [(lost, 0, "user", "Hi.")]) == [
        (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_texts_and_rows_of_one_turn(spark, tmp_path):
    long = "word " * 200_000
    rows = [(1, 0, "user", long + "end."), (1, 1, "assistant", long), (1, 1, "assistant", "b."),
            (1, 1, "assistant", "a."), (1, 2, "user", "." + " " * 300_000)]
    assert answer(spark, tmp_path, rows) == expected(rows)


def test_repaired_rows_are_the_turns_left(spark, sf):
    done = repair.repair(spark.read.parquet(f"{sf}/conversations.parquet"))
    turns = {}
    for r in sorted(done.rows.collect(), key=lambda r: (r.conv_id, r.chunk, r.number)):
        if r.edit != "D":
            turns.setdefault(r.conv_id, []).append(r.role)
    for roles in turns.values():
        roles = roles[roles[0] == "system":]
        assert roles and roles == ["user", "assistant"] * (len(roles) // 2)
    assert {r.conv_id: r.audit.count("D") for r in done.summary.collect() if "D" in r.audit} == {
        r.conv_id: r["count"] for r in done.rows.where("edit = 'D'").groupBy("conv_id").count()
        .collect()}


def test_vectors_of_an_end():
    assert repair.END == (0, 10, 5, 0)
    vector, cost, _ = repair.backwards([("u", 0), ("a", 0)] * 30, repair.END)
    other = repair.backwards([("u", 0), ("a", 0)] * 30, (0, 3, -4, 2))[0]
    assert cost == 0 and vector == other  # rank convergence
