"""Conversation structure repair: the cheapest edits that make turns alternate, by parallel Viterbi.

A conversation must read ``(system? (user assistant)+)?``. Its rows may be kept (0), given the other
role (1) or deleted (2, required for blank rows and copies); a row cut off in the middle adds 5 unless
deleted; an empty turn may be inserted anywhere (5). Between two rows a repair is in one of four states
(nothing yet, after the system's turn, after a user's, after an answer), and a *cost vector* holds what
the rest costs from each of them.

Rows are sorted over ranges and cut into chunks of at most CHUNK rows, so that a conversation of any
length is worked on by many tasks (rank-convergence parallel Viterbi):

- Every chunk runs backwards from a speculative vector, that of a conversation's end.
- A chunk is right if its speculative vector and the one its successor came to differ by a constant
  only: all decisions are then the same. Where they differ by more, a *fix-up pass* runs it again.
  A pass takes blocks of neighbours, twice as many each time, so there are never more passes than
  doublings, also where vectors do not converge (as among rows that are all deleted).
- What the chunks' own parts cost adds up to the cost of the conversation.
- With the stitched vectors every chunk traces the least audit from each of the states it may be
  entered in; a scan over the chunks picks the one that holds. Only letters and states are scanned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.scratch import materialise
from tabwright.llm.common import part_count, slices

#: Rows of a chunk at most (a power of two).
CHUNK = 1 << 12
#: Leading characters of a text that order rows of one turn and role.
ORDER_CHARS = 64
#: White space, ends of a whole sentence, faults in the order in which they count.
WHITE, ENDS = " \t\n\x0b\f\r", (".", "!", "?")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: Costs of the edits.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5

EMPTY, SYSTEM, USER, ANSWER = range(4)
#: The role that an edit may put after each state, and the state that follows.
FOLLOWS = (USER, USER, ANSWER, USER)
ROLE_OF = {USER: "user", ANSWER: "assistant"}
#: States from which a kept row with this initial may follow, and the state that it leads to.
KEPT = {"s": ((EMPTY,), SYSTEM), "u": ((EMPTY, SYSTEM, ANSWER), USER), "a": ((USER,), ANSWER)}
LEGAL_PAIRS = frozenset(("su", "ua", "au"))

#: Edits of one row: those inserted before it, its own, and after the last row those that follow.
ROW_EDITS = re.compile("I*[DKR](?:I+$)?")

Vector = tuple[int, ...]


def with_inserts(costs: Vector) -> Vector:
    """The same costs where up to two empty turns may come first."""
    once = tuple(costs[FOLLOWS[s]] + INSERT for s in range(4))
    return tuple(min(costs[s], once[s], once[FOLLOWS[s]] + INSERT) for s in range(4))


#: What is left to do at the end of a conversation: add an answer, or a turn and an answer.
END = with_inserts((0, 1 << 40, 1 << 40, 0))


def edits(after: Vector, initial: str, fault: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a row in a state: letter, cost with all that follows, next state; by letter."""
    yield "D", DELETE + after[state], state
    if fault in (BLANK, DUPLICATE):
        return
    extra = CUT_OFF if fault == TRUNCATED else 0
    before, leads = KEPT.get(initial, ((), EMPTY))
    if state in before:
        yield "K", extra + after[leads], leads
    yield "R", REROLE + extra + after[FOLLOWS[state]], FOLLOWS[state]


@lru_cache(1 << 16)
def step(after: Vector, initial: str, fault: int) -> tuple[Vector, int, tuple]:
    """One row backwards: the vector before it less its first entry, that entry, and for every state
    the least letters that attain it and the state they lead to. ``after`` begins with 0."""
    costs = with_inserts(tuple(min(c for _, c, _ in edits(after, initial, fault, s))
                               for s in range(4)))
    choices = []
    for state in range(4):
        letters, choice = "", None
        while choice is None:
            options = [*edits(after, initial, fault, state),
                       ("I", INSERT + costs[FOLLOWS[state]], FOLLOWS[state])]
            letter, _, to = min(o for o in options if o[1] == costs[state])
            letters, state = letters + letter, to
            if letter != "I":
                choice = (letters, state)
        choices.append(choice)
    return tuple(c - costs[0] for c in costs), costs[0], tuple(choices)


def backwards(rows: list[tuple[str, int]], after: Vector) -> tuple[Vector, int, list]:
    """All rows (initial, fault) from the last to the first: vector, cost, choices by row."""
    total, choices = 0, []
    for initial, fault in reversed(rows):
        after, grown, choice = step(after, initial, fault)
        total += grown
        choices.append(choice)
    return after, total, choices[::-1]


def trace(choices: list, state: int, last: bool) -> tuple[str, int]:
    """Letters from a state over the rows, and the state after them; the last chunk ends well."""
    letters = []
    for choice in choices:
        put, state = choice[state]
        letters.append(put)
    while last and state in (SYSTEM, USER):
        letters.append("I")
        state = FOLLOWS[state]
    return "".join(letters), state


def in_order(talks: DataFrame) -> DataFrame:
    """Rows with ``place``: by conversation and turn (nulls first); rows of one turn by role, first
    characters, hash of the text and text. Equal rows may spread over several ranges."""
    rows = talks.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumns({
        "opening": F.substring("text", 1, ORDER_CHARS), "text_hash": F.xxhash64("text"),
        "salt": F.monotonically_increasing_id()})
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "opening", "text_hash")]
    return (rows.repartitionByRange(part_count(rows), *order, F.col("salt"))
            .sortWithinPartitions(*order, "text", "salt")
            .select("conv_id", "turn", "role", "text",
                    F.monotonically_increasing_id().alias("place")))


def marked(rows: DataFrame) -> DataFrame:
    """Narrow rows with ``chunk``, the role's ``initial`` and the first ``fault`` (0: none)."""
    text = F.rtrim("text", F.lit(WHITE))
    narrow = rows.select(
        "conv_id", "place", F.substring("role", 1, 1).alias("initial"),
        F.when(text == "", BLANK).when(~F.right(text, F.lit(1)).isin(*ENDS), TRUNCATED)
        .otherwise(0).alias("fault"),
        F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)).alias("said"))
    narrow = materialise(narrow, "repair-said")
    # The first row of each role and text: keys of copies meet as partial minima only, and the join is
    # on the unique place, so many copies of one row are not one hot key.
    first = (narrow.groupBy("conv_id", "said").agg(F.min("place").alias("place"))
             .select("place", F.lit(True).alias("first")))
    return narrow.join(first, "place", "left").select(
        "conv_id", F.shiftright("place", CHUNK.bit_length() - 1).alias("chunk"), "place", "initial",
        F.when(F.col("first").isNull() & (F.col("fault") != BLANK), DUPLICATE)
        .otherwise(F.col("fault")).alias("fault"))


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
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


def batch_of(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def emit(rows: Iterator[tuple], names: list[str],
         types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 512:
            yield batch_of(held, names, types)
            held = []
    yield batch_of(held, names, types)


LONG, TEXT, VECTOR = pa.int64(), pa.string(), pa.list_(pa.int64())
STATE = "conv_id long, chunk long, after array<long>, before array<long>, cost long"
STATE_NAMES, STATE_TYPES = ["conv_id", "chunk", "after", "before", "cost"], \
    [LONG, LONG, VECTOR, VECTOR, LONG]


def speculate(marks: DataFrame) -> DataFrame:
    """First run of every chunk of a conversation, each from the vector of an end; also its first and
    last initial and the illegal neighbours inside."""
    def run(batches):
        def rows():
            for (chunk, conv), found in runs(batches, 2):
                vector, cost, _ = backwards([(i, f) for _, i, f in found], END)
                roles = [i for _, i, _ in found]
                illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(roles, roles[1:]))
                yield conv, chunk, END, vector, cost, roles[0], roles[-1], illegal
        return emit(rows(), [*STATE_NAMES, "first", "last", "illegal"],
                    [*STATE_TYPES, TEXT, TEXT, LONG])

    return by_chunk(marks, []).mapInArrow(run, STATE + ", first string, last string, illegal long")


def by_chunk(marks: DataFrame, further: list[str]) -> DataFrame:
    return (marks.repartition(part_count(marks), "chunk").sortWithinPartitions("chunk", "place")
            .select("chunk", "conv_id", *further, "place", "initial", "fault"))


def matched(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join on equal keys, of which null is one value like others."""
    other = right.select(*[F.col(c).alias(f"other_{c}" if c in keys else c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in keys]
    return left.join(other, on, how).drop(*[f"other_{c}" for c in keys])


def fix_up(marks: DataFrame, state: DataFrame) -> DataFrame:
    """Vectors of chunks of conversations with several, corrected until each chunk's ``after`` is
    its successor's ``before``. ``state`` holds ``number``, the chunk's number in its conversation."""
    order = Window.partitionBy("conv_id").orderBy("number")
    end, width = F.array(*map(F.lit, END)).cast("array<long>"), 1
    while True:
        linked = materialise(state.withColumn("want", F.coalesce(
            F.lead("before").over(order), end)), "repair-linked")
        if linked.where("want <> after").isEmpty():
            return linked.drop("want")
        linked = linked.withColumn("block", F.floor(F.col("number") / width))
        stale = (linked.groupBy("conv_id", "block")
                 .agg(F.bool_or(F.col("want") != F.col("after")).alias("stale"),
                      F.max_by("want", "number").alias("start")).where("stale").drop("stale"))
        again = matched(linked.select("conv_id", "block", "chunk", "number"), stale,
                        "conv_id", "block")
        rows = matched(marks, again, "conv_id", "chunk").select(
            "conv_id", "block", "start", "chunk", "number", "place", "initial", "fault")
        ran = (rows.repartition(part_count(rows), "conv_id", "block")
               .sortWithinPartitions("conv_id", "block", F.desc("place"))
               .mapInArrow(run_again, f"{STATE}, number long"))
        kept = matched(linked, stale, "conv_id", "block", how="left_anti")
        state = kept.select(*STATE_NAMES, "number").unionByName(ran)
        width *= 2


def run_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of chunks, each from its last row to its first, from the block's ``start``."""
    def rows():
        owner = vector = None
        for (conv, block, start, chunk, number), found in runs(batches, 5):
            if (conv, block) != owner:
                owner, vector = (conv, block), tuple(start)
            after = vector
            vector, cost, _ = backwards([(i, f) for _, i, f in reversed(found)], after)
            yield conv, chunk, after, vector, cost, number

    return emit(rows(), [*STATE_NAMES, "number"], [*STATE_TYPES, LONG])


@dataclass
class Repaired:
    """``summary``: a row per conversation; ``rows``: the repaired turns and the deleted ones."""

    summary: DataFrame
    rows: DataFrame


def traced(marks: DataFrame, state: DataFrame) -> DataFrame:
    """Least audits: ``conv_id``, ``chunk``, the state ``entry`` and the ``letters`` from it."""
    order = Window.partitionBy("conv_id").orderBy("number")
    ends = state.select("conv_id", "chunk", "after", (F.col("number") == 0).alias("opens"),
                        F.lead("number").over(order).isNull().alias("closes"))
    rows = matched(marks, ends, "conv_id", "chunk", how="left")

    def run(batches):
        def rows():
            for (chunk, conv, after, opens, closes), found in runs(batches, 5):
                vector = tuple(after) if after else END
                choices = backwards([(i, f) for _, i, f in found], vector)[2]
                for entry in range(4) if opens is False else (EMPTY,):
                    letters, leave = trace(choices, entry, closes is not False)
                    yield conv, chunk, entry, leave, letters, after is None
        return emit(rows(), ["conv_id", "chunk", "entry", "leave", "letters", "whole"],
                    [LONG, LONG, pa.int32(), pa.int32(), TEXT, pa.bool_()])

    found = materialise(by_chunk(rows, ["after", "opens", "closes"]).mapInArrow(
        run, "conv_id long, chunk long, entry int, leave int, letters string, whole boolean"),
        "repair-traces")

    def pick(batches):
        def rows():
            conv, state = object(), EMPTY
            for (now, chunk), options in runs(batches, 2):
                state = EMPTY if now != conv else state
                conv = now
                entry, leave, letters = next(o for o in options if o[0] == state)
                yield now, chunk, entry, letters
                state = leave
        return emit(rows(), ["conv_id", "chunk", "entry", "letters"], [LONG, LONG, pa.int32(), TEXT])

    several = (found.where("not whole").repartition(part_count(found), "conv_id")
               .sortWithinPartitions("conv_id", "chunk")
               .select("conv_id", "chunk", "entry", "leave", "letters")
               .mapInArrow(pick, "conv_id long, chunk long, entry int, letters string"))
    return materialise(found.where("whole").select("conv_id", "chunk", "entry", "letters")
                       .unionByName(several), "repair-letters")


def edited(rows: DataFrame, letters: DataFrame) -> DataFrame:
    """Turns after the edits, in the order of ``chunk`` and ``number``: ``conv_id``, ``edit``
    (K, R, I or D), ``role`` and ``text``; deleted rows (D) as they were."""
    nothing = F.lit(None).cast("string")
    both = rows.select(
        "conv_id", F.shiftright("place", CHUNK.bit_length() - 1).alias("chunk"), "place",
        F.lit(0).alias("entry"), nothing.alias("letters"), "role", "text").unionByName(
        letters.select("conv_id", "chunk", F.lit(-1).cast("long").alias("place"), "entry", "letters",
                       nothing.alias("role"), nothing.alias("text")))

    def run(batches):
        def rows():
            for batch in slices(batches):
                for conv, chunk, place, entry, letters, role, text in zip(
                        *(c.to_pylist() for c in batch.columns)):
                    if letters is not None:
                        state, number, puts = entry, 0, iter(ROW_EDITS.findall(letters))
                        continue
                    for edit in next(puts):
                        if edit == "K":
                            state = KEPT[role[:1]][1]
                        elif edit != "D":
                            state = FOLLOWS[state]
                        new = edit in "IR"
                        yield (conv, chunk, number, edit, ROLE_OF[state] if new else role,
                               "" if edit == "I" else text)
                        number += 1
        return emit(rows(), ["conv_id", "chunk", "number", "edit", "role", "text"],
                    [LONG, LONG, LONG, TEXT, TEXT, TEXT])

    return (both.repartition(part_count(rows), "conv_id", "chunk")
            .sortWithinPartitions("conv_id", "chunk", "place")
            .mapInArrow(run, "conv_id long, chunk long, number long, edit string, role string, "
                             "text string"))


def repair(talks: DataFrame) -> Repaired:
    """Faults, the cheapest repair and the repaired turns of every conversation.

    ``talks`` holds ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored. A null
    role or text counts as one space. A null ``conv_id`` is a conversation. Rows go by turn, nulls
    first; rows of one turn by role and text (those that share their first 64 characters by a hash).
    Repeated rows are duplicates after the first. An empty table gives no rows.

    ``summary``: ``conv_id``, ``gaps`` (missing turn numbers), ``blank``, ``duplicate``, ``truncated``
    (rows by their first fault), ``illegal`` (neighbours other than su, ua, au), ``cost`` and
    ``audit``, the letters of the edits, of the cheapest the least in ASCII. ``rows``: see `edited`.
    """
    rows = materialise(in_order(talks), "repair-rows")
    marks = materialise(marked(rows), "repair-marks")
    chunks = materialise(speculate(marks), "repair-chunks")
    order = Window.partitionBy("conv_id").orderBy("chunk")
    numbered = chunks.select(
        "*", (F.row_number().over(order) - 1).cast("long").alias("number"),
        F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("parts"),
        (F.col("illegal") + F.when(F.concat(F.lag("last").over(order), "first").isin(*LEGAL_PAIRS), 0)
         .otherwise(F.lag("last").over(order).isNotNull().cast("int"))).alias("all_illegal"))
    numbered = materialise(numbered, "repair-numbered")
    state = numbered.where("parts > 1").select(*STATE_NAMES, "number")
    state = fix_up(marks, state)
    letters = traced(marks, state)
    costs = (numbered.where("parts = 1").select("conv_id", "cost").unionByName(
        state.select("conv_id", "cost")).groupBy("conv_id").agg(F.sum("cost").alias("cost")))
    audits = letters.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "letters"))), lambda c: c["letters"]), "")
        .alias("audit"))
    illegal = numbered.groupBy("conv_id").agg(F.sum("all_illegal").alias("illegal"))
    faults = marks.groupBy("conv_id").agg(*[
        F.count_if(F.col("fault") == code).alias(name) for name, code in
        (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))])
    turns = rows.groupBy("conv_id").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    summary = turns
    for part in (faults, illegal, costs, audits):
        summary = matched(summary, part, "conv_id")
    return Repaired(summary, edited(rows, letters))


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's turns that are left, ``role:text`` with line feeds between.

    The hash of one conversation reads its turns one after the other; they pass in a stream.
    """
    turns = (rows.where("edit <> 'D'").repartition(part_count(rows), "conv_id")
             .sortWithinPartitions("conv_id", "chunk", "number").select("conv_id", "role", "text"))

    def run(batches):
        def rows():
            conv, digest = None, None
            for batch in slices(batches):
                for now, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if digest is None or now != conv:
                        if digest is not None:
                            yield conv, digest.hexdigest()
                        conv, digest = now, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(f"{role}:{text}".encode())
            if digest is not None:
                yield conv, digest.hexdigest()
        return emit(rows(), ["conv_id", "sha256"], [LONG, TEXT])

    return turns.mapInArrow(run, "conv_id long, sha256 string")
