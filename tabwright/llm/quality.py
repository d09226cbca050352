"""Quality rules as a short-circuit cascade: the rules that reject most for their cost go first."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scratch import materialise

#: Words: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Words of a window whose repetition counts.
WINDOW = 8
#: Rows of the sample, chosen by hash, on which cost and selectivity are estimated.
SAMPLE_ROWS = 2_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

Measures = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """A named condition on the measures of a text that rejects it."""

    name: str
    reject: Callable[[Measures], Column]


RULES = (
    Rule("few_words", lambda m: m["n_words"] < 20),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    Rule("symbols", lambda m: 100 * m["n_symbols"] > 30 * m["word_chars"]),
    Rule("repeated_lines", lambda m: 100 * m["n_dup_lines"] > 60 * m["n_lines"]),
    Rule("long_words", lambda m: m["word_chars"] > 40 * m["n_words"]),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_hashes(words: Column) -> Column:
    """Hash of the WINDOW words from each word on; empty for texts too short to repeat one."""
    def of_hashes(hashes):
        starts = F.sequence(F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, F.lit(WINDOW))))

    return F.when(F.size(words) > WINDOW, let(F.transform(words, lambda w: F.xxhash64(w)),
                                              of_hashes)).otherwise(F.array().cast("array<long>"))


def covered_words(windows: Column) -> Column:
    """Words covered by the windows whose hash comes twice or more.

    Each whole hash is paired with its place. Sorted, equal hashes are neighbours; then every
    repeated window adds the words from the end of the one before.
    """
    keys = F.sort_array(F.transform(
        windows, lambda h, i: F.struct(h.alias("hash"), i.cast("long").alias("place"))))

    def of_keys(keys):
        def same(key, other):
            return F.coalesce(key["hash"] == other["hash"], F.lit(False))

        repeated = F.filter(keys, lambda k, i: same(k, F.get(keys, i - 1))
                            | same(k, F.get(keys, i + 1)))
        places = F.sort_array(F.transform(repeated, lambda k: k["place"]))
        return F.aggregate(
            places, F.struct(F.lit(0).cast("long").alias("n"),
                             F.lit(-WINDOW).cast("long").alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW).cast("long"), p - a["last"]))
                                  .alias("n"), p.alias("last")), lambda a: a["n"])

    return let(keys, of_keys)


def repeated_words(words: Column) -> Column:
    return let(window_hashes(words), lambda w: F.when(
        F.size(F.array_distinct(w)) < F.size(w), covered_words(w)).otherwise(F.lit(0).cast("long")))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def measures_of(text: Column, words: Column) -> Measures:
    """Measures of a text (null: no text) with its words, all long."""
    whole = F.coalesce(text, F.lit(""))
    lines = lines_with_words(whole)
    found = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")),
        "n_lines": F.size(lines),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeated_words(words),
    }
    return {name: column.cast("long") for name, column in found.items()}


def ranked_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[tuple[Rule, float, float]]:
    """Rules by rejections per second on a sample, best first, each with its cost (seconds beyond
    reading the sample) and its share of rejected rows. The sample is about SAMPLE_ROWS rows chosen
    by hash; it decides the order of the rules only, never a verdict."""
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    edge = int(share * (1 << 32))
    sample = materialise(docs.select("text").where(
        F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 32)) <= edge), "quality-sample")
    rows = max(1, sample.count())

    def seconds(column: Column) -> tuple[float, int]:
        start = time.perf_counter()
        hits = sample.select(column.alias("hit")).agg(F.count_if("hit").alias("n")).first()["n"]
        return time.perf_counter() - start, hits or 0

    reading = F.size(words_of(F.col("text"))) < 0
    seconds(reading)
    base = seconds(reading)[0]
    found = []
    for rule in rules:
        took, hits = seconds(rule.reject(measures_of(F.col("text"), words_of(F.col("text")))))
        found.append((rule, max(took - base, 1e-3), hits / rows))
    return sorted(found, key=lambda r: (-r[2] / r[1], r[0].name))


def judge(docs: DataFrame, rules: tuple[Rule, ...] | None = None, report: bool = False) -> DataFrame:
    """Verdict of the cascade on every document: ``doc_id``, ``failed`` (the first rule that rejects
    it, null if it is kept), ``kept``, and the measures.

    Rules are tried in the given order, by default that of :func:`ranked_rules`, and later ones are
    not computed for a rejected text; with ``report`` all measures are computed and returned too.
    Which rule is named may depend on the order, ``kept`` does not.

    A null or empty text has no words, so it fails; rows count each on its own, whatever their
    ``doc_id``; an empty table gives no rows; other columns are ignored.
    """
    rules = rules if rules is not None else tuple(r for r, _, _ in ranked_rules(docs))
    rows = docs.select("doc_id", "text", words_of(F.col("text")).alias("words"))
    measures = measures_of(F.col("text"), F.col("words"))
    if report:
        rows = rows.select("doc_id", *[c.alias(name) for name, c in measures.items()])
        measures = {name: F.col(name) for name in MEASURES}
    failed = F.lit(None).cast("string")
    for rule in reversed(rules):
        failed = F.when(rule.reject(measures), F.lit(rule.name)).otherwise(failed)
    return (rows.withColumn("failed", failed).withColumn("kept", F.col("failed").isNull())
            .drop("text", "words"))
