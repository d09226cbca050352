"""Registered queries of the text operators, and the SQL that recomputes them where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tabwright.functions.scratch import materialise
from tabwright.llm import id_store, merkle, repair
from tabwright.llm.chat import chains, format_trees, loss_text, read_back
from tabwright.llm.common import table
from tabwright.llm.decontaminate import find_benchmark
from tabwright.llm.ngram_join import similar_groups
from tabwright.llm.packing import pack
from tabwright.llm.pii import KINDS, find_personal_data, joined, plain_of
from tabwright.llm.quality import judge
from tabwright.llm.sharding import shard_documents
from tabwright.llm.token_counts import token_counts
from tabwright.llm.toxicity import THRESHOLD, held_out, learn, score
from tabwright.llm.word_bpe import round_trip

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
SHARDS = 24


def op1_ngram_join(spark, sf_dir):
    return similar_groups(table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE),
                        TOKEN_LIMIT)


def op3_quality_rules(spark, sf_dir):
    judged = judge(table(spark, sf_dir, "documents"), report=True)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
        .alias("base_failed"), "kept")


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return (score(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def op5_id_store(spark, sf_dir):
    path = id_store.store_path(spark)
    id_store.write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_BPE))
    return id_store.read_store(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_chat_formatting(spark, sf_dir):
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    talks = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        "role", "text").unionByName(odd)
    written = materialise(format_trees(chains(talks)), "chat-output")
    turns, loss = read_back(F.col("formatted")), loss_text(F.col("formatted"), F.col("loss_spans"))
    read = written.select("conv_id", turns.alias("turns"), loss.alias("loss"),
                          F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars")


def op7_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = find_personal_data(docs)
    plain = plain_of(F.col("found"))

    def count(kind):
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select("doc_id", *map(count, KINDS),
                        F.sha2(joined(plain), 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"))


def op8_decontamination(spark, sf_dir):
    return find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS).withColumn(
        "grown_shard", F.lit(None).cast("int"))


def op10_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE)).withColumn(
        "ids_crc32", F.crc32("ids")).drop("ids")


def op11_bpe(spark, sf_dir):
    rows = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = merkle.leaf_digest([*map(F.col, columns[:-1]), F.translate("text", "\n", "")])
    leaves = docs.select(*columns, merkle.leaf_digest(list(map(F.col, columns))).alias("leaf")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "leaf",
        F.when(tampered & F.contains("text", F.lit("\n")), changed).otherwise(F.col("leaf"))
        .alias("claimed"))
    manifest = merkle.build(materialise(leaves, "merkle-hashed"))
    rows = merkle.verify(merkle.prove(manifest), manifest.groups, "claimed")
    return rows.select(
        "doc_id", *[merkle.hex_of(c).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.hex_of("proof"), 256).alias("proof_sha256"),
        merkle.hex_of("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"))


def damaged(talks):
    """Rows dropped, emptied, cut, repeated or given to the user, by their hash."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = talks.select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.crc32(F.concat_ws(":", *columns).cast("binary")) % 20).alias("harm")).where("harm <> 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1))).alias("copy"))


def op13_conversation_repair(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations")
    done = repair.repair(damaged(talks))
    found = repair.matched(done.summary, repair.digests(done.rows), "conv_id", how="left")
    every = talks.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return repair.matched(every, found, "conv_id", how="left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (
            "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_token_counts, op3_quality_rules, op4_toxicity, op5_id_store, op6_chat_formatting, op7_pii,
    op8_decontamination, op9_sharding, op10_packing, op11_bpe, op12_merkle_manifest,
    op13_conversation_repair)}

#: crc32 of an ASCII text ``v`` as another engine can write it: bit by bit over the reversed polynomial.
CRC32 = """xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(
            range(1, length({v}) + 1), lambda i: ascii(substr({v}, i, 1))::BIGINT)),
        lambda c, b: list_reduce(
            list_prepend(xor(c, b), range(8)),
            lambda x, k: xor(x >> 1, (x & 1) * 3988292384::BIGINT))))"""

#: Same white space, rules and escapes as the operators, written out for another engine.
SQL = {
    "op1_ngram_join": r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS pos
          FROM texts WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY x, y),
links AS (
    SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)),
reach AS (
    SELECT doc_id, doc_id AS component_id FROM sizes
    UNION
    SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.component_id)
SELECT texts.doc_id, coalesce(max(sizes.n), 0)::BIGINT AS n_shingles,
       coalesce(min(reach.component_id), texts.doc_id) AS component_id
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN reach USING (doc_id)
GROUP BY texts.doc_id""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE marked AS (
    SELECT *, row_number() OVER (ORDER BY doc_id) AS row,
           """ + CRC32.format(v="doc_id::VARCHAR") + r""" % 2 = 0 AS tampered
    FROM documents),
hashed AS (
    SELECT row, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN tampered THEN sha256(head || coalesce(
               strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
           ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claimed
    FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                    || coalesce(strlen(source) || ':' || source, '-')
                    || coalesce(strlen(lang) || ':' || lang, '-')
                    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
          FROM marked)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
           count(*) OVER (PARTITION BY source) AS size FROM hashed),
nodes AS (
    SELECT source, 0 AS level, idx, size, leaf AS digest FROM placed
    UNION ALL
    SELECT source, level + 1, idx // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE size > 1 GROUP BY source, level, idx // 3, size),
tops AS (
    SELECT 0 AS level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx,
           count(*) OVER () AS size, digest FROM nodes WHERE size = 1
    UNION ALL
    SELECT level + 1, idx // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
    FROM tops WHERE size > 1 GROUP BY level, idx // 3, size),
ranks AS (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
    FROM nodes WHERE size = 1),
every AS (
    SELECT tree, level, idx, size, digest FROM nodes
    JOIN ranks ON ranks.source IS NOT DISTINCT FROM nodes.source
    UNION ALL SELECT -1, level, idx, size, digest FROM tops),
beside AS (
    SELECT a.tree, a.level, a.idx, a.size,
           coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
           coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
    FROM every a JOIN every b
      ON b.tree = a.tree AND b.level = a.level AND b.idx // 3 = a.idx // 3
    WHERE a.size > 1 GROUP BY a.tree, a.level, a.idx, a.size),
folds AS (
    SELECT row, ranks.tree AS own, ranks.tree, 0 AS level, idx, size, claimed AS digest,
           '' AS proof, false AS done
    FROM placed JOIN ranks ON ranks.source IS NOT DISTINCT FROM placed.source
    UNION ALL
    SELECT row, own, CASE WHEN f.size > 1 THEN f.tree ELSE -1 END,
           CASE WHEN f.size > 1 THEN f.level + 1 ELSE 0 END,
           CASE WHEN f.size > 1 THEN f.idx // 3 ELSE own END,
           CASE WHEN f.size > 1 THEN (f.size + 2) // 3 ELSE (SELECT count(*) FROM ranks) END,
           CASE WHEN f.size > 1 THEN sha256(l || digest || r) ELSE digest END,
           proof || coalesce(l || r, ''), f.size = 1 AND f.tree = -1
    FROM folds f LEFT JOIN beside b ON b.tree = f.tree AND b.level = f.level AND b.idx = f.idx
    WHERE NOT done)
SELECT placed.doc_id, placed.leaf, ranks.subroot, root.digest AS root, sha256(folds.proof) AS proof_sha256,
       folds.digest AS folded_root, folds.digest = root.digest AS verified
FROM placed JOIN ranks ON ranks.source IS NOT DISTINCT FROM placed.source
JOIN folds ON folds.row = placed.row AND folds.done
JOIN (SELECT digest FROM tops WHERE size = 1) root ON true""",
    "op13_conversation_repair": r"""
WITH RECURSIVE marked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           """ + CRC32.format(v="hashed") + r""" % 20 AS harm
    FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS hashed
          FROM conversations)),
numbers AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
harmed AS (
    SELECT conv, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
           CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
           ELSE text END AS text
    FROM marked JOIN numbers ON numbers.conv_id IS NOT DISTINCT FROM marked.conv_id
    JOIN range(2) AS copies(copy) ON copy = 0 OR harm = 3 WHERE harm <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS place
    FROM harmed),
found AS (
    SELECT conv, turn, role, text, place,
           CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY place) > 1
                THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated'
                ELSE '' END AS fault,
           left(lag(role) OVER (PARTITION BY conv ORDER BY place), 1) || left(role, 1) AS pair
    FROM placed),
counts AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(place) AS places
    FROM found GROUP BY conv),
inserts(here, there, cost, letters, lines) AS (VALUES
    ('0', '0', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
    ('0', 'u', 5, 'I', 'user:' || chr(10)), ('s', 'u', 5, 'I', 'user:' || chr(10)),
    ('a', 'u', 5, 'I', 'user:' || chr(10)), ('u', 'a', 5, 'I', 'assistant:' || chr(10)),
    ('0', 'a', 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    ('s', 'a', 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
edits AS (
    SELECT conv, place, here, there, cost, letter, line FROM (
        SELECT *, unnest([
            {'there': here, 'cost': 2, 'letter': 'D', 'line': ''},
            {'there': CASE WHEN here || left(role, 1) IN ('0s', '0u', 'su', 'au', 'ua')
                           THEN left(role, 1) END,
             'cost': CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'letter': 'K',
             'line': role || ':' || text || chr(10)},
            {'there': CASE here WHEN 'u' THEN 'a' ELSE 'u' END,
             'cost': CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'letter': 'R',
             'line': CASE here WHEN 'u' THEN 'assistant:' ELSE 'user:' END || text || chr(10)}],
            recursive := true)
        FROM found, (VALUES ('0'), ('s'), ('u'), ('a')) AS states(here))
    WHERE letter = 'D' OR there IS NOT NULL AND fault NOT IN ('blank', 'duplicate')),
paths AS (
    SELECT conv, 0::BIGINT AS place, '0' AS state,
           {'cost': 0, 'audit': '', 'lines': ''} AS best FROM counts
    UNION ALL
    SELECT p.conv, p.place + 1, e.there, min({
        'cost': p.best.cost + i.cost + e.cost, 'audit': p.best.audit || i.letters || e.letter,
        'lines': p.best.lines || i.lines || e.line})
    FROM paths p JOIN inserts i ON i.here = p.state
    JOIN edits e ON e.conv = p.conv AND e.place = p.place + 1 AND e.here = i.there
    GROUP BY p.conv, p.place, e.there),
ends AS (
    SELECT p.conv, min({'cost': p.best.cost + i.cost, 'audit': p.best.audit || i.letters,
                        'lines': p.best.lines || i.lines}) AS best
    FROM paths p JOIN counts ON counts.conv = p.conv AND counts.places = p.place
    JOIN inserts i ON i.here = p.state AND i.there IN ('0', 'a') GROUP BY p.conv)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit,
       sha256(coalesce(left(best.lines, greatest(length(best.lines) - 1, 0)), '')) AS repaired_sha256
FROM numbers LEFT JOIN counts USING (conv) LEFT JOIN ends USING (conv)""",
    "op3_quality_rules": r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
windows AS (
    SELECT doc_id, pos, array_to_string(words[pos:pos + 7], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS pos FROM texts
          WHERE len(words) > 8)),
repeated AS (
    SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS last
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM windows)
    WHERE times > 1),
covered AS (
    SELECT doc_id, sum(least(8, pos - coalesce(last, pos - 8))) AS n FROM repeated GROUP BY doc_id),
measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
           length(array_to_string(words, ''))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM texts LEFT JOIN covered USING (doc_id)),
based AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_symbols <= 30 * word_chars
       AND 100 * n_dup_lines <= 60 * n_lines AND word_chars <= 40 * n_words AS kept
FROM based""",
    "op6_chat_formatting": r"""
WITH talks AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                     (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
    SELECT *, length('<|turn|>' || role || chr(10) || '<|end|>' || chr(10)) + length(text)
              + 4 * length(regexp_replace(text, '[^&\[\]]', '', 'g'))
              + 3 * length(regexp_replace(text, '[^<>]', '', 'g')) AS chars
    FROM talks)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
           AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
}
