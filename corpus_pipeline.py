"""Corpus pipeline: drop toxic documents, near copies and benchmark leaks, hide personal data, pack.

Each stage takes the documents that its predecessor kept. All but the last return the columns of
``documents``, and all of them take tables with further columns as well, which they keep.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import name as quoted
from tabwright.functions.scratch import materialise
from tabwright.llm import decontaminate, ngram_join, packing, pii, toxicity
from tabwright.llm.common import free_name

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold. The model is fitted on the given
    documents and the confirmed labels among them. A null or empty text is kept."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    name = free_name(docs, "toxicity")
    scored = toxicity.score(docs, toxicity.learn(docs, labels), name)
    return scored.where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of rows with similar texts: that with the smallest ``doc_id``.

    Every row counts on its own, also among rows of one ``doc_id``; of those the smallest hash of the
    row stays. Rows without a ``doc_id`` come after all others. Rows without words are similar to
    nothing and stay.
    """
    key, number = free_name(docs, "dedup_key"), F.col("doc_id").cast("long")
    shared = docs.groupBy(number.alias("id")).count().where("id is null or count > 1")
    unique = shared.isEmpty()
    if unique:  # the ids tell the rows apart
        keyed = docs.withColumn(key, number)
    else:
        keyed = materialise(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-keyed")
    groups = ngram_join.similar_groups(keyed.select(F.col(key).alias("doc_id"), "text"))
    if unique:
        kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias(key))
    else:
        hashed = [quoted(f.name) for f in docs.schema
                  if "map<" not in f.dataType.simpleString()]  # maps have no hash
        order = keyed.select(F.col(key).alias("doc_id"), F.struct(
            number.isNull().alias("last"), number.alias("id"), F.xxhash64(*hashed).alias("row"),
            F.col(key).alias("key")).alias("place"))
        kept = (groups.join(order, "doc_id").groupBy("component_id")
                .agg(F.min("place").alias("place")).select(F.col("place.key").alias(key)))
    kept = materialise(kept, "pipeline-kept")
    return keyed.join(kept, key, "left_semi").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    name = free_name(docs, "leaks")
    marked = decontaminate.mark_benchmark(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name)
    return marked.where(F.size(name) == 0).select(*docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by the names of its kinds, and
    ``n_chars``, where there is such a column, counted anew."""
    found, clean = free_name(docs, "found"), free_name(docs, "clean")
    hidden = pii.find_personal_data(docs, found, clean).withColumn("text", F.col(clean))
    if "n_chars" in docs.columns:
        hidden = hidden.withColumn("n_chars", F.when(F.size(found) > 0, F.length("text")).otherwise(
            F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return hidden.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens (see :func:`packing.pack`)."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("pii", hide_personal_data),
    ("packing", pack_sequences),
]

#: Trained models, tokenizers and transducers are beyond SQL; tests compare the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
