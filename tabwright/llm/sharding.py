"""Shards of equal size that keep linked documents together: balanced label propagation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.scratch import materialise
from tabwright.llm.common import crc32_of, offsets_of_parts, part_count

#: Rounds of propagation at most; it ends as soon as a round moves nothing.
ROUNDS = 6
#: Rows that are exchanged among themselves; a table has one exchange class for so many rows.
CLASS_ROWS = 200_000
#: Groups with more rows are handled in SUBS parts wherever their rows meet.
HOT_ROWS = 1_000
SUBS = 64


def sub_of(size: Column, row: Column) -> Column:
    """Part of a group that a row belongs to: 0, or one of SUBS in a hot group."""
    return F.when(size > HOT_ROWS, F.pmod(F.xxhash64(row), F.lit(SUBS))).otherwise(F.lit(0))


def running_slots(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add ``name``: the rows that come before, in the order of ``block``, ``keys``, ``row_id``.

    Rows are counted by block and key; the totals of the blocks (one row each) and of the keys
    within a block are added up, and rows are numbered within their key only.
    """
    inside = Window.partitionBy("block").orderBy(*keys)
    cells = rows.groupBy("block", *keys).agg(F.count(F.lit(1)).alias("rows_here")).withColumn(
        "cell_start", F.sum("rows_here").over(inside) - F.col("rows_here"))
    totals = offsets_of_parts(rows.groupBy("block").agg(F.count(F.lit(1)).alias("total")),
                              "block", "total", "block_start")
    numbered = rows.withColumn("nth", F.row_number().over(
        Window.partitionBy("block", *keys).orderBy("row_id")))
    return (numbered.join(cells, ["block", *keys]).join(F.broadcast(totals), "block")
            .withColumn(name, F.col("block_start") + F.col("cell_start") + F.col("nth") - 1)
            .drop("rows_here", "cell_start", "block_start", "nth"))


def first_shards(rows: DataFrame, links: DataFrame, n_shards: int, total: int) -> DataFrame:
    """Equal shards to start from: groups one after the other, cut at the shards' ends.

    Returns ``row_id``, ``shard``, ``free`` (linked with nothing) and ``class`` of every row.
    """
    blocks = part_count(rows)
    home = links.groupBy("row_id").agg(F.min(F.struct("hub", "hub_rows")).alias("home"))
    rows = rows.join(home, "row_id", "left").select(
        "row_id", F.col("home").isNull().alias("free"),
        F.coalesce(F.col("home.hub"), F.lit("")).alias("hub"),
        sub_of(F.coalesce(F.col("home.hub_rows"), F.lit(0)), F.col("row_id")).alias("sub"))
    rows = rows.withColumn("block", F.pmod(
        F.when(F.col("free"), F.xxhash64("row_id")).otherwise(F.xxhash64("hub")),
        F.lit(blocks)).cast("int"))
    classes = max(1, total // CLASS_ROWS)
    return running_slots(rows, ["hub", "sub"], "place").select(
        "row_id", F.expr(f"cast(place * {n_shards} div {max(1, total)} as int)").alias("shard"),
        "free", F.pmod(F.xxhash64("row_id", F.lit(7)), F.lit(classes)).alias("class"))


def wishes(state: DataFrame, links: DataFrame) -> DataFrame:
    """Linked rows that stand apart from most of a group: ``row_id``, ``source``, ``target``,
    ``class`` and ``gain`` (neighbours in the target, less those here).

    Every group adds up its rows by shard first, so its vote is one row however large it is.
    """
    placed = links.join(state.select("row_id", "shard", "class"), "row_id")
    votes = placed.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
    split = (votes.groupBy("hub").agg(
        F.max(F.struct("n", (-F.col("shard")).alias("low"))).alias("top"),
        F.sum("n").alias("hub_rows"),
        F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("by_shard"))
        .where(F.size("by_shard") > 1)
        .select("hub", (-F.col("top.low")).alias("target"), F.col("top.n").alias("most"),
                "by_shard",
                F.explode(F.sequence(F.lit(0), F.when(F.col("hub_rows") > HOT_ROWS, SUBS - 1)
                                     .otherwise(0))).alias("sub")))
    apart = (placed.withColumn("sub", sub_of(F.col("hub_rows"), F.col("row_id")).cast("int"))
             .join(split, ["hub", "sub"]).where(F.col("target") != F.col("shard"))
             .withColumn("gain", F.col("most") + 1 - F.element_at("by_shard", F.col("shard"))))
    best = apart.groupBy("row_id", "shard", "class", "target").agg(F.sum("gain").alias("gain"))
    return (best.groupBy("row_id", F.col("shard").alias("source"), "class")
            .agg(F.max(F.struct("gain", (-F.col("target")).alias("low"))).alias("best"))
            .select("row_id", "source", (-F.col("best.low")).alias("target"), "class",
                    F.col("best.gain").alias("gain")).where("gain > 0"))


def exchanges(state: DataFrame, wanted: DataFrame, n_shards: int) -> DataFrame:
    """Moves that leave every shard's size as it is: ``row_id`` and its new ``moved_to``.

    Within a class, rows from a to b are let through as far as rows from b to a, or free rows of
    b, come back for them. Wishes with the greatest gain go first.
    """
    pairs = wanted.groupBy("class", "source", "target").agg(F.count(F.lit(1)).alias("there"))
    back = pairs.select("class", F.col("source").alias("target"), F.col("target").alias("source"),
                        F.col("there").alias("back"))
    spare = (state.where("free").groupBy("class", F.col("shard").alias("target"))
             .agg(F.count(F.lit(1)).alias("spare")))
    quota = (pairs.join(back, ["class", "source", "target"], "left")
             .join(spare, ["class", "target"], "left").na.fill(0, ["back", "spare"])
             .withColumn("swapped", F.least("there", "back"))
             .withColumn("filled", F.least(F.col("there") - F.col("swapped"),
                                           F.expr(f"spare div {max(1, n_shards - 1)}"))))
    by_gain = Window.partitionBy("class", "source", "target").orderBy(F.desc("gain"), "row_id")
    going = (wanted.withColumn("nth", F.row_number().over(by_gain))
             .join(quota.select("class", "source", "target",
                                (F.col("swapped") + F.col("filled")).alias("quota")),
                   ["class", "source", "target"])
             .where("nth <= quota").select("row_id", F.col("target").alias("moved_to")))
    # Free rows of the target go to the source: the first ones to the first source, and so on.
    upto = Window.partitionBy("class", "target").orderBy("source")
    needs = quota.where("filled > 0").select(
        "class", F.col("target").alias("shard"), F.col("source").alias("moved_to"),
        F.sum("filled").over(upto).alias("upto"),
        (F.sum("filled").over(upto) - F.col("filled")).alias("after"))
    ranked = (state.where("free").join(needs.select("class", "shard").distinct(),
                                       ["class", "shard"], "left_semi")
              .withColumn("nth", F.row_number().over(
                  Window.partitionBy("class", "shard").orderBy("row_id"))))
    coming = (ranked.join(needs, ["class", "shard"])
              .where("nth > after and nth <= upto").select("row_id", "moved_to"))
    return going.unionByName(coming)


def propagate(rows: DataFrame, links: DataFrame, n_shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Shard of every ``row_id`` in ``rows``: ``row_id``, ``shard`` (0 to ``n_shards`` - 1).

    ``links`` holds (``row_id``, ``hub``): rows of one hub are linked with each other, and a row may
    have several hubs. Shards are equal from the start (row counts at most one apart) and stay so:
    each round moves linked rows towards the shard of most of their neighbours, one for one
    against rows that want to go the other way or that have no links.
    """
    total = rows.count()
    # Both sides are written, so that the join can split a hub of very many rows.
    hubs = materialise(links.groupBy("hub").agg(F.count(F.lit(1)).alias("hub_rows"))
                       .where("hub_rows > 1"), "shard-hubs")
    links = materialise(links.join(hubs, "hub"), "shard-links")
    state = materialise(first_shards(rows, links, n_shards, total), "shard-state")
    for _ in range(rounds):
        wanted = materialise(wishes(state, links), "shard-wishes")
        if wanted.isEmpty():
            break
        moves = materialise(exchanges(state, wanted, n_shards), "shard-moves")
        if moves.isEmpty():
            break
        state = materialise(
            state.join(moves, "row_id", "left").withColumn(
                "shard", F.coalesce("moved_to", "shard")).drop("moved_to"), "shard-state")
    return state.select("row_id", "shard")


def shard_documents(docs: DataFrame, n_shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Deal documents over shards so that equal texts meet and row counts are at most one apart.

    Returns ``doc_id``, ``size`` (UTF-8 bytes of the text and 8 more), ``text_crc32``, ``law``
    (``rows``), ``shard`` and ``slot`` (gapless from 0 in every shard). Equal texts are linked; a
    group larger than a shard spreads over as few as it needs.

    A null text has size 8 and is linked with nothing; an empty text is a text. Each row has a
    place of its own, also where its ``doc_id`` is null or repeated; an empty table gives no rows;
    other columns are ignored.
    """
    base = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        crc32_of(F.col("text")).alias("text_crc32"), F.md5(F.col("text").cast("binary")).alias("hub"),
        F.monotonically_increasing_id().alias("row_id")), "shard-rows")
    placed = propagate(base.select("row_id"), base.where("hub is not null").select("row_id", "hub"),
                       n_shards, rounds)
    blocks = part_count(docs)
    rows = (base.select("row_id", "doc_id", "size", "text_crc32").join(placed, "row_id")
            .withColumn("block", F.pmod(F.xxhash64("row_id"), F.lit(blocks)).cast("int")))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0))
                      .alias("start")))
    within = Window.partitionBy("shard", "block").orderBy(F.col("doc_id").asc_nulls_first(),
                                                          "row_id")
    return (rows.withColumn("nth", F.row_number().over(within)).join(starts, ["shard", "block"])
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("start") + F.col("nth") - 1).alias("slot")))
