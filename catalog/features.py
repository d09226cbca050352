"""Imputation, scaling, encoding, splits, weights and clusters."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import GAPPY_LINES_SQL, LINE_KEY_SQL, LINE_KEYS, gappy_lines, table
from tabwright.operators import cluster, features, split

STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.impute_median(gappy_lines(spark, sf_dir).select(*LINE_KEYS, "quantity",
                                                                    "price"),
                                  ["quantity", "price"])


def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.impute_constant(gappy_lines(spark, sf_dir).select(*LINE_KEYS, "flag"),
                                    ["flag"])


def level_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = gappy_lines(spark, sf_dir).withColumn(
        "part", F.concat(F.lit("p"), F.col("l_partkey").cast("string")))
    coded, _ = features.level_codes(lines, ["flag", "part"])
    return coded.select(*LINE_KEYS, "flag_code", "part_code")


def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, "l_quantity", "l_extendedprice", F.lit(7.0).alias("constant"))
    columns = ["l_quantity", "l_extendedprice", "constant"]
    return features.standardise(lines, columns).select(
        *LINE_KEYS, *[F.round(c, 6).alias(c) for c in columns])


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.one_hot_wide(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus", "o_orderpriority"])


def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    model = features.fit_features(orders, "o_orderpriority", ["o_orderkey"])
    slots = vector_to_array("features")
    return model.transform(orders).select("o_orderkey", *[
        F.round(F.get(slots, F.lit(i)), 6).alias(n) for i, n in enumerate(model.feature_names)])


def choose_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(n).alias("table_name"), "n")
              for n in ("region", "nation", "benchmark", "supplier", "orders")]
    every = counts[0]
    for c in counts[1:]:
        every = every.unionByName(c)
    return every.withColumn("k", cluster.choose_k_rule(F.col("n")).cast("int"))


def split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"])


def split_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, "l_linestatus"), "l_linestatus", LINE_KEYS)


def split_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(table(spark, sf_dir, "events").select("event_id", "value"),
                                  None, ["event_id"])


def split_single_class_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class with one row: the split falls back to a plain one."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.expr(
        "CASE WHEN c_custkey = 0 THEN 'ONLY' ELSE c_mktsegment END").alias("segment"))
    return split.stratified_split(customers, "segment", ["c_custkey"])


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.balanced_class_weights(table(spark, sf_dir, "lineitem"), "l_returnflag").select(
        "class_value", "class_count", F.round("weight", 9).alias("weight"))


def weighted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split.add_class_weights(orders, "o_orderstatus").withColumn(
        "weight", F.round("weight", 9))


def sampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.sample_rows(table(spark, sf_dir, "lineitem"), 500, LINE_KEYS).select(
        *LINE_KEYS, "l_quantity")


def profile_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = cluster.cluster_profile(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"],
                                    "p_brand")
    return means.select("p_brand", *[F.round(c, 6).alias(c) for c in ("p_size", "p_retailprice")])


def profile_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.cluster_profile_rounded(table(spark, sf_dir, "lineitem"),
                                           ["l_quantity", "l_discount"], "l_returnflag")


CLUSTER_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster sizes and profile of lineitem."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *CLUSTER_COLUMNS)
    clustered, _ = cluster.kmeans_assign(lines, CLUSTER_COLUMNS, LINE_KEYS, restarts=2,
                                         max_iter=20)
    return clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in CLUSTER_COLUMNS])


def two_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two clusters of all lines by quantity; of all cuts between two values, SQL finds the one of
    least cost."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_quantity")
    model = cluster.kmeans_fit(lines, ["l_quantity"], 2, LINE_KEYS, tol=0.0)
    return model.transform(lines).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_quantity").alias("low"),
        F.max("l_quantity").alias("high"), F.round(F.avg("l_quantity"), 6).alias("centre")) \
        .withColumn("cost", F.lit(round(model.cost, 4))).drop("cluster")


def kmeans_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line: is its cluster the one with the nearest centre?"""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *CLUSTER_COLUMNS)
    clustered, model = cluster.kmeans_assign(lines, CLUSTER_COLUMNS, LINE_KEYS, restarts=1,
                                             max_iter=10)
    scaled = [model.scaling.expression(c) for c in CLUSTER_COLUMNS]
    distances = F.array(*[sum((z - F.lit(float(v))) ** 2 for z, v in zip(scaled, centre))
                          for centre in model.centres])
    own = F.get(distances, F.col("cluster"))
    return clustered.select(*LINE_KEYS, (own <= F.array_min(distances) + 1e-9)
                            .alias("is_nearest"))


QUERIES = {
    "feature_impute_median": impute_median,
    "feature_impute_constant": impute_constant,
    "feature_standardise": standardise,
    "feature_level_codes": level_codes,
    "feature_one_hot": one_hot,
    "feature_vector": feature_vector,
    "cluster_choose_k": choose_k,
    "cluster_profile": profile_by_brand,
    "cluster_profile_rounded": profile_rounded,
    "cluster_kmeans": kmeans_clusters,
    "cluster_two_means": two_means,
    "cluster_nearest_centre": kmeans_nearest,
    "split_stratified_orders": split_orders,
    "split_stratified_lineitem": split_lineitem,
    "split_plain_events": split_plain,
    "split_single_member_class": split_single_class_member,
    "split_class_weights": class_weights,
    "split_weighted_rows": weighted_rows,
    "sample_rows": sampled_rows,
}


def split_sql(source: str, keys: str, key: str, stratum: str, shown: str | None) -> str:
    """Test flag by hash rank within the class quota (largest remainder)."""
    extra = f", {shown}" if shown else ""
    return f"""WITH rows AS (SELECT {keys}{extra}, {stratum} AS stratum,
            md5('42:' || ({key})) AS h FROM {source}),
        counts AS (SELECT stratum, count(*) AS n FROM rows GROUP BY stratum),
        shares AS (SELECT stratum, n, sum(n) OVER () AS total,
            ceil(0.2 * sum(n) OVER ())::BIGINT AS t FROM counts),
        floors AS (SELECT stratum, (t * n // total) AS base, (t * n) % total AS rest, t
            FROM shares),
        quotas AS (SELECT stratum, base + CASE WHEN row_number() OVER
            (ORDER BY rest DESC, stratum) <= t - sum(base) OVER () THEN 1 ELSE 0 END AS quota
            FROM floors)
        SELECT {', '.join('rows.' + c.strip() for c in (keys + extra).split(','))},
            row_number() OVER (PARTITION BY rows.stratum ORDER BY h) <= quota AS is_test
        FROM rows JOIN quotas ON rows.stratum = quotas.stratum"""


_LINE_KEYS_SQL = ", ".join(LINE_KEYS)


def _scaled(column: str, source: str) -> str:
    return (f"round(({column} - (SELECT avg({column}) FROM {source})) / "
            f"(SELECT CASE WHEN stddev_pop({column}) = 0 THEN 1 ELSE stddev_pop({column}) END "
            f"FROM {source}), 6)")


_LINES_CONSTANT = "(SELECT *, 7.0::DOUBLE AS constant FROM lineitem)"

SQL = {
    "feature_level_codes": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        dense_rank() OVER (ORDER BY coalesce(flag, '__MISSING__')) - 1 AS flag_code,
        dense_rank() OVER (ORDER BY 'p' || l_partkey) - 1 AS part_code FROM {GAPPY_LINES_SQL}""",
    "feature_impute_median": f"""SELECT {_LINE_KEYS_SQL}, {', '.join(
        f"coalesce({c}, (SELECT median({c}) FROM {GAPPY_LINES_SQL})) AS {c}"
        for c in ("quantity", "price"))} FROM {GAPPY_LINES_SQL}""",
    "feature_impute_constant": f"""SELECT {_LINE_KEYS_SQL}, coalesce(flag, '__MISSING__') AS flag
        FROM {GAPPY_LINES_SQL}""",
    "feature_standardise": f"""SELECT {_LINE_KEYS_SQL}, {', '.join(
        f"{_scaled(c, _LINES_CONSTANT)}::DOUBLE AS {c}"
        for c in ("l_quantity", "l_extendedprice", "constant"))} FROM {_LINES_CONSTANT}""",
    "feature_one_hot": f"""SELECT o_orderkey, o_orderstatus, o_orderpriority, {', '.join(
        [f'''(o_orderstatus = '{s}')::INTEGER AS "o_orderstatus_{s}"''' for s in STATUSES]
        + [f'''(o_orderpriority = '{p}')::INTEGER AS "o_orderpriority_{p}"'''
           for p in PRIORITIES])} FROM orders""",
    "feature_vector": f"""SELECT o_orderkey, {_scaled('o_custkey', 'orders')} AS o_custkey,
        {_scaled('o_totalprice', 'orders')} AS o_totalprice, {', '.join(
        f'''(o_orderstatus = '{s}')::INTEGER::DOUBLE AS "o_orderstatus_{s}"'''
        for s in STATUSES)} FROM orders""",
    "cluster_two_means": """WITH v AS (SELECT l_quantity AS q, count(*) AS n FROM lineitem GROUP BY 1),
        cuts AS (SELECT c.q AS cut, sum(v.n * v.q) FILTER (v.q <= c.q) / sum(v.n) FILTER (v.q <= c.q)
            AS low, sum(v.n * v.q) FILTER (v.q > c.q) / sum(v.n) FILTER (v.q > c.q) AS high
            FROM v JOIN v AS c ON true GROUP BY 1),
        best AS (SELECT cut, sum(n * power(q - CASE WHEN q <= cut THEN low ELSE high END, 2)) AS cost
            FROM v JOIN cuts ON high IS NOT NULL GROUP BY 1 ORDER BY 2, 1 LIMIT 1)
        SELECT count(*)::BIGINT AS n, min(l_quantity) AS low, max(l_quantity) AS high,
            round(avg(l_quantity), 6) AS centre,
            round(any_value(cost) / (SELECT var_pop(l_quantity) FROM lineitem), 4) AS cost
        FROM lineitem JOIN best ON true GROUP BY l_quantity <= cut""",
    "cluster_nearest_centre": f"SELECT {_LINE_KEYS_SQL}, true AS is_nearest FROM lineitem",
    "cluster_choose_k": "\nUNION ALL ".join(f"""SELECT '{t}' AS table_name, n,
        (CASE WHEN n < 2 * least(greatest(2, n // 10), 10) THEN greatest(2, n // 2)
              ELSE least(greatest(2, n // 10), 10) END)::INTEGER AS k
        FROM (SELECT count(*)::BIGINT AS n FROM {t})"""
        for t in ("region", "nation", "benchmark", "supplier", "orders")),
    "cluster_profile": """SELECT p_brand, round(avg(p_size), 6) AS p_size,
        round(avg(p_retailprice), 6) AS p_retailprice FROM part GROUP BY p_brand""",
    "cluster_profile_rounded": """SELECT l_returnflag, round(avg(l_quantity), 3) AS l_quantity,
        round(avg(l_discount), 3) AS l_discount FROM lineitem GROUP BY l_returnflag""",
    "split_stratified_orders": split_sql("orders", "o_orderkey", "o_orderkey", "o_orderpriority",
                                         "o_orderpriority"),
    "split_stratified_lineitem": split_sql("lineitem", _LINE_KEYS_SQL, LINE_KEY_SQL,
                                           "l_linestatus", "l_linestatus"),
    "split_plain_events": split_sql("events", "event_id", "event_id", "0", "value"),
    "split_single_member_class": split_sql(
        "(SELECT *, CASE WHEN c_custkey = 0 THEN 'ONLY' ELSE c_mktsegment END AS segment "
        "FROM customer)", "c_custkey", "c_custkey", "0", "segment"),
    "split_class_weights": """SELECT l_returnflag AS class_value, n::BIGINT AS class_count,
        round(sum(n) OVER () / (count(*) OVER () * n), 9)::DOUBLE AS weight
        FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag)""",
    "split_weighted_rows": """SELECT o_orderkey, o_orderstatus, round(
        (SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderstatus) FROM orders)
        * count(*) OVER (PARTITION BY o_orderstatus)), 9)::DOUBLE AS weight FROM orders""",
    "sample_rows": f"""SELECT {_LINE_KEYS_SQL}, l_quantity FROM lineitem
        ORDER BY md5('42:' || {LINE_KEY_SQL}) LIMIT 500""",
}
