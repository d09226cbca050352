"""Trees and their relational use, against SQL that grows the same tree.

A forest of one tree on all rows (no bootstrap, all features, a cut between every two values) is
decided by its data, so SQL can find the splits itself: at every node the cut of least impurity.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.models import classified_lines
from catalog.tables import LINE_KEY_SQL
from tabwright.functions.columns import name
from tabwright.functions.scratch import materialise, ordered_by_key
from tabwright.operators import descent, evaluate, explain, forest
from tabwright.operators.descent import NodeForest
from tabwright.operators.target import label_encode

INPUTS = ["l_quantity", "l_discount", "l_tax"]
KINDS = ["big", "plain", "taxed"]
BINS = 64


def _vectors(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    lines = classified_lines(spark, sf_dir)
    coded = label_encode(lines, "kind")[0] if target == "kind" else lines.withColumn(
        "label", name(target).cast("double"))
    return materialise(VectorAssembler(inputCols=INPUTS, outputCol="features").transform(coded)
                       .select("row_id", "label", "features"), "tree-rows")


def class_tree(spark: SparkSession, sf_dir: str):
    rows = _vectors(spark, sf_dir, "kind")
    return rows, forest.fit_rf_classifier(ordered_by_key(rows, ["row_id"]), 1, 2, BINS,
                                          bootstrap=False)


def price_tree(spark: SparkSession, sf_dir: str):
    rows = _vectors(spark, sf_dir, "l_extendedprice")
    return rows, forest.fit_rf_regressor(ordered_by_key(rows, ["row_id"]), 1, 2, BINS,
                                         bootstrap=False)


def _shown(nodes: DataFrame, digits: int) -> DataFrame:
    return nodes.select("depth", "feature", F.round("threshold", 6).alias("threshold"),
                        F.round("impurity", digits).alias("impurity"), "row_count",
                        F.round("prediction", 4).alias("prediction"))


def class_tree_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(explain.tree_table(class_tree(spark, sf_dir)[1], INPUTS), 6)


def price_tree_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(explain.tree_table(price_tree(spark, sf_dir)[1], INPUTS), 0)


def class_tree_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = explain.feature_importance(class_tree(spark, sf_dir)[1], INPUTS)
    return table.select("slot", "feature", F.round("importance", 6).alias("importance"))


def class_tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = class_tree(spark, sf_dir)
    found = descent.predict_by_nodes(NodeForest.of(model), rows, "row_id")
    return found.select("row_id", "prediction", *[
        F.round(F.get("outputs", F.lit(c)), 9).alias(f"share_{c}") for c in range(3)])


def class_tree_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = class_tree(spark, sf_dir)
    keyed = rows.select(F.struct("row_id", "label").alias("row"), "features")
    found = descent.predict_by_nodes(NodeForest.of(model), keyed, "row")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return evaluate.confusion_matrix(found.select(
        F.get(kinds, F.col("row.label").cast("int")).alias("kind"),
        F.get(kinds, F.col("prediction").cast("int")).alias("found")), "kind", "found")


def price_tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = price_tree(spark, sf_dir)
    found = descent.predict_by_nodes(NodeForest.of(model), rows, "row_id")
    return found.select("row_id", F.round("prediction", 4).alias("prediction"))


def _dependence(table: DataFrame) -> DataFrame:
    return table.select("feature", F.round("grid_value", 6).alias("grid_value"),
                        F.round("average", 9).alias("average"))


def class_tree_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows at every value of the three inputs, for class 0."""
    rows, model = class_tree(spark, sf_dir)
    grids = explain.pdp_grids(rows, [0, 1, 2])
    return _dependence(descent.dependence_over_rows(NodeForest.of(model), rows, grids, INPUTS))


def class_tree_covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = class_tree(spark, sf_dir)
    grids = explain.pdp_grids(rows, [0, 1, 2])
    return _dependence(descent.dependence_over_covers(NodeForest.of(model), grids, INPUTS))


QUERIES = {
    "tree_nodes_classes": class_tree_table,
    "tree_nodes_prices": price_tree_table,
    "tree_importance": class_tree_importance,
    "tree_predictions_classes": class_tree_predictions,
    "tree_predictions_prices": price_tree_predictions,
    "tree_confusion": class_tree_confusion,
    "tree_dependence_rows": class_tree_dependence,
    "tree_dependence_covers": class_tree_covers,
}

_KIND = """CASE WHEN l_quantity > 30 AND l_discount > 0.04 THEN 0
    WHEN l_tax > 0.05 THEN 2 ELSE 1 END"""
_X = "[l_quantity::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE]"
_NAMED = "['l_quantity', 'l_discount', 'l_tax'][f + 1]"


def _tree_sql(classes: bool) -> str:
    """CTEs ``nodes`` (heap numbers from 1, impurity, rows, output) and ``x`` (rows by inputs)."""
    if classes:
        stats = [f"sum((kind = {c})::INTEGER)::DOUBLE" for c in range(3)]
        impurity = ("(1 - ({0}a * {0}a + {0}b * {0}b + {0}c * {0}c) "
                    "/ (({0}a + {0}b + {0}c) * ({0}a + {0}b + {0}c)))")
        weight = "({0}a + {0}b + {0}c)"
    else:
        stats = ["count(*)::DOUBLE", "sum(l_extendedprice)", "sum(l_extendedprice * l_extendedprice)"]
        impurity, weight = "({0}c / {0}a - ({0}b / {0}a) * ({0}b / {0}a))", "{0}a"
    sums = ", ".join(f"{s} AS {n}" for s, n in zip(stats, "abc"))
    left = ", ".join(f"sum({n}) FILTER (v <= t) AS l{n}, sum({n}) FILTER (v > t) AS r{n}, "
                     f"sum({n}) AS p{n}" for n in "abc")
    gain = " ".join([impurity.format("p"), *[f"- {weight.format(s)} / {weight.format('p')} * "
                                             f"{impurity.format(s)}" for s in "lr"]])
    best = """b{0} AS (SELECT heap, f, t, gain FROM (SELECT *, row_number() OVER (PARTITION BY heap
            ORDER BY gain DESC, f, t) AS place FROM (SELECT *, {gain} AS gain FROM (
                SELECT heap, f, t, {left} FROM (SELECT heap, f, x[f + 1] AS v, sum(a) AS a,
                    sum(b) AS b, sum(c) AS c FROM n{0}, range(3) AS r(f) GROUP BY 1, 2, 3)
                JOIN cuts USING (f) GROUP BY 1, 2, 3) WHERE la IS NOT NULL AND ra IS NOT NULL))
            WHERE place = 1 AND gain > 1e-9)"""
    level = """n{1} AS (SELECT 2 * heap + (x[f + 1] > t)::INTEGER AS heap, x, a, b, c
            FROM n{0} JOIN b{0} USING (heap))"""
    steps = ",\n".join([best.format(0, gain=gain, left=left), level.format(0, 1),
                        best.format(1, gain=gain, left=left), level.format(1, 2)])
    return f"""x AS (SELECT {_X} AS x, {sums} FROM (SELECT *, {_KIND} AS kind FROM lineitem)
            GROUP BY 1),
        cuts AS (SELECT * FROM (SELECT f, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS t
            FROM (SELECT DISTINCT f, x[f + 1] AS v FROM x, range(3) AS r(f))) WHERE t IS NOT NULL),
        n0 AS (SELECT 1 AS heap, x, a, b, c FROM x),
        {steps},
        splits AS (SELECT * FROM b0 UNION ALL SELECT * FROM b1),
        nodes AS (SELECT heap, a, b, c, {impurity.format('')} AS impurity, {weight.format('')} AS n,
                f, t, gain
            FROM (SELECT heap, sum(a) AS a, sum(b) AS b, sum(c) AS c FROM (SELECT * FROM n0
                UNION ALL SELECT * FROM n1 UNION ALL SELECT * FROM n2) GROUP BY heap)
            LEFT JOIN splits USING (heap))"""


_CLASSES, _PRICES = _tree_sql(True), _tree_sql(False)
_BEST = "CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END::DOUBLE"


def _leaf_sql(rows: str, kept: str) -> str:
    """Leaf of every row of ``rows`` (columns ``kept`` and ``x``), with the leaf's numbers."""
    return f"""(SELECT {kept}, leaf.* EXCLUDE (heap) FROM (
            SELECT {kept}, CASE WHEN m.t IS NULL THEN h ELSE 2 * h + (x[m.f + 1] > m.t)::INTEGER END
                AS h FROM (SELECT {kept}, x, CASE WHEN r.t IS NULL THEN 1
                    ELSE 2 + (x[r.f + 1] > r.t)::INTEGER END AS h
                FROM {rows}, (SELECT f, t FROM nodes WHERE heap = 1) AS r) AS s
            JOIN nodes AS m ON m.heap = s.h) AS d JOIN nodes AS leaf ON leaf.heap = d.h)"""


_LINES = f"(SELECT {LINE_KEY_SQL} AS row_id, {_KIND} AS kind, {_X} AS x FROM lineitem)"
_MOVED = f"""(SELECT f AS slot, v, weight, list_concat(list_concat(x[1:f], [v]), x[f + 2:]) AS x
    FROM (SELECT x, a + b + c AS weight FROM x) JOIN (SELECT DISTINCT f, x[f + 1] AS v
        FROM x, range(3) AS r(f)) ON true)"""


def _nodes_sql(tree: str, prediction: str, digits: int) -> str:
    return f"""WITH {tree} SELECT floor(log2(heap))::INTEGER AS depth,
        CASE WHEN f IS NOT NULL THEN {_NAMED} END AS feature, round(t, 6) AS threshold,
        round(impurity, {digits}) AS impurity, n::BIGINT AS row_count,
        round({prediction}, 4) AS prediction FROM nodes"""


SQL = {
    "tree_nodes_classes": _nodes_sql(_CLASSES, _BEST, 6),
    "tree_nodes_prices": _nodes_sql(_PRICES, "b / a", 0),
    "tree_importance": f"""WITH {_CLASSES} SELECT s::INTEGER AS slot, {_NAMED.replace('f + 1',
            's + 1')} AS feature, round(coalesce(sum(gain * n) FILTER (f = s), 0)
                / sum(gain * n), 6) AS importance
        FROM nodes, range(3) AS r(s) GROUP BY s""",
    "tree_predictions_classes": f"""WITH {_CLASSES} SELECT row_id, {_BEST} AS prediction,
        round(a / n, 9) AS share_0, round(b / n, 9) AS share_1, round(c / n, 9) AS share_2
        FROM {_leaf_sql(_LINES, 'row_id')}""",
    "tree_predictions_prices": f"""WITH {_PRICES} SELECT row_id, round(b / a, 4) AS prediction
        FROM {_leaf_sql(_LINES, 'row_id')}""",
    "tree_confusion": f"""WITH {_CLASSES}, found AS (SELECT {KINDS}[kind + 1] AS actual,
            {KINDS}[{_BEST}::INTEGER + 1] AS predicted
            FROM {_leaf_sql(_LINES, 'row_id, kind')})
        SELECT actual, predicted, count(f.one)::BIGINT AS n
        FROM (SELECT DISTINCT k.k AS actual FROM (SELECT actual AS k FROM found
            UNION SELECT predicted FROM found) AS k) CROSS JOIN (SELECT DISTINCT k.k AS predicted
            FROM (SELECT actual AS k FROM found UNION SELECT predicted FROM found) AS k)
        LEFT JOIN (SELECT *, 1 AS one FROM found) AS f USING (actual, predicted)
        GROUP BY 1, 2""",
    "tree_dependence_rows": f"""WITH {_CLASSES} SELECT {_NAMED.replace('f + 1', 'slot + 1')}
            AS feature, round(v, 6) AS grid_value,
            round(sum(a / n * weight) / sum(weight), 9) AS average
        FROM {_leaf_sql(_MOVED, 'slot, v, weight')} GROUP BY slot, v""",
    "tree_dependence_covers": f"""WITH RECURSIVE {_CLASSES},
        walk AS (SELECT f AS slot, v, 1::BIGINT AS heap, 1.0::DOUBLE AS part
            FROM (SELECT DISTINCT f, x[f + 1] AS v FROM x, range(3) AS r(f))
            UNION ALL SELECT slot, v, child.heap, CASE WHEN m.f = slot THEN part
                ELSE part * child.n / m.n END
            FROM walk JOIN nodes AS m USING (heap) JOIN nodes AS child
                ON child.heap IN (2 * m.heap, 2 * m.heap + 1)
            WHERE m.t IS NOT NULL AND (m.f <> slot OR (child.heap = 2 * m.heap) = (v <= m.t)))
        SELECT {_NAMED.replace('f + 1', 'slot + 1')} AS feature, round(v, 6) AS grid_value,
            round(sum(part * a / n), 9) AS average
        FROM walk JOIN nodes USING (heap) WHERE t IS NULL GROUP BY slot, v""",
}
