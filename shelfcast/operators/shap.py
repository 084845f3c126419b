"""Per-row explanation of boosted trees: SHAP values and pairwise interactions as joins and sums.

The values are those of the published path-dependent tree explainer: a feature that is not in
a coalition is averaged out by the training weight of the children.  A leaf's part in them depends on
a row only through which of the path's features the row meets the conditions of, one bit each.  So

1. the saved model's node table becomes one row per leaf: its value, the path's distinct features, the
   share of training weight that follows the path at each of them, and the node decisions it asks for;
2. every row gets its decisions, one bit per inner node, per tree; rows that decide alike are one pattern;
3. a pattern meets its tree's leaves and gets a condition bitmask for each; every bitmask that occurs is
   given its Shapley weights once, by the polynomial of the coalition sizes (no list of subsets, so
   any depth works);
4. the leaves' parts are summed per pattern, the trees' parts per row.

Everything is DataFrame joins, higher-order functions and partial sums.  Tables of nodes and leaves are as
large as the model, which the driver holds anyway; patterns are bounded by the cells that a tree's
splits cut, not by the rows.
"""

from __future__ import annotations

from math import factorial

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialize, scratch_dir

#: Decisions that are packed in one long.
WORD = 63


def tree_nodes(model: GBTRegressionModel, spark) -> DataFrame:
    """(tree, weight, node, value, cover, left, right, feature, threshold, categories), from the saved model.

    ``cover`` is the training weight in the node; ``left`` is -1 for leaves; ``categories`` (those that go
    left) is null for splits at a threshold.
    """
    path = scratch_dir(spark, "shap-model")
    model.write().save(path)
    weights = spark.createDataFrame(list(enumerate(model.treeWeights)), "tree int, weight double")
    n = F.col("nodeData")
    split, continuous = n["split"], n["split"]["numCategories"] < 0
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["prediction"].alias("value"), n["impurityStats"][0].alias("cover"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), split["featureIndex"].alias("feature"),
        F.when(continuous, F.get(split["leftCategoriesOrThreshold"], 0)).alias("threshold"),
        F.when(~continuous, split["leftCategoriesOrThreshold"]).alias("categories"))
    return materialize(nodes.join(F.broadcast(weights), "tree"), "shap-nodes")


def leaf_paths(nodes: DataFrame, depth: int, words: int) -> DataFrame:
    """(tree, leaf, value, share, features, z, need, want): one row per leaf.

    ``share`` is the leaf's part of the tree's training weight; for each distinct feature of the path, ``z``
    is the share of weight that follows the path at its nodes, and ``need``/``want`` are the decisions
    that count and the ones asked for, in words of ``WORD`` bits.
    """
    inner = nodes.where("left >= 0").select("tree", "node", "feature", F.col("cover").alias("all"), F.explode(F.array(
        F.struct(F.col("left").alias("child"), F.lit(True).alias("goes_left")),
        F.struct(F.col("right").alias("child"), F.lit(False).alias("goes_left")))).alias("to"))
    child = nodes.select("tree", F.col("node").alias("child"), "cover")
    edges = (inner.select("tree", "node", "feature", "all", "to.*").join(child, ["tree", "child"])
             .select("tree", F.col("node").alias("at"), "child", F.struct("node", "feature", "goes_left", (F.col("cover") / F.col("all")).alias("part")).alias("step")))
    edges = materialize(edges, "shap-edges")
    kind = edges.schema["step"].dataType.simpleString()
    paths = nodes.where("node = 0").select("tree", F.col("node").alias("at"), F.array().cast(f"array<{kind}>").alias("path"))
    for _ in range(depth):  # leaves that are reached stay as they are
        paths = paths.join(edges, ["tree", "at"], "left").select(
            "tree", F.coalesce("child", "at").alias("at"),
            F.when(F.col("step").isNull(), F.col("path")).otherwise(F.concat("path", F.array("step"))).alias("path"))
    leaves = paths.join(nodes.select("tree", F.col("node").alias("at"), (F.col("value") * F.col("weight")).alias("value")), ["tree", "at"])
    leaves = leaves.withColumn("features", F.expr("array_distinct(transform(path, p -> p.feature))"))

    def bits(condition: str) -> str:
        return (f"transform(features, f -> transform(sequence(0, {words - 1}), w -> aggregate("
                f"filter(path, p -> p.feature = f AND p.node div {WORD} = w AND {condition}), 0L, "
                f"(a, p) -> a | shiftleft(1L, p.node % {WORD}))))")

    return leaves.select(
        "tree", F.col("at").alias("leaf"), "value", F.expr("aggregate(path, 1.0D, (a, p) -> a * p.part)").alias("share"), "features",
        F.expr("transform(features, f -> aggregate(filter(path, p -> p.feature = f), 1.0D, (a, p) -> a * p.part))").alias("z"),
        F.expr(bits("true")).alias("need"), F.expr(bits("p.goes_left")).alias("want"))


def decisions(rows: DataFrame, nodes: DataFrame, trees: int, words: int) -> DataFrame:
    """(rid, tree, bits) of ``rows(rid, x)``: for each tree with splits, which of its nodes send the row left."""
    of_word = F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda w: F.filter("splits", lambda s: s["word"] == w))
    splits = nodes.where("left >= 0").groupBy("tree").agg(F.collect_list(F.struct(
        F.expr(f"cast(node div {WORD} as int)").alias("word"), F.expr(f"shiftleft(1L, node % {WORD})").alias("bit"),
        "feature", "threshold", "categories")).alias("splits")).select("tree", of_word.alias("splits"))
    left = "if(s.categories is null, x[s.feature] <= s.threshold, array_contains(s.categories, x[s.feature]))"
    bits = f"transform(splits, ss -> aggregate(ss, 0L, (a, s) -> if({left}, a | s.bit, a)))"
    each = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    return each.join(F.broadcast(splits), "tree").select("rid", "tree", F.expr(bits).alias("bits"))


def _polynomial(left_out: str) -> str:
    """Coefficients, by coalition size, of the product of (z + o t) over the path's features but those left out."""
    return (f"aggregate(filter(sequence(0, size(features) - 1), k -> {left_out}), array(1.0D), (p, k) -> "
            "zip_with(concat(p, array(0.0D)), concat(array(0.0D), p), (a, b) -> a * z[k] + b * o[k]))")


def _weighed(polynomial: str, weights: str) -> str:
    return f"aggregate(zip_with({polynomial}, {weights}[size(features)], (p, w) -> p * w), 0.0D, (a, v) -> a + v)"


def _table(depth: int, least: int, weight) -> str:
    """A literal array: for each number of features the weights of the coalition sizes."""
    rows = [", ".join(f"{weight(d, k)!r}D" for k in range(d - least + 1)) if d >= least else "" for d in range(depth + 1)]
    return "array(" + ", ".join(f"cast(array({r}) as array<double>)" for r in rows) + ")"


def leaf_parts(masked: DataFrame, depth: int, n_features: int, interact: int | None = None) -> DataFrame:
    """Adds ``part`` to leaves with a condition bitmask: what the leaf adds to each feature's value.

    With ``interact``, the parts are the interactions of that feature with each other one and, at its own
    place, what is left of its value, so they sum to it.
    """
    shapley = _table(depth, 1, lambda d, k: factorial(k) * factorial(d - 1 - k) / factorial(d))
    df = masked.withColumn("o", F.expr("transform(sequence(0, size(features) - 1), j -> cast(shiftright(mask, j) & 1 as double))"))
    own = f"value * (o[j] - z[j]) * {_weighed(_polynomial('k != j'), shapley)}"
    if interact is None:
        parts = df.withColumn("parts", F.expr(f"transform(sequence(0, size(features) - 1), j -> {own})"))
    else:
        pair = _table(depth, 2, lambda d, k: factorial(k) * factorial(d - 2 - k) / (2 * factorial(d - 1)))
        df = df.withColumn("i", F.expr(f"array_position(features, {interact}) - 1").cast("int")).where("i >= 0")
        both = f"value * (o[i] - z[i]) * (o[j] - z[j]) * {_weighed(_polynomial('k != j AND k != i'), pair)}"
        df = df.withColumn("pairs", F.expr(f"transform(sequence(0, size(features) - 1), j -> if(j = i, 0.0D, {both}))"))
        mine = f"transform(array(i), j -> {own})[0] - aggregate(pairs, 0.0D, (a, v) -> a + v)"
        df = df.withColumn("mine", F.expr(mine))
        parts = df.withColumn("parts", F.expr("transform(pairs, (v, j) -> if(j = i, mine, v))"))
    place = f"transform(sequence(0, {n_features - 1}), f -> coalesce(try_element_at(map_from_arrays(features, parts), f), 0.0D))"
    return parts.withColumn("part", F.expr(place))


def _sums(column: str, n: int):
    return F.array(*[F.sum(F.get(F.col(column), F.lit(i))) for i in range(n)])


def explain(model: GBTRegressionModel, rows: DataFrame, n_features: int, features_col: str = "features",
            interact: int | None = None) -> tuple[DataFrame, float]:
    """``rows`` with ``shap``, an array of one value per feature, and the base value.

    A row's values and the base sum to its prediction.  With ``interact``, the number of a feature, the
    array holds that feature's interactions instead (see :func:`leaf_parts`).

    Defined results: a feature that no split uses gets 0, in trees without splits all do; repeated rows get
    equal values; no rows give no rows.  ``rows`` must not have the columns ``rid`` and ``shap``.
    """
    spark = rows.sparkSession
    trees, depth = model.trees, max(1, max(t.depth for t in model.trees))
    words = (max(t.numNodes for t in trees) - 1) // WORD + 1
    nodes = tree_nodes(model, spark)
    leaves = materialize(leaf_paths(nodes, depth, words), "shap-leaves")
    base = leaves.agg(F.sum(F.col("value") * F.col("share"))).first()[0]

    numbered = materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "shap-rows")
    x = numbered.select("rid", vector_to_array(features_col).alias("x"))
    decided = materialize(decisions(x, nodes, len(trees), words), "shap-decisions")

    paths = leaves.where(F.size("features") > 0)
    meets = f"aggregate(sequence(0, {words - 1}), true, (ok, w) -> ok AND (bits[w] & need[j][w]) = want[j][w])"
    mask = f"aggregate(sequence(0, size(features) - 1), 0L, (a, j) -> if({meets}, a | shiftleft(1L, j), a))"
    met = decided.select("tree", "bits").distinct().join(F.broadcast(paths.select("tree", "leaf", "features", "need", "want")), "tree")
    met = materialize(met.select("tree", "bits", "leaf", F.expr(mask).alias("mask")), "shap-masks")
    masked = met.select("tree", "leaf", "mask").distinct().join(paths.select("tree", "leaf", "value", "features", "z"), ["tree", "leaf"])
    parts = materialize(leaf_parts(masked, depth, n_features, interact).select("tree", "leaf", "mask", "part"), "shap-parts")

    of_pattern = met.join(parts, ["tree", "leaf", "mask"]).groupBy("tree", "bits").agg(_sums("part", n_features).alias("part"))
    of_row = decided.join(materialize(of_pattern, "shap-patterns"), ["tree", "bits"]).groupBy("rid").agg(_sums("part", n_features).alias("shap"))
    out = numbered.join(of_row, "rid", "left").drop("rid")
    return out.withColumn("shap", F.coalesce("shap", F.array_repeat(F.lit(0.0), n_features))), base
