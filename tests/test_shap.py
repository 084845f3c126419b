"""SHAP values and interactions against a brute force over all subsets of the features."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfcast.operators import shap


def read_trees(model, spark):
    """Per tree its weight and a dict of nodes."""
    out = {}
    for r in shap.tree_nodes(model, spark).collect():
        out.setdefault(r.tree, (r.weight, {}))[1][r.node] = r
    return list(out.values())


def goes_left(n, x):
    return x[n.feature] <= n.threshold if n.categories is None else x[n.feature] in n.categories


def expected(nodes, x, known, at=0):
    """The tree's value with the ``known`` features of x, the others averaged by training weight."""
    n = nodes[at]
    if n.left < 0:
        return n.value
    if n.feature in known:
        return expected(nodes, x, known, n.left if goes_left(n, x) else n.right)
    return sum(expected(nodes, x, known, c) * nodes[c].cover / n.cover for c in (n.left, n.right))


def brute(trees, x, m):
    """(base, Shapley values, interaction matrix) over all subsets of the m features."""
    value = {}
    for size in range(m + 1):
        for s in combinations(range(m), size):
            value[frozenset(s)] = sum(w * expected(nodes, x, set(s)) for w, nodes in trees)
    phi, inter = np.zeros(m), np.zeros((m, m))
    for s, v in value.items():
        for i in set(range(m)) - s:
            phi[i] += factorial(len(s)) * factorial(m - len(s) - 1) / factorial(m) * (value[s | {i}] - v)
            for j in set(range(m)) - s - {i}:
                d = value[s | {i, j}] - value[s | {i}] - value[s | {j}] + v
                inter[i, j] += factorial(len(s)) * factorial(m - len(s) - 2) / (2 * factorial(m - 1)) * d
    for i in range(m):
        inter[i, i] = phi[i] - inter[i].sum()
    return value[frozenset()], phi, inter


NAMES = ["a", "b", "c", "k"]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(5)
    n = 1500
    a, b, c = rng.normal(size=n), rng.integers(0, 6, n), rng.random(n)
    k = rng.choice(list("pqrstu"), n)
    y = 3 * a * (b > 2) + 5 * np.isin(k, ["p", "t"]) * c + b + rng.normal(0, 0.1, n)
    w = rng.integers(1, 4, n).astype(float)
    df = spark.createDataFrame([(float(p), float(q), float(r), str(s), float(t), float(u)) for p, q, r, s, t, u in zip(a, b, c, k, y, w)],
                               "a double, b double, c double, k string, y double, w double")
    prep = Pipeline(stages=[StringIndexer(inputCol="k", outputCol="k_i"), VectorAssembler(inputCols=["a", "b", "c", "k_i"], outputCol="features")]).fit(df)
    data = prep.transform(df)
    model = GBTRegressor(labelCol="y", weightCol="w", maxIter=6, maxDepth=4, stepSize=0.4, seed=1).fit(data)
    return model, data


def test_values_equal_all_subsets_and_sum_to_the_prediction(spark, fitted):
    model, data = fitted
    trees, rows = read_trees(model, spark), data.limit(25).repartition(3)
    got, base = shap.explain(model, model.transform(rows), 4)
    assert "rid" not in got.columns and got.count() == 25
    for r in got.collect():
        want_base, phi, _ = brute(trees, r.features.toArray(), 4)
        assert base == pytest.approx(want_base, abs=1e-9)
        assert np.allclose(r.shap, phi, atol=1e-9)
        assert base + sum(r.shap) == pytest.approx(r.prediction, abs=1e-9)
    every, base = shap.explain(model, model.transform(data), 4)
    off = every.select(F.max(F.abs(F.aggregate("shap", F.lit(0.0), lambda s, v: s + v) + base - F.col("prediction")))).first()[0]
    assert off < 1e-9


@pytest.mark.parametrize("feature", [0, 3])
def test_interactions_equal_all_subsets(spark, fitted, feature):
    model, data = fitted
    trees, rows = read_trees(model, spark), data.limit(15)
    got, _ = shap.explain(model, rows, 4, interact=feature)
    for r in got.collect():
        _, phi, inter = brute(trees, r.features.toArray(), 4)
        assert np.allclose(r.shap, inter[feature], atol=1e-9) and sum(r.shap) == pytest.approx(phi[feature], abs=1e-9)


def test_deep_trees_need_several_words(spark):
    rng = np.random.default_rng(6)
    x = rng.random((600, 3))
    y = np.sin(9 * x[:, 0]) + x[:, 1] * x[:, 2]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = GBTRegressor(labelCol="y", maxIter=2, maxDepth=8, seed=1).fit(data)
    assert max(t.numNodes for t in model.trees) > shap.WORD
    trees = read_trees(model, spark)
    got, base = shap.explain(model, model.transform(data.limit(8)), 3)
    for r in got.collect():
        assert np.allclose(r.shap, brute(trees, r.features.toArray(), 3)[1], atol=1e-9)
        assert base + sum(r.shap) == pytest.approx(r.prediction, abs=1e-9)


def test_no_rows_repeated_rows_and_trees_without_splits(spark, fitted):
    model, data = fitted
    assert shap.explain(model, data.limit(0), 4)[0].collect() == []
    twice, _ = shap.explain(model, data.limit(1).union(data.limit(1)), 4)
    first, second = twice.collect()
    assert first.shap == second.shap
    flat = data.withColumn("y", F.lit(2.0))
    same = GBTRegressor(labelCol="y", maxIter=2, maxDepth=3, seed=1).fit(flat)
    got, base = shap.explain(same, flat.limit(3), 4)
    assert base == pytest.approx(2.0) and all(r.shap == [0.0] * 4 for r in got.collect()) and got.count() == 3
