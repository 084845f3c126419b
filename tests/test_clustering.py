import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfcast.operators import clustering as K


def test_zscore_sample_std(spark):
    import datetime as dt
    df = spark.createDataFrame([("S", dt.date(2010, 1, 1), 3), ("S", dt.date(2010, 1, 2), 5)],
                               "stock_code string, date date, qty int")
    r = K.series_zscore(df).first()
    assert r.series_std == pytest.approx(1.41421356, abs=1e-8) and r.series_mean == 4.0


def test_zero_days_counted(spark):
    import datetime as dt
    df = spark.createDataFrame([("S", dt.date(2010, 1, 1), 4), ("T", dt.date(2010, 1, 2), 2)],
                               "stock_code string, date date, qty int")
    r = {x.stock_code: x for x in K.series_zscore(df).collect()}
    # S over two dates: (4, 0) -> mean 2, sample std sqrt(8)
    assert r["S"].series_mean == 2.0 and r["S"].series_std == pytest.approx(math.sqrt(8))


def _llf(x, lam):
    y = np.log(x) if lam == 0 else (x ** lam - 1) / lam
    return (lam - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())


def test_boxcox_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.lognormal(1.0, 0.6, 200)
    df = spark.createDataFrame([(f"s{i}", float(v)) for i, v in enumerate(x)], "stock_code string, a double")
    got = K.boxcox_lambdas(df, ["a"]).first()
    grid = np.linspace(-3, 3, 60001)
    best = grid[np.argmax([_llf(x, g) for g in grid])]
    assert got.lmbda == pytest.approx(best, abs=2.6e-3)


@pytest.mark.parametrize("power", [1 / 20, 1 / 40, -1 / 30])
def test_boxcox_goes_beyond_the_first_grid(spark, power):
    # x ** (1 / power) is normal, so the best lambda is near 1 / power
    rng = np.random.default_rng(2)
    x = rng.normal(10, 1.0, 400) ** power
    df = spark.createDataFrame([(f"s{i}", float(v), 5.0) for i, v in enumerate(x)], "stock_code string, a double, b double")
    got = {r.feature: r for r in K.boxcox_lambdas(df, ["a", "b"]).collect()}
    u = x / np.exp(np.log(x).mean())
    grid = np.linspace(got["a"].lmbda - 30, got["a"].lmbda + 30, 6001)
    best = grid[np.argmax([_llf(u, g) for g in grid])]
    assert abs(best) > 3.5 and got["a"].lmbda == pytest.approx(best, abs=0.1)
    assert got["b"].lmbda == 1.0  # no variance


def test_standardize_population(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "a double")
    z = [r.a for r in K.standardize(df, ["a"]).collect()]
    assert np.std(z) == pytest.approx(1.0) and np.mean(z) == pytest.approx(0.0)


def test_select_k_errors(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError):
        K.select_k(df, max_clusters=1)


def test_fewer_stocks_than_clusters_is_an_error(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([float(i)]),) for i in range(4)], ["features"])
    with pytest.raises(ValueError, match="4 rows"):
        K.select_k(df, max_clusters=10)
    assert K.select_k(df, max_clusters=3).count() == 2


@pytest.fixture(scope="module")
def daily(spark, clean_small):
    from shelfcast.plans.demand import demand_table
    from shelfcast.session import materialize
    return materialize(demand_table(clean_small, "day"), "test-daily")


def test_item_clusters_invariants(spark, daily):
    labels = K.item_clusters(daily, max_clusters=4)
    n_stock = daily.select("stock_code").distinct().count()
    assert labels.count() == n_stock == labels.select("stock_code").distinct().count()
    assert labels.agg(F.min("product_type"), F.max("product_type")).first() [0] >= 0


def test_series_clusters_invariants(spark, daily):
    labels = K.series_clusters(daily, max_cluster=3)
    assert labels.count() == daily.select("stock_code").distinct().count()
    assert set(r.time_series_type for r in labels.collect()) <= {0, 1, 2}


def test_series_vectors_dense_length(spark, daily):
    n = daily.select("date").distinct().count()
    v = K.series_vectors(daily).first().features
    assert len(v) == n


def test_series_vectors_equal_plain_fill(spark):
    import datetime as dt
    rng = np.random.default_rng(5)
    rows = [(s, dt.date(2010, 1, 1) + dt.timedelta(days=int(d)), int(rng.integers(1, 9)))
            for s in "ABCDE" for d in rng.choice(40, rng.integers(1, 20), replace=False)] + [("F", dt.date(2010, 2, 9), 3)]
    df = spark.createDataFrame(rows, "stock_code string, date date, qty int")
    days = sorted({r[1] for r in rows})
    for r in K.series_vectors(df).collect():
        x = np.zeros(len(days))
        for s, d, q in rows:
            if s == r.stock_code:
                x[days.index(d)] += q
        sd = x.std(ddof=1)
        assert np.allclose(r.features.toArray(), (x - x.mean()) / sd if sd else x * 0)


def plain_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels.tolist()) - {labels[i]})
        out.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("block", [4096, 17])
def test_euclidean_silhouettes_equal_a_plain_reading(spark, block):
    from pyspark.ml.linalg import Vectors
    from shelfcast.operators.silhouette import euclidean_silhouettes
    rng = np.random.default_rng(9)
    x = np.r_[rng.normal(size=(120, 3)) + rng.integers(0, 3, 120)[:, None] * 4, np.zeros((4, 3))]
    labels = np.stack([rng.integers(0, 2, len(x)), rng.integers(0, 5, len(x)), (np.arange(len(x)) > 0) * 1 + (np.arange(len(x)) > 60)], 1)
    df = spark.createDataFrame([(Vectors.dense(v), row.tolist()) for v, row in zip(x, labels)], ["features", "labels"])
    got = {r.k: r.silhouette for r in euclidean_silhouettes(df.repartition(5), [2, 5, 3], block).collect()}
    for at, k in enumerate((2, 5, 3)):
        assert got[k] == pytest.approx(plain_silhouette(x, labels[:, at]), abs=1e-9)
    assert euclidean_silhouettes(df.limit(0), [2, 5, 3]).collect() == []


def test_select_k_by_euclidean_distance(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(10)
    x = rng.normal(size=(90, 2)) + (np.arange(90) % 3)[:, None] * 9
    df = spark.createDataFrame([(Vectors.dense(v),) for v in x], ["features"]).coalesce(1)
    got = {r.k: r.silhouette for r in K.select_k(df, 5, distance="euclidean").collect()}
    assert set(got) == {2, 3, 4, 5} and max(got, key=got.get) == 3
    labels = np.array([r.prediction for r in KMeans(k=3, seed=42).fit(df).transform(df).collect()])
    assert got[3] == pytest.approx(plain_silhouette(x, labels), abs=1e-9)
    with pytest.raises(ValueError):
        K.select_k(df, 3, distance="cosine")
