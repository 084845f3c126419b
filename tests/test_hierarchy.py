"""The Ward hierarchy against merging the closest pair step by step."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from shelfcast.operators import clustering as K
from shelfcast.operators import hierarchy as H


def plain(vectors):
    """Merges of {code: vector}, one closest pair at a time."""
    clusters = {c: (1, np.asarray(v, float)) for c, v in vectors.items()}
    out = []
    while len(clusters) > 1:
        names = sorted(clusters)
        best = None
        for i, a in enumerate(names):
            (na, xa) = clusters[a]
            for b in names[i + 1:]:
                (nb, xb) = clusters[b]
                d = math.sqrt(2 * na * nb / (na + nb) * float(((xa - xb) ** 2).sum()))
                if best is None or (d, a, b) < best:
                    best = (d, a, b)
        d, a, b = best
        (na, xa), (nb, xb) = clusters.pop(a), clusters.pop(b)
        clusters[a] = (na + nb, (na * xa + nb * xb) / (na + nb))
        out.append((a, b, d, na + nb))
    return out


def cut(vectors, merges, k):
    """Groups after all but the last k - 1 merges."""
    group = {c: {c} for c in vectors}
    for a, b, _, _ in merges[:len(merges) - (k - 1)]:
        group[a] |= group.pop(b)
    return {frozenset(g) for g in group.values()}


def table(spark, vectors):
    return spark.createDataFrame([(c, Vectors.dense(v)) for c, v in vectors.items()], ["stock_code", "features"]).repartition(3)


def series(n, dims=12, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 4, (5, dims))
    return {f"s{i:03d}": centre[i % 5] + rng.normal(0, 1, dims) for i in range(n)}


@pytest.mark.parametrize("n, block", [(90, 2048), (90, 25), (120, 7)])
def test_merges_equal_closest_pair_merging(spark, n, block):
    vectors = series(n, seed=n + block)
    want = plain(vectors)
    got = H.ward_merges(table(spark, vectors), block)
    rows = sorted(map(tuple, got.collect()), key=lambda r: (r[2], r[0], r[1]))
    assert [(r[0], r[1], r[3]) for r in rows] == [(r[0], r[1], r[3]) for r in sorted(want, key=lambda r: (r[2], r[0], r[1]))]
    assert np.allclose([r[2] for r in rows], sorted(r[2] for r in want), atol=1e-9)
    for k in (1, 2, 3, 5, 9, n, n + 5):
        labels = {r.stock_code: r.cluster for r in H.cut_merges(got, table(spark, vectors), k).collect()}
        groups = {frozenset(c for c in labels if labels[c] == g) for g in set(labels.values())}
        assert groups == cut(vectors, want, min(k, n)) and sorted(set(labels.values())) == list(range(min(k, n)))


@pytest.mark.parametrize("block", [3, 2048])
def test_equal_series_ties_and_rings(spark, block):
    vectors = {f"z{i}": [0.0, 0.0] for i in range(9)} | {f"p{i}": [float(i), 0.0] for i in range(1, 9)} | {"q0": [0.0, -0.0]}
    got = [tuple(r) for r in H.ward_merges(table(spark, vectors), block).collect()]
    assert len(got) == len(vectors) - 1 and len({r[1] for r in got}) == len(got)
    assert sorted(r[2] for r in got)[:9] == [0.0] * 9 and max(r[3] for r in got) == len(vectors)
    # every merge is of whole clusters: sizes add up along the forest
    size = dict.fromkeys(vectors, 1)
    for a, b, _, s in sorted(got, key=lambda r: (r[2], r[3])):
        assert size[a] + size[b] == s
        size[a] = s


def test_few_series(spark):
    empty = table(spark, {"a": [1.0]}).limit(0)
    assert H.ward_merges(empty).collect() == [] and H.cut_merges(H.ward_merges(empty), empty, 3).collect() == []
    one = table(spark, {"a": [1.0]})
    assert H.ward_merges(one).collect() == []
    assert [tuple(r) for r in H.cut_merges(H.ward_merges(one), one, 3).collect()] == [("a", 0)]


def test_demand_series(spark, clean_small):
    from shelfcast.plans.demand import demand_table
    demand = demand_table(clean_small, "day")
    vec = {r.stock_code: r.features.toArray() for r in K.series_vectors(demand).collect()}
    merges = K.series_merges(demand)
    want = plain(vec) if len(vec) <= 220 else None
    rows = merges.collect()
    assert len(rows) == len(vec) - 1
    if want:
        assert np.allclose(sorted(r.height for r in rows), sorted(r[2] for r in want), atol=1e-9)
    labels = K.series_clusters(demand, 3, method="ward").collect()
    assert {r.stock_code for r in labels} == set(vec) and {r.time_series_type for r in labels} == {0, 1, 2}
    with pytest.raises(ValueError):
        K.series_clusters(demand, 3, method="other")
