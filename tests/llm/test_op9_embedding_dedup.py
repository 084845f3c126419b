"""Embedding links against all cosines."""

import numpy as np
import pytest

from shelfcast.llm import op9_embedding_dedup as op

VECS = "vec_id long, embedding array<float>"


def corpus(seed=1):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for _ in range(150):
        c = rng.normal(size=24)
        for _ in range(int(rng.integers(1, 8))):
            rows.append((n, (c + rng.normal(size=24) * rng.choice([0, 0.03, 0.1, 0.2])).astype(np.float32).tolist()))
            n += 1
    big = rng.normal(size=24)
    rows += [(n + i, (big + rng.normal(size=24) * 0.1).astype(np.float32).tolist()) for i in range(200)]
    n += 200
    v = rows[3][1]
    rows += [(n, v), (n + 1, [2 * x for x in v]), (n, v), (None, v), (n + 2, None), (n + 3, [0.0] * 24), (n + 4, [float("nan")] + v[1:]), (n + 5, [None] + v[1:]),
             (n + 6, [1.0, 2.0]), (n + 7, [1.0, 2.0]), (n + 8, []), (n + 9, [float("inf")] * 24), (n + 10, [1e30] * 24), (n + 11, [1e-30] * 24)]
    return rows


def brute(rows):
    unit = []
    for _, v in rows:
        x = None if not v or any(c is None for c in v) else np.array(v, np.float32).astype(float)
        unit.append(x / np.abs(x).max() if x is not None and np.isfinite(x).all() and x.any() else None)
    unit = [None if x is None else x / np.sqrt(x @ x) for x in unit]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, x in enumerate(unit):
        for j in range(i):
            if x is not None and unit[j] is not None and len(x) == len(unit[j]) and x @ unit[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, links[i], min(ids) if ids else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1024, 50])
def test_equals_all_cosines(spark, block):
    rows = corpus()
    df = spark.createDataFrame(rows, VECS).repartition(4).selectExpr("*", "1 as label", "2 as class_id", "3 as unit")
    got = op.embedding_links(df, block).collect()
    want = brute(rows)
    assert sorted([tuple(r)[:3] for r in got], key=repr) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_empty(spark):
    assert op.op9_embedding_dedup(spark.createDataFrame([], VECS)).collect() == []
    assert op.op9_embedding_dedup(spark.createDataFrame([(4, None)], VECS)).collect()[0][:] == (4, 0, 4, True)


def test_shape_follows_n():
    shapes = [op.shape(n) for n in (0, 1, 100, 10_000, 10**6, 10**9)]
    assert shapes == sorted(shapes) and all((1 - op.same_bucket((2 - 1.8) ** 0.5) ** k) ** t <= op.MISS for k, t in shapes)


def test_every_link_of_planted_64_dimensional_vectors_is_found(spark):
    rng = np.random.default_rng(64)
    centres = rng.normal(size=(260, 64))
    x = np.concatenate([c + rng.normal(size=(rng.integers(1, 20), 64)) * rng.choice([0.2, 0.3, 0.36]) for c in centres]).astype(np.float32)
    unit = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(1))[:, None]
    linked = unit @ unit.T >= op.COSINE
    np.fill_diagonal(linked, False)
    got = {r.vec_id: r.n_links for r in op.op9_embedding_dedup(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECS)).collect()}
    found = sum(got.values()) / linked.sum()
    assert linked.sum() > 5000 and 0.999 <= found <= 1.0
    assert all(got[i] <= n for i, n in enumerate(linked.sum(1).tolist()))
