"""Ward's hierarchy of series (K8) by merging reciprocal nearest neighbours.

A cluster is its size and centroid; Ward's distance of two clusters follows from these alone.  The
method is reducible: merging two clusters never brings the result nearer to a third than the nearer of
them was.  So clusters that are each other's nearest neighbour are merged at once, all such pairs of a
round together, a neighbour that was not merged stays the nearest, and the hierarchy is that of merging the
closest pair step by step.

Nearest neighbours need the distance of every two clusters: quadratic work in the number of series.
Clusters that look for a neighbour and all clusters are dealt to blocks; a task holds one block of
each, takes the distances from a matrix product and lets out one candidate per cluster, never pairs.
Once all clusters fit one block, one task of that bounded size does the rest.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import materialize

# what runs in Python workers travels by value: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Clusters of a block.
BLOCK = 2048
#: Rows of a block whose distances are computed at once.
ROWS = 256

NEAREST = "id long, d double, lo long, hi long"


def _read(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids ascending, sizes, centroids)."""
    t = t.select(["id", "size", "centroid"]).sort_by("id").combine_chunks()
    ids = t["id"].to_numpy()
    return ids, t["size"].to_numpy().astype(float), t["centroid"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)


def _squared(size: np.ndarray, x: np.ndarray, other_size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Squared Ward distances of all rows to all others, by a matrix product."""
    gap = (x * x).sum(1)[:, None] + (other * other).sum(1)[None, :] - 2 * (x @ other.T)
    return 2.0 * size[:, None] * other_size[None, :] / (size[:, None] + other_size[None, :]) * np.maximum(gap, 0)


def _exact(size_a: float, a: np.ndarray, size_b: float, b: np.ndarray) -> float:
    """The Ward distance of two clusters, the same in either order."""
    return float(np.sqrt(2.0 * size_a * size_b / (size_a + size_b) * ((a - b) ** 2).sum()))


def _nearest(seek: pa.Table, other: pa.Table) -> pa.Table:
    """For each seeking cluster the nearest of the others, as (id, distance, pair); equal ones go to the smaller id."""
    found: list[tuple[int, float, int, int]] = []
    if seek.num_rows and other.num_rows:
        (ids, size, x), (to, to_size, y) = _read(seek), _read(other)
        for a in range(0, len(ids), ROWS):
            some = slice(a, a + ROWS)
            d = _squared(size[some], x[some], to_size, y)
            d[ids[some][:, None] == to[None, :]] = np.inf
            for i, j in zip(range(a, a + len(d)), d.argmin(1).tolist(), strict=True):
                if ids[i] != to[j]:
                    found.append((ids[i], _exact(size[i], x[i], to_size[j], y[j]), min(ids[i], to[j]), max(ids[i], to[j])))
    columns = list(zip(*found, strict=True)) or [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                    names=["id", "d", "lo", "hi"])


def _rest(t: pa.Table) -> pa.Table:
    """All merges of the clusters of one block."""
    ids, size, x = _read(t)
    x, rows = x.copy(), []
    d = _squared(size, x, size, x)
    np.fill_diagonal(d, np.inf)
    live = np.arange(len(ids))
    while len(live) > 1:
        near = live[d[np.ix_(live, live)].argmin(1)]
        to = dict(zip(live.tolist(), near.tolist(), strict=True))
        pairs = [(i, j) for i, j in to.items() if i < j and to[j] == i]
        if not pairs:  # equal distances in a ring: the closest pair
            i = int(live[d[live, near].argmin()])
            pairs = [tuple(sorted((i, to[i])))]
        for i, j in pairs:
            total = size[i] + size[j]
            rows.append((int(ids[i]), int(ids[j]), _exact(size[i], x[i], size[j], x[j]), int(total)))
            x[i] = (size[i] * x[i] + size[j] * x[j]) / total
            size[i] = total
        gone = np.array([j for _, j in pairs])
        live = np.setdiff1d(live, gone)
        new = np.array([i for i, _ in pairs])
        d[np.ix_(new, live)] = _squared(size[new], x[new], size[live], x[live])
        d[np.ix_(live, new)] = d[np.ix_(new, live)].T
        d[new, new] = np.inf
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)],
                    names=["a", "b", "height", "size"])


def _dealt(clusters: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    """The clusters in blocks ``own``, each block once for every block of the other side."""
    named = clusters.select(*[F.col(c).alias(c) for c in ("id", "size", "centroid")])  # the two sides are one table
    rows = named.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int"))
    return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def _twins(points: DataFrame) -> DataFrame:
    """(id, first, nth, copies): equal series, told by two 64-bit hashes, are numbered in the order of their ids."""
    key = [F.xxhash64(F.lit(1), "centroid").alias("h1"), F.xxhash64(F.lit(2), "centroid").alias("h2")]
    same = Window.partitionBy("h1", "h2")
    return points.select("id", *key).select("id", F.min("id").over(same).alias("first"),
                                            F.row_number().over(same.orderBy("id")).alias("nth"), F.count("*").over(same).alias("copies"))


def ward_merges(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b, height, size): the merges of Ward's hierarchy over ``vectors(stock_code, features)``.

    ``a`` and ``b`` are the smallest stock codes of the two clusters (``a < b``), ``height`` their Ward
    distance, ``size`` the number of series of both.  A series but the first is ``b`` in just one row: the
    table is a forest that points from each cluster to the one it goes into.

    Defined results: equal series are merged first, at height 0, in the order of their codes; equal
    distances go to the smaller codes; one series or none gives no rows.  Codes are distinct and vectors
    of one length.
    """
    ordered = vectors.orderBy("stock_code").select(F.monotonically_increasing_id().alias("id"), "stock_code", vector_to_array("features").alias("centroid"))
    points = materialize(ordered, "ward-points")
    twins = materialize(_twins(points), "ward-twins")
    merges = [twins.where("nth > 1").select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("height"), F.col("nth").cast("long").alias("size"))]
    heads = twins.where("nth = 1").select("id", F.col("copies").alias("size"))
    clusters = materialize(points.drop("stock_code").join(heads, "id"), "ward-clusters")
    n, known = clusters.count(), None

    while n > block:
        seekers = clusters if known is None else clusters.join(known.select("id"), "id", "left_anti")
        n_seek = n if known is None else seekers.count()
        parts, seek_parts = -(-n // block), max(1, -(-n_seek // block))
        left = _dealt(seekers, "s", seek_parts, "t", parts).groupBy("s", "t")
        right = _dealt(clusters, "t", parts, "s", seek_parts).groupBy("s", "t")
        found = left.cogroup(right).applyInArrow(_nearest, NEAREST)
        best = found.groupBy("id").agg(F.min(F.struct("d", "lo", "hi")).alias("best")).select("id", "best.*")
        known = materialize(best if known is None else best.unionByName(known), "ward-nearest")

        pairs = known.groupBy("lo", "hi").agg(F.min("d").alias("height"), F.count("*").alias("times")).where("times = 2")
        pairs = materialize(pairs, "ward-pairs")
        if pairs.isEmpty():  # equal distances in a ring: the closest pair
            pairs = materialize(known.orderBy("d", "lo", "hi").limit(1).select("lo", "hi", F.col("d").alias("height")), "ward-pairs")
        a = clusters.select(F.col("id").alias("lo"), F.struct("size", "centroid").alias("a"))
        b = clusters.select(F.col("id").alias("hi"), F.struct("size", "centroid").alias("b"))
        total = F.col("a.size") + F.col("b.size")
        mean = F.zip_with("a.centroid", "b.centroid", lambda x, y: (F.col("a.size") * x + F.col("b.size") * y) / total)
        new = materialize(pairs.join(a, "lo").join(b, "hi").select("lo", "hi", "height", total.alias("size"), mean.alias("centroid")), "ward-new")
        merges.append(new.select(F.col("lo").alias("a"), F.col("hi").alias("b"), "height", F.col("size").cast("long").alias("size")))
        touched = new.select(F.explode(F.array("lo", "hi")).alias("id"))
        clusters = materialize(clusters.join(touched, "id", "left_anti")
                               .unionByName(new.select(F.col("lo").alias("id"), "size", "centroid")), "ward-clusters")
        # who was merged, or whose neighbour was, looks for a new one
        for side in ("lo", "hi"):
            known = known.join(touched.withColumnRenamed("id", side), side, "left_anti")
        known = known.select("id", "d", "lo", "hi")
        n -= new.count()

    merges.append(clusters.groupBy(F.lit(0).alias("all")).applyInArrow(_rest, "a long, b long, height double, size long"))
    every = materialize(reduce(DataFrame.union, merges), "ward-merges")
    code = points.select("id", "stock_code")
    return (every.join(code.select(F.col("id").alias("a"), F.col("stock_code").alias("from")), "a")
            .join(code.select(F.col("id").alias("b"), F.col("stock_code").alias("into")), "b")
            .select(F.col("from").alias("a"), F.col("into").alias("b"), "height", "size"))


def cut_merges(merges: DataFrame, stocks: DataFrame, k: int) -> DataFrame:
    """(stock_code, cluster): the groups that are left without the ``k - 1`` highest merges, numbered from 0 by
    their smallest code; fewer groups where there are fewer stocks.

    Of equally high merges the larger goes first, then the one of the smaller codes.  Stocks follow the
    merges to their group's smallest code by pointer jumping, so in as many rounds as the
    binary logarithm of the longest way.
    """
    top = merges.orderBy(F.desc("height"), F.desc("size"), "a", "b").limit(max(k, 1) - 1).select("b")
    into = merges.join(F.broadcast(top), "b", "left_anti").select(F.col("b").alias("stock_code"), "a")
    way = materialize(stocks.select("stock_code").distinct().join(into, "stock_code", "left")
                      .select("stock_code", F.coalesce("a", "stock_code").alias("root")), "ward-way")
    while True:
        up = way.select(F.col("stock_code").alias("root"), F.col("root").alias("up"))
        jumped = materialize(way.join(up, "root").select("stock_code", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "ward-way")
        way = jumped.select("stock_code", "root")
        if jumped.where("moved").isEmpty():
            break
    number = F.row_number().over(Window.orderBy("root")) - 1  # one row per group
    groups = way.select("root").distinct().withColumn("cluster", number)
    return way.join(F.broadcast(groups), "root").select("stock_code", "cluster")
