"""Mean silhouettes with Euclidean distances (K4), for several clusterings of the same points in one pass.

A point's silhouette needs its distances to all others, so the work is quadratic in the points (stocks, not
lines).  Points are dealt to blocks; a task holds two blocks, and what leaves it are, for each point, its sums of
distances to the clusters of every clustering: as many numbers as there are clusters, never pairs.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialize

# what runs in Python workers travels by value: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Points of a block, and distances that are held at once.
BLOCK, CELLS = 4096, 1 << 20


def _block_sums(sizes: list[int]):
    """For points with ``x`` and one label per clustering: sums of distances to the clusters of another block."""
    first = np.cumsum([0, *sizes])

    def read(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = t.combine_chunks()
        n = t.num_rows
        return (t["id"].to_numpy(), t["x"].combine_chunks().flatten().to_numpy().reshape(n, -1),
                t["labels"].combine_chunks().flatten().to_numpy().reshape(n, -1))

    def run(own: pa.Table, other: pa.Table) -> pa.Table:
        ids, sums = np.empty(0, np.int64), np.empty((0, first[-1]))
        if own.num_rows and other.num_rows:
            (ids, x, _), (_, y, labels) = read(own), read(other)
            member = np.zeros((len(y), first[-1]))
            member[np.arange(len(y))[:, None], labels + first[:-1]] = 1.0
            sums = np.empty((len(ids), first[-1]))
            rows = max(1, CELLS // (len(y) * max(1, x.shape[1])))
            for a in range(0, len(ids), rows):
                gap = x[a:a + rows, None, :] - y[None, :, :]
                sums[a:a + rows] = np.sqrt((gap * gap).sum(2)) @ member
        bounds = pa.array(np.arange(0, sums.size + 1, first[-1], dtype=np.int32))
        return pa.table([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(sums.reshape(-1)))], names=["id", "sums"])
    return run


def euclidean_silhouettes(points: DataFrame, sizes: list[int], block: int = BLOCK) -> DataFrame:
    """(k, silhouette) for clusterings of ``points(features, labels)``: ``labels`` is an array with one label for each
    of the numbers of clusters ``sizes``, 0-based.

    A point's silhouette is (b - a) / max(a, b), a its mean distance to the others of its cluster and b the
    least mean distance to another cluster; 0 where it is alone in its cluster or both are 0.
    Empty clusters don't count.  Without points there are no rows.
    """
    own = points.select(F.monotonically_increasing_id().alias("id"), vector_to_array("features").alias("x"), F.col("labels").cast("array<long>").alias("labels"))
    own = materialize(own, "silhouette-points")
    blocks = max(1, -(-own.count() // block))
    dealt = own.withColumn("s", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    other = own.select(*[F.col(c).alias(c) for c in own.columns]).withColumn("t", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    pairs = dealt.withColumn("t", every).groupBy("s", "t").cogroup(other.withColumn("s", every).groupBy("s", "t"))
    sums = pairs.applyInArrow(_block_sums(sizes), "id long, sums array<double>")
    width = sum(sizes)
    total = sums.groupBy("id").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))
    each = own.join(total, "id").select("id", F.posexplode("labels").alias("c", "own"), "sums")
    # numbers of members: a row per cluster
    members = own.select(F.posexplode("labels").alias("c", "own")).groupBy("c", "own").agg(F.count("*").alias("n"))
    counts = materialize(members.groupBy("c").agg(F.map_from_entries(F.collect_list(F.struct("own", "n"))).alias("n_of")), "silhouette-counts")
    starts = F.array(*[F.lit(sum(sizes[:i])) for i in range(len(sizes))])
    widths = F.array(*[F.lit(k) for k in sizes])
    rows = each.join(F.broadcast(counts), "c").withColumn("sums", F.slice("sums", F.get(starts, F.col("c")) + 1, F.get(widths, F.col("c"))))
    n = F.element_at("n_of", F.col("own"))
    a = F.get("sums", F.col("own").cast("int")) / (n - 1)
    means = F.transform("sums", lambda s, i: F.when(i != F.col("own"), s / F.try_element_at(F.col("n_of"), i.cast("long"))))
    b = F.array_min(means)
    value = F.when(n == 1, 0.0).when(F.greatest(a, b) == 0, 0.0).otherwise((b - a) / F.greatest(a, b))
    mean = rows.groupBy("c").agg(F.avg(F.coalesce(value, F.lit(0.0))).alias("silhouette"))
    return mean.select(F.get(widths, F.col("c")).alias("k"), "silhouette")
