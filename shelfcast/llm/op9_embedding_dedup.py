"""Near-duplicate embeddings by p-stable hashing in several tables and exact cosines."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import blocked, components, sorted_groups, whole_groups
from shelfcast.session import materialize

#: Cosine from which two vectors are linked; the bucket width of a projection.
COSINE, WIDTH = 0.9, 2.5
#: Chance that a pair at exactly COSINE shares no table (pairs at 0.95: under 1e-8).
MISS = 1e-3
#: Sign bits of a vector, and how many two bucket mates may differ in.  At cosine 0.9 they differ in
#: 18.4 on average with deviation 4.0, so 45 is over six deviations off; unrelated vectors
#: differ in 64 with deviation 5.7, so few of them (about one pair in two thousand) pass.
SIGNS, SIGN_BITS = 128, 45
BLOCK = 1024


def same_bucket(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection of two points at a Euclidean distance agrees."""
    r = width / distance
    return erf(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def shape(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(projections per table, tables) for ``n`` vectors.

    So many projections that a bucket holds one unrelated vector (at a right angle)
    on average, and so many tables that a pair at ``cosine`` shares none with
    probability ``miss``.  Both follow from ``n`` by one rule: the tables grow as
    about the 0.27th power of ``n``.
    """
    near, far = same_bucket(sqrt(2 - 2 * cosine)), same_bucket(sqrt(2.0))
    k = max(4, ceil(log(max(n, 2)) / -log(far)))
    return k, ceil(log(miss) / log(1 - near**k))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors as bytes and the class of equal vectors; null where a vector can't be linked."""
    for b in batches:
        lists = b.column(1)
        unit: list[bytes | None] = [None] * b.num_rows
        classes: list[bytes | None] = [None] * b.num_rows
        lengths = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
        values = lists.flatten()
        whole = np.ones(b.num_rows, bool)
        if values.null_count:
            owner = np.repeat(np.arange(b.num_rows), lengths)
            whole[owner[np.asarray(values.is_null())]] = False
        flat = np.asarray(pc.fill_null(values.cast(pa.float64()), 0.0))
        starts = np.cumsum(lengths) - lengths
        for n in np.unique(lengths[lengths > 0]):
            at = np.flatnonzero((lengths == n) & whole)
            x = flat[starts[at][:, None] + np.arange(n)]
            top = np.abs(x).max(1, initial=0.0)
            good = np.isfinite(x).all(1) & (top > 0)
            at, x, top = at[good], x[good], top[good]
            scaled = x / top[:, None]  # so that squares neither overflow nor vanish
            scaled /= np.sqrt((scaled * scaled).sum(1))[:, None]
            for i, row, u in zip(at, x, scaled, strict=True):
                unit[i], classes[i] = u.tobytes(), blake2b(row.tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(classes, pa.binary()), pa.array(unit, pa.binary())], names=["vec_id", "class_id", "unit"])


def _rows(column: pa.Array | pa.ChunkedArray, kind) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) of the byte rows of each width."""
    values = column.to_pylist()
    widths = np.array([len(v) for v in values])
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        yield at, np.frombuffer(b"".join(values[i] for i in at), kind).reshape(len(at), -1)


def _hasher(k: int, tables: int):
    """Table keys (32 bits each) and sign bits of unit vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, signs = [b""] * b.num_rows, np.zeros((b.num_rows, SIGNS // 8), np.uint8)
            for at, x in _rows(b.column(1), np.float64):
                dim = x.shape[1]
                rng = np.random.default_rng([0x9E37, dim])
                signs[at] = np.packbits(x @ rng.normal(size=(dim, SIGNS)) > 0, axis=1)
                out = np.empty((len(at), tables), np.uint32)
                odd = rng.integers(0, 2**62, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                for t in range(tables):
                    cell = np.floor((x @ rng.normal(size=(dim, k)) + rng.uniform(0, WIDTH, k)) / WIDTH).astype(np.int64).astype(np.uint64)
                    mixed = (cell * odd).sum(1, dtype=np.uint64) + np.uint64(dim)
                    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
                    out[:, t] = (mixed >> np.uint64(32)).astype(np.uint32)
                for i, row in zip(at, out, strict=True):
                    keys[i] = row.tobytes()
            lists = np.frombuffer(b"".join(keys), np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(keys, pa.binary()), pa.array([r.tobytes() for r in signs], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, len(lists) + 1, tables, dtype=np.int32)), pa.array(lists))],
                names=["class_id", "keys", "signs", "buckets"])
    return run


CELL = ["band", "band_key", "ci", "cj"]


def _alive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a cell that have a mate within SIGN_BITS.

    Most cells are tiny, so all cells of a batch are compared at once: every row with
    the row ``d`` places on, for d up to the largest cell's size.
    """
    for t, starts in whole_groups(batches, CELL):
        sizes = np.diff([*starts, t.num_rows])
        cell = np.repeat(np.arange(len(starts)), sizes)
        s = np.frombuffer(b"".join(t["signs"].to_pylist()), np.uint64).reshape(t.num_rows, -1)
        block = t["block"].to_numpy()
        apart = t["ci"].to_numpy() != t["cj"].to_numpy()
        keep = np.zeros(t.num_rows, bool)
        for d in range(1, int(sizes.max())):
            i = np.flatnonzero(cell[d:] == cell[:-d])
            near = (np.bitwise_count(s[i] ^ s[i + d]).sum(1) <= SIGN_BITS) & (~apart[i] | (block[i] != block[i + d]))
            keep[i[near]] = keep[i[near] + d] = True
        if keep.any():
            yield from t.select([*CELL, "block", "class_id"]).filter(pa.array(keep)).combine_chunks().to_batches()


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell and class with a link: copies linked by pairs that this table is the first to find, and a local root."""
    for g in sorted_groups(batches, CELL):
        band, apart = g["band"][0].as_py(), g["ci"][0].as_py() != g["cj"][0].as_py()
        ids, copies, block = g["class_id"].to_pylist(), g["copies"].to_numpy(), g["block"].to_numpy()
        linked = np.zeros((len(ids), len(ids)), bool)
        for at, x in _rows(g["unit"], np.float64):
            linked[np.ix_(at, at)] = x @ x.T >= COSINE
        np.fill_diagonal(linked, False)
        if apart:
            linked &= block[:, None] != block[None, :]
        if not linked.any():
            continue
        keys = np.frombuffer(b"".join(g["keys"].to_pylist()), np.uint32).reshape(len(ids), -1)
        owned = linked.copy()
        for t in range(band):
            i, j = np.nonzero(owned)
            if len(i) == 0:
                break
            owned[i, j] = keys[i, t] != keys[j, t]
        root = np.arange(len(ids))
        while True:
            least = np.minimum(root, np.where(linked, root[None, :], len(ids)).min(1))
            least = least[least]
            if (least == root).all():
                break
            root = least
        some = np.flatnonzero(linked.any(1))
        yield pa.RecordBatch.from_arrays([
            pa.array([ids[i] for i in some], pa.binary()), pa.array((owned * copies[None, :]).sum(1)[some]),
            pa.array([ids[i] for i in root[some]], pa.binary())], names=["class_id", "links", "root"])


def embedding_links(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding)``.

    Equal vectors form a class with a number of copies, so copies never meet in
    pairs.  Unit vectors are hashed to ``shape(n)`` tables of quantised random
    projections.  In each bucket ``SIGNS`` sign bits sort out the mates that can't reach the
    cosine, before any vector is joined; the rest is compared exactly, in double precision, in blocks of
    ``block`` members.  A linked pair is counted by the first table that finds it
    and only counts and local roots leave a task, never pairs.

    Defined results: null vectors, zero vectors and vectors with null or non-finite
    components link with nothing; vectors of different lengths don't link; each row
    counts as one vector, repeated ids included; a null ``vec_id`` takes its
    component's smallest id and is kept only where there is none; an empty table
    gives an empty result; other columns are ignored.
    """
    clean = materialize(vectors.select("vec_id", "embedding").mapInArrow(
        _clean, f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, class_id binary, unit binary"), "op9-vectors")
    classes = clean.where("class_id is not null").groupBy("class_id").agg(F.count("*").alias("copies"), F.min("unit").alias("unit"))
    classes = materialize(classes, "op9-classes")
    k, tables = shape(classes.count())
    hashes = materialize(classes.select("class_id", "unit").mapInArrow(
        _hasher(k, tables), "class_id binary, keys binary, signs binary, buckets array<int>"), "op9-keys")
    rows = hashes.select("class_id", "signs", F.posexplode("buckets").alias("band", "band_key"))
    shared = rows.groupBy("band", "band_key").agg(F.count("*").alias("members")).where("members > 1")
    cells = blocked(rows.join(shared, ["band", "band_key"]), block).select(*CELL, "block", "class_id", "signs")
    alive = cells.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(_alive, "band int, band_key int, ci int, cj int, block int, class_id binary")
    alive = materialize(alive, "op9-alive")
    full = alive.join(classes, "class_id").join(hashes.select("class_id", "keys"), "class_id")
    found = materialize(full.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(
        _cosines, "class_id binary, links long, root binary"), "op9-links")

    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")), "op9-components")
    of_class = (classes.select("class_id", "copies").join(links, "class_id", "left")
                .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
                .select("class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "class_id").alias("root")))
    ids = clean.select("vec_id", "class_id")
    alone = ids.where("class_id is null").select("vec_id", "class_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("binary").alias("root"))
    of_class = materialize(of_class, "op9-linked")
    out = materialize(ids.where("class_id is not null").join(of_class, "class_id").unionByName(alone), "op9-rows")
    least = materialize(out.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("component_id")), "op9-least")
    # rows without a component are no part of the join: all of them would be one key
    linked = out.where("root is not null").join(least, "root")
    out = linked.unionByName(out.where("root is null").withColumn("component_id", F.lit(None).cast(least.schema["component_id"].dataType))).withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def op9_embedding_dedup(vectors: DataFrame) -> DataFrame:
    """The contract's (vec_id, n_links, component_id, kept): :func:`embedding_links` as it is, with its defined results."""
    return embedding_links(vectors)


ORACLE = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, row_number() OVER () AS row, list_transform(CAST(embedding AS FLOAT[]), lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
good AS (
  SELECT row, v, sqrt(list_dot_product(v, v)) AS size FROM vectors
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.row AS a, b.row AS b FROM good a JOIN good b ON a.row <> b.row AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9),
reached AS (SELECT row, row AS at FROM vectors UNION SELECT r.row, l.b FROM reached r JOIN links l ON l.a = r.at),
least AS (SELECT r.row, min(x.vec_id) AS component_id FROM reached r JOIN vectors x ON x.row = r.at GROUP BY r.row)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = x.row) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors x JOIN least USING (row)
"""
