"""Helpers shared by the operators: inputs, row identity, sorted groups, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import materialize

#: The six ASCII white-space characters of the contracts, as a character class.
ASCII_SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bytes of an Arrow batch, unless the session sets its own; Spark itself bounds only the rows.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of the batches that go to Python workers, so that long texts don't add up to huge ones."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, str(2**31 - 1)):
        spark.conf.set(key, str(BATCH_BYTES))


def lean(run):
    """``run`` for ``mapInArrow``, giving memory back to the system at a task's end: workers are used again by later stages."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # not this C library
                pass
    return task


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128-bit identity of a row's (doc_id, text), nulls included.

    Rows that agree in both columns get the same key: every per-text result is
    the same for them, so it may be computed once and joined back to each.
    """
    parts = [F.coalesce(F.col(doc_id).cast("string"), F.lit("\x00null")), F.lit("\x00"),
             F.coalesce(F.col(text), F.lit("\x00null"))]
    return F.unhex(F.md5(F.concat(*parts)))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def quoted(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names have."""
    return [F.col(f"`{c}`") for c in df.columns]


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and where each group starts, from batches sorted by integer ``keys``.

    Only a group that goes on in the next batch is kept back, so callers bound memory
    by bounding groups.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        t = pa.Table.from_batches([*held, b])
        starts = _starts(t, keys)
        if starts[-1] > 0:
            yield t.slice(0, starts[-1]).combine_chunks(), starts[:-1]
        held = t.slice(starts[-1]).to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, _starts(t, keys)


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for k in keys:
        v = t[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per group of batches sorted by integer ``keys``."""
    for t, starts in whole_groups(batches, keys):
        for a, b in zip(starts, [*starts[1:], t.num_rows], strict=True):
            yield t.slice(a, b - a)


def blocked(rows: DataFrame, block: int, member: str = "class_id") -> DataFrame:
    """Deal the rows of large buckets to cells of at most about ``2 * block`` rows.

    ``rows`` has ``members``, the size of its bucket.  Members are split into blocks by
    hash; cell (ci, cj) holds blocks ci and cj, so every two members meet in just one
    cell.  A bucket of up to ``block`` members is the one cell (0, 0).
    """
    n = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64(member), n).cast("int")
    return (rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn("ci", F.least("block", "other")).withColumn("cj", F.greatest("block", "other")).drop("other"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (node, root) per node met.

    ``root`` is the smallest node of the component.  Each round hooks every root
    to its smallest neighbour, follows the hooks to their ends by pointer
    jumping, and contracts the edges; at least half of the roots that still have
    an edge go away per round.  All steps are joins and partial aggregates over
    tables written to the shared checkpoint folder, so nothing is collected and
    a lost executor costs a re-read.
    """
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    live = materialize(both.distinct(), f"{name}-edges")
    labels = None
    while not live.isEmpty():
        hook = live.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        while True:
            hook = materialize(hook, f"{name}-hooks")
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = hook.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved"))
            jumped = materialize(jumped, f"{name}-jumps")
            hook = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = hook
        else:
            later = hook.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
            labels = materialize(labels.join(later, "root", "left").select("node", F.coalesce("new_root", "root").alias("root")), f"{name}-labels")
        to = hook.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        to_b = hook.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        live = materialize(live.join(to, "a").join(to_b, "b").where("ra <> rb")
                           .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), f"{name}-edges")
    if labels is None:
        labels = live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
