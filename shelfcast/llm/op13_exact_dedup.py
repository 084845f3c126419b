"""Exact duplicates by deterministic block naming: blocks, then pairs of names, get integers until a text has one."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shingles import text_chunks
from shelfcast.session import materialize

#: Bytes of a block of normalised text.
BLOCK = 1024
#: A name is the number of the task that found it first, then its place there.
PLACE_BITS = 40


def _prefix_sums(mask: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])


def _cut(block: int):
    """Rows (rid, doc_id, text) to their normalised texts in blocks, with lengths and digest."""
    is_space = np.zeros(256, bool)
    is_space[[9, 10, 11, 12, 13, 32]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(2)):
                stays = ~is_space[data]
                kept, bounds = data[stays], _prefix_sums(stays)[offsets]
                size = np.diff(bounds)
                points = np.diff(_prefix_sums((data & 0xC0) != 0x80)[offsets])
                whole = kept.tobytes()
                digests = [sha256(whole[lo:hi]).hexdigest() for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                blocks = np.maximum(-(-size // block), 1)  # an empty text is one empty block
                first = _prefix_sums(blocks)
                starts = np.repeat(bounds[:-1] - first[:-1] * block, blocks) + np.arange(first[-1]) * block
                ends = np.concatenate([starts, [len(kept)]]).astype(np.int32)
                values = pa.Array.from_buffers(pa.binary(), int(first[-1]), [None, pa.py_buffer(ends), pa.py_buffer(whole)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(points), pa.array(size),
                    pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), values)],
                    names=["rid", "doc_id", "n_points", "n_bytes", "text_sha256", "blocks"])
    return run


def _differs(column: pa.Array) -> np.ndarray:
    """Whether each element but the first differs from the one before."""
    return ~np.asarray(pc.equal(column.slice(1), column.slice(0, len(column) - 1)))


def _number(keys: list[str]):
    """Names for rows sorted by (order, keys): runs of equal keys are numbered as they come.

    Rows whose run has no other row are left out, unless the run may go on in the next or
    previous batch.  The first and the last ``order`` value of a task may be in other tasks too:
    their runs are reported as rows without ``rid`` but with their keys.
    """
    names = ["rid", "place", "n", "name", "edge"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, runs, orders, before, tail = TaskContext.get().partitionId() << PLACE_BITS, 0, 0, None, []

        def edges(found: list) -> pa.RecordBatch:
            empty = pa.nulls(len(found), pa.int64())
            return pa.RecordBatch.from_arrays([empty, empty, empty, pa.array([n for n, _ in found], pa.int64()),
                                               pa.array([k for _, k in found], edge_type)], names=names)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            edge_type = pa.struct([batch.schema.field(k) for k in keys])
            t = pa.Table.from_batches([batch] if before is None else [before, batch]).combine_chunks()
            order_new = np.append(True, _differs(t["order"].chunk(0)))
            new = order_new.copy()
            for k in keys:
                new[1:] |= _differs(t[k].chunk(0))
            single = new & np.append(new[1:], False)
            single[0] = False
            if before is not None:
                new, order_new, single, t = new[1:], order_new[1:], single[1:], t.slice(1)
            number, order = runs + np.cumsum(new), orders + np.cumsum(order_new)
            starts = np.flatnonzero(new)
            found = lambda at: [(task + int(number[i]), {k: t[k][int(i)].as_py() for k in keys}) for i in at]
            if len(head := starts[order[starts] == 1]):
                yield edges(found(head))
            tail = ([] if order[-1] != orders else tail) + found(starts[order[starts] == order[-1]])
            keep = np.flatnonzero(~single)
            rows = t.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*(rows[c].combine_chunks() for c in names[:3]), pa.array(task + number[keep]),
                                              pa.nulls(len(keep), edge_type)], names=names)
            runs, orders, before = int(number[-1]), int(order[-1]), batch.slice(batch.num_rows - 1)
        if orders > 1:
            yield edges(tail)
    return run


def name_keys(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """(rid, place, n, name): one integer for equal ``keys`` and different ones for different keys.

    ``rows`` are (rid, place, n, *keys).  They are range-partitioned and sorted by a hash of the
    keys, the keys and the row, so a key with very many rows spreads over several tasks; runs of
    equal keys, compared byte by byte, are numbered in each task.  Runs that meet a task's edge are
    named alike by a grouping of those few.  Rows with a key that no other row has may be missing.
    """
    dealt = rows.select("rid", "place", "n", F.xxhash64(*keys).alias("order"), *[k for k in keys if k != "place"])
    placed = dealt.repartitionByRange("order", "rid").sortWithinPartitions("order", *keys, "rid")
    kinds = ", ".join(f"{k}: {rows.schema[k].dataType.simpleString()}" for k in keys)
    found = materialize(placed.mapInArrow(_number(keys), f"rid long, place long, n long, name long, edge struct<{kinds}>"), f"op13-names-{label}")
    edge = found.where("rid is null").select("name", "edge.*")
    least = edge.groupBy(*keys).agg(F.min("name").alias("least"), F.collect_set("name").alias("names")).where(F.size("names") > 1)
    alias = least.select("least", F.explode("names").alias("name"))
    return found.where("rid is not null").join(alias, "name", "left").select("rid", "place", "n", F.coalesce("least", "name").alias("name"))


def exact_copies(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, n_points) for every row of ``docs(doc_id, text)``.

    Texts are equal when they agree byte for byte without ASCII white space.  Of equal texts the row
    with the most code points in its original text stays, then the smallest ``doc_id``.

    1. Normalised texts are written once, in blocks of ``block`` bytes, with a number for each row.
    2. Blocks are sorted and equal ones (of the same length of text and place) get one integer.  A
       text with a block that no other text has there is alone and goes no further.
    3. Neighbouring names are paired, and the pairs named in the same way, until each text that is
       left has one name: names are equal only if the texts are, no hash decides.  The rounds are
       the binary logarithm of the blocks of the longest text that is left.

    Each round writes its names to the shared checkpoint folder.  Texts are shuffled once, afterwards
    only integers are; counts and the row that stays are partial aggregates.

    Defined results: null counts as empty text, and all empty texts are equal; a null ``doc_id`` comes
    after all others; of rows with equal id and text just one is kept; an empty table gives an empty
    result; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    base = materialize(rows.mapInArrow(
        _cut(block), f"rid long, doc_id {kind}, n_points long, n_bytes long, text_sha256 string, blocks array<binary>"), "op13-blocks")
    cells = base.select("rid", "n_bytes", F.size("blocks").cast("long").alias("n"), F.posexplode("blocks").alias("place", "block"))
    cells = cells.withColumn("place", F.col("place").cast("long"))
    named, done, level = name_keys(cells.select("rid", "place", "n", "n_bytes", "block"), ["n_bytes", "place", "block"], "0"), [], 0
    while True:
        whole = named.groupBy("rid").agg(F.min("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "name"))).alias("names"))
        whole = materialize(whole.where(F.size("names") == F.col("n")).select("rid", "n", F.col("names.name").alias("names")), f"op13-texts-{level}")
        done.append(whole.where("n = 1").select("rid", F.lit(level).alias("level"), F.element_at("names", 1).alias("name")))
        longer = whole.where("n > 1")
        if longer.isEmpty():
            break
        level += 1
        half = longer.withColumn("n", F.expr("(n + 1) div 2")).withColumn("place", F.explode(F.expr("sequence(0L, n - 1)")))
        pairs = half.select("rid", "place", "n", F.get("names", F.expr("cast(2 * place as int)")).alias("a"),
                            F.coalesce(F.get("names", F.expr("cast(2 * place + 1 as int)")), F.lit(-1).cast("long")).alias("b"))
        named = name_keys(pairs, ["a", "b"], str(level))

    meta = base.select("rid", "doc_id", "n_points", "text_sha256")
    shared = materialize(reduce(DataFrame.union, done).join(meta.drop("text_sha256"), "rid"), "op13-shared")
    best = F.min(F.struct((-F.col("n_points")).alias("size"), F.col("doc_id").isNull().alias("without"), "doc_id", "rid"))
    groups = shared.groupBy("level", "name").agg(F.count("*").alias("group_size"), best.alias("best")).where("group_size > 1")
    groups = materialize(groups.select("level", "name", "group_size", F.col("best.rid").alias("best"), F.col("best.doc_id").alias("keep_id")), "op13-groups")
    member = shared.join(groups, ["level", "name"]).select("rid", "keep_id", "group_size", (F.col("rid") == F.col("best")).alias("kept"))
    out = meta.join(member, "rid", "left")
    return out.select("doc_id", F.when(F.col("kept").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.coalesce("kept", F.lit(True)).alias("kept"),
                      "text_sha256", "n_points")


def op13_exact_dedup(docs: DataFrame) -> DataFrame:
    """The contract's columns of :func:`exact_copies`."""
    return exact_copies(docs).drop("n_points")


ORACLE = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
placed AS (
  SELECT doc_id, body, count(*) OVER (PARTITION BY body) AS group_size,
         row_number() OVER w AS nth, first_value(doc_id) OVER w AS keep_id
  FROM plain WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, nth = 1 AS kept, sha256(body) AS text_sha256 FROM placed
"""
