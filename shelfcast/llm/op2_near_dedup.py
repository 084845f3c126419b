"""Near-duplicate documents by banded SetSketch registers, likelihood and full sets."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import setsketch
from shelfcast.llm.common import blocked, components, lean, quoted, row_key, sorted_groups, unused
from shelfcast.llm.shingles import shingle_sets, text_chunks
from shelfcast.session import materialize

#: Words per shingle and the link rule 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 5, 75
#: Registers, and bands of ROWS registers.  A pair at 0.75 shares none of the 32 bands
#: with probability (1 - 0.75 ** 4) ** 32 = 5e-6, a pair at 0.8 with 4e-8.
REGISTERS, BANDS, ROWS = 512, 32, 4
#: The estimate must reach 0.75 less four standard errors, sqrt(0.75 * 0.25 / 512) = 0.0191.
LEAST_ESTIMATE = 0.75 - 4 * 0.0191
#: Members of a bucket that are compared in one task; larger buckets are split into blocks.
BLOCK = 1024


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in text_chunks(batch.column(1)):
            elements, bounds = shingle_sets(data, offsets, WORDS)
            regs = setsketch.registers(elements, bounds, REGISTERS)
            keys = regs[:, :BANDS * ROWS].reshape(b - a, BANDS, ROWS).copy().view(np.int64).reshape(-1)
            classes = [blake2b(elements[bounds[i]:bounds[i + 1]].tobytes(), digest_size=16).digest() for i in range(b - a)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a),
                pa.array(np.diff(bounds)),
                pa.array(classes, pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, BANDS, dtype=np.int32)), pa.array(keys)),
                pa.array([r.tobytes() for r in regs], pa.binary())],
                names=["row_id", "n_shingles", "class_id", "bands", "regs"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in text_chunks(batch.column(0)):
            elements, bounds = shingle_sets(data, offsets, WORDS)
            sets = [elements[bounds[i]:bounds[i + 1]].tobytes() for i in range(b - a)]
            yield pa.RecordBatch.from_arrays([
                pa.array([blake2b(s, digest_size=16).digest() for s in sets], pa.binary()), pa.array(sets, pa.binary())],
                names=["class_id", "elements"])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, n_a, regs_a, n_b, regs_b), the pairs whose estimate is near the threshold or above."""
    for t in batches:
        if t.num_rows == 0:
            continue
        na, nb = t.column(2).to_numpy(), t.column(4).to_numpy()
        est = setsketch.estimate(_matrix(t.column(3)), _matrix(t.column(5)), na, nb)
        keep = pa.array((est >= LEAST_ESTIMATE) & (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)))
        yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(keep)


CELL = ["band", "band_key", "ci", "cj"]


def _cross(comp: np.ndarray, n: np.ndarray, block: np.ndarray, apart: bool, i: int) -> np.ndarray:
    """Later members of a cell that are not in member ``i``'s component (nor block, across blocks) and of a size to be linked."""
    near = (comp[i + 1:] != comp[i]) & (100 * np.minimum(n[i + 1:], n[i]) >= PERCENT * np.maximum(n[i + 1:], n[i]))
    if apart:
        near &= block[i + 1:] != block[i]
    return np.flatnonzero(near) + i + 1


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().dictionary_encode().indices.to_numpy()


def _alive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a cell that likelihood links to a row of another component."""
    for g in sorted_groups(batches, CELL):
        comp, n, block, regs = _numbers(g["root"]), g["n_shingles"].to_numpy(), g["block"].to_numpy(), _matrix(g["regs"])
        apart, keep, quick = g["ci"][0].as_py() != g["cj"][0].as_py(), np.zeros(len(comp), bool), np.ascontiguousarray(regs[:, :REGISTERS // 4])
        for i in range(len(comp) - 1):
            others = _cross(comp, n, block, apart, i)
            if keep[i]:  # only rows that aren't marked yet can be of use
                others = others[~keep[others]]
            # a look at a quarter of the registers, with six standard errors' room, then at all
            others = others[(quick[others] == quick[i]).sum(1) >= (LEAST_ESTIMATE - 0.15) * quick.shape[1]]
            others = others[(regs[others] == regs[i]).sum(1) >= (LEAST_ESTIMATE - 0.02) * REGISTERS]
            if len(others):
                likely = setsketch.estimate(np.broadcast_to(regs[i], (len(others), REGISTERS)), regs[others], np.full(len(others), n[i]), n[others]) >= LEAST_ESTIMATE
                keep[others[likely]] = True
                keep[i] |= likely.any()
        if keep.any():
            yield from g.select([*CELL, "block", "class_id", "root"]).filter(pa.array(keep)).combine_chunks().to_batches()


def _bridges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One linked pair, on full sets, for every two components of a cell that have one."""
    for g in sorted_groups(batches, CELL):
        comp, n, block = _numbers(g["root"]), g["n_shingles"].to_numpy(), g["block"].to_numpy()
        apart, ids = g["ci"][0].as_py() != g["cj"][0].as_py(), g["class_id"]
        sets = [np.frombuffer(e, np.uint64) for e in g["elements"].to_pylist()]
        values, flat = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        mark, seen, found = np.zeros(len(values), np.uint8), set(), []
        for i in range(len(comp) - 1):
            others = _cross(comp, n, block, apart, i)
            if len(others) == 0:
                continue
            own = flat[starts[i]:starts[i] + n[i]]
            mark[own] = 1
            common = np.add.reduceat(mark[flat[starts[i]:]], starts[i:] - starts[i], dtype=np.int64)[others - i]
            mark[own] = 0
            for j in others[100 * common >= PERCENT * (n[i] + n[others] - common)]:
                if (pair := (min(comp[i], comp[j]), max(comp[i], comp[j]))) not in seen:
                    seen.add(pair)
                    found.append((i, int(j)))
        if found:
            left, right = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
            roots = g["root"].combine_chunks()
            yield pa.RecordBatch.from_arrays([roots.take(left), roots.take(right)], names=["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, set_a, set_b), the pairs whose full sets meet the link rule."""
    for t in batches:
        keep = []
        for x, y in zip(t.column(2), t.column(3), strict=True):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


PAIR = "a binary, b binary"


def near_duplicate_components(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, row_id, root) for every row of ``docs``.

    A text's set is its distinct 5-word shingles (A-Z lower-cased, words split at
    ASCII white space; with fewer words the whole sequence).  Texts are linked when
    100 * intersection >= 75 * union; ``component_id`` is the smallest ``doc_id``
    that links reach and ``kept`` marks the rows that carry it.  ``root`` is the
    component itself, whatever its ids; null for texts without shingles.

    1. Every text is sketched where it is read; texts with equal sets form a class,
       and only one row per class goes on, so copies never meet in pairs.
    2. Classes that agree in a band share a bucket.  Round one compares each member
       with its bucket's smallest member (a star, so linear in the bucket), by
       likelihood and then on full sets, and joins linked classes to components.
    3. Round two compares, within buckets that still hold several components, only
       members of different components, in blocks of ``block`` rows: likelihood tells
       which members go on, full sets decide, and what leaves a task is one link for
       each two components, never the pairs.

    Defined results: null, empty or white-space texts have ``n_shingles`` 0 and stand
    alone; repeated rows are copies of each other (all with the smallest id are
    kept); a null ``doc_id`` takes the component's smallest id and is kept only if
    it stands alone; an empty table gives an empty result; other columns are ignored.
    """
    base = docs.select(row_key().alias("row_id"), "text")
    sk = materialize(base.mapInArrow(lean(_sketch), "row_id binary, n_shingles long, class_id binary, bands array<long>, regs binary"), "op2-sketches")
    filled = sk.where("n_shingles > 0")

    # One row per class: repeated classes collapse before anything is compared.
    band_rows = (filled.select("class_id", "bands").dropDuplicates(["class_id"])
                 .select("class_id", F.posexplode("bands").alias("band", "band_key")))
    hubs = band_rows.groupBy("band", "band_key").agg(F.min("class_id").alias("hub"), F.count("*").alias("members")).where("members > 1")
    buckets = materialize(band_rows.join(hubs, ["band", "band_key"]), "op2-buckets")

    met = buckets.select("class_id").distinct()
    sketches = materialize(filled.join(met, "class_id", "left_semi").groupBy("class_id")
                           .agg(F.min("row_id").alias("row_id"), F.min("n_shingles").alias("n_shingles"), F.min("regs").alias("regs")), "op2-classes")
    chosen = base.join(sketches.select("row_id"), "row_id", "left_semi").select("text")
    sets = materialize(chosen.mapInArrow(lean(_sets), "class_id binary, elements binary")
                       .groupBy("class_id").agg(F.min("elements").alias("elements")), "op2-sets")

    def named(df: DataFrame, side: str, *cols: str) -> DataFrame:
        return df.select(F.col("class_id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in cols])

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        full = pairs.join(named(sets, "a", "elements"), "a").join(named(sets, "b", "elements"), "b")
        return materialize(full.select("a", "b", "elements_a", "elements_b").mapInArrow(lean(_linked), PAIR), name)

    stars = buckets.where("class_id <> hub").select(F.col("hub").alias("a"), F.col("class_id").alias("b")).distinct()
    stars = (stars.join(named(sketches, "a", "n_shingles", "regs"), "a").join(named(sketches, "b", "n_shingles", "regs"), "b")
             .select("a", "b", "n_shingles_a", "regs_a", "n_shingles_b", "regs_b").mapInArrow(lean(_likely), PAIR))
    first = confirmed(stars, "op2-links")
    roots = components(first, "op2-first")

    labelled = (buckets.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
                .withColumn("root", F.coalesce("root", "class_id")))
    mixed = labelled.groupBy("band", "band_key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    open_rows = labelled.join(mixed.select("band", "band_key"), ["band", "band_key"], "left_semi")
    cells = (blocked(open_rows, block).join(sketches.select("class_id", "n_shingles", "regs"), "class_id")
             .select(*CELL, "block", "class_id", "root", "n_shingles", "regs"))
    alive = materialize(cells.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(
        lean(_alive), "band int, band_key long, ci int, cj int, block int, class_id binary, root binary"), "op2-alive")
    full = alive.join(sets, "class_id").withColumn("n_shingles", (F.octet_length("elements") / 8).cast("long"))
    bridges = materialize(full.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(lean(_bridges), PAIR).distinct(), "op2-bridges")
    joined = components(bridges, "op2-second")

    top = (filled.select("row_id", "class_id")
           .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
           .join(joined.select(F.col("node").alias("root"), F.col("root").alias("new_root")), "root", "left")
           .select("row_id", F.coalesce("new_root", "root").alias("root")).distinct())
    ids = docs.select("doc_id", row_key().alias("row_id"))
    rows = ids.join(top, "row_id", "left").join(sk.select("row_id", "n_shingles").distinct(), "row_id")
    rows = materialize(rows, "op2-rows")
    grouped, alone = rows.where("root is not null"), rows.where("root is null")  # rows without shingles would all be one key
    least = materialize(grouped.groupBy("root").agg(F.min("doc_id").alias("component_id")), "op2-least")
    out = grouped.join(least, "root").unionByName(alone.withColumn("component_id", F.lit(None).cast(docs.schema["doc_id"].dataType)))
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"), "row_id", "root")


def op2_near_dedup(docs: DataFrame) -> DataFrame:
    """The contract's columns of :func:`near_duplicate_components`."""
    return near_duplicate_components(docs).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each near-duplicate component, all columns unchanged.

    Equal rows (same id and text) that would all be kept are reduced to one.
    """
    (row,) = unused(docs, "_row")
    kept = near_duplicate_components(docs).where("kept")
    # of several texts under the component's id the one with the smallest key stays
    alone = F.when(F.col("component_id").isNull(), F.col("row_id"))
    one = kept.groupBy("component_id", alone.alias("alone")).agg(F.min("row_id").alias(row))
    return docs.withColumn(row, row_key()).join(one.select(row), row, "left_semi").dropDuplicates([row]).select(*quoted(docs))


def one_per_component(docs: DataFrame) -> DataFrame:
    """``docs`` with just one row of each near-duplicate component, all columns unchanged.

    Unlike :func:`keep_one` it goes by the component and not by its id: unrelated texts
    under one reused id all stay, and of near copies without an id one stays.  The
    smallest id stays, then the smallest key; texts without shingles stand alone, equal
    rows (same id and text) are reduced to one.
    """
    (row,) = unused(docs, "_row")
    every = near_duplicate_components(docs)
    alone = F.when(F.col("root").isNull(), F.col("row_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row_id"))
    one = every.groupBy("root", alone.alias("alone")).agg(first.alias("first")).select(F.col("first.row_id").alias(row))
    return docs.withColumn(row, row_key()).join(one, row, "left_semi").dropDuplicates([row]).select(*quoted(docs))


ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, row_number() OVER () AS row,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT row, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT row, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM texts WHERE len(words) > 0)),
sizes AS (SELECT row, count(*) AS n FROM shingles GROUP BY row),
common AS (
  SELECT a.row AS a, b.row AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row <> b.row GROUP BY a.row, b.row),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reached AS (SELECT row, row AS at FROM texts UNION SELECT r.row, l.b FROM reached r JOIN links l ON l.a = r.at),
least AS (SELECT r.row, min(t.doc_id) AS component_id FROM reached r JOIN texts t ON t.row = r.at GROUP BY r.row)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, t.doc_id = component_id AS kept
FROM texts t JOIN least USING (row) LEFT JOIN sizes s USING (row)
"""
