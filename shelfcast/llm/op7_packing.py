"""Packing of tokenised documents by length patterns, fitted by non-negative least squares."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import lean
from shelfcast.llm.tokens import PATTERN, Encoder, default_paths
from shelfcast.session import materialize

#: Tokens of a sequence.
CAPACITY = 2048
#: Pieces of one length that are numbered together.
CELL = 50_000
#: Representative lengths that patterns of three and of four documents draw from, lengths that
#: hold the most tokens and may stand up to REPEATS times in a pattern, and sweeps of the fit.
GRID3, GRID4, HEAVY, REPEATS, SWEEPS = 12, 5, 6, 8, 12


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter than the capacity."""
    first = n - capacity * (ceil(n / capacity) - 1)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, paths: tuple[str, str | None], capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document of ``docs``."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(paths, PATTERN)
        for batch in batches:
            rows, where = [], []
            for i, ids in enumerate(encoder.all_ids(batch.column(1))):
                for p, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    own = ids[start:start + length]
                    rows.append((p, start, length, zlib.crc32(own.tobytes()), *([own.astype(np.int32)] * with_ids)))
                    where.append(i)
            if rows:
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(where, pa.int32())), *(pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))],
                    names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length int, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lean(cut), schema)


class Plan:
    """Where the ``r``-th piece of each length goes: runs of ranks -> runs of sequences at one offset."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = dict(counts)
        self.total = dict(counts)
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int]] = []  # length, first rank, first sequence, offset

    def put(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.rows.append((length, self.total[length] - self.left[length], sequence, offset))
        self.left[length] -= n

    def repeat(self, pattern: tuple[int, ...], times: int) -> None:
        """``times`` new sequences that hold the lengths of ``pattern`` in turn."""
        offset = 0
        for length in pattern:
            self.put(length, times, self.sequences, offset)
            offset += length
        self.sequences += times

    def best_fit(self) -> None:
        """All pieces that are left, longest first, each to the fullest sequence that it fits."""
        room: dict[int, list[list[int]]] = {}  # tokens free -> runs of [first sequence, sequences]
        for length in sorted(self.left, reverse=True):
            while (n := self.left[length]) > 0:
                fits = min((r for r in room if r >= length), default=None)
                if fits is None:
                    per = self.capacity // length
                    times = max(1, n // per)
                    slots = min(per, n)
                    first = self.sequences
                    self.repeat((length,) * slots, times)
                    room.setdefault(self.capacity - slots * length, []).append([first, times])
                    continue
                run = room[fits][-1]
                take = min(n, run[1])
                self.put(length, take, run[0], self.capacity - fits)
                room.setdefault(fits - length, []).append([run[0], take])
                run[0], run[1] = run[0] + take, run[1] - take
                if run[1] == 0:
                    room[fits].pop()
                    if not room[fits]:
                        del room[fits]
            room.pop(0, None)


def length_patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Multisets of few lengths that fill a sequence.

    All pairs; triples with one and quadruples with two lengths from a grid of
    quantiles of the histogram; repeats of a length that holds many tokens (copies of
    one text do) with one or two others.  Their number depends on the capacity alone.
    """
    have = sorted(counts)
    weights = np.cumsum([counts[x] for x in have])

    def grid(k: int) -> list[int]:
        at = np.searchsorted(weights, (np.arange(k) + 0.5) / k * weights[-1])
        return sorted({have[i] for i in at})

    found = {(capacity,)} if capacity in counts else set()
    found |= {(a, capacity - a) for a in have if 2 * a >= capacity and capacity - a in counts}
    heavy = sorted(have, key=lambda x: (-x * counts[x], x))[:HEAVY]
    middles = [(g,) for g in grid(GRID3)] + [(g, h) for g in grid(GRID4) for h in grid(GRID4) if g <= h]
    middles += [(x,) * k for x in heavy for k in range(1, min(REPEATS, capacity // x) + 1)]
    for middle in middles:
        rest = capacity - sum(middle)
        if rest in counts or rest == 0:
            found.add(tuple(sorted((*middle, rest) if rest else middle, reverse=True)))
        found |= {tuple(sorted((*middle, a, rest - a), reverse=True)) for a in have if 2 * a >= rest > a and rest - a in counts}
    return sorted(found, reverse=True)


def fit(patterns: list[tuple[int, ...]], counts: dict[int, int], sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative least squares by coordinate descent: repeats whose use of each length is nearest to the histogram."""
    residual = {k: float(v) for k, v in counts.items()}
    uses = [tuple((k, p.count(k)) for k in set(p)) for p in patterns]
    norms = [sum(m * m for _, m in u) for u in uses]
    x = [0.0] * len(patterns)
    for _ in range(sweeps):
        for i, u in enumerate(uses):
            new = x[i] + sum(m * residual[k] for k, m in u) / norms[i]
            new = new if new > 0 else 0.0
            if (step := new - x[i]) != 0.0:
                x[i] = new
                for k, m in u:
                    residual[k] -= m * step
    return np.array(x)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Fit, round down, and best-fit what is left."""
    out = Plan(counts, capacity)
    if counts:
        patterns = length_patterns(counts, capacity)
        repeats = fit(patterns, counts) if patterns else np.array([])
        for i in np.argsort(-repeats, kind="stable"):
            pattern = patterns[i]
            times = min([int(repeats[i] + 1e-9), *(out.left[k] // pattern.count(k) for k in set(pattern))])
            if times > 0:
                out.repeat(pattern, times)
        out.best_fit()
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY, cell: int = CELL) -> DataFrame:
    """``cut`` (rows with ``doc_id``, ``piece``, ``length``) with ``sequence_id`` and ``offset``.

    Only the histogram of lengths, at most ``capacity`` counts, comes to the driver;
    the plan that goes back has a number of rows bounded by the capacity too.  Pieces
    of one length are numbered within cells of about ``cell`` rows and the cells'
    sizes are summed, so a length that most rows share is not one task's work.
    """
    spark = cut.sparkSession
    n_cells = max(1, ceil(cut.count() / cell))
    salted = cut.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_cells)))
    sizes = salted.groupBy("length", "_cell").agg(F.count("*").alias("n"))
    sizes = materialize(sizes, "op7-sizes")
    before = sizes.withColumn("_before", F.sum("n").over(Window.partitionBy("length").orderBy("_cell")) - F.col("n")).drop("n")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    made = plan(counts, capacity)
    rows = np.array(sorted(made.rows), np.int64).reshape(-1, 4)
    shared = spark.sparkContext.broadcast(rows)
    numbered = salted.withColumn("_in_cell", F.row_number().over(Window.partitionBy("length", "_cell").orderBy("doc_id", "piece", *[c for c in ("ids_crc32",) if c in cut.columns])))
    ranked = numbered.join(before, ["length", "_cell"]).withColumn("_rank", F.col("_in_cell") - 1 + F.col("_before"))

    names = cut.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        step = np.int64(1) << 40
        keys = table[:, 0] * step + table[:, 1]
        for b in batches:
            length, rank = b.column(b.num_columns - 2).to_numpy(), b.column(b.num_columns - 1).to_numpy()
            at = np.searchsorted(keys, length.astype(np.int64) * step + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-2], pa.array(table[at, 2] + rank - table[at, 1]), pa.array(table[at, 3])], names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.select(*names, F.col("length").alias("_length"), "_rank").mapInArrow(place, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces with ``ids``; a group has at most a sequence's tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op7_packing(docs: DataFrame, paths: tuple[str, str | None] | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    Defined results: null and empty texts are the one token that ends a document; a repeated row is
    packed once for each time it stands there; a null ``doc_id`` is kept; an empty
    table gives an empty result; other columns are ignored.  Texts are encoded once,
    whole; ids leave the task only as each piece's checksum.
    """
    cut = materialize(pieces(docs, paths or default_paths(), capacity), "op7-pieces")
    return pack(cut, capacity).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
