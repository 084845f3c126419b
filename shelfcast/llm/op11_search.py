"""Exact ranked lexical search over posting lists in geometric blocks with coordinatewise-maximum summaries."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.shingles import text_chunks
from shelfcast.session import materialize

TOP = 10
#: Bytes of item texts that are searched for at once; more items take more passes.
ITEM_BYTES = 1 << 22
#: Cells (documents x terms asked for) of a shard's forward matrix, and the documents of a shard at most.
CELLS, SHARD_DOCS = 1 << 23, 1 << 14
#: Postings of a block on average; a block has at most twice as many.
POSTINGS = 64
#: Coordinates of the sketches by which postings are clustered.
SKETCH = 32
#: Documents that are searched first, on average, for thresholds to start from.
SEED_DOCS = 1 << 14
#: Bytes of a text that are split into terms at once.
PIECE = 1 << 20


def _letters() -> bytes:
    """Byte table: A-Z as a-z, 0-9, a-z and bytes beyond ASCII as they are, all others a space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for lo, hi in ((48, 58), (97, 123)):
        table[lo:hi] = bytes(range(lo, hi))
    table[65:91] = bytes(range(97, 123))
    return bytes(table)


def term_counts(text: bytes) -> Counter:
    """Terms of a whole UTF-8 text with their occurrences; long texts are split in pieces, between terms."""
    plain, counts, at = text.translate(_letters()), Counter(), 0
    while len(plain) - at > PIECE:
        end = plain.find(b" ", at + PIECE)
        if end < 0:
            break
        counts.update(plain[at:end].split())
        at = end
    counts.update(plain[at:].split())
    return counts


def _forward(number: dict[bytes, int]):
    """Documents with at least one term: their number of terms, and the asked terms with occurrences."""
    asked = number.keys()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                keep, size, ids, tfs, ends = [], [], [], [], [0]
                for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    counts = term_counts(data[lo:hi].tobytes())
                    if counts:
                        found = asked & counts.keys()
                        keep.append(a + i)
                        size.append(counts.total())
                        ids += [number[t] for t in found]
                        tfs += [counts[t] for t in found]
                        ends.append(len(ids))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(keep, pa.int64())), pa.array(size, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                    names=["doc_id", "n", "terms", "tfs"])
    return run


class Shard:
    """Some documents as a matrix of term factors, with their posting lists in blocks.

    A term's list is clustered by document similarity (nearest of some documents drawn from it,
    by sketches of the weighted term vectors); each cluster, cut to ``2 * POSTINGS`` documents, is
    a block, whose summary is the largest factor of its documents in every coordinate that an item
    with this term can ask for.  Lists are blocked when an item first needs them.
    """

    def __init__(self, sizes: np.ndarray, bounds: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray,
                 n_docs: int, n_terms: int, coordinates: list[np.ndarray]):
        # m = 100 - 75 + ((75 * n * N) div L), in integers of any size
        distinct, which = np.unique(sizes, return_inverse=True)
        m = np.array([25 + 75 * int(n) * n_docs // n_terms for n in distinct.tolist()], np.int64)[which]
        row = np.repeat(np.arange(len(sizes)), np.diff(bounds))
        factor = 10**9 * tfs // (1000 * tfs + 8 * m[row])  # at most 10**6
        self.matrix = np.zeros((len(sizes), len(weights)), np.int32)
        self.matrix[row, terms] = factor
        self.most = self.matrix.max(0).astype(np.int64)
        rng = np.random.default_rng(0x5E15)
        sketch = self.matrix.astype(np.float32) @ (rng.normal(size=(len(weights), SKETCH)) * weights[:, None] * 1e-9).astype(np.float32)
        self.sketch = sketch / np.maximum(np.sqrt((sketch * sketch).sum(1)), 1e-30)[:, None]
        order = np.argsort(terms, kind="stable")
        self.postings, self.lists = row[order], np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.coordinates, self.blocks = coordinates, {}

    def blocked(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents by block, first document of each block and the end, summaries) of a term's list."""
        if term not in self.blocks:
            docs = self.postings[self.lists[term]:self.lists[term + 1]]
            starts = np.zeros(1, np.int64)
            if len(docs) > 2 * POSTINGS:
                rng = np.random.default_rng([0xB10C, term])
                heads = docs[rng.choice(len(docs), -(-len(docs) // POSTINGS), replace=False)]
                nearest = np.argmax(self.sketch[docs] @ self.sketch[heads].T, axis=1)
                order = np.argsort(nearest, kind="stable")
                docs, nearest = docs[order], nearest[order]
                first = np.append(True, nearest[1:] != nearest[:-1])
                place = np.arange(len(docs)) - np.maximum.accumulate(np.where(first, np.arange(len(docs)), 0))
                starts = np.flatnonzero(place % (2 * POSTINGS) == 0)
            summary = np.maximum.reduceat(self.matrix[np.ix_(docs, self.coordinates[term])], starts, axis=0)
            self.blocks[term] = docs, np.append(starts, len(docs)), summary
        return self.blocks[term]

    def search(self, terms: np.ndarray, weights: np.ndarray, least: int, best: "Best") -> None:
        """Offer every document of a score that can enter ``best`` and is at least ``least``.

        Lists are taken by falling bound; once the lists left can't reach the threshold together,
        no document that is in none of the lists before can.  A block is skipped if its summary's
        bound is below the threshold; all others are scored in full.
        """
        bound = weights * self.most[terms]
        order = np.argsort(-bound, kind="stable")
        rest = bound.sum()
        seen = np.zeros(len(self.matrix), bool)
        for j in order.tolist():
            need = max(least, best.least, 1)
            if rest < need:
                return
            rest -= bound[j]
            if bound[j] == 0:
                continue
            docs, starts, summary = self.blocked(int(terms[j]))
            at = np.searchsorted(self.coordinates[int(terms[j])], terms)
            alive = np.flatnonzero(summary[:, at] @ weights >= need)
            for group in np.array_split(alive, -(-len(alive) // 64)) if len(alive) else []:
                found = np.concatenate([docs[starts[i]:starts[i + 1]] for i in group.tolist()])
                found = found[~seen[found]]
                seen[found] = True
                scores = self.matrix[np.ix_(found, terms)] @ weights
                good = scores >= max(least, best.least, 1)
                best.offer(scores[good], found[good])


class Best:
    """The highest scores of an item so far; equal scores by ascending id, null ids last."""

    def __init__(self, top: int):
        self.top, self.rows, self.least, self.ids = top, [], 0, None

    def offer(self, scores: np.ndarray, docs: np.ndarray) -> None:
        if len(scores) == 0:
            return
        rows = [(-s, self.ids[d] is None, self.ids[d]) for s, d in zip(scores.tolist(), docs.tolist(), strict=True)]
        self.rows = sorted(self.rows + rows, key=lambda r: r[:2] + (0 if r[1] else r[2],))[:self.top]
        if len(self.rows) == self.top:
            self.least = -self.rows[-1][0]


def _search(items: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, coordinates: list[np.ndarray],
            n_docs: int, n_terms: int, least: dict[int, int], top: int):
    """The ``top`` documents of each item among a task's documents."""
    per_shard = int(min(SHARD_DOCS, max(64, CELLS // max(1, len(weights)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: Best(top) for number, _, _ in items}

        def shard(parts: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(parts).combine_chunks()
            ids, terms, tfs = t["doc_id"].to_pylist(), t["terms"].combine_chunks(), t["tfs"].combine_chunks()
            bounds = np.append(0, np.cumsum(np.diff(terms.offsets.to_numpy())))
            s = Shard(t["n"].to_numpy(), bounds, terms.flatten().to_numpy(), tfs.flatten().to_numpy(), weights, n_docs, n_terms, coordinates)
            for number, asked, factors in items:
                best[number].ids = ids
                s.search(asked, factors, least.get(number, 0), best[number])

        held, rows = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, per_shard):
                part = batch.slice(a, per_shard)
                if rows + part.num_rows > per_shard:
                    shard(held)
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            shard(held)
        out = [(number, r[2], -r[0]) for number, b in best.items() for r in b.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["item", "doc_id", "score"])
    return run


def _best(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item, with their rank; first within slices of the tasks' rows."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "score"), F.lit(64)))
    for keys in (["item", "slice"], ["item"]):
        sliced = sliced.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return sliced.drop("slice")


def _items_at_once(items: DataFrame, size: int) -> Iterator[list[tuple]]:
    """Runs of rows (item_id, terms with occurrences) of about ``size`` bytes, streamed to the driver."""
    held, total = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        text = (row["text"] or "").encode()
        if held and total + len(text) > size:
            yield held
            held, total = [], 0
        held.append((row["item_id"], term_counts(text)))
        total += len(text) + 100  # an item without text takes room too
    if held:
        yield held


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of ``docs(doc_id, text)`` for each row of ``items(item_id, text)``.

    Terms are runs of ASCII letters (A-Z as a-z), digits and characters beyond ASCII.  With N documents
    that have terms, L terms in all, n terms in a document and a term in df documents, tf times in this
    one, a document scores the sum, over the item's terms with repeats, of
    ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and
    ``m = 25 + (75 * n * N) div L``, all in integers but the logarithm.  Only scores above 0 are returned.

    1. Items are taken in runs of about ``item_bytes`` of text; a run's terms are what the driver and every
       task hold, whatever the number of documents.  Each document is reduced to the asked terms it has,
       written once; N, L and df are partial aggregates over all of them.
    2. A task indexes its documents shard by shard, in bounded memory: each asked term's posting list is
       clustered into blocks with coordinatewise-maximum summaries (:class:`Shard`), and a block is skipped
       only if its summary's bound is below the item's threshold, so the result is exact.
    3. Thresholds start from the search of a sample of about ``SEED_DOCS`` documents (a lower bound of what
       is asked for, so it changes the work and never the result) and rise in each task.  A task sends
       at most ``top`` rows for an item.

    Defined results: null texts have no terms; an item without terms, or without a scored document, has no
    rows; equal scores go by ascending ``doc_id``, null ids last; each row of either table counts by
    itself, repeats included; empty tables give an empty result; other columns are ignored.  ``doc_id``
    is an integer.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    parts = [_search_run(spark, docs, run, kind, top) for run in _items_at_once(items, item_bytes)]
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for p in parts:
        out = out.union(p)
    return out


def _search_run(spark: SparkSession, docs: DataFrame, run: list[tuple], kind: str, top: int) -> DataFrame:
    vocabulary = sorted(set().union(*(counts.keys() for _, counts in run)))
    number = {t: i for i, t in enumerate(vocabulary)}
    forward = materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _forward(number), "doc_id long, n long, terms array<int>, tfs array<long>"), "op11-forward")
    total = forward.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per asked term
        df[r["term"]] = r["count"]
    weights = np.array([floor(1000 * log((2 * total["docs"] + 2) / (2 * int(d) + 1))) for d in df], np.int64)

    items, beside = [], [set() for _ in vocabulary]
    for i, (_, counts) in enumerate(run):
        # terms that no document has add nothing
        asked = np.array(sorted(number[t] for t in counts if df[number[t]]), np.int64)
        if len(asked):
            items.append((i, asked, weights[asked] * np.array([counts[vocabulary[t]] for t in asked], np.int64)))
            for t in asked.tolist():
                beside[t].update(asked.tolist())
    coordinates = [np.array(sorted(b), np.int64) for b in beside]

    def found(rows: DataFrame, least: dict[int, int]) -> DataFrame:
        task = _search(items, weights, coordinates, total["docs"], total["terms"], least, top)
        return rows.mapInArrow(task, "item long, doc_id long, score long")

    least: dict[int, int] = {}
    if total["docs"] > 2 * SEED_DOCS:
        sample = forward.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(total["docs"] // SEED_DOCS)) == 0)
        least = {r["item"]: r["score"] for r in _best(found(sample, {}), top).where(F.col("rank") == top).collect()}
    best = _best(materialize(found(forward, least), "op11-found"), top)
    ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(run)], f"item long, item_id {kind}")
    return best.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's ten documents for each benchmark item: :func:`ranked_search` as it is."""
    return ranked_search(docs, benchmark)


ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + ((75 * n * docs) // terms))))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
