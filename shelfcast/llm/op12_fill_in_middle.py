"""Fill-in-the-middle transformation: line cuts found by a Fenwick tree over fixed blocks of each text."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shingles import text_chunks

#: Bytes of a block of the tree.
BLOCK = 2048
#: What stands before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = 7, 100, 50


def fenwick(counts: np.ndarray) -> np.ndarray:
    """The Fenwick trees of the rows of ``counts``: node i holds the sum of the lowbit(i) blocks up to i."""
    n, step = counts.shape[1], 1
    tree = np.concatenate([np.zeros((len(counts), 1), np.int64), counts], axis=1)
    while step <= n:
        node = np.arange(step, n - step + 1, 2 * step)
        tree[:, node + step] += tree[:, node]
        step *= 2
    return tree


def _starts_point(data: np.ndarray) -> np.ndarray:
    """Whether a UTF-8 byte is the first of its code point."""
    return (data & 0xC0) != 0x80


class LineIndex:
    """Where the lines of a text end, in bytes and code points.

    Per fixed block of ``block`` bytes the tree holds the number of line ends and of code
    points that start in it; a binary-lifting descent finds the block of the k-th line end
    and what lies before it, and only that block is looked at byte by byte.
    """

    def __init__(self, data: np.ndarray, block: int = BLOCK):
        self.data, self.block = data, block
        edges = np.arange(0, len(data), block)
        counts = np.zeros((2, len(edges)), np.int64)
        if len(data):
            counts[0] = np.add.reduceat(data == 10, edges, dtype=np.int64)
            counts[1] = np.add.reduceat(_starts_point(data), edges, dtype=np.int64)
        self.ends, self.points = counts.sum(1).tolist()
        self.lines, self.chars = (t.tolist() for t in fenwick(counts))
        #: lines of the text; the last one may lack its line break
        self.n = self.ends + bool(len(data) and data[-1] != 10)

    def after(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``k`` lines."""
        if k <= 0:
            return 0, 0
        if k > self.ends:
            return len(self.data), self.points
        blocks = len(self.lines) - 1
        at, left, points, step = 0, k, 0, 1 << (blocks.bit_length() - 1)
        while step:
            if at + step <= blocks and self.lines[at + step] < left:
                at += step
                left -= self.lines[at]
                points += self.chars[at]
            step >>= 1
        within = self.data[at * self.block:(at + 1) * self.block]
        end = int(np.flatnonzero(within == 10)[left - 1]) + 1
        return at * self.block + end, points + int(np.count_nonzero(_starts_point(within[:end])))


def _draws(seed: int, doc_id) -> list[int]:
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def _transform(seed: int, rate: int, spm: int, markers: tuple[str, str, str]):
    marks = [m.encode() for m in markers]
    pre, suf, mid = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offsets in text_chunks(batch.column(1)):
                lines, forms, heads, middles, outputs = [], [], [], [], []
                for doc_id, lo, hi in zip(ids.slice(a, b - a).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    index = LineIndex(data[lo:hi])
                    text = data[lo:hi].tobytes()
                    h1, h2, h3, h4 = _draws(seed, doc_id)
                    lines.append(index.n)
                    if not text or h3 % 100 >= rate or any(m in text for m in marks):
                        forms.append("plain")
                        heads.append(None)
                        middles.append(None)
                        outputs.append(text)
                        continue
                    first, last = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
                    (cut, head), (end, upto) = index.after(first), index.after(last)
                    prefix, middle, suffix = text[:cut], text[cut:end], text[end:]
                    heads.append(head)
                    middles.append(upto - head)
                    if h4 % 100 < spm:
                        forms.append("spm")
                        outputs.append(b"".join((suf, suffix, pre, prefix, mid, middle)))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((pre, prefix, suf, suffix, mid, middle)))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), pa.array(lines, pa.int64()), pa.array(forms, pa.string()), pa.array(heads, pa.int64()),
                    pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM,
                   markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs(doc_id, text)``.

    A text of ``n`` lines is cut after two of its lines (or before the first) into prefix, middle and
    suffix; the cuts, whether it is transformed (``rate`` percent) and the order (``spm`` percent suffix
    first) follow from the sha256 of ``seed:doc_id``, so any run gives the same rows.  ``markers`` stand
    before prefix, suffix and middle; a text that contains one of them stays plain.

    Work and memory follow the texts: one pass where they are read, a text's tree has one node for
    each ``BLOCK`` bytes, nothing is shuffled.

    Defined results: null and empty texts are plain, with ``n`` 0 and an empty output; plain rows have
    null ``prefix_chars`` and ``middle_chars``; a null ``doc_id`` draws as empty text; repeated rows give
    equal rows; an empty table gives an empty result; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _transform(seed, rate, spm, markers), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an ``output`` was made from; ``markers`` as given to :func:`fill_in_middle`."""
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in markers), -1)
    one, two, three = (F.element_at(parts, i) for i in (2, 3, 4))
    return (F.when(form == "psm", F.concat(one, three, two))
            .when(form == "spm", F.concat(two, three, one)).otherwise(output))


def op12_fill_in_middle(docs: DataFrame) -> DataFrame:
    """The contract's columns of :func:`fill_in_middle`: digests of the output and of the text rebuilt from it."""
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
  FROM units),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS first, greatest(h1 % (n + 1), h2 % (n + 1)) AS last,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:first], '') AS prefix, array_to_string(units[first + 1:last], '') AS middle,
         array_to_string(units[last + 1:n], '') AS suffix
  FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
