"""Lines repeated across documents, found by range-partitioned hashes, returned as keep bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import ascii_lower, quoted, unused
from shelfcast.session import materialize

#: Key length in code points from which lines count, and documents from which a key is repeated.
MIN_CHARS, MIN_DOCS = 40, 5
#: Sub-groups that the occurrences of one key are dealt to, by document.
SALTS = 64
#: Lines of one bitmap word.
WORD = 64


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_hash(text: Column) -> Column:
    """Tells rows of one doc_id apart: 0 for null."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, salts: int = SALTS) -> DataFrame:
    """(doc_id, text_hash, n_dropped, keep) for every row that loses a line.

    ``keep`` is a compressed bitmap: word number -> 64 bits, bit ``i`` of word ``w``
    set if line ``64 * w + i`` stays; words whose lines all stay are left out.

    A key (see :func:`line_key`) of at least ``min_chars`` code points that at least
    ``min_docs`` distinct documents hold loses its lines everywhere but in the
    largest ``doc_id`` that holds it, where all of them stay.

    Lines travel as two 64-bit hashes with document and position, never as text; they are
    written once, so that finding the range bounds reads this narrow table and not the texts.
    They are range-partitioned by hash and salt and sorted by document and
    position; one pass over the sorted rows marks a document's first occurrence of
    a key.  The salt (of the document) splits a key that a large share of all rows
    holds, and the counts of its parts are summed by a partial aggregate.  Only
    keys over ``min_docs`` are joined back: as a table of their own, which Spark broadcasts if it
    is small and else joins by a shuffle whose hot keys it can split.

    Defined results: null and empty texts are one empty line; rows of one
    ``doc_id`` are one document; null ids are together one document, smaller than
    any other; equal rows get equal bitmaps; other columns are ignored.
    """
    line = docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = line.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    occurrences = keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                               F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"), "doc_id", "text_hash", "pos")
    by_key = ["h1", "h2", "salt"]
    occurrences = materialize(occurrences, "op8-hashes")
    dealt = occurrences.repartitionByRange(*by_key).sortWithinPartitions(*by_key, "doc_id", "text_hash", "pos")
    stream = Window.partitionBy(*by_key).orderBy("doc_id", "text_hash", "pos")
    first = (F.row_number().over(stream) == 1) | ~F.col("doc_id").eqNullSafe(F.lag("doc_id").over(stream))
    dealt = materialize(dealt.withColumn("first", first), "op8-lines")

    frequent = (dealt.groupBy("h1", "h2").agg(F.sum(F.col("first").cast("int")).alias("docs"), F.max("doc_id").alias("last_doc"))
                .where(F.col("docs") >= min_docs).select("h1", "h2", "last_doc"))
    frequent = materialize(frequent, "op8-frequent")
    dropped = (dealt.join(frequent, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
               .select("doc_id", "text_hash", "pos").distinct())
    bit = F.expr(f"shiftleft(1L, pos % {WORD})")
    words = (dropped.groupBy("doc_id", "text_hash", F.expr(f"pos div {WORD}").cast("int").alias("word"))
             .agg(F.bitwise_not(F.bit_or(bit)).alias("bits"), F.count("*").alias("n")))
    return words.groupBy("doc_id", "text_hash").agg(
        F.sum("n").alias("n_dropped"), F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines whose bit in the bitmap is set, in order."""
    def stays(_, i):
        bits = F.try_element_at(keep, F.floor(i / WORD).cast("int"))
        return bits.isNull() | (F.getbit(bits, (i % WORD).cast("int")) == 1)
    return F.filter(lines, stays)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns, and their names: lines dropped (0 if none) and the text that stays."""
    key, own, key_hash, n, keep, kept = unused(docs, "_doc_id", "_hash", "_text_hash", "_n_dropped", "_keep", "_kept")
    marks = bitmaps.select(F.col("doc_id").alias(key), F.col("text_hash").alias(key_hash), F.col("n_dropped").alias(n), F.col("keep").alias(keep))
    hashed = docs.withColumn(own, text_hash(F.col("text")))
    joined = hashed.join(marks, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(own) == F.col(key_hash)), "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    left = F.when(F.col(keep).isNull(), text).otherwise(F.array_join(kept_lines(lines_of(F.col("text")), F.col(keep)), "\n"))
    return joined.select(*quoted(docs), F.coalesce(F.col(n), F.lit(0).cast("long")).alias(n), left.alias(kept)), n, kept


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that stay as ``text`` (and its length as ``n_chars``, where there is one).

    Every row stays, null and empty texts as they are, repeated rows with equal results; columns and their
    types are those of ``docs``.
    """
    out, n, kept = with_bitmaps(docs, keep_bitmaps(docs))
    changed = out.withColumn("text", F.when(F.col(n) > 0, F.col(kept)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(F.col(n) > 0, size).otherwise(F.col("n_chars")))
    return changed.select(*quoted(docs))


def op8_line_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, n_lines, n_dropped, kept_sha256); lines are dropped as :func:`keep_bitmaps` says.

    Defined results: a null or empty text is one empty line and keeps it; equal rows get equal results;
    rows of one ``doc_id``, and all rows of null ids, count as one document; an empty table gives an
    empty result; other columns are ignored.
    """
    out, n, kept = with_bitmaps(docs.select("doc_id", "text"), keep_bitmaps(docs))
    return out.select("doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"), F.col(n).alias("n_dropped"),
                      F.sha2(F.col(kept), 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, row, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -1)) >= 5),
marked AS (
  SELECT k.*, r.key IS NOT NULL AND r.last_doc IS DISTINCT FROM k.doc_id AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row, doc_id
"""
