"""Benchmark passages in documents, found by winnowed word-gram fingerprints and extended to exact windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import ascii_lower, quoted, row_key, unused
from shelfcast.session import materialize

#: Words of a window; of a gram; grams per winnowing window.  A span of
#: GRAM + WINNOW - 1 = WINDOW words always holds the least of its WINNOW gram hashes,
#: so documents and items that share a window share a selected fingerprint at the same place in it.
WINDOW, GRAM, WINNOW = 10, 7, 4
#: Bytes of a table of item fingerprints or windows up to which it is broadcast; above, both sides are shuffled.
BROADCAST_BYTES = 64 << 20
#: Bits of the set of item words that document words are tested against, at most: some 32 for each
#: word, and more words than that make it let more through.
WORD_BITS = 1 << 22

_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A-Z lower-cased runs of 0-9, a-z and characters beyond ASCII; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _SPLIT, -1), "")


def _starts(n: Column, size: int) -> Column:
    """0-based starts of the spans of ``size`` among ``n`` elements."""
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def _grams(df: DataFrame, hashes: str, size: int) -> Column:
    return F.transform(_starts(F.size(hashes), size), lambda i: F.xxhash64(F.lit(size), F.slice(F.col(hashes), i + 1, size)))


def hashed(df: DataFrame) -> DataFrame:
    """Adds the word hashes (``_h``) and the gram hashes (``_g``) to rows with ``words``."""
    with_words = df.withColumn("_h", F.transform("words", lambda w: F.xxhash64(w)))
    return with_words.withColumn("_g", _grams(with_words, "_h", GRAM))


def fingerprints(df: DataFrame, short: list[int]) -> DataFrame:
    """Adds ``prints``: the distinct hashes that winnowing selects, and all grams of the lengths ``short``."""
    df = hashed(df)
    least = F.transform(_starts(F.size("_g"), WINNOW), lambda i: F.array_min(F.slice(F.col("_g"), i + 1, WINNOW)))
    kinds = [least, *[_grams(df, "_h", n) for n in short]]
    return df.withColumn("prints", F.array_distinct(F.concat(*kinds) if len(kinds) > 1 else least)).drop("_h", "_g")


def selections(df: DataFrame, short: list[int]) -> DataFrame:
    """Adds ``picks``: the windows' selected grams as distinct (place, print), with rightmost ties, and short grams."""
    df = hashed(df)
    # the least hash of each window, the rightmost of equal ones, as (print, -place)
    def least(i):
        return F.array_min(F.transform(F.sequence(i, i + WINNOW - 1), lambda j: F.struct(F.get(F.col("_g"), j).alias("print"), (-j).alias("back"))))

    picked = F.transform(F.array_distinct(F.transform(_starts(F.size("_g"), WINNOW), least)),
                         lambda s: F.struct((-s["back"]).alias("place"), s["print"].alias("print")))
    kinds = [picked]
    for n in short:
        kinds.append(F.transform(_grams(df, "_h", n), lambda g, i: F.struct(i.cast("int").alias("place"), g.alias("print"))))
    return df.withColumn("picks", F.concat(*kinds) if len(kinds) > 1 else picked).drop("_h", "_g")


def word_set(windows: DataFrame) -> tuple[Column, int]:
    """The hashes of all item words as a literal array of longs, and its number of bits.

    A word's bit is given by the first bits of its hash.  The size follows from the number of words, up to ``WORD_BITS``; the rows collected are its longs.
    """
    hashes = windows.select(F.explode("window").alias("w")).distinct().select(F.xxhash64("w").alias("h"))
    bits = 64
    while bits < min(WORD_BITS, 32 * hashes.count()):
        bits *= 2
    place = F.shiftrightunsigned("h", 64 - bits.bit_length() + 1)
    longs = hashes.select((place / 64).cast("int").alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit"))
    there = {r["at"]: r["set"] for r in longs.groupBy("at").agg(F.bit_or("bit").alias("set")).collect()}
    longs = ", ".join(f"bigint('{there.get(i, 0)}')" for i in range(bits // 64))
    return F.expr(f"array({longs})"), bits


def stretches(df: DataFrame, known: Column, bits: int, least: int) -> DataFrame:
    """Adds ``stretches`` to rows with ``words``: the longest runs, of ``least`` words or more, that are all among the known ones.

    An item's window can only lie within one of them, so all other words need no grams.
    """
    def among(w):
        place = F.shiftrightunsigned(F.xxhash64(w), 64 - bits.bit_length() + 1)
        return F.getbit(F.get(known, (F.shiftright(place, 6)).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1

    # words hold neither blanks nor line breaks
    marked = F.array_join(F.transform("words", lambda w: F.when(among(w), w).otherwise("\n")), " ")
    runs = F.filter(F.split(marked, r" ?\n ?"), lambda r: F.length(r) >= 2 * least - 1)
    return df.withColumn("stretches", F.filter(F.transform(runs, lambda r: F.split(r, " ")), lambda r: F.size(r) >= least))


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """The windows of the items and the lengths of items under WINDOW words.

    Rows (item_id, window, length, print, place): a window's words, its selected
    fingerprint and that gram's place in it.  Repeated items give equal rows once.
    """
    items = benchmark.select("item_id", words(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)
    length = F.least(F.size("item_words"), F.lit(WINDOW))
    cut = items.withColumn("length", length).select(
        "item_id", "length", F.explode(F.transform(
            F.sequence(F.lit(0), F.size("item_words") - F.col("length")), lambda i: F.slice("item_words", i + 1, F.col("length")))).alias("words")).distinct()
    cut = materialize(cut, "op3-windows")
    short = sorted(r["length"] for r in cut.where(F.col("length") < WINDOW).select("length").distinct().collect())
    long_rows = selections(cut.where(F.col("length") == WINDOW), []).select(
        "item_id", F.col("words").alias("window"), "length", F.col("picks")[0]["print"].alias("print"), F.col("picks")[0]["place"].alias("place"))
    parts = long_rows
    for n in short:
        rows = cut.where(F.col("length") == n).withColumn("_h", F.transform("words", lambda w: F.xxhash64(w)))
        parts = parts.unionByName(rows.select("item_id", F.col("words").alias("window"), "length",
                                              F.xxhash64(F.lit(n), F.col("_h")).alias("print"), F.lit(0).alias("place")))
    named = parts.withColumn("window_id", F.unhex(F.md5(F.concat_ws(" ", "window"))))
    return materialize(named, "op3-items"), short


def find_windows(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, spans, windows): every distinct document row with its word count, the occurring windows, the item windows.

    ``rows``: (row_id, n_words); ``spans``: distinct (row_id, stretch, start, length, window_id), where ``start`` is a
    place in one of the row's stretches of words that all occur in items.
    """
    windows, short = item_windows(benchmark)
    prints = materialize(windows.select("print").distinct(), "op3-prints")
    distinct_windows = materialize(windows.select("window_id", "window", "length", "print", F.col("place").alias("inside")).dropDuplicates(["window_id"]), "op3-distinct")
    n_prints = prints.count()
    held = distinct_windows.agg(F.sum(F.octet_length(F.concat_ws(" ", "window")) + 100)).first()[0] or 0

    def side(df: DataFrame, size: int) -> DataFrame:
        return F.broadcast(df) if size <= broadcast_bytes else df

    known, bits = word_set(windows)
    base = docs.select(row_key().alias("row_id"), words(F.col("text")).alias("words"))
    cut = stretches(base, known, bits, min([WINDOW, *short]))
    texts = materialize(cut.select("row_id", F.size("words").cast("long").alias("n_words"), "stretches"), "op3-stretches")
    rows = materialize(texts.select("row_id", "n_words").distinct(), "op3-rows")
    one = texts.where(F.size("stretches") > 0).select("row_id", "stretches").dropDuplicates(["row_id"])
    pieces = materialize(one.select("row_id", F.posexplode("stretches").alias("stretch", "words")), "op3-pieces")

    # an outer explode: a plain one adds a filter on the array, which moves below the
    # projections and computes the grams anew for each of their elements
    each = fingerprints(pieces, short).select("row_id", "stretch", F.explode_outer("prints").alias("print"))
    met = each.join(side(prints, 16 * n_prints), "print", "left_semi").select("row_id", "stretch").distinct()
    chosen = pieces.join(materialize(met, "op3-met"), ["row_id", "stretch"], "left_semi")
    reach = WINDOW - GRAM  # words before a selected gram that can belong to its window
    picked = selections(chosen, short)
    # each selected gram goes with the words around it, so the stretch's text isn't copied for each
    near = F.transform("picks", lambda s: F.struct(
        s["place"].alias("place"), s["print"].alias("print"), F.greatest(s["place"] - reach, F.lit(0)).alias("from"),
        F.slice("words", F.greatest(s["place"] - reach, F.lit(0)) + 1, WINDOW + reach).alias("near")))
    picks = picked.select("row_id", "stretch", F.explode_outer(near).alias("s")).where("s is not null").select("row_id", "stretch", "s.*")
    start = F.col("place") - F.col("inside")
    at = start - F.col("from")
    spans = (picks.join(side(distinct_windows, held), "print")
             .where((at >= 0) & (F.slice("near", F.greatest(at, F.lit(0)) + 1, F.col("length")) == F.col("window")))
             .select("row_id", "stretch", start.alias("start"), "length", "window_id"))
    return rows, materialize(spans, "op3-spans"), windows


def contamination(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(row_id, n_words, n_hit, n_items, items) for every distinct (doc_id, text) of ``docs``.

    An item's windows are its runs of 10 words; an item of 1 to 9 words is one window.
    ``n_hit`` counts the words inside any occurrence of a window, ``items`` are the
    ids with an occurring window, sorted as strings.

    1. A document's words are tested against the set of all item words, one bit for each of their
       hashes; only stretches of words that pass, long enough for a window, go on.  No window is
       lost: all its words are item words.
    2. Stretches and items are winnowed; a stretch whose fingerprints meet none of
       the items' is clean (item tables are broadcast up to ``broadcast_bytes``, joined by a
       shuffle beyond).
    3. In the others every selected gram that an item's window selects too is
       extended to that window, word by word.
    4. Hit words are the union of the found spans, by a running maximum of their ends.

    Items under 10 words are sought by all grams of their length (winnowing over
    one gram).  Defined results: null texts have no words; repeated rows get equal
    results; items of null ``item_id`` mark hits but are not listed; an empty
    benchmark leaves every document clean; other columns are ignored.
    """
    rows, spans, windows = find_windows(docs, benchmark, broadcast_bytes)
    by_start = Window.partitionBy("row_id", "stretch").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ends = spans.groupBy("row_id", "stretch", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(by_start), F.lit(0)))
    covered = ends.select("row_id", F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy("row_id").agg(F.sum("fresh").alias("n_hit"))
    holders = windows.select("window_id", F.col("item_id").cast("string").alias("item_id")).where("item_id is not null").distinct()
    listed = (spans.select("row_id", "window_id").distinct().join(holders, "window_id").groupBy("row_id")
              .agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    return (rows.join(covered, "row_id", "left").join(listed, "row_id", "left")
            .select("row_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents in which a window of an item occurs; columns unchanged.

    Null and empty texts stay, repeated rows stay or go together, an empty benchmark or table changes nothing.
    """
    _, spans, _ = find_windows(docs, benchmark)
    (row,) = unused(docs, "_row")
    found = spans.select(F.col("row_id").alias(row)).distinct()
    return docs.withColumn(row, row_key()).join(found, row, "left_anti").select(*quoted(docs))


def op3_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated); see :func:`contamination`."""
    found = contamination(docs, benchmark)
    rows = docs.select("doc_id", row_key().alias("row_id")).join(found, "row_id")
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
b AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark),
w AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS gram
  FROM (SELECT *, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM b WHERE len(words) > 0)),
g AS (
  SELECT row, size, i, array_to_string(words[i:i + size - 1], ' ') AS gram
  FROM (SELECT d.row, d.words, s.size, unnest(range(1, greatest(len(d.words) - s.size + 2, 1))) AS i FROM d, (SELECT DISTINCT size FROM w) s)),
h AS (SELECT DISTINCT g.row, g.i, g.size, w.item_id FROM g JOIN w ON g.gram = w.gram AND g.size = w.size),
c AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS place FROM h) GROUP BY row),
l AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT row, item_id FROM h) GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (row) LEFT JOIN l USING (row)
"""
