"""File sources and sinks: raw invoice lines, sheet parts, scored predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw column names of the invoice file, in file order, with types.
RAW_SCHEMA = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.StringType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Customer ID", T.StringType()),
    T.StructField("Country", T.StringType()),
])

# The scored-predictions file (';' separated).
SCORED_SCHEMA = T.StructType([
    T.StructField("stock_code", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("qty", T.DoubleType()),
    T.StructField("predictions", T.DoubleType()),
])


# One text dialect for every reader and writer here: quotes inside a quoted field
# are doubled, blanks are kept.
TEXT_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Texts that stand for a missing value when a file is read.
EMPTY_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
               "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def empty_to_null(c: Column, words: Sequence[str] = EMPTY_WORDS) -> Column:
    """Null where the text is one of the words for a missing value."""
    return F.when(~c.isin(*words), c) if words else c


def file_order(part: Column | None = None) -> Column:
    """An orderable column that reproduces input-file order.

    Spark packs file splits into tasks by size, so a bare
    ``monotonically_increasing_id`` is not file order.  Within one split,
    rows are read sequentially, so (file, split start, id) is: files sort by
    path (or by ``part`` when given), splits by byte offset, rows by id.
    """
    fields = [F.col("_metadata.file_path").alias("file"),
              F.col("_metadata.file_block_start").alias("block"),
              F.monotonically_increasing_id().alias("pos")]
    if part is not None:
        fields.insert(0, part.alias("part"))
    return F.struct(*fields)


def read_transactions(spark: SparkSession, path: str | Sequence[str], *, sep: str = "\t",
                      encoding: str = "ISO-8859-1", header: bool = True,
                      order_col: str = "row_order", multi_line: bool = False,
                      empty_words: Sequence[str] = EMPTY_WORDS) -> DataFrame:
    """Read raw invoice lines and type the 8 columns by name (no inference).

    Columns are matched by header name, so file column order does not matter;
    casts run under ANSI, so a malformed number raises as in the original.
    ``empty_words`` are read as nulls.  Adds ``order_col`` holding file order, which
    the keep-first / first-match / last-price rules need; ``land_transactions``
    makes it a fixed number.

    ``multi_line`` admits line breaks inside quoted fields.  Spark then reads each
    file in one task, so it is off by default; land such files once.
    """
    df = (spark.read.options(**TEXT_DIALECT).option("sep", sep).option("header", header).option("encoding", encoding)
          .option("inferSchema", False).option("multiLine", multi_line).csv(path))
    missing = [f.name for f in RAW_SCHEMA.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"raw transactions lack columns {missing}")
    return df.select([empty_to_null(F.col(f"`{f.name}`"), empty_words).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields]
                     + [file_order().alias(order_col)])


def union_parts(spark: SparkSession, paths: Sequence[str], *, fmt: str = "csv",
                order_col: str | None = "row_order", save_to: str | None = None,
                save_options: dict | None = None, **options) -> DataFrame:
    """Read every part (one file per original sheet) as untyped text and stack them.

    Columns absent from a part come back null, as with a pandas concat.  The
    optional ``order_col`` keeps part order, then file order within a part.
    ``save_to`` also writes the stacked table (``write_table`` options in
    ``save_options``) and returns it read back from there.
    """
    frames = []
    for i, p in enumerate(paths):
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.options(**TEXT_DIALECT).option("header", True).option("inferSchema", False)
        for k, v in options.items():
            reader = reader.option(k, v)
        df = reader.load(p)
        df = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]
                       + ([file_order(F.lit(i)).alias(order_col)] if order_col else []))
        frames.append(df)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    if save_to:
        opts = dict(save_options or {})
        write_table(out, save_to, **opts)
        if opts.get("fmt", "csv") == "csv":
            return read_text_table(spark, save_to, sep=opts.get("sep", "\t"))
        return spark.read.format(opts["fmt"]).load(save_to)
    return out


def read_text_table(spark: SparkSession, path: str | Sequence[str], *, sep: str = "\t", schema: str | T.StructType | None = None,
                    multi_line: bool = False) -> DataFrame:
    """A text table in the shared dialect, untyped unless ``schema`` is given."""
    reader = spark.read.options(**TEXT_DIALECT).option("sep", sep).option("header", True).option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).csv(path)


def write_table(df: DataFrame, path: str, *, fmt: str = "csv", sep: str = "\t", header: bool = True,
                mode: str = "overwrite", partition_by: Sequence[str] | None = None,
                encoding: str | None = None) -> None:
    """S3: write a table; CSV output is a folder of tab-separated parts with a
    header, in the shared dialect (quotes doubled, blanks kept)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(**TEXT_DIALECT).option("sep", sep).option("header", header)
        if encoding:
            writer = writer.option("encoding", encoding)
        writer.csv(path)
    else:
        writer.format(fmt).save(path)


def read_scored(spark: SparkSession, path: str | Sequence[str], *, sep: str = ";") -> DataFrame:
    """Read the scored-predictions file (stock_code, date, qty, predictions)."""
    return (spark.read.options(**TEXT_DIALECT).schema(SCORED_SCHEMA).option("sep", sep).option("header", True)
            .option("mode", "FAILFAST").csv(path))


def _is_file_order(df: DataFrame, order_col: str) -> bool:
    kind = df.schema[order_col].dataType
    return isinstance(kind, T.StructType) and {"file", "block", "pos"} <= set(kind.names)


def land_transactions(df: DataFrame, order_col: str = "row_order", how: str = "parquet") -> DataFrame:
    """Ingest step: write the raw lines once as Parquet with a fixed, compact order.

    Written once, the order can't come out differently in two branches that read the
    lines.  For lines of text files no sort is needed: the splits (file, start), one
    row each, are ranked, and the order becomes one ``long``, split rank * 2**33 + the
    row's number, which only grows within a split.  Any other order column is
    replaced by a range sort and ``monotonically_increasing_id``.  Every
    "first"/"last" of the cleaning rules then is a hash aggregate.
    """
    from shelfcast.session import materialize
    if not _is_file_order(df, order_col):
        return materialize(df.orderBy(order_col).withColumn(order_col, F.monotonically_increasing_id()), "landed", how)
    landed = materialize(df, "landed", how)
    names = [n for n in landed.schema[order_col].dataType.names if n != "pos"]
    key = [F.col(f"{order_col}.{n}").alias(n) for n in names]
    # one row per split of the input, as many as the scan has
    splits = landed.select(*key).distinct().withColumn("_rank", F.row_number().over(Window.orderBy(*names)) - 1)
    joined = landed.select(*landed.columns, *[F.col(f"{order_col}.{n}").alias(f"_{n}") for n in names]).join(
        splits.select(*[F.col(n).alias(f"_{n}") for n in names], "_rank"), [f"_{n}" for n in names])
    row = F.col(f"{order_col}.pos").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn(order_col, F.col("_rank").cast("long") * F.lit(1 << 33) + row).select(*landed.columns)


def land_by_stock(df: DataFrame, table: str, buckets: int, key: str = "stock_code") -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by stock, and read it back.

    Groupings, windows and joins by stock over it need no shuffle, again and again.  A bucket holds
    its stocks whole, so this is for tables in which no stock has a large share of the rows (the
    demand table has one row per stock, price and day); others are better left to shuffles, which can
    pre-aggregate and split.
    """
    spark = df.sparkSession
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return spark.table(table)
