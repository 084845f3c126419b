"""The shared text dialect, empty-value words, and the file order of landed lines."""

import os

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import cleaning as C
from shelfcast.plans.cleaning import clean_transactions
from shelfcast.session import clear_scratch, ensure_checkpoint_dir, scratch_dir
from shelfcast.sources import land_transactions, read_transactions, union_parts, write_table
from shelfcast.sources.files import EMPTY_WORDS, read_text_table

HEAD = "Invoice\tStockCode\tDescription\tQuantity\tInvoiceDate\tPrice\tCustomer ID\tCountry\n"


def local(path):
    path = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(path, exist_ok=True)
    return path


def test_awkward_text_survives_every_reader_and_writer(spark):
    texts = ['12" RULER', 'a "quoted" word', "tab\there", ' blanks ', '"', "semi;colon, comma", "back\\slash", None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "Invoice string, Description string")
    for sep in ("\t", ",", ";"):
        path = scratch_dir(spark, "t-text")
        write_table(df, path, sep=sep)
        for back in (read_text_table(spark, path, sep=sep), union_parts(spark, [path], sep=sep, order_col=None)):
            assert sorted((r.Invoice, r.Description) for r in back.collect()) == [(str(i), t) for i, t in enumerate(texts)]


def test_doubled_quotes_as_other_tools_write_them(spark):
    path = local(scratch_dir(spark, "t-quotes"))
    with open(f"{path}/a.csv", "w", encoding="ISO-8859-1") as f:
        f.write(HEAD + '1\tA\t"12"" RULER"\t5\t2010-01-01 00:00:00\t1.5\t7\tUK\n2\tB\t"two\tparts"\t6\t2010-01-01 00:00:00\t2\t\tUK\n')
    rows = sorted(read_transactions(spark, path).drop("row_order").collect())
    assert [r.Description for r in rows] == ['12" RULER', "two\tparts"] and [r.Quantity for r in rows] == [5, 6]


def test_line_breaks_inside_quotes_need_multi_line(spark):
    path = local(scratch_dir(spark, "t-lines"))
    with open(f"{path}/a.csv", "w", encoding="ISO-8859-1") as f:
        f.write(HEAD + '1\tA\t"two\nlines"\t5\t2010-01-01 00:00:00\t1.5\t7\tUK\n')
    assert [r.Description for r in read_transactions(spark, path, multi_line=True).collect()] == ["two\nlines"]


def test_empty_words_are_nulls(spark):
    path = local(scratch_dir(spark, "t-empty"))
    with open(f"{path}/a.csv", "w", encoding="ISO-8859-1") as f:
        f.write(HEAD + "".join(f"{i}\tA\t{w}\t5\t2010-01-01 00:00:00\tNaN\t{w}\tUK\n" for i, w in enumerate(EMPTY_WORDS)))
    rows = read_transactions(spark, path).collect()
    assert len(rows) == len(EMPTY_WORDS) and all(r.Description is None and r["Customer ID"] is None and r.Price is None for r in rows)
    kept = read_transactions(spark, path, empty_words=("", "NaN")).collect()
    assert sum(r.Description == "NULL" for r in kept) == 1


def _files(spark):
    """Five files of unequal size whose first matching sale is in the third."""
    path = local(scratch_dir(spark, "t-order"))
    n = 0
    for k, size in enumerate((3, 400, 50, 1, 900)):
        with open(f"{path}/part-{k}.csv", "w", encoding="ISO-8859-1") as f:
            f.write(HEAD)
            for _ in range(size):
                f.write(f"{100000 + n}\t1000{n % 7}\ta description {n % 7}\t{2 + n % 3}\t2010-01-01 00:00:00\t{1 + n % 4}\t{n % 2}\tUK\n")
                n += 1
            f.write("C9\t10001\ta description 1\t-3\t2010-01-01 00:00:00\t1\t1\tUK\n")
    return path


def test_landed_order_is_file_order_without_a_sort(spark):
    path = _files(spark)
    for size in ("1k", "10m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            landed = land_transactions(read_transactions(spark, path))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert dict(landed.dtypes)["row_order"] == "bigint"
        got = [r.Invoice for r in landed.orderBy("row_order").collect()]
        want = [line.split("\t")[0] for k in range(5) for line in open(f"{local(path)}/part-{k}.csv", encoding="ISO-8859-1").read().splitlines()[1:]]
        assert got == want


def test_clean_lines_of_landed_files(spark):
    landed = land_transactions(read_transactions(spark, _files(spark)))
    clean = clean_transactions(landed)
    rows = {r.invoice_id for r in clean.collect()}
    sales = [r for r in C.rename_columns(landed).orderBy("row_order").collect()]
    first = next(r.invoice_id for r in sales if (r.stock_code, r.qty, r.customer_id) == ("10001", 3, "1"))
    assert first not in rows and "C9" not in rows
    dedup = C.deduplicate(C.rename_columns(landed))
    dedup.write.format("noop").mode("overwrite").save()
    assert "SortAggregate" not in dedup._jdf.queryExecution().executedPlan().toString()


def test_scratch_is_removed_on_request_only(spark):
    from pyspark.sql import SparkSession

    path = scratch_dir(spark, "t-clear")
    spark.range(3).write.parquet(path)
    import shelfcast.session as S
    others = S._written[spark.sparkContext.applicationId]
    S._written[spark.sparkContext.applicationId] = [path]
    assert spark.read.parquet(path).count() == 3
    assert clear_scratch(SparkSession.active()) == 1
    S._written[spark.sparkContext.applicationId] = [p for p in others if p != path]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


@pytest.mark.parametrize(("master", "fails"), [("local-cluster[2,1,1024]", True), ("spark://h:7077", True), ("yarn", True), ("local[4]", False), ("local", False)])
def test_only_a_single_process_may_use_a_folder_of_its_own(master, fails, tmp_path):
    class Context:
        def __init__(self):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    if fails:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(Session())
    else:
        assert os.path.isdir(ensure_checkpoint_dir(Session()))
