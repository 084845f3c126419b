"""Micro-fixtures for the cleaning rules (hand-computed answers)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import cleaning as C
from shelfcast.operators import matching as M

TS = dt.datetime(2010, 12, 1, 8, 26)


def lines(spark, rows):
    from conftest import LINE_SCHEMA
    full = [(r[0], r[1], r.get("desc", "white hanging heart"), r[2], TS, 2.5, r[3], "UK", r[4])
            if isinstance(r, dict) else r for r in rows]
    return spark.createDataFrame(full, LINE_SCHEMA)


def row(inv, code, qty, cust, order, desc="white hanging heart"):
    return (inv, code, desc, qty, TS, 2.5, cust, "UK", order)


def netted_orders(spark, rows):
    df = C.flag_cancelled(lines(spark, rows))
    return sorted(r["row_order"] for r in M.net_cancellations(df).collect())


def test_cancel_many_to_one(spark):
    rows = [row("500001", "s", 5, "c", 0), row("C500002", "s", -5, "c", 1),
            row("500003", "s", 5, "c", 2), row("C500004", "s", -5, "c", 3)]
    assert netted_orders(spark, rows) == [2]


def test_cancel_null_customer(spark):
    rows = [row("C500004", "s", -7, None, 4), row("500005", "s", 7, None, 5)]
    assert netted_orders(spark, rows) == []


def test_cancel_unmatched_survives_netting_only(spark):
    rows = [row("C500006", "s", -9, "c", 6)]
    assert netted_orders(spark, rows) == [6]
    df = M.net_cancellations(C.flag_cancelled(lines(spark, rows)))
    assert C.drop_cancelled(df).count() == 0


def test_cancel_before_sale_still_matches(spark):
    rows = [row("C500001", "s", -3, "c", 0), row("500002", "s", 3, "c", 1)]
    assert netted_orders(spark, rows) == []


def test_negative_sale_matches_positive_cancel(spark):
    # A cancellation of +4 looks for a sale of -4 (signed key, N4d).
    rows = [row("C500001", "s", 4, "c", 0), row("500002", "s", -4, "c", 1), row("500003", "s", 4, "c", 2)]
    assert netted_orders(spark, rows) == [2]


def test_cancellation_pairs_first_sale(spark):
    rows = [row("500001", "s", 5, "c", 0), row("C500002", "s", -5, "c", 1), row("500003", "s", 5, "c", 2)]
    pairs = M.cancellation_pairs(C.flag_cancelled(lines(spark, rows))).collect()
    assert [(p.cancelled_invoice, p.matching_invoice) for p in pairs] == [("C500002", "500001")]


def test_odd_fragments(spark):
    codes = ["POST", "M", "85123A", "15056BL", "15056bl", "DCGS0058", "gift_0001_20", "C2", "5"]
    df = spark.createDataFrame([(c,) for c in codes], "stock_code string")
    got = {r.fragment for r in M.odd_code_fragments(df).collect()}
    assert got == {"POST", "M", "bl", "DCGS", "gi", "ft", "C2", "5"}


def test_drop_odd_codes_prefix(spark):
    codes = ["M", "M_123", "85123A", "15056bl", "POSTAGE", None]
    df = spark.createDataFrame([(c,) for c in codes], "stock_code string")
    kept = sorted(r.stock_code for r in M.drop_odd_codes(df).collect())
    # M removes every M-code; POST (from POSTAGE itself: \D[A-Z]+\D) removes it;
    # 15056bl yields 'bl', which no code starts with, so it stays.
    assert kept == ["15056bl", "85123A"]


def test_mode_tie_smallest_non_null(spark):
    rows = [row("1", "s", 1, "c", i, desc=d) for i, d in enumerate(["x", "b", "b", "x", None])]
    out = C.description_modes(lines(spark, rows)).collect()
    assert [(r.stock_code, r.canonical) for r in out] == [("s", "b")]
    canon = C.canonical_description(lines(spark, rows)).select("description").collect()
    assert {r.description for r in canon} == {"b"}   # null descriptions replaced too


def test_quantile_linear_interpolation(spark):
    df = spark.range(1000).select(F.col("id").cast("int").alias("qty"))
    from shelfcast.functions import exact_quantile
    q = spark.range(1).select(exact_quantile(df, "qty", 0.995).alias("q")).first().q
    assert q == pytest.approx(994.005)
    assert C.trim_qty(df).count() == 995   # 0..994 < 994.005


def test_trim_removes_whole_top_value(spark):
    df = spark.createDataFrame([(v,) for v in [1] * 10 + [50] * 990], "qty int")
    assert C.trim_qty(df).count() == 10


def test_strip_unicode_whitespace_and_lower(spark):
    df = spark.createDataFrame([("\t  Red RETROSPOT Bag \n",)], "description string")
    assert C.normalize_text(df).first().description == "red retrospot bag"


def test_null_invoice_is_cancelled(spark):
    df = spark.createDataFrame([(None,), ("C1",), ("5",)], "invoice_id string")
    flags = [r.is_cancelled for r in C.flag_cancelled(df).collect()]
    assert flags == [True, True, False]


def test_drop_adjustments_seven_char_non_cancelled(spark):
    df = C.flag_cancelled(spark.createDataFrame([("A500001",), ("C500001",), ("500001",)], "invoice_id string"))
    assert sorted(r.invoice_id for r in C.drop_adjustments(df).collect()) == ["500001", "C500001"]


def test_description_rules(spark):
    rows = [row("1", "s", 1, "c", i, desc=d) for i, d in
            enumerate(["red rod", "set of 3 cake tins", "pack of 12 tissues", "jumbo bag red", None])]
    d = C.drop_multipacks(C.valid_description(lines(spark, rows)))
    assert [r.description for r in d.collect()] == ["jumbo bag red"]


def test_deduplicate_keeps_first(spark):
    rows = [row("1", "s", 1, "c", 7), row("1", "s", 1, "c", 3), row("1", "s", 2, "c", 5)]
    out = sorted((r.qty, r.row_order) for r in C.deduplicate(lines(spark, rows)).collect())
    assert out == [(1, 3), (2, 5)]


def test_parse_dates_text(spark):
    df = spark.createDataFrame([("2010-12-01 08:26:00",)], "invoice_timestamp string")
    r = C.parse_dates(df).first()
    assert r.invoice_timestamp == dt.datetime(2010, 12, 1, 8, 26) and r.invoice_date == dt.date(2010, 12, 1)


def test_parse_dates_rejects_bad_text(spark):
    df = spark.createDataFrame([("01/12/2010 08:26",)], "invoice_timestamp string")
    with pytest.raises(Exception):
        C.parse_dates(df).collect()


def test_audit_counts_while_the_tables_are_written(spark):
    from conftest import SF_SMALL
    from shelfcast.plans import audited_clean, clean_stage_frames
    from shelfcast.plans.catalog import ORDER, raw_lines
    lines = raw_lines(spark, SF_SMALL)
    group = "audit-jobs"
    frames = clean_stage_frames(lines, ORDER)
    want = [lines.count()] + [f.count() for _, f in frames]
    spark.sparkContext.setJobGroup("plain", "cleaning alone")
    clean_stage_frames(lines, ORDER)[-1][1].write.format("noop").mode("overwrite").save()
    plain = len(spark.sparkContext.statusTracker().getJobIdsForGroup("plain"))
    spark.sparkContext.setJobGroup(group, "audited")
    clean, audit = audited_clean(lines, ORDER)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows = sorted(audit.collect())
    assert [r.rows_out for r in rows] == want and [r.step for r in rows] == list(range(len(want)))
    assert clean.count() == want[-1]
    assert jobs <= plain + 1  # nothing is run for the counts
