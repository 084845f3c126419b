"""Not-modified revisits against a plain scan of all earlier responses."""

import datetime as dt
import random

from shelfcast.llm import op1_revisits as op

SCHEMA = "record_id string, kind string, url string, date timestamp, status int, headers map<string,string>, payload_digest string, body string, bucket int"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def rec(i, kind, url, minutes, headers=None, digest=None, status=200):
    return (i, kind, url, None if minutes is None else T0 + dt.timedelta(minutes=minutes), status, headers, digest, "x", 1)


def records():
    u = "https://www.Example.com:443/a/?b=2&a=1&utm_source=f#top"
    v = "http://example.com/a?a=1&b=2"
    rows = [rec("a1", "response", u, 0, {"ETag": '"1"', "X": "old", "Content-Type": "text/html"}, "d1"),
            rec("a2", "response", v, 5, {"ETag": '"2"', "Cache-Control": "no-store"}, "d2"),
            rec("a3", "response", v, 5, {"etag": '"3"'}, "d3"), rec("a4", "response", v, 9000, {"Last-Modified": "L"}, "d4"),
            rec("a5", "response", v, 9001, {"ETag": '"1"'}, "d5", 503), rec("a6", "response", None, 1, {}, "d6"), rec("a7", "response", v, None, {}, "d7"),
            rec("b1", "revisit", v, 5, {"etag": 'W/"1"', "Content-Type": "no", "x": "new"}, None, 304),
            rec("b2", "revisit", u, 6, {"etag": '"3"', "expires": "E"}, None, 304), rec("b3", "revisit", u, 6, {"etag": '"9"'}, None, 304),
            rec("b4", "revisit", v, 9000, {"etag": '"3"'}, None, 304), rec("b5", "revisit", v, 9002, {"last-modified": "L"}, "zz", 304),
            rec("b6", "revisit", v, 20000, None, "d4", 304), rec("b7", "revisit", v, 20000, None, None, 304), rec("b8", "revisit", v, 0, {"etag": '"1"'}, None, 304),
            rec("b9", "revisit", None, 7, {"etag": '"1"'}, None, 304), rec("c1", "revisit", v, None, {"etag": '"1"'}, None, 304),
            rec("c2", "revisit", "ftp://other/", 7, {"etag": '"1"'}, None, 304)]
    return rows + [rows[8]]


WANT = {"b1": ("resolved", "a1"), "b2": ("resolved", "a3"), "b3": ("mismatch", None), "b4": ("resolved", "a3"), "b5": ("resolved", "a4"),
        "b6": ("resolved", "a4"), "b7": ("unvalidated", None), "b8": ("no_response", None), "b9": ("no_response", None),
        "c1": ("no_response", None), "c2": ("no_response", None)}


def test_outcomes_for_any_bucket_width(spark):
    df = spark.createDataFrame(records(), SCHEMA).repartition(3)
    for width in (60, 86_400, 10**8):
        rows = op.resolve_revisits(df, width).collect()
        assert len(rows) == 12
        assert {r.record_id: (r.outcome, r.refers_to) for r in rows} == WANT


def test_one_url_with_most_rows_and_few_dates(spark):
    """Most records are of one URL, many of them of one date; against a scan of all earlier responses."""
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        kind = rnd.choice(["response", "revisit"])
        url = rnd.choice(["http://hot/"] * 8 + [f"http://u{i % 40}/", None])
        minutes = rnd.choice([7] * 6 + [rnd.randrange(4000), None])
        rows.append(rec(f"r{i:04d}", kind, url, minutes, {"etag": f'"{rnd.randrange(3)}"'}, None, 200 if kind == "response" else 304))
    full = [r for r in rows if r[1] == "response" and r[2] and r[3]]
    want = {}
    for r in rows:
        if r[1] == "revisit":
            earlier = [f for f in full if r[2] and r[3] and f[2] == r[2] and f[3] < r[3]]
            last = max(earlier, key=lambda f: (f[3], f[0]), default=None)
            same = last is not None and last[5] == r[5]
            want[r[0]] = ("no_response" if last is None else "resolved" if same else "mismatch", last[0] if same else None)
    assert len({w[0] for w in want.values()}) == 3
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for width in (3600, 86_400):
        assert {r.record_id: (r.outcome, r.refers_to) for r in op.resolve_revisits(df, width).collect()} == want


def test_header_merge(spark):
    rows = {r.record_id: r for r in op.resolve_revisits(spark.createDataFrame(records(), SCHEMA)).collect()}
    assert rows["b1"].headers == {"etag": 'W/"1"', "x": "new", "content-type": "text/html"}
    assert rows["b2"].headers == {"etag": '"3"', "expires": "E"} and rows["b2"].payload_digest == "d3"
    assert rows["b3"].headers is None and rows["b3"].payload_digest is None


def test_canonical_url(spark):
    urls = [("HTTP://u@WWW.Ex.org:80", "ex.org/"), (" https://ex.org/A//?&z=1&A=2#x?y ", "ex.org/A?A=2&z=1"), ("ex.org?ref=1", "ex.org/"),
            ("https://m.ex.org:8080/x.html?SID=3&q=%20", "m.ex.org:8080/x.html?q=%20"), ("", "/"), (None, None)]
    df = spark.createDataFrame(urls, "url string, want string")
    for r in df.select(op.canonical_url(df.url).alias("got"), "want").collect():
        assert r.got == r.want


def test_bodies_and_empty(spark):
    df = spark.createDataFrame(records(), SCHEMA)
    out = op.with_bodies(op.resolve_revisits(df), df.where("kind = 'response'").select("record_id", "body"))
    assert {r.body for r in out.where("outcome = 'resolved'").collect()} == {"x"}
    assert op.resolve_revisits(spark.createDataFrame([], SCHEMA)).collect() == []
    pages = spark.createDataFrame([(1, None, None), (2, "http://a/", "x"), (2, "http://a/", "x"), (None, "http://a/", "y")], "page_id long, url string, html string")
    assert op.op1_revisits(pages).count() == 4
