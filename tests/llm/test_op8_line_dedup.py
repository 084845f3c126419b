"""Line dedup against a plain count of every line."""

import random
from hashlib import sha256

import pytest

from helpers import DOCS, LOWER, ordered
from shelfcast.llm import op8_line_dedup as op


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows):
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(d)
    gone = {k: max((x for x in v if x is not None), default=None) for k, v in holders.items() if len(v) >= 5}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return ordered(out)


def corpus():
    rnd = random.Random(6)
    shared = ["the same boilerplate line in many documents é " + "x" * i for i in range(12)] + ["short line", "", "  \t", "á" * 40, "b" * 39]
    rows = []
    for i in range(120):
        lines = [rnd.choice([rnd.choice(shared), rnd.choice(shared).upper(), "\t" + rnd.choice(shared) + " \r", f"own line {i} {rnd.random()} and some more words"])
                 for _ in range(rnd.randint(0, 150))]
        rows.append((i, "\n".join(lines)))
    rows += [(None, shared[0]), (None, shared[1]), (500, None), (501, ""), (502, "\n\n"), (7, rows[7][1]), (7, shared[0]), (503, (shared[0] + "\n") * 3000)]
    return rows


@pytest.mark.parametrize("salts", [1, 64])
def test_equals_plain_count(spark, salts):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).repartition(5).selectExpr("*", "1 as keep", "'a' as line", "3 as _keep", "4 as pos")
    marks = op.keep_bitmaps(df, salts=salts)
    out, n, kept = op.with_bitmaps(df, marks)
    got = [(r.doc_id, len((r.text or "").split("\n")), r[n], sha256(r[kept].encode()).hexdigest()) for r in out.collect()]
    assert ordered(got) == brute(rows)
    assert ordered(op.op8_line_dedup(df).collect()) == brute(rows)


def test_pipeline_form(spark):
    rows = corpus()
    df = spark.createDataFrame([(t, d, len(t or ""), "s") for d, t in rows], "text string, doc_id long, n_chars long, source string")
    out = op.drop_repeated_lines(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    want = {(d, h) for d, _, _, h in brute(rows)}
    assert {(r.doc_id, sha256((r.text or "").encode()).hexdigest()) for r in out.collect()} == want
    assert all(r.n_chars == len(r.text or "") for r in out.collect())


def test_empty(spark):
    assert op.op8_line_dedup(spark.createDataFrame([], DOCS)).collect() == []
