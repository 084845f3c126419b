"""Fill-in-the-middle against a plain reading, round trips, and the tree against counts."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import DOCS, ordered
from shelfcast.llm import op12_fill_in_middle as op


def brute(rows, seed=7, rate=100, spm=50):
    out = []
    for d, t in rows:
        t = t or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", t)
        n = len(units)
        hexed = sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(hexed[i:i + 8], 16) for i in (0, 8, 16, 24))
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
            out.append((d, n, "plain", None, None, t))
        elif h4 % 100 < spm:
            out.append((d, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"))
        else:
            out.append((d, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))
    return ordered(out)


def corpus():
    rnd = random.Random(12)
    line = lambda: "".join(rnd.choices(["a", "é", "日", "𝄞", " ", "<", "P>", "\r", "\t"], k=rnd.randint(0, 90)))
    rows = [(i, "\n".join(line() for _ in range(rnd.randint(0, 60))) + rnd.choice(["", "\n", "\n\n"])) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "\n"), (203, "one line"), (204, "a<M>b\nc\n"), (205, "<P"), (None, "x\ny\nz\n"), (3, rows[3][1]), (3, rows[3][1])]
    rows += [(300 + i, "\n" * 7000 + "é" * 5000 + "\n") for i in range(4)]
    rows += [(310, "long " * 300_000), (311, "日本\n" * 200_000)]
    return rows


def test_equals_plain_reading_and_round_trip(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).repartition(4).selectExpr("*", "1 as n", "'x' as form", "'y' as output")
    out = op.fill_in_middle(df)
    assert ordered(out.collect()) == brute(rows)
    back = out.select("doc_id", op.restored(F.col("output"), F.col("form")).alias("text"))
    assert ordered(back.collect()) == ordered((d, t or "") for d, t in rows)
    digests = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in op.op12_fill_in_middle(df).collect()}
    hexed = lambda t: sha256((t or "").encode()).hexdigest()
    want = dict(((d, t or ""), None) for d, t in rows)
    assert len(digests) == len(want) and {x[2] for x in digests} == {hexed(t) for _, t in rows}
    assert {(d, hexed(o)) for d, *_, o in brute(rows)} == {x[:2] for x in digests}


@pytest.mark.parametrize("rate, spm", [(0, 50), (30, 0), (100, 100)])
def test_parameters(spark, rate, spm):
    rows = corpus()[:150]
    df = spark.createDataFrame(rows, DOCS)
    assert ordered(op.fill_in_middle(df, 11, rate, spm).collect()) == brute(rows, 11, rate, spm)
    own = ("[[", "||", "]]")
    out = op.fill_in_middle(df, 11, rate, spm, own)
    assert ordered(out.select("doc_id", op.restored(F.col("output"), F.col("form"), own).alias("t")).collect()) == ordered(rows)


def test_empty(spark):
    assert op.op12_fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="\na é日𝄞", max_size=200), st.integers(1, 9))
def test_tree_finds_every_line_end(text, block):
    index = op.LineIndex(np.frombuffer(text.encode(), np.uint8), block)
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert index.n == len(units)
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert index.after(k) == (len(head.encode()), len(head))


@given(st.lists(st.integers(0, 50), max_size=70))
def test_fenwick_nodes(counts):
    tree = op.fenwick(np.array([counts], np.int64).reshape(1, -1))[0]
    assert [int(tree[i]) for i in range(1, len(counts) + 1)] == [sum(counts[i - (i & -i):i]) for i in range(1, len(counts) + 1)]
