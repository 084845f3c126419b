"""SetSketch near-duplicates against a brute force over all pairs of sets."""

import random
import re

import numpy as np
import pytest

from shelfcast.llm import op2_near_dedup as op
from shelfcast.llm import setsketch


def brute(rows):
    def shingles(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        if not w:
            return frozenset()
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        comp = min(ids) if ids else None
        out.append((d, len(sets[i]), comp, d == comp))
    return sorted(out, key=repr)


def corpus():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(6))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(rnd.randint(30, 120))]
        for _ in range(rnd.randint(1, 12)):
            copy = list(base)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = word()
            rows.append((n, rnd.choice([" ", "\n", "\t "]).join(copy)))
            n += 1
    passage = " ".join(word() for _ in range(60))
    for _ in range(60):
        rows.append((n, passage + " " + " ".join(word() for _ in range(rnd.randint(5, 40)))))
        n += 1
    rows += [(n, "One two three"), (n + 1, "one TWO\tthree"), (n + 2, "one two"), (n + 3, ""), (n + 4, None), (n + 5, "  \n\x0b"),
             (None, "one two three"), (None, "alone in here"), (n, "One two three"), (n, "another text under one id " * 3),
             (n + 6, "ONE\x0btwo \x0cthree"), (n + 7, "x " * 4000), (n + 8, "X " * 3999), (n + 9, "one two three\x1cfour")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_equals_brute_force(spark, block):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = op.near_duplicate_components(df.selectExpr("*", "1 as class_id", "2 as root"), block)
    assert sorted([tuple(r)[:3] + (r.kept,) for r in got.collect() if r.doc_id is not None], key=repr) == \
        [r for r in brute(rows) if r[0] is not None]
    nulls = sorted(((r.n_shingles, r.component_id, r.kept) for r in got.collect() if r.doc_id is None), key=repr)
    two = min(d for d, t in rows if t in ("One two three", "ONE\x0btwo \x0cthree", "one TWO\tthree") and d is not None)
    assert nulls == sorted([(1, two, False), (1, None, True)], key=repr)


def test_keep_one_row_per_component(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    got = op.keep_one(df)
    assert got.columns == df.columns
    want = {c for d, n, c, k in brute(rows) if c is not None}
    ids = [r.doc_id for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.op2_near_dedup(df).collect() == []
    assert op.op2_near_dedup(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()[0][:] == (1, 0, 1, True)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(x[:2000]), np.unique(x[500:])
    regs = [setsketch.registers(s, np.array([0, len(s)]), 512) for s in (a, b, np.union1d(a, b))]
    assert (setsketch.merge(regs[0], regs[1]) == regs[2]).all()
    est = setsketch.estimate(regs[0], regs[1], np.array([len(a)]), np.array([len(b)]))
    assert abs(est[0] - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.08


def test_pipeline_keeps_one_row_of_each_component_whatever_the_ids(spark):
    rnd = random.Random(6)
    say = lambda: " ".join("".join(rnd.choice("abcde") for _ in range(6)) for _ in range(40))
    one, two, three, near = say(), say(), say(), say()
    rows = [(1, one), (1, two), (1, ""), (1, None), (1, one), (2, one), (3, two + " more"),
            (None, near), (None, near + " end"), (None, near.upper()), (None, three), (4, three + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    import corpus_pipeline
    got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, df, "").collect()]
    left = [r for r in got if r not in [(1, one), (1, two), (1, ""), (1, None), (4, three + " end")]]
    assert len(got) == 6 and len(left) == 1 and left[0][0] is None and left[0][1].lower().startswith(near)
