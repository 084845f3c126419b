"""Exact duplicates against a plain grouping, and the naming against sorted keys."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from helpers import DOCS, ordered
from shelfcast.llm import op13_exact_dedup as op

GONE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(rows):
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault((t or "").translate(GONE), []).append((-len(t or ""), d is None, d or 0, i))
    out = []
    for body, members in groups.items():
        first = min(members)
        for m in members:
            out.append((rows[m[3]][0], rows[first[3]][0], len(members), m == first, sha256(body.encode()).hexdigest()))
    return ordered(out)


def corpus(block):
    rnd = random.Random(13)
    letters = "abcdé日\x1f\xa0 "
    text = lambda n: "".join(rnd.choices(letters, k=n))
    bodies = [text(rnd.randint(0, 9 * block)) for _ in range(60)]
    bodies += [b[:-1] + "Z" for b in bodies if b] + [b + "a" for b in bodies[:20]] + ["A" * (k * block) for k in (1, 2, 3, 4, 7, 8)] + ["A" * (8 * block - 1)]
    spaced = lambda b: "".join(c + rnd.choice(["", "", "", " ", "\n", "\t\r", "\x0b"]) for c in b)
    rows = [(i, spaced(rnd.choice(bodies))) for i in range(400)]
    rows += [(1000 + i, "A" * (4 * block)) for i in range(300)]
    rows += [(None, None), (None, " \n"), (900, None), (901, ""), (902, "\t"), (None, bodies[2]), (7, rows[7][1]), (7, rows[7][1]), (7, rows[9][1]), (None, None)]
    rows += [(903, bodies[0] * 3000), (904, bodies[0] * 3000 + " "), (905, bodies[0] * 3000 + "b")]
    return rows


@pytest.mark.parametrize("block, parts", [(1, 3), (8, 16), (1024, 2)])
def test_equals_plain_grouping(spark, block, parts):
    rows = corpus(block if block < 1024 else 40)
    if block == 1:
        rows = [r for r in rows if len(r[1] or "") < 4000]
    df = spark.createDataFrame(rows, DOCS).repartition(parts).selectExpr("*", "1 as rid", "'x' as name", "2 as kept", "3 as blocks")
    got = op.exact_copies(df, block).drop("n_points")
    assert ordered(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == brute(rows)


def test_contract_query(spark):
    rows = corpus(30)
    got = op.op13_exact_dedup(spark.createDataFrame(rows, DOCS).repartition(7))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert ordered(got.collect()) == brute(rows)
    assert got.where("kept").count() == got.select("text_sha256").distinct().count()


def test_empty_and_all_empty(spark):
    assert op.op13_exact_dedup(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(2, None), (1, " "), (3, "")]
    assert ordered(op.op13_exact_dedup(spark.createDataFrame(rows, DOCS)).collect()) == brute(rows)


def test_names_are_equal_just_for_equal_keys_over_many_tasks(spark):
    # one key holds most rows, so its run spans several range partitions; batches are small
    rnd = random.Random(1)
    rows = [(i, 0, 1, rnd.choice([0, 0, 0, 1, rnd.randint(2, 500)]), rnd.choice([b"", b"\x00", b"ab"])) for i in range(5000)]
    df = spark.createDataFrame(rows, "rid long, place long, n long, a long, b binary")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        named = {r.rid: r["name"] for r in op.name_keys(df.repartition(6), ["a", "b"], "t").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    keys = {i: (a, bytes(b)) for i, _, _, a, b in rows}
    count = {}
    for k in keys.values():
        count[k] = count.get(k, 0) + 1
    assert all(i in named for i, k in keys.items() if count[k] > 1)
    pairs = {(keys[i], n) for i, n in named.items()}
    assert len(pairs) == len({k for k, _ in pairs}) == len({n for _, n in pairs})
    assert len({n >> op.PLACE_BITS for n in named.values()}) > 1


def test_hash_order_collisions_are_named_apart(spark, monkeypatch):
    # a constant order: every task begins and ends with the same order value
    monkeypatch.setattr(op.F, "xxhash64", lambda *_: F.lit(5).cast("long"))
    rows = [(i, 0, 1, i % 40) for i in range(400)]
    named = op.name_keys(spark.createDataFrame(rows, "rid long, place long, n long, a long").repartition(3), ["a"], "t").collect()
    assert len(named) == 400 and len({(r.rid % 40, r["name"]) for r in named}) == 40
