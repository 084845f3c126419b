"""Shards of permuted sequences: exact round trip."""

import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import op6_training_order as op
from shelfcast.llm.tokens import PATTERN, Encoder, default_paths
from shelfcast.session import scratch_dir

DOCS = "doc_id long, text string"


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_feistel_is_a_permutation(n):
    f = op.Feistel(n, key=3)
    y = f.forward(np.arange(n))
    assert sorted(y) == list(range(n)) and (f.backward(y) == np.arange(n)).all()
    if n > 60:
        assert (op.Feistel(n, key=4).forward(np.arange(n)) != y).any() and (y != np.arange(n)).any()


def corpus():
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta,", "Gamma\n", "né", "42"]) for _ in range(rnd.randint(0, 200)))) for i in range(150)]
    return rows + [(500, None), (501, ""), (None, "no id"), (502, "word " * 5000), (3, rows[3][1])]


def laid_end_to_end(spark, rows):
    """All ids in the operator's order: by a hash of id and text (then id)."""
    df = spark.createDataFrame(rows, DOCS).select("doc_id", "text", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1).alias("key"))
    encoder = Encoder(default_paths(), PATTERN)
    first = sorted(df.collect(), key=lambda r: (r["key"], r.doc_id is not None, r.doc_id or 0))
    return np.concatenate([encoder.ids(r.text or "") for r in first])


def test_round_trip(spark):
    rows, length, per = corpus(), 64, 16
    df = spark.createDataFrame(rows, DOCS).coalesce(3).selectExpr("*", "1 as slot", "2 as payload", "3 as copies", "4 as start")
    path = scratch_dir(spark, "op6-test")
    index, total = op.materialise(df, path, length=length, per_shard=per)
    index = {r.slot: r for r in index.collect()}
    assert sorted(index) == list(range(total)) and op.missing_shards(spark, path, total, length, per).collect() == []
    back = {r.slot: r for r in op.read_shards(spark, path, length, per).collect()}
    assert sorted(back) == list(range(total))
    for s, r in back.items():
        assert (r.shard, r.byte_offset) == (s // per, s % per * op.stride(length))
        assert r.record_crc32 == index[s].record_crc32 == zlib.crc32(np.array(r.ids, "<u2").tobytes())
        assert all(x == op.PAD for x in r.ids[index[s].n_tokens:])
    # put back in order, the sequences are the documents' ids, end to end; only the last is padded
    ranks = op.Feistel(total).backward(np.arange(total))
    got = np.concatenate([np.array(back[s].ids[:index[s].n_tokens]) for s in np.argsort(ranks)])
    assert (got == laid_end_to_end(spark, rows)).all()
    assert sorted(r.n_tokens for r in index.values())[1:] == [length] * (total - 1)


def test_the_split_of_the_input_changes_nothing(spark):
    rows = corpus() + [(None, None)] * 700 + [(9, "copies of one row")] * 2300
    results = []
    for parts, buckets in ((1, "8"), (7, "3"), (40, "13")):
        spark.conf.set("spark.sql.shuffle.partitions", buckets)
        path = scratch_dir(spark, "op6-split")
        index, total = op.materialise(spark.createDataFrame(rows, DOCS).repartition(parts), path, length=96, per_shard=32)
        back = {(r.slot, r.record_crc32) for r in op.read_shards(spark, path, 96, 32, with_ids=False).collect()}
        assert back == {(r.slot, r.record_crc32) for r in index.collect()} and len(back) == total
        results.append((back, {(r.slot, tuple(r.doc_ids)) for r in index.collect()}))
        tokens = total * 96
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
    assert 0 <= tokens - len(laid_end_to_end(spark, rows)) < 96


def test_resumed_run_writes_what_is_missing(spark):
    df = spark.createDataFrame(corpus(), DOCS).repartition(3)
    path = scratch_dir(spark, "op6-resume").removeprefix("file:")
    _, total = op.materialise(df, path, length=64, per_shard=16)
    shards = -(-total // 16)
    read = lambda: {n: [(f, (Path(path) / f"shard={n}" / f).read_bytes()) for f in sorted(p.name for p in (Path(path) / f"shard={n}").glob("part-*"))]
                    for n in range(shards)}
    before = read()
    for crc in Path(path).glob("shard=*/.*.crc"):
        crc.unlink()
    for f, _ in before[1]:  # one shard is gone, one is cut off, one holds more than it should
        (Path(path) / "shard=1" / f).unlink()
    (Path(path) / "shard=3" / before[3][0][0]).write_bytes(before[3][0][1][:100])
    (Path(path) / f"shard={shards - 1}" / before[shards - 1][0][0]).write_bytes(before[shards - 1][0][1] * 2)
    assert sorted(r.shard for r in op.missing_shards(spark, path, total, 64, 16).collect()) == [1, 3, shards - 1]
    op.materialise(df.repartition(9), path, length=64, per_shard=16, resume=True)
    after = read()
    assert {n: [data for _, data in x] for n, x in after.items()} == {n: [data for _, data in x] for n, x in before.items()}
    assert [n for n in range(shards) if after[n][0][0] == before[n][0][0]] == [n for n in range(shards) if n not in (1, 3, shards - 1)]
    op.materialise(df, path, length=64, per_shard=16, resume=True)
    assert read() == after


@pytest.mark.parametrize("first", [0, 15, 16, 37, 10_000])
def test_reading_from_a_slot_on(spark, first):
    df = spark.createDataFrame(corpus(), DOCS).repartition(3)
    path = scratch_dir(spark, "op6-from")
    _, total = op.materialise(df, path, length=64, per_shard=16)
    every = {r.slot: tuple(r) for r in op.read_shards(spark, path, 64, 16).collect()}
    some = {r.slot: tuple(r) for r in op.read_shards(spark, path, 64, 16, first_slot=first).collect()}
    assert some == {s: r for s, r in every.items() if s >= first}


def test_ids_beyond_16_bits_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(op.Encoder, "ids", lambda self, text: np.array([70_000, 0], "<u4"))
    with pytest.raises(Exception, match="16-bit"):
        op.materialise(spark.createDataFrame([(1, "a")], DOCS), scratch_dir(spark, "op6-wide"))


def test_query_and_empty(spark):
    df = spark.createDataFrame(corpus(), DOCS)
    rows = op.op6_training_order(df).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert {d for r in rows for d in r.doc_ids} == {d for d, _ in corpus()}
    assert op.op6_training_order(df.limit(0)).collect() == []


def test_payload_code_is_exact():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50_257, 2048).astype("<u2")
    for counts in ({}, {int(i): int(i) % 7 for i in ids[:100]}):
        code = op.Payload(counts)
        assert (code.unpack(code.pack(ids)) == ids).all()
