"""Shared helpers: components, cells, sorted groups, row identity."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import common


def roots(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for e in edges for x in e if e[0] != e[1]}


@pytest.mark.parametrize("shape", ["path", "shuffled path", "star", "random"])
def test_components_equal_union_find(spark, shape):
    rnd = random.Random(3)
    n = 120
    names = list(range(n))
    if shape == "shuffled path":
        rnd.shuffle(names)
    if shape == "star":
        edges = [(0, i) for i in range(1, n)] + [(i, 0) for i in range(1, 9)]
    elif shape == "random":
        edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(90)] + [(5, 5), (777, 777)]
    else:
        edges = list(zip(names, names[1:], strict=False))
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == roots(edges)


def test_components_of_no_edge(spark):
    assert common.components(spark.createDataFrame([], "a binary, b binary")).collect() == []


def test_every_two_members_meet_in_one_cell(spark):
    df = spark.range(57).select(F.col("id").alias("class_id"), F.lit(57).alias("members"))
    cells = {}
    for r in common.blocked(df, 10).collect():
        cells.setdefault((r.ci, r.cj), []).append((r.class_id, r.block))
    met = {}
    for (ci, cj), rows in cells.items():
        for i, (x, bx) in enumerate(rows):
            for y, by in rows[:i]:
                if ci == cj or bx != by:
                    met[frozenset((x, y))] = met.get(frozenset((x, y)), 0) + 1
    assert len(met) == 57 * 56 // 2 and set(met.values()) == {1}


def test_sorted_groups_span_batches():
    rows = [(0, 1)] * 3 + [(0, 2)] + [(1, 2)] * 25 + [(1, 3)]
    batches = [pa.RecordBatch.from_pydict({"a": [r[0] for r in rows[i:i + 4]], "b": [r[1] for r in rows[i:i + 4]], "x": list(range(i, min(i + 4, len(rows))))})
               for i in range(0, len(rows), 4)]
    batches.insert(2, batches[0].slice(0, 0))
    groups = [(g["a"][0].as_py(), g["b"][0].as_py(), g["x"].to_pylist()) for g in common.sorted_groups(iter(batches), ["a", "b"])]
    assert groups == [(0, 1, [0, 1, 2]), (0, 2, [3]), (1, 2, list(range(4, 29))), (1, 3, [29])]
    assert list(common.sorted_groups(iter([]), ["a"])) == []


def test_row_key_tells_nulls_from_texts(spark):
    rows = [(1, "a"), (1, None), (1, ""), (None, "a"), (None, None), (None, ""), (11, ""), (1, "1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert df.select(common.row_key().alias("k")).distinct().count() == len(rows)
