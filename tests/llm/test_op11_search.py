"""Ranked search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from helpers import DOCS, ordered, split
from shelfcast.llm import op11_search as op

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ITEMS = "item_id long, text string"


def brute(docs, items, top=10):
    counts = [(d, Counter(split(TERM, t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        asked, scored = Counter(split(TERM, text)), []
        for d, c in counts:
            m = 100 - 75 + (75 * c.total() * n_docs) // n_terms
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, k in asked.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item_id, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(scored)[:top])]
    return ordered(out)


def corpus(n=700, seed=3):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["élan", "ÉLAN", "X1", "x1", "naïve", "日本"]
    weight = [1 / (i + 1) for i in range(len(words))]
    topics = [rnd.sample(words, 30) for _ in range(8)]
    docs = []
    for i in range(n):
        some = rnd.choices(words, weight, k=rnd.randint(0, 40)) + rnd.choices(rnd.choice(topics), k=rnd.randint(0, 40))
        docs.append((i, rnd.choice([" ", ", ", "-\n"]).join(some)))
    docs += [(n, None), (n + 1, ""), (n + 2, " .,;\n"), (None, "w299 w298 x1"), (5, docs[5][1]), (n + 3, docs[5][1]), (n + 4, "w0 " * 60_000)]
    docs += [(n + 10 + i, "the same words again w250") for i in range(60)]
    items = [(i, " ".join(rnd.choices(words, weight, k=rnd.randint(1, 25)))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "unheard of here"), (103, "w250"), (104, "X1 x1 x1, w0"), (104, "w7"), (None, "日本 élan"), (105, docs[9][1])]
    return docs, items


def table(spark, docs):
    return spark.createDataFrame(docs, DOCS).repartition(5).selectExpr("*", "1 as n", "'a' as terms", "3 as item", "4 as score")


def items_table(spark, items):
    return spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as doc_id", "2 as rank")


def test_equals_plain_scoring(spark):
    docs, items = corpus()
    got = op.op11_search(table(spark, docs), items_table(spark, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ordered(got.collect()) == brute(docs, items)


def test_small_blocks_shards_seeds_and_runs_of_items(spark, monkeypatch):
    # many blocks a list, many shards a task, thresholds from a sample, several runs of items
    for name, value in (("POSTINGS", 4), ("SHARD_DOCS", 90), ("SEED_DOCS", 40), ("PIECE", 1000)):
        monkeypatch.setattr(op, name, value)
    docs, items = corpus(seed=4)
    got = op.ranked_search(table(spark, docs), items_table(spark, items), top=7, item_bytes=1500)
    assert ordered(got.collect()) == brute(docs, items, 7)


def test_blocks_bound_their_documents_and_are_skipped(monkeypatch):
    monkeypatch.setattr(op, "POSTINGS", 8)
    rng = np.random.default_rng(5)
    n, v = 600, 40
    topic = rng.integers(0, 6, n)
    tfs = np.where((np.arange(v)[None, :] % 6 == topic[:, None]) | (rng.random((n, v)) < 0.05), rng.integers(1, 6, (n, v)), 0)
    tfs[:, 0] = 1
    rows, terms = np.nonzero(tfs)
    weights = rng.integers(1000, 9000, v)
    sizes = tfs.sum(1)
    everything = [np.arange(v)] * v
    shard = op.Shard(sizes, np.searchsorted(rows, np.arange(n + 1)), terms, tfs[rows, terms], weights, n, int(sizes.sum()), everything)
    for t in range(v):
        docs, starts, summary = shard.blocked(t)
        assert sorted(docs.tolist()) == np.flatnonzero(tfs[:, t]).tolist() and np.diff(starts).max() <= 16
        for b in range(len(starts) - 1):
            assert (shard.matrix[docs[starts[b]:starts[b + 1]]].max(0) == summary[b]).all()
    asked = np.array([0, 1, 7, 13])
    best = op.Best(5)
    best.ids = list(range(n))
    offered = []
    monkeypatch.setattr(op.Best, "offer", lambda self, s, d, old=op.Best.offer: (offered.extend(d.tolist()), old(self, s, d))[1])
    shard.search(asked, weights[asked], 0, best)
    scores = shard.matrix[:, asked] @ weights[asked]
    assert [-r[0] for r in best.rows] == sorted(scores.tolist(), reverse=True)[:5]
    assert len(offered) < n / 2


def test_terms():
    assert op.term_counts("Ab ab-1ab\x7fÉx éX\x00[z]".encode()) == {k.encode(): v for k, v in Counter(split(TERM, "Ab ab-1ab\x7fÉx éX\x00[z]")).items()}
    assert set(re.findall(TERM, "".join(map(chr, range(300))).translate({}))) and op.term_counts(b"") == {}


@pytest.mark.parametrize("docs, items", [([], []), ([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    got = op.op11_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert got.collect() == [] and dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
