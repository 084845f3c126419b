"""Winnowed decontamination against a scan of every window."""

import random
from hashlib import sha256

import pytest

from helpers import DOCS, ordered, split
from shelfcast.llm import op3_decontaminate as op

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = split(WORD, text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for d, text in docs:
        w, hit, found = split(WORD, text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (t := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in windows[t] if x is not None}
        out.append((d, len(w), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return ordered(out)


def corpus(seed, short):
    rnd = random.Random(seed)
    vocab = ["a", "b", "ñu", "Cé", "d9", "e", "F", "gg", "h"]
    say = lambda n: " ".join(rnd.choice(vocab) + rnd.choice(["", ",", "\n", "!"]) for _ in range(n))
    items = [(i, say(rnd.randint(10, 40))) for i in range(12)] + [(3, "a b"), (50, None), (51, ""), (None, say(14)), (52, "x " * 30)]
    items = [(i, t) for i, t in items if short or not t or len(split(WORD, t)) >= 10]
    if short:
        items += [(60, "b! ñu gg"), (61, "zz"), (62, "a b ñu cé d9 e f gg h"), (60, "b! ñu gg")]
    docs = []
    for i in range(120):
        parts = [say(rnd.randint(0, 30)) for _ in range(3)]
        if rnd.random() < 0.7:
            t = rnd.choice([t for _, t in items if t])
            w = t.split()
            a = rnd.randrange(len(w))
            parts.insert(1, " ".join(w[a:a + rnd.randint(5, 30)]).upper() if rnd.random() < 0.5 else t)
        docs.append((i, rnd.choice([" ", "--", "\t"]).join(parts)))
    docs += [(200, None), (201, ""), (202, "!!"), (None, items[0][1]), (203, "x " * 3000), (5, docs[5][1]), (5, "other text")]
    return docs, items


@pytest.mark.parametrize(("seed", "short", "limit"), [(1, False, 10**6), (2, True, 10**6), (3, True, 0)])
def test_equals_every_window(spark, seed, short, limit):
    docs, items = corpus(seed, short)
    d = spark.createDataFrame(docs, DOCS).repartition(4).selectExpr("*", "1 as words", "2 as print")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as window")
    found = {r.row_id: (r.n_words, r.n_hit, list(r.items)) for r in op.contamination(d, b, limit).collect()}
    got = []
    for r in d.select("doc_id", op.row_key().alias("k")).collect():
        n, h, i = found[r.k]
        got.append((r.doc_id, n, h, len(i), sha256(",".join(i).encode()).hexdigest(), h > 0))
    assert ordered(got) == brute(docs, items)
    clean = {r.doc_id for r in op.drop_contaminated(d, b).collect()}
    assert clean == {r[0] for r in brute(docs, items) if not r[5]}


def test_query_and_empty_tables(spark):
    docs, items = corpus(4, True)
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert ordered(op.op3_decontaminate(d, b).collect()) == brute(docs, items)
    assert op.op3_decontaminate(d.limit(0), b).collect() == []
    assert {r.contaminated for r in op.op3_decontaminate(d, b.limit(0)).collect()} == {False}


def test_every_shared_window_shares_a_selected_gram(spark):
    rnd = random.Random(9)
    words = [str(rnd.randint(0, 30)) for _ in range(400)]
    df = spark.createDataFrame([(words,)], "words array<string>")
    picks = {p.place for p in op.selections(df, []).collect()[0].picks}
    assert all(any(i <= p <= i + op.WINDOW - op.GRAM for p in picks) for i in range(len(words) - op.WINDOW + 1))
    assert len(picks) < len(words) * 0.55
