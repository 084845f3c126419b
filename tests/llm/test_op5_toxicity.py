"""Weak supervision on planted lexicons: held-out accuracy, and edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from helpers import crc
from shelfcast.llm import op5_toxicity as op

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def corpus(seed=1, n=1500):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randint(3, 9)))
    vocab = [word() for _ in range(600)]
    bad, stems = ["grobble", "snark", "vileton", "Murgh"], ["quorz", "blixé"]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(5, 120))]
        toxic = rnd.random() < 0.2
        for _ in range(rnd.randint(2, 4) if toxic else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(bad) if i % 2 else rnd.choice(stems) + word())
        docs.append((i, " ".join(w) + rnd.choice(["", ".", "!\n"]), "en"))
        if rnd.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, DOCS).repartition(4).selectExpr("*", "1 as hits", "0 as toxic")
    rows = {r.doc_id: r for r in op.op5_toxicity(d, spark.createDataFrame(labels, LABELS)).collect()}
    assert len(rows) == len(docs) and all(r.held_out == (crc(i, 5) == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    held = [(rows[i].predicted, t) for i, _, t in labels if crc(i, 5) == 0]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    assert sum(p for p, t in held if t == 0) <= 0.01 * len(held)


def test_held_out_labels_are_never_used(spark):
    docs, labels = corpus(2, 600)
    turned = [(i, q, 1 - t if crc(i, 5) == 0 else t) for i, q, t in labels]
    d = spark.createDataFrame(docs, DOCS)
    a, b = (sorted(op.op5_toxicity(d, spark.createDataFrame(x, LABELS)).collect()) for x in (labels, turned))
    assert a == b


def test_reject_keeps_clean_rows_and_columns(spark):
    docs, labels = corpus(3, 600)
    extra = docs + [(9001, None, None), (9002, "", "en"), (9003, "x" * 200_000, "en"), (None, "plain words", "en"), docs[0]]
    d = spark.createDataFrame(extra, DOCS).selectExpr("lang", "text", "doc_id", "5 as score")
    scored = {(r.doc_id): r.predicted for r in op.op5_toxicity(d, spark.createDataFrame(labels, LABELS)).collect()}
    kept = op.reject_toxic(d, spark.createDataFrame(labels, LABELS))
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, p in scored.items() if p == 0} >= {9001, 9002, 9003, None}


def test_without_labels_or_rows(spark):
    d = spark.createDataFrame([(1, "some words", "en"), (2, None, "en")], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert [r.predicted for r in op.op5_toxicity(d, none).collect()] == [0, 0]
    conflicting = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (None, 1, 1), (2, 1, None)], LABELS)
    assert [r.predicted for r in op.op5_toxicity(d, conflicting).collect()] == [0, 0]
    assert op.op5_toxicity(d.limit(0), none).collect() == []


def test_rare_toxicity_is_trained_on(spark, monkeypatch):
    monkeypatch.setattr(op, "SAMPLE_POSTERIOR", 100)
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randint(3, 9)))
    vocab, bad = [word() for _ in range(300)], ["grobble", "snark", "vileton", "murgh", "quorz", "blixen"]
    docs = [(i, " ".join([rnd.choice(vocab) for _ in range(20)] + [bad[i // 50 % 6]] * (i % 50 == 0)), "en") for i in range(6000)]
    labels = [(i, 1, int(i % 50 == 0)) for i in range(6000) if i % 2 == 0]
    rows = op.op5_toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert sum(r.predicted for r in rows if r.doc_id % 50 == 0) >= 114 and sum(r.predicted for r in rows if r.doc_id % 50) <= 30


def test_a_kind_with_few_of_the_toxic_labels_is_caught(spark):
    rnd = random.Random(19)
    word = lambda: "".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randint(3, 9)))
    vocab = [word() for _ in range(300)]
    # of about 8,000 toxic labels 20 (16 of them not held out) are of a kind that has one term of its own
    term = lambda i: "" if i % 3 else "zorvan" if i % 1200 == 0 else "grobble"
    docs = [(i, " ".join([rnd.choice(vocab) for _ in range(12)] + [term(i)]), "en") for i in range(24_000)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(24_000)]
    rows = op.op5_toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert all(r.predicted for r in rows if r.doc_id % 1200 == 0)
    assert sum(r.predicted for r in rows if r.doc_id % 3) <= 80


def test_scripts_without_spaces(spark):
    rnd = random.Random(20)
    letters = "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏"
    run = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    docs = [(i, run(20) + ("毒罵詞" if i % 4 == 0 else "") + run(20) + "。" + run(9), "zh") for i in range(1200)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(1200) if i % 3]
    rows = op.op5_toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in rows)


def test_a_family_of_copies_counts_once(spark):
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randint(3, 9)))
    vocab = [word() for _ in range(400)]
    body = [rnd.choice(vocab) for _ in range(80)]
    near = lambda: " ".join(w if rnd.random() > 0.03 else word() for w in body)
    rows = [(i, near()) for i in range(30)] + [(30, " ".join(body)), (31, " ".join(body))]
    rows += [(100 + i, " ".join(rnd.choice(vocab) for _ in range(60))) for i in range(40)] + [(200, None), (201, "")]
    kept = op.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), {d: 1 for d, _ in rows} | {500: 0, 501: 0})
    assert {d for d in kept if 100 <= d < 200} == set(range(100, 140)) and kept[500] == 0
    assert len([d for d in kept if d < 100]) <= 3


def plain_em(patterns, k, c1, n1, c0, n0, rounds):
    """The label model's rules, one document at a time."""
    p1, p0, prior = [(c + 0.1) / (n1 + 1) for c in c1], [(c + 0.01) / (n0 + 1) for c in c0], (n1 + 1) / (n1 + n0 + 2)
    posterior = lambda votes: 1 / (1 + (1 - prior) / prior * np.prod([p0[v] / p1[v] for v in votes]))
    for _ in range(rounds):
        toxic, clean, s1, s0 = 0.0, 0.0, [0.0] * k, [0.0] * k
        for votes, n in patterns:
            p = posterior(votes)
            toxic, clean = toxic + n * p, clean + n * (1 - p)
            for v in votes:
                s1[v] += n * p
                s0[v] += n * (1 - p)
        p1 = [min(max((s + c + 0.1) / (toxic + n1 + 1), 1e-6), 0.999) for s, c in zip(s1, c1)]
        p0 = [min(max((s + c + 0.01) / (clean + n0 + 1), 1e-8), 0.999) for s, c in zip(s0, c0)]
        prior = min(max((toxic + 1) / (toxic + clean + 2), 1e-4), 0.9)
    return p1, p0, prior, posterior


def test_label_model_equals_plain_expectation_maximisation(spark):
    rng = np.random.default_rng(22)
    voters, docs = 6, 900
    toxic = rng.random(docs) < 0.25
    fires = rng.random((docs, voters)) < np.where(toxic[:, None], np.linspace(0.7, 0.2, voters), np.linspace(0.01, 0.1, voters))
    fires[:, 1] = fires[:, 0]  # two voters that always agree
    hits = [np.flatnonzero(f).tolist() + [voters + 3] for f in fires]
    model = op.Model([f"t{i}" for i in range(voters + 5)], voters)
    votes = [[h for h in x if h < voters] or [voters] for x in hits]
    known = range(0, docs, 10)
    count = lambda y: np.array([sum(v in votes[i] for i in known if toxic[i] == y) for v in range(voters + 1)], float)
    given = (count(True), sum(toxic[i] for i in known), count(False), sum(not toxic[i] for i in known))
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hits)], "doc_id long, hits array<int>").repartition(5)
    op.label_model(df, model, given)
    p1, p0, prior, posterior = plain_em([(v, 1) for v in votes], voters + 1, *given, op.EM_ROUNDS)
    assert np.allclose(model.fires_toxic, p1, rtol=1e-9) and np.allclose(model.fires_clean, p0, rtol=1e-9)
    assert abs(model.prior - prior) < 1e-9
    # trust: one over one plus the positive correlations with the others among expected toxic documents
    w = np.array([posterior(v) for v in votes])
    x = np.array([[v in s for v in range(voters + 1)] for s in votes], float)
    mean = (w[:, None] * x).sum(0) / max(w.sum(), 1)
    cov = (w[:, None, None] * x[:, :, None] * x[:, None, :]).sum(0) / max(w.sum(), 1) - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    rho = np.clip(cov / np.outer(sd, sd), 0, 1)
    np.fill_diagonal(rho, 0)
    assert np.allclose(model.trust, 1 / (1 + rho.sum(1)), rtol=1e-6) and model.trust[0] < 0.75


def test_classifier_reaches_the_loss_of_plain_gradient_descent():
    rng = np.random.default_rng(23)
    m, n = 12, 400
    x = rng.random((n, m)) < 0.2
    target = 1 / (1 + np.exp(-(x @ rng.normal(0, 2, m) - 1)))
    weight = rng.integers(1, 5, n).astype(float)
    model = op.train(op.Model([f"t{i}" for i in range(m)]), [np.flatnonzero(r) for r in x], target, weight)

    def loss(w, b):
        z = x @ w + b
        return (weight * (np.logaddexp(0, z) - target * z)).sum() / weight.sum()

    w, b = np.zeros(m), 0.0
    for _ in range(6000):
        e = weight * (1 / (1 + np.exp(-(x @ w + b))) - target) / weight.sum()
        w, b = w - 1.0 * (x.T @ e), b - 1.0 * e.sum()
    assert loss(model.weights, model.bias) <= loss(w, b) + 2e-3


def test_share_of_toxic_found_on_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("toxic is not null").select("doc_id", "toxic")
    rows = op.op5_toxicity(docs, labels).join(known, "doc_id").groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()
    n = {(r.toxic, r.predicted): r.n for r in rows}
    assert n.get((0, 1), 0) <= 0.02 * (n[0, 0] + n.get((0, 1), 0))
