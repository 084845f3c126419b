"""Toxicity by weak supervision: mined voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import crc_mod, lean
from shelfcast.llm.op2_near_dedup import BANDS, ROWS, _sketch
from shelfcast.session import materialize

#: Labelled rows that voters are mined from, at most: toxic and clean ones (in the order of a hash of the id).
SAMPLE_TOXIC, SAMPLE_CLEAN = 8_000, 16_000
#: Documents whose posterior labels train the classifier, at most, besides the toxic rows of the labelled sample.
SAMPLE_POSTERIOR = 20_000
#: Mined terms that are classifier features, and those of them that vote.
FEATURES, VOTERS = 2_000, 256
#: A term needs so many toxic sample rows, so large a log-odds ratio, so large a log-likelihood
#: ratio against no relation with toxicity (25 is five standard deviations: about one term in
#: three million by chance, however rare it is) and so large a share of toxic ones among the
#: labelled rows that have it.
MIN_TOXIC, MIN_LOG_ODDS, MIN_EVIDENCE, MIN_PRECISION = 4, 1.0, 25.0, 0.6
#: Lengths of word beginnings that are pattern terms, and of character runs in scripts without spaces.
STEMS, GRAMS = (4, 5, 6), (2, 3, 4)
#: Estimated similarity of 5-word shingles from which labelled toxic texts are one family of copies.
FAMILY = 0.4
EM_ROUNDS = 6
#: Distinct words whose terms a task remembers, and terms that it counts before it sends them on.
MEMO = 200_000

_WORD = re.compile(r"[^\W\d_]+")
#: Blocks of scripts whose words aren't set apart by spaces (Thai, Lao, Myanmar, Khmer, kana, Han).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def terms(word: str) -> list[str]:
    """The lexicon term and the pattern terms of a run of letters.

    They are its beginnings (``stem*``) or, in scripts without spaces, where a run holds
    many words, all its short pieces (``*piece*``).
    """
    if _UNSPACED.search(word):
        return [word, *{f"*{word[i:i + n]}*" for n in GRAMS for i in range(len(word) - n + 1)}]
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


@dataclass
class Model:
    """Everything that scoring needs; sizes are bounded by the parameters above."""

    features: list[str] = field(default_factory=list)  # voters first
    n_voters: int = 0
    prior: float = 0.0
    fires_toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    fires_clean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trust: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -9.0

    def posterior(self, fired: list[np.ndarray]) -> np.ndarray:
        """P(toxic | votes) of the label model; ``fired`` has the numbers of the voters that fired.

        A voter that abstains says nothing, whatever its language; that no voter
        fired is the vote of the last one, the clean voter.
        """
        speak = self.trust * (np.log(self.fires_toxic) - np.log(self.fires_clean))
        z = np.log(self.prior) - np.log1p(-self.prior) + np.array([speak[f].sum() for f in fired])
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def score(self, hits: list[np.ndarray]) -> np.ndarray:
        z = self.bias + np.array([self.weights[h].sum() for h in hits]) if hits else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def feature_hits(column: pa.Array, index: dict[str, int], memo: dict[str, tuple[int, ...]]) -> Iterator[np.ndarray]:
    """Sorted numbers of the features that each whole text has."""
    for text in (t.as_py() for t in column):
        found: set[int] = set()
        for w in words(text):
            ids = memo.get(w)
            if ids is None:
                ids = tuple(index[t] for t in terms(w) if t in index)
                if len(memo) < MEMO:
                    memo[w] = ids
            if ids:
                found.update(ids)
        yield np.array(sorted(found), np.int32)


def first_by_hash(df: DataFrame, n: int, total: int) -> DataFrame:
    """The ``n`` rows of ``total`` whose ids have the least hashes.

    Rows beyond twice the wanted share of the hash's range go where they are read, so
    about ``2 * n`` rows are ever sorted or sent, however many tasks there are.
    """
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, 2.0 * n / max(1, total)) * (1 << 30))
    return df.where(share & F.col("doc_id").isNotNull()).orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id").limit(n)


def labelled_sample(labels: DataFrame, usable, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> tuple[dict, float]:
    """doc_id -> label of at most ``toxic`` + ``clean`` ids, and the clean rows that a clean sample row stands for, per toxic one.

    Ids with contradicting labels are left out.
    """
    one = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & usable(F.col("doc_id")))
           .groupBy("doc_id").agg(F.min("toxic").alias("lo"), F.max("toxic").alias("hi")).where("lo = hi"))
    there = {r["lo"]: r["n"] for r in one.groupBy("lo").agg(F.count("*").alias("n")).collect()}
    out: dict = {}
    for value, n in ((1, toxic), (0, clean)):
        out |= {r["doc_id"]: value for r in first_by_hash(one.where(F.col("lo") == value), n, there.get(value, 0)).collect()}
    shares = [there.get(y, 0) / max(1, sum(v == y for v in out.values())) for y in (1, 0)]
    return out, shares[1] / shares[0] if shares[0] else 1.0


def families(regs: np.ndarray, least: float = FAMILY) -> np.ndarray:
    """For each row the first row of its family: rows that share a band with it and agree in ``least`` of the registers."""
    root = np.arange(len(regs))
    bands = regs.reshape(len(regs), BANDS, ROWS).copy().view(np.int64)[:, :, 0]

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for band in bands.T:
        order = np.argsort(band, kind="stable")
        new = np.append(True, band[order][1:] != band[order][:-1])
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        for a in np.flatnonzero(~new & ((regs[order] == regs[head]).mean(1) >= least)).tolist():
            i, j = sorted((top(order[a]), top(head[a])))
            root[j] = i
    return np.array([top(i) for i in range(len(root))], np.int64)


def one_of_each(docs: DataFrame, sample: dict) -> dict:
    """The sample without all but one of the toxic texts of a family of copies.

    Else the rare words of one toxic text that has many labelled copies would look like
    marks of toxicity.  Families come from SetSketch registers of 5-word shingles, as in the
    near-duplicate operator, so texts that merely share words stay apart.  Clean rows
    all stay: their copies show that a word is harmless.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.sparkSession.createDataFrame([(d,) for d, y in sample.items() if y], f"doc_id {kind}")
    sketched = docs.join(F.broadcast(known), "doc_id").select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lean(_sketch), f"doc_id {kind}, n_shingles long, class_id binary, bands array<long>, regs binary")
    head = F.substring("regs", 1, 2 * BANDS * ROWS)  # the registers that bands are made of
    one = sketched.where("n_shingles > 0").groupBy("doc_id").agg(F.min(head).alias("regs"))
    rows = one.orderBy("doc_id").collect()  # at most SAMPLE_TOXIC rows of 256 bytes
    if not rows:
        return {d: y for d, y in sample.items() if not y}
    regs = np.frombuffer(b"".join(r["regs"] for r in rows), np.uint16).reshape(len(rows), BANDS * ROWS)
    first = families(regs)
    return {rows[i]["doc_id"]: 1 for i in np.unique(first).tolist()} | {d: y for d, y in sample.items() if not y}


def mine(docs: DataFrame, sample: dict, clean_weight: float = 1.0) -> list[str]:
    """At most FEATURES terms that mark the toxic rows of the sample, best first."""
    shared = docs.sparkSession.sparkContext.broadcast(sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = shared.value
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        rows = [0, 0]

        def out():
            both = list(seen[1].keys() | seen[0].keys())
            batch = pa.RecordBatch.from_arrays([pa.array(both, pa.string()), pa.array([seen[1][t] for t in both], pa.int64()),
                                                pa.array([seen[0][t] for t in both], pa.int64())], names=["term", "toxic", "clean"])
            for s in seen:
                s.clear()
            return batch

        for b in batches:
            known = [(i, label[d]) for i, d in enumerate(b.column(0).to_pylist()) if d in label]
            for i, y in known:
                seen[y].update({t for w in words(b.column(1)[i].as_py()) for t in terms(w)})
                rows[y] += 1
                if len(seen[0]) + len(seen[1]) > MEMO:
                    yield out()
        yield out()
        yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([rows[1]], pa.int64()), pa.array([rows[0]], pa.int64())], names=["term", "toxic", "clean"])

    counted = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lean(count), "term string, toxic long, clean long")
    counted = materialize(counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(f"toxic >= {MIN_TOXIC}"), "op5-terms")
    rows = counted.where("term = ''").collect()
    if not rows or rows[0]["clean"] == 0:
        return []
    n1, n0 = rows[0]["toxic"], rows[0]["clean"]
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    both, share = F.col("toxic") + F.col("clean"), n1 / (n1 + n0)
    part = lambda c, q: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (both * q))).otherwise(0.0)
    evidence = 2 * (part("toxic", share) + part("clean", 1 - share))
    pure = F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + clean_weight * F.col("clean"))
    best = (counted.where((F.col("term") != "") & pure)
            .withColumn("odds", odds).where((F.col("odds") >= MIN_LOG_ODDS) & (evidence >= MIN_EVIDENCE))
            .orderBy((F.col("toxic") * F.col("odds")).desc(), F.length("term"), "term").limit(2 * FEATURES).collect())
    chosen: dict[str, float] = {}
    inner = lambda t: [p for p in terms(t.strip("*")) if p[0] == "*" and p != t] if _UNSPACED.search(t) else []
    for r in best:  # a longer term adds nothing where a chosen stem or piece of it is as pure
        if not any(r["odds"] <= chosen.get(r["term"][:n] + "*", -1.0) + 0.5 for n in STEMS if len(r["term"].rstrip("*")) > n or r["term"][-1] != "*") \
                and not any(piece in chosen and r["odds"] <= chosen[piece] + 0.5 for piece in inner(r["term"])):
            chosen[r["term"]] = r["odds"]
    return list(chosen)[:FEATURES]


def votes_of(hits, n_voters: int):
    """The voters that fire: those among the hits, or the clean voter if there is none."""
    own = F.filter(hits, lambda h: h < n_voters)
    return F.when(F.size(own) > 0, own).otherwise(F.array(F.lit(n_voters)))


def label_model(hits: DataFrame, model: Model, sample_votes: tuple[np.ndarray, int, np.ndarray, int]) -> Model:
    """Accuracies, class balance and correlations of the voters, from all documents.

    A voter fires with one probability on toxic and another on clean documents; the
    clean voter fires where no other does.
    They start from the labelled sample and are refined by expectation
    maximisation over the vote patterns of every document; the expected counts are
    summed by Spark, ``2 * VOTERS + 2`` numbers per round.  Then one pass sums how
    often two voters fire together on (expected) toxic documents; a voter that is
    positively correlated with others is trusted less, by the sum of its correlations.
    """
    k = model.n_voters + 1  # the last is the clean voter
    (c1, n1, c0, n0) = sample_votes
    model.fires_toxic, model.fires_clean = (c1 + 0.1) / (n1 + 1), (c0 + 0.01) / (n0 + 1)
    model.prior, model.trust = (n1 + 1) / (n1 + n0 + 2), np.ones(k)
    patterns = hits.select(votes_of(F.col("hits"), model.n_voters).alias("votes")).groupBy("votes").agg(F.count("*").alias("n"))
    patterns = materialize(patterns, "op5-patterns")

    def sums(pairs: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 * k + 2)
            joint = np.zeros((k, k)) if pairs else None
            for b in batches:
                fired = [np.array(v, np.int64) for v in b.column(0).to_pylist()]
                n, p = b.column(1).to_numpy().astype(float), model.posterior(fired)
                total[2 * k] += (n * p).sum()
                total[2 * k + 1] += (n * (1 - p)).sum()
                for f, w1, w0 in zip(fired, n * p, n * (1 - p), strict=True):
                    total[f] += w1
                    total[k + f] += w0
                    if pairs and len(f):
                        joint[np.ix_(f, f)] += w1
            at, value = np.arange(2 * k + 2), total
            if pairs:
                i, j = np.nonzero(joint)
                at, value = np.concatenate([at, 2 * k + 2 + i * k + j]), np.concatenate([value, joint[i, j]])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(value)], names=["at", "value"])

        rows = patterns.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(2 * k + 2 + (k * k if pairs else 0))
        for r in rows:
            out[r["at"]] = r["value"]
        return out

    for _ in range(EM_ROUNDS):
        s = sums(False)
        toxic, clean = s[2 * k], s[2 * k + 1]
        # the labelled sample stays in the estimate, so classes cannot change places
        model.fires_toxic = np.clip((s[:k] + c1 + 0.1) / (toxic + n1 + 1), 1e-6, 0.999)
        model.fires_clean = np.clip((s[k:2 * k] + c0 + 0.01) / (clean + n0 + 1), 1e-8, 0.999)
        model.prior = float(np.clip((toxic + 1) / (toxic + clean + 2), 1e-4, 0.9))
    s = sums(True)
    n = max(s[2 * k], 1.0)
    mean, both = s[:k] / n, s[2 * k + 2:].reshape(k, k) / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    rho = (both - np.outer(mean, mean)) / np.outer(spread, spread)
    np.fill_diagonal(rho, 0)
    model.trust = 1 / (1 + np.clip(rho, 0, 1).sum(1))
    return model


def train(model: Model, hits: list[np.ndarray], target: np.ndarray, weight: np.ndarray, rounds: int = 300) -> Model:
    """Logistic regression on soft labels of weighted rows by accelerated gradient steps with a small ridge."""
    rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    cols = np.concatenate(hits).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    n, m = weight.sum(), len(model.features)
    mean = (weight * target).sum() / n
    w, b = np.zeros(m), float(np.log((mean + 1e-4) / (1 - mean + 1e-4)))
    vw, vb, ridge = w.copy(), b, 1e-4
    step = 4.0 / (1 + max(len(h) for h in hits)) if hits else 1.0
    scale = np.maximum(np.bincount(cols, weight[rows], minlength=m), 1.0) / n  # a rare term's weight moves as fast as a common one's
    for i in range(rounds):
        z = vb + np.bincount(rows, vw[cols], minlength=len(hits))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - target)
        new_w = vw - step * (np.bincount(cols, error[rows], minlength=m) / n / scale + ridge * vw)
        new_b = vb - step * error.sum() / n
        momentum = i / (i + 3)
        vw, vb = new_w + momentum * (new_w - w), new_b + momentum * (new_b - b)
        w, b = new_w, new_b
    model.weights, model.bias = w, b
    return model


def training_rows(hits: DataFrame, model: Model, toxic: list, n: int) -> tuple[list, np.ndarray, np.ndarray]:
    """(hits, posterior, weight) of the classifier's training rows.

    They are the rows of the ``toxic`` ids, and ``n`` others: half of them from those that the
    label model takes for toxic, half from those for clean, more of one where the other
    has fewer.  A row weighs as many documents as it stands for, so rare toxicity has
    as many rows as there are and the weights keep its share.
    """
    shared = hits.sparkSession.sparkContext.broadcast(model)

    def posterior(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = shared.value.posterior([np.array(v, np.int64) for v in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p, pa.float64())], names=["doc_id", "hits", "p"])

    kind = hits.schema["doc_id"].dataType.simpleString()
    scored = hits.where("doc_id is not null").select("doc_id", "hits", votes_of(F.col("hits"), model.n_voters).alias("votes")).mapInArrow(
        posterior, f"doc_id {kind}, hits array<int>, p double")
    known = F.broadcast(hits.sparkSession.createDataFrame([(d,) for d in toxic], f"doc_id {kind}").withColumn("known", F.lit(True)))
    group = F.when(F.col("known"), 2).otherwise((F.col("p") >= 0.5).cast("int"))
    scored = materialize(scored.join(known, "doc_id", "left").withColumn("group", group).drop("known"), "op5-posterior")
    there = {r["group"]: r["count"] for r in scored.groupBy("group").count().collect()}
    few = min((0, 1), key=lambda g: there.get(g, 0))
    take = {few: min(there.get(few, 0), n // 2)}
    take[1 - few] = n - take[few]
    rows, weight = [], []
    for g in sorted(there):
        # all rows of the labelled toxic ids: at most SAMPLE_TOXIC ids
        own = scored.where(F.col("group") == g)
        got = (own if g == 2 else first_by_hash(own, take[g], there[g])).select("hits", "p").collect()
        rows += got
        weight += [there[g] / len(got)] * len(got) if got else []
    return [np.array(r["hits"], np.int64) for r in rows], np.array([r["p"] for r in rows]), np.array(weight)


def hits_of(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, hits) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(model.features)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo = shared.value, {}
        for b in batches:
            found = [h.tolist() for h in feature_hits(b.column(1), index, memo)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "hits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lean(run), f"doc_id {kind}, hits array<int>")


def held_out(doc_id):
    return crc_mod(doc_id, 5) == 0


def fit(docs: DataFrame, labels: DataFrame, usable=lambda d: ~held_out(d)) -> tuple[Model, DataFrame]:
    """The model, and the table (doc_id, hits) of all documents that it was fitted on."""
    sample, clean_weight = labelled_sample(labels, usable)
    sample = one_of_each(docs, sample) if sample else sample
    model = Model(mine(docs, sample, clean_weight) if sample else [])
    model.n_voters = min(VOTERS, len(model.features))
    hits = materialize(hits_of(docs, model), "op5-hits")
    if not model.features:
        return model, hits
    k = model.n_voters + 1
    known = docs.sparkSession.createDataFrame(list(sample.items()), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, toxic int")
    per = (hits.join(F.broadcast(known), "doc_id")  # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows
           .select("toxic", F.explode(F.concat(votes_of(F.col("hits"), model.n_voters), F.array(F.lit(-1)))).alias("voter"))
           .groupBy("toxic", "voter").count().collect())
    fired = {(r["toxic"], r["voter"]): r["count"] for r in per}
    c1, c0 = (np.array([fired.get((y, j), 0) for j in range(k)], float) for y in (1, 0))
    model = label_model(hits, model, (c1, fired.get((1, -1), 0), c0, fired.get((0, -1), 0)))
    found, target, weight = training_rows(hits, model, [d for d, y in sample.items() if y], SAMPLE_POSTERIOR)
    return train(model, found, target, weight), hits


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier predicts to be toxic; columns unchanged."""
    model, _ = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model, {t: i for i, t in enumerate(model.features)}))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (m, index), memo = shared.value, {}
        for b in batches:
            yield b.filter(pa.array(m.score(list(feature_hits(b.column(at), index, memo))) < 0.5, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def op5_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted).

    Voters are words, word beginnings and (in scripts without spaces) pieces of runs that mark
    toxic rows of a bounded sample of labelled, not held-out rows; the label model's accuracies and correlations come
    from the votes on every document; a linear classifier is trained on its
    posterior labels and scores every whole text.  Only text is an input of a score.

    Defined results: null and empty texts have no features and get the score of the
    bias; repeated rows get equal scores; null ids are scored and, with the checksum
    of an empty text, held out; without toxic and clean labels every score is that
    of a clean text; an empty table gives an empty result.
    """
    model, hits = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.array(h, np.int64) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(found), pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = hits.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
