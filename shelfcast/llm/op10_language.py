"""Language identification by cross-parsing against suffix automata of labelled text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import crc_mod
from shelfcast.session import materialize

#: Labelled documents per language, at most, and characters taken from the middle of each.
SAMPLE_DOCS, SAMPLE_CHARS = 200, 240
#: Characters of all automata together, at most: where languages are many, each gets an even share of
#: it, and one passage at least.
TOTAL_CHARS = 2_000_000
#: Languages up to which their counts are broadcast; beyond, they are joined by a shuffle.
BROADCAST_LANGS = 100_000
#: Symbols after which the parse of a long text starts a new phrase.
BLOCK = 4096
#: Characters that are parsed in step.
CHUNK_CHARS = 4_000_000
#: Letters with a column in the table of transitions, the most frequent ones; the others' transitions are looked up.
#: With many states there are fewer columns, so that the table has no more than CELLS cells.
COLUMNS, CELLS = 250, 1 << 25
UNDETERMINED = "und"


@cache
def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, joined, and the bounds of the texts."""
    parts = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint32)), bounds


class SuffixAutomaton:
    """States and transitions (one dict per state) that accept every substring of what was added."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def add(self, symbol: int) -> None:
        state = len(self.next)
        self.next.append({})
        self.length.append(self.length[self.last] + 1)
        self.link.append(0)
        p = self.last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            if self.length[p] + 1 == self.length[q]:
                self.link[state] = q
            else:
                twin = len(self.next)
                self.next.append(dict(self.next[q]))
                self.length.append(self.length[p] + 1)
                self.link.append(self.link[q])
                while p >= 0 and self.next[p].get(symbol) == q:
                    self.next[p][symbol] = twin
                    p = self.link[p]
                self.link[q] = self.link[state] = twin
        self.last = state


@dataclass
class Model:
    """All automata as one table.

    ``steps[state + symbol]`` is ``4 * next state + phrases ended``; states are row
    offsets.  Symbol 0 stands for characters that no training text has, 1 for a run
    of non-letters.  All letters of the training texts are numbered by frequency; the
    transitions by those from ``width`` on are few, and kept as sorted ``keys``
    (``state number * letters + symbol``) with the next states in ``to``.
    """

    languages: list[str]
    roots: np.ndarray
    bits: np.ndarray  # log2 of each language's training size
    steps: np.ndarray
    symbols: np.ndarray  # by code point
    width: int
    letters: int
    keys: np.ndarray
    to: np.ndarray

    def step(self, state: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """The steps from ``state`` (languages, texts) by ``sym`` (texts)."""
        rare = np.flatnonzero(sym >= self.width) if len(self.keys) else ()
        if not len(rare):
            return self.steps[state + sym]
        out = self.steps[state + np.where(sym < self.width, sym, 0)].astype(np.int64)
        state, sym, roots = state[:, rare], sym[rare], self.roots[:, None]

        def find(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            wanted = rows // self.width * self.letters + sym
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            return self.keys[at] == wanted, self.to[at]

        (on, to), (again, first) = find(state), find(roots)
        out[:, rare] = np.where(on, to * 4, np.where(again, first * 4 + 1, roots * 4 + np.where(state != roots, 2, 1)))
        return out

    def parse(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases (languages, texts), symbols per text) of the greedy longest-match parses."""
        points, bounds = code_points(texts)
        sym = self.symbols[points]
        keep = np.ones(len(sym), bool)
        keep[1:] = (sym[1:] != 1) | (sym[:-1] != 1)
        first = bounds[:-1][np.diff(bounds) > 0]
        keep[first] = True
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        sym = sym[keep].astype(np.int64)
        sizes = np.diff(bounds)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = bounds[owner] + inner * BLOCK
        length = np.minimum(BLOCK, bounds[owner + 1] - start) if len(owner) else np.empty(0, np.int64)
        order = np.argsort(-length, kind="stable")
        start, length, owner = start[order], length[order], owner[order]
        roots = self.roots[:, None]
        state = np.repeat(roots, len(owner), 1)
        ended = np.zeros(state.shape, np.int64)
        # in step: the t-th symbol of every block that is longer than t
        active = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
        for t, n in enumerate(active):
            step = self.step(state[:, :n], sym[start[:n] + t])
            ended[:, :n] += step & 3
            state[:, :n] = step >> 2
        ended += state != roots
        phrases = np.zeros((len(self.languages), len(texts)))
        for j in range(len(self.languages)):
            phrases[j] = np.bincount(owner, ended[j], minlength=len(texts))
        return phrases, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size == 0 or size + len(texts[end] or "") <= CHUNK_CHARS):
                size += len(texts[end] or "") + 1
                end += 1
            part = [t or "" for t in texts[at:end]]
            points, bounds = code_points(part)
            has = np.concatenate([[0], np.cumsum(letters()[points])])
            known = np.flatnonzero(has[bounds[1:]] > has[bounds[:-1]])
            if len(known) and self.languages:
                phrases, sizes = self.parse([part[i] for i in known])
                entropy = phrases * self.bits[:, None] / sizes
                best = entropy.argmin(0)
                ranked = np.sort(entropy, 0)
                margin = 1 - ranked[0] / ranked[1] if len(self.languages) > 1 else np.ones(len(known))
                for i, b, m in zip(known, best, margin, strict=True):
                    langs[at + i], scores[at + i] = self.languages[b], m
            at = end
        return langs, scores


def build(samples: dict[str, list[str]]) -> Model:
    """Automata over the sampled passages of each language, set apart by a break."""
    languages = sorted(k for k, v in samples.items() if any(v))
    symbols = np.ones(0x110000, np.uint32)
    symbols[letters()] = 0
    points = np.concatenate([code_points(samples[k])[0] for k in languages]) if languages else np.empty(0, np.int64)
    seen, often = np.unique(points[letters()[points]], return_counts=True)
    symbols[seen[np.argsort(-often, kind="stable")]] = np.arange(2, 2 + len(seen))
    states = 2 * (len(points) + sum(len(samples[k]) for k in languages)) + 1  # at most
    width, count = 2 + min(len(seen), COLUMNS, max(1, CELLS // states)), 2 + len(seen)
    tables, roots, bits, at = [], [], [], 0
    keys, to_rows = [], []
    for k in languages:
        auto, size = SuffixAutomaton(), 0
        for passage in samples[k]:
            sym = symbols[code_points([passage])[0]]
            sym = sym[np.concatenate([[True], (sym[1:] != 1) | (sym[:-1] != 1)])] if len(sym) else sym
            for s in sym.tolist():
                if s:
                    auto.add(s)
            auto.add(-1)  # matched by nothing, so that no phrase runs from passage to passage
            size += len(sym)
        n = len(auto.next)
        go = np.full((n, width), -1, np.int64)
        for state, moves in enumerate(auto.next):
            for s, to in moves.items():
                if 0 <= s < width:
                    go[state, s] = to
                elif s >= 0:
                    keys.append((at // width + state) * count + s)
                    to_rows.append(at + to * width)
        # where a phrase can't go on, it ends and the next starts with the symbol;
        # a symbol that the language doesn't have is a phrase of its own
        fresh = np.where(go[0] >= 0, 1, 2)
        steps = np.where(go >= 0, (go * width + at) * 4, (np.maximum(go[0], 0) * width + at) * 4 + fresh)
        steps[0] = np.where(go[0] >= 0, (go[0] * width + at) * 4, at * 4 + 1)
        tables.append(steps.reshape(-1))
        roots.append(at)
        # a phrase costs no less than naming one of all symbols, else a language with next to no text were cheap
        bits.append(np.log2(max(size, count) + 2))
        at += n * width
    kind = np.int32 if at * 4 < 2**31 else np.int64
    order = np.argsort(np.array(keys, np.int64))
    return Model(languages, np.array(roots, np.int64), np.array(bits), np.concatenate(tables).astype(kind) if tables else np.empty(0, kind), symbols,
                 width, count, np.array(keys, np.int64)[order], np.array(to_rows, np.int64)[order])


def learn(docs: DataFrame, usable, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, total_chars: int = TOTAL_CHARS) -> Model:
    """Fit on a bounded, hashed sample of the rows with text and lang that ``usable(doc_id)`` admits.

    Of each language ``sample_docs`` documents are taken, of each the ``sample_chars`` characters in its
    middle; with so many languages that this exceeds ``total_chars``, fewer documents of each, one at
    least.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & usable(F.col("doc_id"))).select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    counts = materialize(rows.groupBy("lang").agg(F.count("*").alias("rows")), "op10-languages")
    languages = counts.count()
    per = int(min(sample_docs, max(1, total_chars // sample_chars // max(1, languages))))
    # a share of four times the wanted rows of each language by hash, then the first of them
    share = F.pmod(F.xxhash64("doc_id", F.lit("op10")), F.lit(1 << 30)) / float(1 << 30)
    first = Window.partitionBy("lang").orderBy("share", "doc_id", "passage")
    middle = F.expr(f"substring(text, cast(greatest(length(text) div 2 - {sample_chars // 2}, 0) as int) + 1, {sample_chars})")
    known = F.broadcast(counts) if languages <= BROADCAST_LANGS else counts
    some = rows.join(known, "lang").withColumn("share", share).where(F.col("share") * F.col("rows") < 4.0 * per)
    picked = (some.select("doc_id", "lang", "share", middle.alias("passage"))
              .withColumn("n", F.row_number().over(first)).where(F.col("n") <= per).orderBy("lang", "n").collect())
    samples: dict[str, list[str]] = {}
    for r in picked:
        samples.setdefault(r["lang"], []).append(r["passage"])
    return build(samples)


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = shared.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id):
    return crc_mod(doc_id, 4) == 2


def op10_language(docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, held_out, lang_pred, score).

    It learns from a bounded sample of the labelled rows that aren't held out (:func:`learn`).
    A text (letters lower-cased, every run of other characters one symbol) is parsed
    greedily into the longest phrases that occur in a language's training text; the
    automaton reads each character once.  Phrases times log2 of the training size,
    per symbol, is the cross-entropy; the least wins, ties go to the smaller name.
    ``score`` is one less the ratio of the least to the second least.  The parse of
    a text starts anew every 4096 symbols.

    Defined results: ``und`` with score 0 for null text, text without a letter, or
    if there is nothing to learn from; repeated rows are predicted each; null ids
    count as the empty text in the checksum; an empty table gives an empty result.
    """
    model = learn(docs, lambda d: ~held_out(d))
    return with_language(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
