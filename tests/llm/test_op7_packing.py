"""Packing: exact ids, gapless sequences, few of them."""

import random
import zlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfcast.llm import op7_packing as op
from shelfcast.llm.tokens import FAST_PATTERN, PATTERN, Encoder, default_paths, runs

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_paths()[0])


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_paths(), PATTERN)


@pytest.fixture(scope="module")
def public_words(encoder):
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=encoder.fast._mergeable_ranks, special_tokens={})


def want_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'séß 012.,-\x1c\x85\xa0 ʼ²½"))))
def test_ids_equal_the_tokenizers(tokenizer, encoder, text):
    assert (encoder.ids(text) == want_ids(tokenizer, text)).all()


def test_special_strings_and_runs(tokenizer, encoder):
    for text in ("a <|endoftext|> b", "<|endoftext|>", "it's  we'll\n\n x"):
        assert (encoder.ids(text) == want_ids(tokenizer, text)).all()
    rnd = random.Random(1)
    text = " ".join(rnd.choice(["word", "Übung,", "42", "don't", "x\n y"]) for _ in range(3000))
    parts = runs(text, 500)
    assert len(parts) > 5 and "".join(parts) == text
    ids = [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids]
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from([*" \n\t\r'stmdlvreSaß1²½!-_\xa0ªº×"])))
def test_the_faster_word_rule_finds_the_same_words(encoder, public_words, text):
    assert encoder.fast._pat_str == FAST_PATTERN != PATTERN
    assert encoder.fast.encode_ordinary(text) == public_words.encode_ordinary(text)


def check(rows, docs, tokenizer, capacity):
    want = {}
    for d, t in docs:
        ids = want_ids(tokenizer, t)
        first = len(ids) % capacity or capacity
        bounds = [(0, min(first, len(ids))), *((s, capacity) for s in range(first, len(ids), capacity))]
        for p, (s, n) in enumerate(bounds):
            want.setdefault((d, p, s, n, zlib.crc32(ids[s:s + n].tobytes())), []).append(1)
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
    assert got == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_whole_contract(spark, tokenizer):
    rnd = random.Random(8)
    docs = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma,", "né"]) for _ in range(int(rnd.expovariate(1 / 150))))) for i in range(400)]
    docs += [(900, None), (901, ""), (902, "x y " * 4000), (None, "no id"), (5, docs[5][1]), (5, "two texts, one id")]
    df = spark.createDataFrame(docs, DOCS).repartition(4).selectExpr("*", "7 as length", "8 as piece")
    rows = op.op7_packing(df, capacity=512).collect()
    n = check(rows, docs, tokenizer, 512)
    assert n <= 1.01 * sum(r.length for r in rows) / 512 + 2


def test_sequences_and_small_cells(spark, tokenizer):
    docs = [(i, "word " * (i % 40)) for i in range(200)]
    df = spark.createDataFrame(docs, DOCS)
    cut = op.pieces(df, default_paths(), 64, with_ids=True)
    packed = op.pack(cut, 64, cell=7)
    rows = packed.collect()
    check(rows, docs, tokenizer, 64)
    joined = {r.sequence_id: r.ids for r in op.sequences(packed).collect()}
    for r in rows:
        assert zlib.crc32(np.array(joined[r.sequence_id][r.offset:r.offset + r.length], "<u4").tobytes()) == r.ids_crc32


def test_empty(spark):
    assert op.op7_packing(spark.createDataFrame([], DOCS)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 500), max_size=40))
def test_plan_places_every_piece_once(counts):
    made = op.plan(counts, 100)
    assert all(v == 0 for v in made.left.values())
    used = {}
    rows = sorted(made.rows)
    for i, (length, rank, sequence, offset) in enumerate(rows):
        end = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == length else counts[length]
        for s in range(sequence, sequence + end - rank):
            used.setdefault(s, []).append((offset, length))
    assert len(used) == made.sequences
    for parts in used.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 100
    assert made.sequences <= 2 * -(-sum(k * v for k, v in counts.items()) // 100) + 1
