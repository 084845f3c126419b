"""Cross-parsing: the automaton against plain longest matches, and held-out accuracy."""

import random
import re

import numpy as np

from helpers import crc
from shelfcast.llm import op10_language as op

DOCS = "doc_id long, text string, lang string"
SYLLABLES = {"xx": ["ba", "ka", "to", "mi", "ru"], "yy": ["schle", "ung", "ver", "keit", "ä"], "zz": ["eau", "tion", "que", "é", "ment"]}


def say(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n)).capitalize() + "."


def corpus(n=400, seed=2):
    rnd = random.Random(seed)
    return [(i, say(rnd, lang, rnd.randint(2, 60)), lang) for i in range(n) for lang in [rnd.choice(list(SYLLABLES))]]


def phrases(text, passages):
    """Greedy longest-match parse, by searching."""
    norm = lambda t: re.sub(r"[\W\d_]+", " ", t.lower())
    text, known, n, i = norm(text), [norm(p) for p in passages], 0, 0
    while i < len(text):
        j = i + 1
        while j < len(text) and any(text[i:j + 1] in p for p in known):
            j += 1
        i, n = j, n + 1
    return n


def test_parse_counts_longest_matches():
    rnd = random.Random(1)
    samples = {k: [say(rnd, k, 30) for _ in range(4)] for k in SYLLABLES}
    model = op.build(samples)
    texts = [say(rnd, k, n) for k in SYLLABLES for n in (1, 5, 40)] + ["12 !! a", "ooo ööö", "B"]
    got, _ = model.parse(texts)
    for j, k in enumerate(model.languages):
        assert got[j].tolist() == [phrases(t, samples[k]) for t in texts]


def test_held_out_accuracy_and_edges(spark):
    rows = corpus() + [(9001, None, "xx"), (9002, "", "yy"), (9003, "123 !?\n", "zz"), (9004, "word", None), (9005, say(random.Random(3), "yy", 30_000), "yy"),
                       (None, say(random.Random(4), "zz", 9), "zz"), (0, corpus()[0][1], corpus()[0][2])]
    df = spark.createDataFrame(rows, DOCS).repartition(4).selectExpr("*", "1 as score", "2 as lang_pred")
    out = op.op10_language(df).collect()
    assert len(out) == len(rows)
    langs = {i: k for i, _, k in rows}
    for r in out:
        assert r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1
    by = {r.doc_id: r.lang_pred for r in out}
    assert [by[i] for i in (9001, 9002, 9003)] == ["und"] * 3 and by[9004] in SYLLABLES and by[9005] == "yy"
    held = [(r.lang_pred, langs[r.doc_id]) for r in out if r.held_out and r.doc_id is not None and r.doc_id < 9000]
    assert np.mean([a == b for a, b in held]) >= 0.97


def test_held_out_labels_are_never_used(spark):
    rows = corpus(200)
    turned = [(i, t, "zz" if crc(i, 4) == 2 else k) for i, t, k in rows]
    a, b = (sorted(op.op10_language(spark.createDataFrame(x, DOCS)).collect()) for x in (rows, turned))
    assert a == b


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "text", None)], DOCS)
    assert op.op10_language(df).collect()[0].lang_pred == "und"
    assert op.op10_language(df.limit(0)).collect() == []


def test_blocks_cover_long_texts():
    model = op.build({"xx": ["baka tomiru"], "yy": ["schlever ung"]})
    text = "baka " * 5000
    got, sizes = model.parse([text])
    assert sizes[0] == len(text) and got[0, 0] <= len(text) / 4


def test_languages_of_many_letters():
    rnd = random.Random(8)
    letters = [chr(0x4E00 + i) for i in range(900)]
    alphabets = {"aa": letters[:500], "bb": letters[400:], "cc": [*letters[300:700], *"abcdef"]}
    words = {k: ["".join(rnd.choice(v) for _ in range(rnd.randint(1, 4))) for _ in range(400)] for k, v in alphabets.items()}
    speak = lambda k, n: "".join(rnd.choice(words[k]) + rnd.choice(["", "", "。"]) for _ in range(n))
    samples = {k: [speak(k, 60) for _ in range(12)] for k in words}
    model = op.build(samples)
    texts = [speak(k, n) for k in words for n in (3, 25, 120)] + ["가" + letters[5] + "가", "abc" + letters[450], letters[899] * 9]
    got, _ = model.parse(texts)
    for j, k in enumerate(model.languages):
        assert got[j].tolist() == [phrases(t, samples[k]) for t in texts]
    held = [(k, model.predict([speak(k, 40)])[0][0]) for k in words for _ in range(10)]
    assert all(a == b for a, b in held)


def test_thousands_of_lang_values_make_a_plan_and_a_model(spark):
    # two real languages and 5,000 stray values of the column with one short row each
    rnd = random.Random(30)
    word = {"aa": lambda: "".join(rnd.choice("abcde") for _ in range(5)), "zz": lambda: "".join(rnd.choice("vwxyz") for _ in range(5))}
    rows = [(i, " ".join(word["aa" if i % 2 else "zz"]() for _ in range(30)), "aa" if i % 2 else "zz") for i in range(400)]
    rows += [(1000 + i, f"q{i}", f"stray{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = op.learn(df, lambda d: d.isNotNull())
    assert len(model.languages) == 5002
    small = op.learn(df.where("doc_id < 1100"), lambda d: d.isNotNull(), sample_docs=50, sample_chars=40, total_chars=4000)
    got = {r.doc_id: r.lang_pred for r in op.with_language(df.where("doc_id < 40"), small).collect()}
    assert all(got[i] == ("aa" if i % 2 else "zz") for i in range(40))


def test_fewer_columns_change_no_prediction(spark, monkeypatch):
    rnd = random.Random(31)
    samples = {k: ["".join(rnd.choice(letters + " ") for _ in range(200)) for _ in range(5)] for k, letters in (("a", "abcdefghij"), ("b", "ghijklmnop"), ("c", "αβγδεζηθ"))}
    texts = ["".join(rnd.choice("abcghijmnoαβγ ") for _ in range(60)) for _ in range(50)]
    wide = op.build(samples).predict(texts)
    monkeypatch.setattr(op, "CELLS", 1)
    narrow = op.build(samples)
    assert narrow.width == 3
    langs, scores = narrow.predict(texts)
    assert list(langs) == list(wide[0]) and list(scores) == list(wide[1])
