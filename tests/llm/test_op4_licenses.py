"""Licence findings against a comparison of every span with every template."""

import re
import textwrap

from helpers import DOCS, split
from shelfcast.llm import op4_licenses as op

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def grams(text):
    w = split(WORD, text)
    return set(zip(w, w[1:], strict=False))


def brute(docs):
    out = set()
    for d, text in docs:
        for n, span in enumerate(re.split(r"\n|(?<=[.!?])[\x20\x09\x0B-\x0D]+", text or "")):
            a = grams(span)
            near = sorted((-2 * len(a & b) / (len(a) + len(b)), i, k) for i, (k, t) in enumerate(op.TEMPLATES) if a and (b := grams(t)))
            if near and -near[0][0] >= op.LEAST_DICE:
                out.add((d, n, near[0][2], near[0][1], round(-near[0][0], 9)))
    return out


def docs():
    rows = [(i, f"Some words before. {t} And after it all\n{t.upper()}\nend") for i, (_, t) in enumerate(op.TEMPLATES)]
    mit = next(t for k, t in op.TEMPLATES if k == "MIT" and len(t) > 100)
    rows += [(100, mit.replace("free of charge", "for nothing")), (101, None), (102, ""), (103, "one"), (104, "All rights reserved"),
             (105, "Released under the MIT License " * 400), (106, "released  under*the\tmit/license"), (107, "Version 2.0. Licensed under the apache license"),
             (None, "All rights reserved."), (108, "All rights reserved."), (108, "All rights reserved."), (109, "x " * 50_000)]
    return rows


def test_equals_all_pairs(spark):
    df = spark.createDataFrame(docs(), DOCS).repartition(3).selectExpr("*", "1 as span", "'z' as license_id", "2 as bigram")
    got = {(r.doc_id, r.span, r.license_id, r.template, round(r.dice, 9)) for r in op.scan(df).collect()}
    assert got == brute(docs()) and len(got) > 60
    assert op.scan(df).count() == len(got)


def test_empty(spark):
    assert op.op4_licenses(spark.createDataFrame([], DOCS)).collect() == []


def test_bounds_admit_exactly_what_can_reach(spark):
    least = op.LEAST_DICE
    for n in range(1, 60):
        lo, hi = spark.range(1).select(*[c.alias(a) for c, a in zip(op.bounds(op.F.lit(n), least), "ab", strict=True)]).first()
        assert [m for m in range(1, 200) if 2 * min(m, n) >= least * (m + n)] == list(range(max(1, lo), hi + 1))


def test_no_span_without_an_anchor_can_be_near():
    groups = [set(g) for g in op.anchors()]
    for _, t in op.TEMPLATES:
        pairs = grams(t)
        left = {p for p in pairs if not any({w} in groups for w in p)}
        while left and any(g <= {w for p in left for w in p} for g in groups):
            left.discard(next(iter(sorted(left))))  # a span with all of them would have the group
        # the best that a span of these bigrams alone can do, whatever its size
        best = max((2 * len(left) / (n + len(pairs)) for n in range(max(1, len(left)), 2 * len(pairs) + 1)), default=0)
        assert best < op.LEAST_DICE


def brute_wrapped(docs):
    """(doc_id, first span, license, template, dice) of the windows of lines, by trying all."""
    out = set()
    for d, text in docs:
        units = re.split(r"\n|(?<=[.!?])[\x20\x09\x0B-\x0D]+", text)
        words = [split(WORD, u) for u in units]
        ranked = []
        for i in range(len(units)):
            for j in range(i, len(units)):
                if not words[j] or not words[i] or len(sum(words[i:j + 1], [])) > 120 or any(not w or u[-1:] in ".!?" for w, u in zip(words[i:j], units[i:j], strict=True)):
                    continue
                a = grams("\n".join(units[i:j + 1]))
                ranked += [(-2 * len(a & b) / (len(a) + len(b)), j - i + 1, i, t, k) for t, (k, x) in enumerate(op.TEMPLATES) if a and (b := grams(x))][:]
        taken = set()
        for minus, n, i, t, k in sorted(r for r in ranked if -r[0] >= op.LEAST_DICE):
            if not taken & set(range(i, i + n)):
                taken |= set(range(i, i + n))
                if n > 1:
                    out.add((d, i, k, t, round(-minus, 9)))
    return out


def test_wrapped_notices_are_found(spark):
    rows, want = [], set()
    for i, (_, t) in enumerate(op.TEMPLATES):
        for j, (mark, width) in enumerate([("", 76), ("# ", 40), (" * ", 24)]):
            body = "\n".join(mark + x for x in textwrap.wrap(t, width))
            rows.append((10 * i + j, f"{mark}A heading\n{mark}\n{body}\n{mark}\n{mark}more words here"))
            rows.append((10 * i + j + 5, f"Some title of it\n{body}\nand lines that go on\nwithout an end"))
    got = {(r.doc_id, r.span, r.license_id, r.template, round(r.dice, 9)) for r in op.scan(spark.createDataFrame(rows, DOCS)).collect()}
    want = brute_wrapped(rows)
    assert want <= got and len({d // 10 for d, *_ in want}) > 20
    assert {(d, *x) for d, *x in got if not any((d, *x) == w for w in want)} <= brute(rows)
    by = {}
    for d, _, k, _, _ in got:
        by.setdefault(d, set()).add(k)
    assert all(op.TEMPLATES[d // 10][0] in by.get(d, ()) for d, _ in rows)


def test_sha_is_of_the_lines_and_equal_rows_count_once(spark):
    t = next(x for k, x in op.TEMPLATES if k == "ISC")
    lines = textwrap.wrap(t, 60)
    df = spark.createDataFrame([(1, "\n".join(["x. y", *lines]))] * 2 + [(2, "\n\n".join(lines))], DOCS)
    (r,) = op.scan(df).collect()
    assert (r.doc_id, r.span, r.license_id, r.dice, r.text) == (1, 2, "ISC", 1.0, "\n".join(lines))


def test_the_clauses_that_follow_tell_the_two_bsd_licences_apart(spark):
    opening = next(t for _, t in op.TEMPLATES if t.startswith("Redistribution and use"))
    binary = "2. Redistributions in binary form must reproduce the above copyright notice."
    third = "3. Neither the name of the copyright holder nor the names of its contributors may be used."
    rows = [(1, f"{opening}\n{binary}"), (2, f"{opening}\n{binary}\n{third}"), (3, opening), (4, "\n".join(textwrap.wrap(opening, 50)) + "\n\n" + binary.replace(" ", "\n * ")),
            (5, "\n".join(textwrap.wrap(opening, 50)) + "\n\n" + binary + third.upper())]
    got = {r.doc_id: r.license_id for r in op.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: "BSD-2-Clause", 2: "BSD-3-Clause", 3: "BSD-3-Clause", 4: "BSD-2-Clause", 5: "BSD-3-Clause"}


def test_whole_licence_texts(spark):
    import random
    rnd = random.Random(44)
    words = [f"word{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(300)]
    licences = {"A": " ".join(base), "A-clause": " ".join(base + [rnd.choice(words) for _ in range(40)]), "B": " ".join(rnd.choice(words) for _ in range(120)), "none": "x"}
    rows = [(1, licences["A"]), (2, licences["A-clause"].upper()), (3, "Copyright 2020 Some One\n" + licences["A"].replace(" ", "\n# ", 30)), (4, licences["B"]),
            (5, licences["B"] + " " + " ".join(rnd.choice(words) for _ in range(90))), (6, None), (7, ""), (8, "x"), (9, licences["A"] * 40), (1, licences["A"]), (None, licences["B"])]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'z' as license_id", "1 as n")
    lic = spark.createDataFrame(list(licences.items()), "license_id string, text string")
    for limit in (1 << 20, 0):
        got = {(r.doc_id, r.license_id, round(r.dice, 9)) for r in op.whole_licences(df, lic, 0.9, limit).collect()}
        want = set()
        for d, t in rows:
            a = grams(t or "")
            near = sorted((-2 * len(a & b) / (len(a) + len(b)), k) for k, x in licences.items() if a and (b := grams(x)))
            if near and -near[0][0] >= 0.9:
                want.add((d, near[0][1], round(-near[0][0], 9)))
        assert got == want and {(d, k) for d, k, _ in got} == {(1, "A"), (2, "A-clause"), (3, "A"), (4, "B"), (9, "A"), (None, "B")}  # 9 is A forty times over: the same bigrams
    assert op.whole_licences(df, lic.limit(0)).collect() == [] and op.whole_licences(df.limit(0), lic).collect() == []
