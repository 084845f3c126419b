"""Licence notices in documents by the Dice coefficient of word bigrams against templates."""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import LOWER, UPPER, ascii_lower, row_key
from shelfcast.session import materialize

#: Least Dice coefficient of a finding; words under SHORT characters are poor anchors.
LEAST_DICE, SHORT = 0.8, 5

# Usual notices of public licences, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
            '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                     "conditions are met:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "No part of this publication may be reproduced without the prior written permission of the publisher."),
)

#: A template that opens two licences, the one meant if the text has the first phrase and lacks the second.
VARIANTS = (("Redistribution and use in source and binary forms", "BSD-2-Clause", "redistributions in binary form", "neither the name"),)
#: Bytes of licence texts' bigrams up to which they are broadcast; above, both sides are shuffled.
BROADCAST_BYTES = 64 << 20

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A span ends at a line break, or after . ! ? before white space.
_SPAN_END = r"\n|(?<=[.!?])[\x20\x09\x0B-\x0D]+"
#: Lines run on until a sentence ends, or before a line without words (a comment's mark is none).
_RUN_END = r"(?<=[.!?])[\x20\x09\x0B-\x0D]+|(?<=[.!?])\n|\n(?=[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*(?:\n|\z))"


def normalised(text: Column) -> Column:
    """The words of a text: A-Z lower-cased, split at other ASCII than letters and digits."""
    return F.array_remove(F.split(ascii_lower(text), _NOT_WORD, -1), "")


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words; a single word is paired with nothing."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, license_id, n_template, bigram): one row per template's bigram."""
    rows = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(templates)], "template int, license_id string, text string")
    each = rows.withColumn("bigrams", bigrams(normalised(F.col("text")))).withColumn("n_template", F.size("bigrams"))
    return each.select("template", "license_id", "n_template", F.explode("bigrams").alias("bigram"))


def bounds(n: Column, least: float) -> tuple[Column, Column]:
    """Sizes between which a set can reach Dice ``least`` with a set of ``n``: 2 min / (a + b) >= least."""
    return F.ceil(n * (least / (2 - least)) - 1e-9), F.floor(n * ((2 - least) / least) + 1e-9)


def anchors(templates=TEMPLATES, least: float = LEAST_DICE) -> list[tuple[str, ...]]:
    """Groups of words: every span that can reach ``least`` has all words of at least one group.

    With a template of ``n`` bigrams a span needs ``least * (n + low) / 2`` common ones,
    ``low`` being the least size that the bounds admit.  Per template the longest
    words are taken, each a group of its own, until its bigrams without any of them are
    fewer than that.  Where only short words are left and none of their bigrams may be
    missing, these words together are the last group.
    """
    chosen: set[tuple[str, ...]] = set()
    for _, text in templates:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER)))
        pairs = set(zip(words, words[1:], strict=False))
        needed = math.ceil(least * (len(pairs) + math.ceil(len(pairs) * least / (2 - least) - 1e-9)) / 2 - 1e-9)
        own: set[str] = set()
        for w in sorted(set(words), key=lambda w: (-len(w), w)):
            left = [p for p in pairs if not own & set(p)]
            if len(left) < needed:
                break
            if len(w) < SHORT and len(left) == needed:
                chosen.add(tuple(sorted({x for p in left for x in p}, key=lambda x: (-len(x), x))))
                break
            own.add(w)
        chosen |= {(w,) for w in own}
    return sorted(chosen)


def anchored(c: Column, groups: list[tuple[str, ...]]) -> Column:
    return reduce(or_, [reduce(and_, [F.contains(c, F.lit(w)) for w in g]) for g in groups])


def phrase(words: str) -> str:
    """A pattern for ``words`` with anything but letters and digits between them, in lower-cased text."""
    return r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+".join(words.split())


def meant(text: Column) -> Column:
    """For each of the VARIANTS whether the text is of the other licence."""
    low = ascii_lower(text)
    return F.array(*[F.rlike(low, F.lit(phrase(has))) & ~F.rlike(low, F.lit(phrase(lacks))) for _, _, has, lacks in VARIANTS])


def variant(templates) -> Column:
    """``license_id``, or the other licence where ``meant`` says so and the template is one that opens both."""
    out = F.col("license_id")
    for i, (opening, other, _, _) in enumerate(VARIANTS):
        numbers = [n for n, (_, t) in enumerate(templates) if t.startswith(opening)]
        out = F.when(F.col("template").isin(numbers) & F.get("meant", F.lit(i)), F.lit(other)).otherwise(out)
    return out.alias("license_id")


def wrapped(texts: DataFrame, table: DataFrame, groups: list[tuple[str, ...]], least: float) -> DataFrame:
    """(row_id, doc_id, meant, span, until, license_id, template, dice, text) of the notices that are spread over several lines.

    ``texts`` are (doc_id, row_id, text, meant) that hold a group of anchor words.  Windows are whole neighbouring spans of one run
    (:data:`_RUN_END`), with together no more words than the bounds of the largest
    template admit.  A run is looked into only for templates of which it has enough
    bigrams.  Of overlapping windows the nearest stays, ties to the one of fewer
    lines, the first, the smaller template; single spans compete as well.  All of it
    happens where the text is read.
    """
    rows = table.groupBy("template", "license_id", "n_template", "low").agg(F.collect_list("bigram").alias("bigrams")).orderBy("template").collect()
    most = int(max(r["n_template"] for r in rows) * (2 - least) / least + 1e-9) + 1
    needed = {r["template"]: math.ceil(least * (r["n_template"] + r["low"]) / 2 - 1e-9) for r in rows}
    strings = lambda values: F.array(*[F.lit(v) for v in values])
    every = strings(sorted({g for r in rows for g in r["bigrams"]}))
    known = F.array(*[F.struct(F.lit(r["template"]).alias("template"), F.lit(r["license_id"]).alias("license_id"), F.lit(r["n_template"]).alias("n"),
                               F.lit(needed[r["template"]]).alias("needed"), strings(r["bigrams"]).alias("bigrams")) for r in rows])

    runs = texts.select("doc_id", "row_id", "meant", F.split("text", _RUN_END, -1).alias("runs")).where(F.exists("runs", lambda x: F.contains(x, F.lit("\n"))))
    lines_of = lambda x: F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit(""))) + 1
    starts = F.aggregate("runs", F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + lines_of(x))))
    runs = runs.withColumn("starts", starts)
    several = F.filter(F.transform("runs", lambda x, i: F.struct(F.get("starts", i).alias("first"), x.alias("run"))), lambda r: F.contains(r["run"], F.lit("\n")))
    runs = runs.select("doc_id", "row_id", "meant", F.inline(several)).where(anchored(F.lower("run"), groups))
    runs = runs.withColumn("has", F.array_intersect(bigrams(normalised(F.col("run"))), every)).where(F.size("has") >= min(needed.values()))
    near = F.filter(known, lambda t: F.size(F.array_intersect(F.col("has"), t["bigrams"])) >= t["needed"])
    runs = runs.withColumn("near", near).where(F.size("near") > 0).drop("has")
    parts = F.split("run", "\n", -1)
    runs = runs.withColumn("parts", parts).withColumn("words", F.transform("parts", normalised))

    def windows(i: Column) -> Column:
        rest = lambda n: F.slice("words", i + 1, n)
        length = F.least(F.size("words") - i, F.lit(most))
        fits = F.filter(F.sequence(F.lit(1), length), lambda n: F.aggregate(rest(n), F.lit(0), lambda a, w: a + F.size(w)) <= most)
        ends = F.filter(fits, lambda n: F.size(F.get("words", i + n - 1)) > 0)
        return F.transform(ends, lambda n: F.struct(n.alias("lines"), bigrams(F.flatten(rest(n))).alias("grams")))

    def nearest(i: Column, w: Column) -> Column:
        dice = lambda t: 2 * F.size(F.array_intersect(w["grams"], t["bigrams"])) / (F.size(w["grams"]) + t["n"])
        return F.array_min(F.transform("near", lambda t: F.struct((-dice(t)).alias("minus"), w["lines"].alias("lines"), i.alias("at"),
                                                                 t["template"].alias("template"), t["license_id"].alias("license_id"))))

    begins = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.size(F.get("words", i)) > 0)
    ranked = F.flatten(F.transform(begins, lambda i: F.filter(F.transform(windows(i), lambda w: nearest(i, w)), lambda b: b["minus"] <= -least)))
    runs = runs.withColumn("ranked", F.array_sort(ranked)).where(F.exists("ranked", lambda b: b["lines"] > 1))
    apart = lambda a, b: (a["at"] + a["lines"] <= b["at"]) | (b["at"] + b["lines"] <= a["at"])
    chosen = F.aggregate("ranked", F.slice("ranked", 1, 0),
                         lambda kept, b: F.when(F.forall(kept, lambda k: apart(k, b)), F.concat(kept, F.array(b))).otherwise(kept))
    found = runs.select("doc_id", "row_id", "meant", "first", "parts", F.explode(F.filter(chosen, lambda b: b["lines"] > 1)).alias("b"))
    span = F.col("first") + F.col("b.at")
    return found.select("row_id", "doc_id", "meant", span.alias("span"), (span + F.col("b.lines") - 1).alias("until"), "b.license_id", "b.template",
                        (-F.col("b.minus")).alias("dice"), F.array_join(F.slice("parts", F.col("b.at") + 1, F.col("b.lines")), "\n").alias("text"))


def scan(docs: DataFrame, templates=TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """(doc_id, span, license_id, template, dice, text) of every span that is near a template.

    Spans are the sentences and lines of the whole text, numbered from 0 in reading
    order.  A span's candidates are the templates whose size bounds admit it; Dice is
    2 * common / (span's bigrams + template's bigrams) over distinct bigrams.  Of a
    span's templates the nearest is given, ties to the smaller number.  A sentence that opens two
    licences is given as the one whose clauses the text has (:data:`VARIANTS`).

    A notice that is wrapped over several lines is one finding under the number of its
    first span, with the lines as its text (:func:`wrapped`); a line in it that is near a
    template of the same licence by itself is no finding of its own.

    Texts and spans without a group of anchor words (:func:`anchors`), which can't reach the
    coefficient, and spans outside the bounds of every template go before their
    bigrams are formed.  The templates are a fixed list, so these are broadcast; matches are
    counted by a partial aggregate, and no text is shuffled but the findings'.

    Defined results: null, empty and one-word texts have no finding; equal rows
    (same id and text) have their findings once; null ids are kept; an empty table
    gives an empty result; other columns are ignored.
    """
    table = template_table(docs.sparkSession, templates)
    low, high = bounds(F.col("n_template"), least)
    table = table.withColumn("low", low).withColumn("high", high)
    sizes = [r["n"] for r in table.groupBy("template").agg(F.max("n_template").alias("n")).collect()]
    smallest, largest = min(sizes) * least / (2 - least), max(sizes) * (2 - least) / least

    groups = anchors(templates, least)
    base = docs.select("doc_id", "text", F.lower("text").alias("low")).where(anchored(F.col("low"), groups))
    base = base.select("doc_id", row_key().alias("row_id"), "text", meant(F.col("text")).alias("meant"))
    spans = base.select("doc_id", "row_id", "meant", F.posexplode(F.split("text", _SPAN_END, -1)).alias("span", "text"))
    spans = spans.withColumn("low", F.lower("text")).where(anchored(F.col("low"), groups)).drop("low")
    # n bigrams need n + 1 words, and these 2 n + 1 characters
    spans = spans.where(F.length("text") >= int(2 * smallest + 1)).withColumn("words", normalised(F.col("text")))
    spans = spans.where(F.size("words") - 1 >= smallest).withColumn("bigrams", bigrams(F.col("words")))
    spans = spans.withColumn("n_span", F.size("bigrams")).where(F.col("n_span").between(smallest, largest))
    each = spans.select("doc_id", "row_id", "meant", "span", "text", "n_span", F.explode("bigrams").alias("bigram"))
    met = each.join(F.broadcast(table), "bigram").where(F.col("n_span").between(F.col("low"), F.col("high")))
    common = (met.groupBy("row_id", "doc_id", "meant", "span", "n_span", "template", "license_id", "n_template")
              .agg(F.count_distinct("bigram").alias("common"), F.min("text").alias("text")))
    near = common.withColumn("dice", 2 * F.col("common") / (F.col("n_span") + F.col("n_template"))).where(F.col("dice") >= least)
    best = F.min(F.struct((-F.col("dice")).alias("minus"), "template", "license_id", "text"))
    single = near.groupBy("row_id", "doc_id", "meant", "span").agg(best.alias("b")).select(
        "row_id", "doc_id", "meant", "span", "b.license_id", "b.template", (-F.col("b.minus")).alias("dice"), "b.text")
    # two branches read it: written, so that the texts are looked through for it once
    several = materialize(wrapped(base, table, groups, least).dropDuplicates(["row_id", "span"]), "op4-wrapped")
    lines = several.select("row_id", "license_id", F.explode(F.sequence("span", "until")).alias("span"))
    single = single.join(lines, ["row_id", "span", "license_id"], "left_anti")
    out = ["doc_id", "span", variant(templates), "template", "dice", "text"]
    return single.select(*out).unionByName(several.select(*out))


def whole_licences(docs: DataFrame, licences: DataFrame, least: float = 0.9, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, license_id, dice): the nearest of ``licences(license_id, text)`` of every document that is a licence text as a whole.

    Dice is over the distinct word bigrams of both whole texts, so years and names don't matter and texts
    that differ in a clause are told apart; it must reach ``least``.  Documents outside the size bounds of
    all licences go before their bigrams are formed; matches are counted by a partial aggregate.

    Defined results: ties go to the smaller ``license_id``; null and empty texts, and licences without
    two words, are near nothing; equal rows (same id and text) give one row; empty tables an empty result.
    """
    known = licences.select("license_id", bigrams(normalised(F.col("text"))).alias("grams")).where(F.size("grams") > 0).distinct()
    low, high = bounds(F.col("n_licence"), least)
    known = known.withColumn("n_licence", F.size("grams")).withColumns({"low": low, "high": high})
    known = materialize(known.select("license_id", "n_licence", "low", "high", F.md5(F.array_join("grams", " ")).alias("licence"), F.explode("grams").alias("gram")), "op4-licences")
    seen = known.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum(F.octet_length("gram") + 60).alias("size")).first()
    small, large = seen["low"] or 1, seen["high"] or 0
    # n bigrams need n + 1 words, and these 2 n + 1 characters
    texts = docs.select("doc_id", row_key().alias("row_id"), "text").where(F.length("text") >= int(2 * small + 1))
    texts = texts.select("doc_id", "row_id", normalised(F.col("text")).alias("words")).where(F.size("words") > int(small))
    texts = texts.withColumn("grams", bigrams(F.col("words"))).withColumn("n", F.size("grams")).where(F.col("n").between(small, large))
    each = texts.select("doc_id", "row_id", "n", F.explode("grams").alias("gram"))
    side = F.broadcast(known) if (seen["size"] or 0) <= broadcast_bytes else known
    met = each.join(side, "gram").where(F.col("n").between(F.col("low"), F.col("high")))
    common = met.groupBy("row_id", "doc_id", "n", "license_id", "licence", "n_licence").agg(F.count_distinct("gram").alias("common"))
    near = common.withColumn("dice", 2 * F.col("common") / (F.col("n") + F.col("n_licence"))).where(F.col("dice") >= least)
    best = F.min(F.struct((-F.col("dice")).alias("minus"), "license_id"))
    return near.groupBy("row_id", "doc_id").agg(best.alias("b")).select("doc_id", "b.license_id", (-F.col("b.minus")).alias("dice"))


def op4_licenses(docs: DataFrame) -> DataFrame:
    """One row per finding: (doc_id, span, license_id, template, dice, span_sha256); see :func:`scan`."""
    return scan(docs).select("doc_id", F.col("span").cast("long").alias("span"), "license_id", F.col("template").cast("long").alias("template"),
                             F.round("dice", 6).alias("dice"), F.sha2("text", 256).alias("span_sha256"))


def oracle(templates=TEMPLATES, least: float = LEAST_DICE) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quote(k)}, {quote(t)})" for i, (k, t) in enumerate(templates))
    words = (r"list_filter(string_split_regex(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")
    grams = "list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))"
    case = "license_id"
    for opening, other, has, lacks in VARIANTS:
        numbers = ", ".join(str(n) for n, (_, t) in enumerate(templates) if t.startswith(opening)) or "-1"
        case = (f"CASE WHEN id IN ({numbers}) AND regexp_matches(low, {quote(phrase(has))}) "
                f"AND NOT regexp_matches(low, {quote(phrase(lacks))}) THEN {quote(other)} ELSE {case} END")
    return rf"""
WITH t AS (SELECT id, license_id, {grams} AS grams FROM (SELECT id, license_id, {words.format("text")} AS words FROM (VALUES {values}) v(id, license_id, text))),
d AS (SELECT row_number() OVER () AS row, doc_id, text FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
l AS (SELECT row, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d),
s AS (SELECT row, doc_id, unnest(parts) AS text, generate_subscripts(parts, 1) - 1 AS span
      FROM (SELECT row, doc_id, string_split(regexp_replace(text, '([.!?])[\x20\x09\x0B-\x0D]+', '\1' || chr(10), 'g'), chr(10)) AS parts FROM d)),
w AS (SELECT row, doc_id, span, text, {grams} AS grams FROM (SELECT *, {words.format("text")} AS words FROM s)),
m AS (SELECT w.*, t.id, t.license_id, 2 * len(list_intersect(w.grams, t.grams)) / (len(w.grams) + len(t.grams)) AS dice
      FROM w JOIN t ON len(w.grams) > 0 AND 2 * least(len(w.grams), len(t.grams)) >= {least} * (len(w.grams) + len(t.grams)) - 1e-9)
SELECT doc_id, span, {case} AS license_id, id AS template, round(dice, 6) AS dice, sha256(text) AS span_sha256
FROM m JOIN l USING (row) WHERE dice >= {least} QUALIFY row_number() OVER (PARTITION BY row, span ORDER BY dice DESC, id) = 1
"""
