"""The corpus pipeline: every stage against its operator's contract, on its own input."""

import random

import corpus_pipeline
from helpers import split
from shelfcast.llm.queries import oracle_sql, queries


def write(spark, tmp):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randint(3, 9)))
    docs, labels = [], []
    boiler, item = "a line of boilerplate that many documents share " + word(), " ".join(word() for _ in range(30))
    for i in range(400):
        w = [word() for _ in range(rnd.randint(30, 90))]
        toxic = i % 7 == 0
        for _ in range(3 if toxic else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(["grobble", "snark", "vileton"]))
        if i % 40 == 1:
            w += item.split()
        docs.append((i, " ".join(w) + ("\n" + boiler if i % 11 == 2 else ""), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(toxic)))
    docs += [(1000 + i, docs[5][1] + " " + word(), "en", "s", 0) for i in range(6)]
    docs += [(2000, None, "en", None, 0), (2001, "", None, "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return docs, boiler, item


def test_stages_take_effect(spark, tmp_path):
    docs, boiler, item = write(spark, str(tmp_path))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    table, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, str(tmp_path))
        seen[name] = table.collect()
        if name != "packing":
            assert table.columns == columns
    ids = {k: {r.doc_id for r in v} for k, v in seen.items()}
    toxic = {d for d, t, *_ in docs if t and {"grobble", "snark", "vileton"} & set(t.split())}
    assert ids["toxicity"] == {d for d, *_ in docs} - toxic
    assert ids["line_dedup"] == ids["toxicity"]
    held = [r.doc_id for r in seen["line_dedup"] if boiler in (r.text or "")]
    assert held == [max(r.doc_id for r in seen["toxicity"] if boiler in (r.text or ""))]
    assert ids["near_dedup"] == ids["line_dedup"] - {1000 + i for i in range(6)}
    assert ids["decontaminate"] == {r.doc_id for r in seen["near_dedup"] if " ".join(split(r"\S+", item)) not in (r.text or "")} >= {2000, 2001}
    assert ids["packing"] == ids["decontaminate"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == ids["packing"]


def test_registry():
    import __spark_entry__ as entry
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(oracle_sql()) <= set(names)
    assert set(names) | {"pipeline"} <= set(entry.queries()) and entry.queries()["pipeline"] is corpus_pipeline.run


def test_no_documents(spark, tmp_path):
    write(spark, str(tmp_path))
    none = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
        assert none.collect() == []


def test_clashing_columns_repeated_rows_null_ids_and_a_long_text(spark, tmp_path):
    docs, _, _ = write(spark, str(tmp_path))
    extra = docs + [docs[3], docs[3], (None, "a row without an id", None, None, None), (None, None, None, None, None),
                    (3000, "very long " * 150_000 + "\n" + "end", "en", "s", 0)]
    df = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["_row", "_doc_id", "_hash", "row_id", "root", "hits", "words", "stretches", "print", "class_id", "kept"]
    df = df.selectExpr("*", *[f"'{n}' as {n}" for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
    rows = df.collect()
    assert all(r[n] == n for r in rows for n in names)
    ids = [r.doc_id for r in rows]
    assert ids.count(docs[3][0]) == 1 and ids.count(None) == 2 and 3000 in ids
    packed = corpus_pipeline.packing(spark, df, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(ids)
