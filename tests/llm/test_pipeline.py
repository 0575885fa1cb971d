"""Registered queries and the pipeline."""

import random

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from profilegate.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_matches_sql(spark, name):
    con = compare.connect(FOLDER)
    (columns, rows), (sql_columns, sql_rows) = compare.both(spark, con, queries.QUERIES[name], queries.statements()[name], FOLDER)
    assert columns == sql_columns
    assert rows == sql_rows


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")} and "pipeline" in names


def documents():
    rnd = random.Random(1)
    words = [f"{a}{b}{c}" for a in "bdk" for b in "aeiou" for c in "lmnr"]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(rnd.choice(words) for _ in range(80)), "aa", f"s{i % 3}", 0, "x", 1))
    rows += [(100 + i, rows[i][1], "aa", "s0", 0, "x", 1) for i in range(5)]
    rows += [(200 + i, rows[i][1] + " tail", "aa", "s1", 0, "x", 1) for i in range(5)]
    rows += [(300, None, "aa", "s0", 0, None, 1), (301, "", None, None, 0, "x", 1), (302, "12 34", "aa", "s0", 0, "x", 1)]
    return [*rows, (None, "some words", None, None, None, None, None), rows[0]]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, gone_id int"


def test_stages_one_by_one(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != "best_fit_packing":
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        docs = out.persist()
        kept.append(docs.count())
        if name == "language_id":
            assert docs.filter("text IS NULL OR NOT text RLIKE '[a-z]'").count() == 0
        if name == "exact_dedup":
            assert docs.filter("doc_id BETWEEN 100 AND 199").count() == 0 and docs.filter("doc_id = 0").count() == 1
        if name == "minhash_dedup":
            assert {r["doc_id"] for r in docs.collect()} == {*range(60), None}
        if name == "source_mixing":
            assert docs.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert kept[0] == 72 and kept[1] == 66 and kept[2] == 61
    assert set(docs.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_language_stage_rejects_and_fills(spark):
    rnd = random.Random(2)
    say = {lang: lambda n, w=w: " ".join(rnd.choice(w) for _ in range(n)) for lang, w in (("aa", ["balo", "keni", "dumo"]), ("bb", ["tirsu", "vorga", "zeph"]))}
    rows = [(i, say[lang](40), lang, "s", 0, "x", i) for i, lang in enumerate(["aa", "bb"] * 30)]
    rows += [(100, say["bb"](30), None, None, None, None, None), (101, say["aa"](30) + " " + say["bb"](30), None, "s", 0, "x", 1)]
    rows += [(102, "漢字" * 40, None, "s", 0, "x", 1), (103, "balo keni " + "漢字" * 40, None, "s", 0, "x", 1), (104, "7 %", "bb", "s", 0, "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA.replace("size string", "FOUND string"))
    out = corpus_pipeline.language_id(spark, docs, FOLDER)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert set(got) == {*range(60), 100, 101}
    assert got[100]["lang"] == "bb" and got[101]["lang"] in ("aa", "bb") and all(tuple(got[i]) == rows[i] for i in range(60))
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, FOLDER).count() == 64


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
