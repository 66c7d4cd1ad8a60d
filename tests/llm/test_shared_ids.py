"""Labels without documents, rows that share a doc_id, and texts of very many lines."""

import time
import zlib

from pyspark.sql import functions as F

from raillark.llm import labelled, line_dedup, toxicity


def test_sample_is_full_among_labels_without_documents(spark):
    docs = spark.createDataFrame([(d, f"text {d}", "en") for d in range(0, 1000)], "doc_id long, text string, lang string")
    labels = spark.range(0, 100_000).selectExpr("id as doc_id", "cast(id % 10 = 0 as int) as toxic")
    rows, weight = labelled.sample(docs, labels, "toxic", 60, 100)
    assert {r.y: r["count"] for r in rows.groupBy("y").count().collect()} == {0: 60, 1: 60}
    there = [d for d in range(1000) if zlib.crc32(str(d).encode()) % 4 != 2]
    assert weight.tolist() == [sum(d % 10 != 0 for d in there) / 60, max(1, sum(d % 10 == 0 for d in there) / 60)]


def test_long_texts_leave_their_place(spark):
    docs = spark.createDataFrame([(d, "x" * (500 if d % 2 else 5), "en") for d in range(400)], "doc_id long, text string, lang string")
    labels = spark.range(0, 400).selectExpr("id as doc_id", "cast(id % 4 < 2 as int) as toxic")
    rows, weight = labelled.sample(docs, labels, "toxic", 40, 100)
    assert {r.y: r["count"] for r in rows.groupBy("y").count().collect()} == {0: 40, 1: 40} and weight.min() > 1.5


def test_toxic_stage_without_language(spark, edge_docs, labels):
    docs = edge_docs.drop("lang")
    assert toxicity.clean_rows(docs, labels).columns == docs.columns


def test_rows_that_share_a_doc_id_lose_only_what_matched(spark):
    copy = "one two three four five"
    rows = [(1, copy), (5, copy), (5, "quite other words stand here now"), (5, f"{copy}\nquite other words stand here now\nthe last line is its own"), (6, "the last line is its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _id", "2 as _gone")
    got = sorted((r.doc_id, r.text) for r in line_dedup.cleaned(docs).collect())
    assert sum(t.count(copy) for _, t in got) == 1 and sum(t.count("quite other") for _, t in got) == 1 and sum(t.count("last line") for _, t in got) == 1
    assert (1, copy) in got and not any(d == 6 for d, _ in got)


def test_many_lines(spark):
    lines = [f"line {k} has its own number {k}" if k % 2 else "the same words once more" for k in range(200_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    began = time.time()
    even = F.sequence(F.lit(0), F.lit(199_999), F.lit(2))
    got = docs.select(line_dedup.without(docs.text, even).alias("t")).collect()[0].t
    assert got == "\n".join(lines[1::2]) and time.time() - began < 20

