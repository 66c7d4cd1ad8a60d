"""A language's size, rank or slices decide nothing about its texts."""

import random

import pyarrow as pa
import pytest

from raillark.llm import quality_rules


def texts(lang, n, words, vocabulary=60):
    rng = random.Random(lang)
    pool = [f"{lang}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(vocabulary)]
    weight = [1 / (k + 1) for k in range(vocabulary)]
    return [(" ".join(rng.choices(pool, weight, k=words)), lang) for _ in range(n)]


def test_language_without_reference_has_no_verdict(spark):
    rows = [*texts("xa", 30, 400), *texts("rare", 2, 400), (texts("xa", 1, 400)[0][0], None), (texts("zz", 1, 400)[0][0], None)]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality_rules.judged(docs).collect()}
    assert all(got[k].word_distance is None and got[k].char_distance is None for k in (30, 31))
    assert got[32].word_distance < 0.3 < got[33].word_distance  # without a name, the nearest reference


def test_every_large_language_has_a_reference(spark):
    rows = [r for k in range(270) for r in texts(f"l{chr(97 + k % 26)}{chr(97 + k // 26)}", 6, 400)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert len(quality_rules.references(docs).languages) == 270


def test_all_words_are_counted():
    rare = "once " + "often " * 3000
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [rare]})
    got = [r for b in quality_rules._gather(iter([batch])) for r in b.to_pylist() if r["kind"] == "word"]
    assert sorted(r["amount"] for r in got) == [1.0, 3000.0]


def test_joined_references_give_the_same_verdicts(spark, edge_docs):
    """Where languages are too many for the driver their references are joined: the same rows."""
    rows = [r for k in range(70) for r in texts(f"l{chr(97 + k % 26)}{chr(97 + k // 26)}", 6, 400)]
    rows += [*texts("rare", 2, 400), (rows[0][0], None), (None, "laa"), ("", None), (rows[40][0], "laa")]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string").selectExpr("*", "1 as _reference", "2 as total")
    sent, joined = (quality_rules.known_references(docs, most) for most in (4096, 0))
    assert len(sent.named.languages) == 70 and len(sent.common.languages) == 64 and joined.named is None
    one, two = ({r.doc_id: tuple(r) for r in quality_rules.judged(docs, k).collect()} for k in (sent, joined))
    assert one.keys() == two.keys() and len(one) == len(rows)
    assert all(a[:8] == b[:8] and (a[8] or 0, a[9] or 0) == pytest.approx((b[8] or 0, b[9] or 0)) for a, b in ((one[k], two[k]) for k in one))
    kept = [sorted(r.doc_id for r in quality_rules.kept_rows(docs, k).collect()) for k in (sent, joined)]
    assert kept[0] == kept[1] == sorted(k for k, r in one.items() if r[7])
    assert quality_rules.kept_rows(docs, joined).columns == docs.columns
    assert quality_rules.kept_rows(edge_docs, quality_rules.known_references(edge_docs, 0)).columns == edge_docs.columns
    assert quality_rules.kept_rows(edge_docs.drop("lang"), None).count() > 0
