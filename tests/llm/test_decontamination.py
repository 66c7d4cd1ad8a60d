"""Hits against plain Python on both ways, removal of spans and documents, edge rows."""

import random
import re
import time

import pytest

from raillark.llm import decontamination as dec

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, bench, size=10):
    """(doc_id, n_words, n_hit, items) of each row."""
    grams = {}
    for item, text in bench:
        w = WORD.findall(lower(text))
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w = WORD.findall(lower(text))
        hit, items = set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                if (own := grams.get(tuple(w[i : i + k]))) is not None:
                    hit |= set(range(i, i + k))
                    items |= {str(x) for x in own if x is not None}
        out.append((doc, len(w), len(hit), sorted(items)))
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma", "ñandú", "x1", "Ñ", "the", "of"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", ", ", "-"]) for _ in range(n))
    bench = [(k, text(rng.choice([0, 1, 3, 7, 9, 10, 11, 25]))) for k in range(12)] + [(3, text(12)), (None, text(14)), (5, None)]
    docs = [(k, text(rng.choice([0, 1, 5, 40])) + (bench[k % len(bench)][1] or "").upper().replace("Ñ", "ñ") + text(rng.choice([0, 3]))) for k in range(60)]
    return [*docs, docs[7], docs[7], (7, "another text of seven"), (None, docs[3][1]), (99, None), (98, "")], bench


@pytest.mark.parametrize("limit", [dec.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_hits_equal_plain_python(spark, seed, limit):
    docs, bench = made(seed)
    got = dec.judged(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as key", "2 as n_words"), spark.createDataFrame(bench, "item_id long, text string"), limit=limit)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()), key=repr) == plain(docs, bench)


@pytest.mark.parametrize("limit", [dec.BROADCAST_BYTES, 0])
def test_removal(spark, limit):
    passage = "One two three four five six seven eight nine ten eleven"
    docs = [(1, f"Before, {passage}! After it.", 5), (1, "Clean text here", 6), (2, passage, 7), (3, None, 8), (None, f"so {passage.upper()} it is", 9), (4, "zzz yyy ... tail", 9)]
    table = spark.createDataFrame(docs, "doc_id long, text string, n_chars long").selectExpr("*", "1 as _id", "2 as _KEY", "3 as _spans", "4 as spans")
    bench = spark.createDataFrame([(1, passage), (2, "ZZZ. yyy")], "item_id long, text string")
    out = dec.cleaned(table, bench, limit=limit)
    assert out.columns == table.columns
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=repr)
    assert got == sorted([(1, "Before, After it.", 17), (1, "Clean text here", 6), (2, "", 0), (3, None, 8), (None, "so it is", 8), (4, "tail", 4)], key=repr)
    left = dec.cleaned(table, bench, remove="documents", limit=limit)
    assert left.columns == table.columns and sorted((r.doc_id, r.text) for r in left.collect()) == [(1, "Clean text here"), (3, None)]
    with pytest.raises(ValueError, match="remove"):
        dec.cleaned(table, bench, remove="lines")


def test_long_text_is_cut_in_time(spark):
    text = " ".join(f"w{k}" for k in range(200_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(f"w{k + d}" for d in range(12))) for k in range(0, 200_000, 2000)], "item_id long, text string")
    began = time.time()
    left = dec.cleaned(docs, bench).collect()[0].text.split()
    assert len(left) == 200_000 - 1200 and time.time() - began < 60


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (2, ""), (3, None)], "item_id long, text string")
    rows = {r.doc_id: r for r in dec.judged(edge_docs, bench).collect()}
    assert len(rows) == 9 and rows[5].n_hit == 11 and rows[5].n_words == 30000 and rows[5]["items"] == ["1"]
    assert rows[3].n_words == 0 and rows[6].n_words == 0
    assert dec.judged(edge_docs, bench).count() == 10
    assert dec.judged(edge_docs, bench.where("false")).where("n_hit > 0").count() == 0
    assert dec.judged(no_docs, bench).count() == 0
    assert dec.cleaned(no_docs, bench).columns == no_docs.columns


def test_no_python_on_the_main_path(spark, edge_docs):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = dec.judged(edge_docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
