"""Long posting lists are dealt to cells, and no cell or stand-in loses a match."""

import random

import numpy as np
import pyarrow as pa
import pytest

from raillark.llm import line_dedup


@pytest.mark.parametrize("block", [24, 100])
def test_lists_in_blocks(spark, block, monkeypatch):
    longest = spark.sparkContext.accumulator(0)  # counts the rows of all lists over two blocks
    plain = line_dedup._dealt

    def dealt(*args):
        out = plain(*args)
        held = out.groupBy(line_dedup._token("key").alias("t")).count().agg({"count": "max"}).collect()[0][0]
        longest.add(int(held > 3 * block))  # blocks are dealt by hash, so a little more than two
        return out

    monkeypatch.setattr(line_dedup, "_dealt", dealt)
    rng = random.Random(9)
    # lines of common words only: every list is long
    rows = [(d, " ".join(rng.sample([f"w{k}" for k in range(14)], rng.randint(7, 11)))) for d in range(400)]
    seen, want = [], set()
    for d, text in rows:
        s = set(text.split())
        if any(100 * len(s & t) >= 80 * len(s | t) for t in seen):
            want.add(d)
        seen.append(s)
    gone, _ = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string"), block=block)
    assert {r.doc_id for r in gone.collect()} == want
    assert longest.value == 0


def test_many_candidates_in_one_list():
    """A line with more candidates than it keeps says so; all of them come when it is looked up again."""
    n = 200
    cols = {"key": np.full(n, (5 << line_dedup._SIZE) | 10), "doc_id": np.arange(n)[::-1].copy(), "line_no": np.zeros(n, np.int64), "sketch": np.zeros(n, np.int64), "sketch2": np.zeros(n, np.int64), "mark": np.zeros(n, np.int64)}
    cols["mark"][0] |= 1 << line_dedup._FLAG  # the row of doc_id 199
    found = lambda flagged: [r for out in line_dedup._merge(80, flagged)(iter([pa.RecordBatch.from_pydict(cols)])) for r in out.to_pylist()]
    few = found(False)
    for d in (1, 3, 150):
        own = [r for r in few if r["doc_id"] == d]
        assert sorted(r["first_doc"] for r in own) == list(range(min(d, line_dedup.KEEP)))
        assert all(r["more"] for r in own) or d <= line_dedup.KEEP
    assert sorted((r["doc_id"], r["first_doc"]) for r in found(True)) == [(199, d) for d in range(199)]


@pytest.mark.parametrize("at_once", [1, 7, 1000])
def test_lists_over_batches(monkeypatch, at_once):
    """Lists that run over batches are compared whole."""
    monkeypatch.setattr(line_dedup, "AT_ONCE", at_once)
    rng = np.random.default_rng(2)
    token = np.sort(rng.integers(-4, 4, 60))
    cols = {"key": (token << line_dedup._SIZE) | 10, "doc_id": rng.permutation(60), "line_no": np.zeros(60, np.int64), "sketch": np.zeros(60, np.int64), "sketch2": np.zeros(60, np.int64), "mark": np.zeros(60, np.int64)}
    whole = pa.RecordBatch.from_pydict(cols)
    rows = {(r["doc_id"], r["first_doc"]) for out in line_dedup._merge(80, False)(whole.slice(k, 5) for k in range(0, 60, 5)) for r in out.to_pylist()}
    want = set()
    for t in np.unique(token):
        own = np.sort(cols["doc_id"][token == t])
        want |= {(b, a) for k, b in enumerate(own) for a in own[: min(k, line_dedup.KEEP)]}
    assert rows == want


def test_sketches_never_overstate_a_difference():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    sets = [pool[rng.random(400) < share] for share in rng.random(60)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    one, two = (x.view(np.uint64) for x in line_dedup.sketches(np.concatenate(sets), at))
    for a in range(60):
        gap = line_dedup.apart(np.full(60, one[a]), one) + line_dedup.apart(np.full(60, two[a]), two)
        for b in range(60):
            assert gap[b] <= len(np.setxor1d(sets[a], sets[b]))
            assert (gap[b] == 0) or a != b
