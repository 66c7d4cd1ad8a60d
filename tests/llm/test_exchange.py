"""Co-training: what one view is sure of reaches the other, over all documents."""

import random

import numpy as np
import pyarrow as pa
import pytest

from raillark.llm import co_training, scan


def batch(rows):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def test_metadata_never_reads_the_text():
    one = co_training.metadata(batch([(1, "a", "en", "s", 5), (2, "b", None, None, None)]))
    two = co_training.metadata(batch([(1, None, "en", "s", 5), (2, "zz " * 99, None, None, None)]))
    assert (one.col == two.col).all() and one.n == 2 and one.col.max() < co_training.META


def dense(x):
    out = np.zeros((x.n, x.width))
    np.add.at(out, (x.row, x.col), x.val)
    return out


def test_pull_of_confident_rows():
    rows = [(k, "good words" if k % 2 else "bad words", "en", "s1" if k < 5 else "s0", 9) for k in range(10)]
    part = next(scan.slices(batch(rows).column(1)))
    text, meta = co_training.content(part), co_training.metadata(batch(rows))
    teacher = np.zeros(co_training.META)
    teacher[meta.col.reshape(10, -1)[0, 1]], teacher[meta.col.reshape(10, -1)[9, 1]] = 9, -9  # sure of all rows
    w = np.random.default_rng(1).normal(size=text.width)
    got = co_training.pull_of(text, w, meta, teacher)
    x = dense(text)
    p = 1 / (1 + np.exp(-x @ w))
    assert got.count.tolist() == [5, 5]
    assert got.gradient[1] == pytest.approx(x[:5].T @ (p[:5] - 1)) and got.gradient[0] == pytest.approx(x[5:].T @ p[5:])
    unsure = co_training.pull_of(meta, np.zeros(meta.width), text, np.zeros(text.width))
    assert unsure.count.tolist() == [0, 0] and not unsure.gradient.any()
    # the bound holds: no direction has a larger second derivative
    for _ in range(20):
        v = np.random.default_rng().normal(size=text.width)
        assert v @ ((x[:5].T * (p[:5] * (1 - p[:5]))) @ x[:5]) @ v <= v @ (got.curvature[1] * v) + 1e-9


@pytest.mark.parametrize("parts", [1, 5])
def test_round_equals_plain_numpy(spark, parts):
    """A whole co-training over documents in Spark against one over dense arrays in numpy."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").select("doc_id", "text", "lang", "source", "n_chars")
    rows = batch([tuple(r) for r in docs.collect()])
    part = next(scan.slices(rows.column(1), 1 << 40))
    text, meta = co_training.content(part), co_training.metadata(rows)
    known = np.arange(0, text.n, 3)
    y = np.array([(k * 7919) % 5 < 2 for k in known]).astype(int)
    base = docs.repartition(parts)
    got = co_training.co_train(text.take(known), meta.take(known), y, lambda w, t: co_training.pulls(base, w, t), rounds=2, steps=1)

    views = [dense(text), dense(meta)]
    balance = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def adagrad(x, start, slope, bound):
        w, seen = start.copy(), np.full(x.shape[1], 1e-8)
        for _ in range(120):
            g = x[known].T @ ((sigmoid(x[known] @ w) - y) * balance) + slope + bound * (w - start) + 1e-4 * w
            seen += g * g
            w -= 0.5 * g / np.sqrt(seen)
        return w

    want = [adagrad(x, np.zeros(x.shape[1]), 0.0, 0.0) for x in views]
    taught = 0
    for _ in range(2):
        new = []
        for k, x in enumerate(views):
            sure = sigmoid(views[1 - k] @ want[1 - k])
            slope, bound = np.zeros(x.shape[1]), np.zeros(x.shape[1])
            for label, at in ((0, sure <= co_training.CONFIDENT * -1 + 1), (1, sure >= co_training.CONFIDENT)):
                if at.any():
                    taught += at.sum()
                    share = co_training.PSEUDO / 2 / at.sum()
                    slope += share * (x[at].T @ (sigmoid(x[at] @ want[k]) - label))
                    bound += share * (np.abs(x[at]).T @ (np.abs(x[at]).sum(1) / 4))
            new.append(adagrad(x, want[k], slope, bound))
        want = new
    assert taught > 20
    for a, b in zip(got, want, strict=True):
        assert np.abs(a - b).max() < 1e-6


@pytest.mark.parametrize("parts", [1, 7])
def test_unlabelled_rows_teach(spark, parts):
    """Words that no labelled row holds get a weight from rows whose source the metadata knows."""
    rng = random.Random(1)
    row = lambda k, words, good: (k, " ".join(rng.choices(words, k=40)), "en", f"s{int(good)}", 200)
    rows = [row(k, ["aa", "bb"] if k % 2 else ["cc", "dd"], k % 2) for k in range(200)]
    rows += [row(k, ["ee", "ff"] if k % 2 else ["gg", "hh"], k % 2) for k in range(200, 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int")
    got = {r.doc_id: r for r in co_training.scored(docs, co_training.fit(docs, labels)).collect()}
    new = [(got[k].text_score, k % 2) for k in range(200, 1000)]
    assert min(p for p, y in new if y) > max(p for p, y in new if not y)
