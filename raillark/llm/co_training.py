"""Quality scores by co-training two views (operator 4).

One view is the text's content (hashed words and character classes), the other
the page's metadata (language, source, both, and the recorded length); the second never
reads the text.  Each view's logistic classifier starts from the labelled rows.  In
each round both score every document in Spark; the documents that one view is
confident of (``CONFIDENT``) become, with its label, training rows of the *other*
view.  Since all documents take part, these rows are not gathered: for each
pseudo-label the sums of their features are aggregated, and their mean joins the other
view's training rows with a fixed share of the weight.  The two are calibrated on
labelled rows that neither has seen, and their calibrated log-odds are combined to
score every document.

Only the labelled rows are a bounded, documented sample: ``PER_CLASS`` of each label,
texts of at most ``MAX_CHARS``.

Defined results: a null or empty text has an empty content view and is scored
from the rest; null source, language or length is a value of its own; without both
labels every score is 0.5; of labels of one doc_id the greatest counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raillark.llm import scan
from raillark.llm.labelled import part_of, sample, scores
from raillark.llm.quality_rules import CLASSES, class_counts
from raillark.llm.toxicity import newton, platt
from raillark.llm.workspace import pick

BUCKETS = 1 << 13
#: Hashed values of each kind of metadata; lengths have 32 bins.
KIND = 1 << 9
META = 3 * KIND + 32 + 1
PER_CLASS, MAX_CHARS = 3000, 20_000
ROUNDS, STEPS = 3, 2
CONFIDENT = 0.9
#: Weight of all pseudo-labelled rows beside the labelled ones'.
PSEUDO = 0.5
#: Numbers of a partial sum that go to one task.
_CHUNK = 1 << 11
THRESHOLD = 0.5


class Sparse(NamedTuple):
    """Rows as (row, column, value) triples."""

    row: np.ndarray
    col: np.ndarray
    val: np.ndarray
    n: int
    width: int

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * g[self.row], minlength=self.width)

    def take(self, rows: np.ndarray) -> Sparse:
        new = np.full(self.n, -1)
        new[rows] = np.arange(len(rows))
        keep = new[self.row] >= 0
        return Sparse(new[self.row[keep]], self.col[keep], self.val[keep], len(rows), self.width)


def content(part: scan.Slice) -> Sparse:
    """Square roots of the shares of hashed words and of character classes, and a bias."""
    rows = part.hi - part.lo
    w, _, _ = scan.words(part, lower=False, sep=scan.SPACE)
    col = (w.hash & np.uint64(BUCKETS - 1)).astype(np.int64)
    key, n = np.unique(w.doc * BUCKETS + col, return_counts=True)
    size = np.maximum(1, np.diff(w.first))
    row = key // BUCKETS
    classes = class_counts(part).astype(float)
    share = classes / np.maximum(1, classes.sum(1))[:, None]
    r = np.arange(rows)
    k = share.shape[1]
    return Sparse(
        np.concatenate([row, np.repeat(r, k), r]),
        np.concatenate([key % BUCKETS, BUCKETS + np.tile(np.arange(k), rows), np.full(rows, BUCKETS + k)]),
        np.concatenate([np.sqrt(n / size[row]), 2 * np.sqrt(share).ravel(), np.ones(rows)]),
        rows,
        BUCKETS + k + 1,
    )


def metadata(rows: pa.RecordBatch) -> Sparse:
    """Hashed language, source and both, and the binned length, from the columns after the text."""
    n = rows.num_rows

    def hashed(column: pa.Array) -> np.ndarray:
        """A number below ``KIND`` of each value, worked out once for each distinct one."""
        values = pc.dictionary_encode(pc.fill_null(column, "\0"))
        of = np.array([zlib.crc32(v.encode()) % KIND for v in values.dictionary.to_pylist()], np.int64)
        return of[values.indices.to_numpy(zero_copy_only=False)] if n else np.zeros(0, np.int64)

    lang, source = pc.fill_null(rows.column(2), "\0"), pc.fill_null(rows.column(3), "\0")
    size = rows.column(4)
    known = size.is_valid().to_numpy(zero_copy_only=False)
    length = np.where(known, 1 + np.minimum(30, np.log2(1 + np.maximum(0, pc.fill_null(size, 0).to_numpy(zero_copy_only=False)))).astype(np.int64), 0)
    both = pc.binary_join_element_wise(lang, source, "\1")
    col = np.stack([hashed(lang), KIND + hashed(source), 2 * KIND + hashed(both), 3 * KIND + length, np.full(n, META - 1)], 1)
    return Sparse(np.repeat(np.arange(n), col.shape[1]), col.ravel(), np.ones(col.size), n, META)


def logistic(x: Sparse, y: np.ndarray, weight: np.ndarray, steps: int = 120, rate: float = 0.5, decay: float = 1e-4, start: np.ndarray | None = None, pull: Pull | None = None) -> np.ndarray:
    """Adagrad on the whole sample.

    With ``pull``, the loss of the rows behind it joins: each label has ``PSEUDO / 2`` of
    the weight, and around ``start`` the loss is held by its gradient and a bound of its curvature,
    below which it never lies, so each solution lowers the loss of all rows.
    """
    w, seen = np.zeros(x.width) if start is None else start.copy(), np.full(x.width, 1e-8)
    weight = weight / weight.sum()
    slope = bound = np.zeros(x.width)
    if pull is not None:
        each = np.where(pull.count > 0, PSEUDO / 2 / np.maximum(1, pull.count), 0)
        slope, bound = each @ pull.gradient, each @ pull.curvature
    first = w.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w), -30, 30)))
        g = x.back((p - y) * weight) + slope + bound * (w - first) + decay * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


class Model(NamedTuple):
    text: np.ndarray
    meta: np.ndarray
    text_fit: tuple[float, float]
    meta_fit: tuple[float, float]
    mixture: np.ndarray  # weights of the two calibrated log-odds, and a bias


def combined(model: Model, text: Sparse, meta: Sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a = np.clip(model.text_fit[0] * text.dot(model.text) + model.text_fit[1], -12, 12)
    b = np.clip(model.meta_fit[0] * meta.dot(model.meta) + model.meta_fit[1], -12, 12)
    z = model.mixture[0] * a + model.mixture[1] * b + model.mixture[2]
    one = lambda v: 1 / (1 + np.exp(-v))
    return one(z), one(a), one(b)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Pull(NamedTuple):
    """What pseudo-labelled rows say to a view's weights: sums over labels 0 and 1, and the rows' numbers."""

    gradient: np.ndarray  # (2, width): x * (p - y)
    curvature: np.ndarray  # (2, width): |x| * sum(|x|) / 4, which bounds the second derivatives
    count: np.ndarray  # (2,)


def pull_of(view: Sparse, weights: np.ndarray, other: Sparse, teacher: np.ndarray) -> Pull:
    """Of the rows of ``other`` that ``teacher`` is sure of, with its label, the pull on ``view``'s ``weights``."""
    judged, own = _sigmoid(other.dot(teacher)), _sigmoid(view.dot(weights))
    reach = np.bincount(view.row, np.abs(view.val), minlength=view.n) / 4
    size = view._replace(val=np.abs(view.val))
    sure = [(judged <= 1 - CONFIDENT).astype(float), (judged >= CONFIDENT).astype(float)]
    return Pull(np.stack([view.back((own - y) * k) for y, k in enumerate(sure)]), np.stack([size.back(reach * k) for k in sure]), np.array([k.sum() for k in sure]))


Weights = tuple[np.ndarray, np.ndarray]  # of the text and of the metadata


def pulls(docs: DataFrame, weights: Weights, teachers: Weights) -> tuple[Pull, Pull]:
    """The pull on the text's weights of what the metadata is sure of, and the other way round, over all documents."""
    sent = docs.sparkSession.sparkContext.broadcast((weights, teachers))  # of fixed size
    width = (BUCKETS + len(CLASSES) + 1, META)
    size = sum(4 * w + 2 for w in width)
    schema = "chunk int, amounts binary"

    def rows_of(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["chunk", "amounts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        (own_text, own_meta), (by_text, by_meta) = sent.value
        for batch in batches:
            for part in scan.slices(batch.column(1)):
                text, meta = content(part), metadata(batch.slice(part.lo, part.hi - part.lo))
                both = pull_of(text, own_text, meta, by_meta), pull_of(meta, own_meta, text, by_text)
                total += np.concatenate([x.ravel() for pull in both for x in pull])
        yield rows_of({k: total[lo : lo + _CHUNK] for k, lo in enumerate(range(0, size, _CHUNK))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[chunk] = total.get(chunk, 0) + np.frombuffer(raw, float)
        yield rows_of(total)

    got = docs.mapInArrow(run, schema).repartition("chunk").mapInArrow(add, schema).toArrow()  # a fixed number of numbers
    parts = dict(zip(got["chunk"].to_pylist(), got["amounts"].to_pylist(), strict=True))
    flat = np.concatenate([np.frombuffer(parts[k], float) for k in sorted(parts)]) if parts else np.zeros(size)
    out, at = [], 0
    for w in width:
        gradient, curvature, count = np.split(flat[at : at + 4 * w + 2], [2 * w, 4 * w])
        at += 4 * w + 2
        out.append(Pull(gradient.reshape(2, w), curvature.reshape(2, w), count))
    return out[0], out[1]


def co_train(text: Sparse, meta: Sparse, y: np.ndarray, exchange: Callable[[Weights, Weights], tuple[Pull, Pull]], rounds: int = ROUNDS, steps: int = STEPS) -> Weights:
    """Weights of both views from labelled rows and, step by step, what ``exchange`` tells of the pseudo-labelled ones."""
    own = y.astype(float)
    balance = np.where(own == 1, 0.5 / max(1, own.sum()), 0.5 / max(1, (1 - own).sum()))
    weights = (logistic(text, own, balance), logistic(meta, own, balance))
    for _ in range(rounds):
        teachers = weights
        for _ in range(steps):
            pair = exchange(weights, teachers)
            weights = tuple(logistic(view, own, balance, start=w, pull=p) for view, w, p in zip((text, meta), weights, pair, strict=True))
    return weights


COLUMNS = {"lang": "string", "source": "string", "n_chars": "bigint"}


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in scan.slices(batch.column(1)):
            own = batch.slice(part.lo, part.hi - part.lo)
            text, meta = content(part), metadata(own)
            order = np.argsort(text.row, kind="stable")
            cut = np.searchsorted(text.row[order], np.arange(text.n + 1))
            cols, vals = text.col[order].astype(np.int32), text.val[order].astype(np.float32)
            rows = range(text.n)
            m = meta.col.astype(np.int32).reshape(text.n, -1)
            binary = lambda parts: pa.array([x.tobytes() for x in parts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(5), own.column(6), binary(cols[cut[k] : cut[k + 1]] for k in rows), binary(vals[cut[k] : cut[k + 1]] for k in rows), binary(m[k] for k in rows)],
                ["doc_id", "part", "y", "cols", "vals", "meta"],
            )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model | None:
    base = pick(docs, doc_id="bigint", text="string", **COLUMNS)
    known, weight = sample(base, labels, "quality", per_class, max_chars)
    got = known.select("doc_id", "text", *COLUMNS, "part", "y").mapInArrow(_views, "doc_id long, part int, y int, cols binary, vals binary, meta binary").toArrow().sort_by([("doc_id", "ascending"), ("cols", "ascending"), ("vals", "ascending"), ("meta", "ascending")])
    y, part = got["y"].to_numpy(), got["part"].to_numpy()
    if not (y == 1).any() or not (y == 0).any():
        return None
    cols = [np.frombuffer(x, np.int32) for x in got["cols"].to_pylist()]
    vals = [np.frombuffer(x, np.float32) for x in got["vals"].to_pylist()]
    row = np.repeat(np.arange(len(y)), [len(c) for c in cols])
    text = Sparse(row, np.concatenate(cols).astype(np.int64), np.concatenate(vals).astype(float), len(y), BUCKETS + len(CLASSES) + 1)
    m = np.stack([np.frombuffer(x, np.int32) for x in got["meta"].to_pylist()])
    meta = Sparse(np.repeat(np.arange(len(y)), m.shape[1]), m.ravel().astype(np.int64), np.ones(m.size), len(y), META)
    tune, learn = np.flatnonzero(part == 0), np.flatnonzero(part != 0)
    if len(set(y[tune].tolist())) < 2:
        tune = np.arange(len(y))
    if len(set(y[learn].tolist())) < 2:
        learn = np.arange(len(y))
    a, b = co_train(text.take(learn), meta.take(learn), y[learn], lambda weights, teachers: pulls(base, weights, teachers))
    goal = y[tune].astype(float)
    za, zb = text.take(tune).dot(a), meta.take(tune).dot(b)
    # rows count as the labelled rows they stand for, so log-odds mean the same at every size
    stand = weight[y[tune]] * (len(tune) / weight[y[tune]].sum())
    fa, fb = platt(za, goal, stand), platt(zb, goal, stand)
    both = np.stack([np.clip(fa[0] * za + fa[1], -12, 12), np.clip(fb[0] * zb + fb[1], -12, 12), np.ones(len(tune))], 1)
    mixture = newton(both, goal, stand, np.array([0.5, 0.5, 0.0]), 1.0)  # equal weights where the rows say little
    return Model(a, b, fa, fb, mixture)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def score(part: scan.Slice, rows: pa.RecordBatch) -> dict[str, np.ndarray]:
        own = sent.value
        if own is None:
            half = np.full(part.hi - part.lo, 0.5)
            return {"score": half, "text_score": half, "meta_score": half}
        both, text, meta = combined(own, content(part), metadata(rows))
        return {"score": both, "text_score": text, "meta_score": meta}

    return scores(docs, COLUMNS, "score double, text_score double, meta_score double", score, 1 << 21)


def op4_co_training_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trains on ``labels`` and scores the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", (part_of(F.col("doc_id")) == 2).alias("held_out"), "score", "text_score", "meta_score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
