"""Toxicity by a convolutional text classifier in numpy (operator 2).

A word is the sum of two hashed embeddings, of the word and of its first bytes.
Filters over one, two and three words are max-pooled over the whole text and
feed a logistic unit.  Every labelled row outside part 2 is used.  Rows of parts 1 and 3 are dealt
to shards of some ``SHARD`` rows; in each of ``EPOCHS`` rounds every shard learns from all
its rows, starting from the common weights, and the shards' moves are averaged in Spark (a
word's over the shards that moved it).  Scores are calibrated on all rows of part 0, counted by
language, label and logit (to 1 / ``GRID``), and a threshold is chosen for each language there.
``fit`` can be told to draw a bounded sample instead; its rows are then weighted to the label
rate of all labelled rows.  Language, source and
doc_id never enter a score; the language only picks the threshold of ``flagged``.

Defined results: a null or empty text has no words and gets the score of pooled
zeros; a language's threshold is drawn to the common one, the more the fewer labelled
rows it has; without
any usable label every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raillark.llm import scan
from raillark.llm.labelled import labelled, part_of, sample, scores
from raillark.llm.workspace import pick, shuffles_dropped, stored

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
PREFIX_BYTES = 5
EPOCHS, BATCH, RATE = 8, 64, 0.05
#: Rows of a shard, about, and words of a mini-batch of long texts.
SHARD, BATCH_WORDS = 4096, 1 << 17
#: Shards of a task, about, where they are more than so many times the cores; else there is a task a core.
TASK_SHARDS = 16
#: Steps of a logit's unit that the calibration tells apart, and the largest logit it knows.
GRID, MOST = 256, 64
#: Rows of the embedding whose sums go to one task.
_CHUNK = 1 << 11
THRESHOLD = 0.3
#: A language's threshold counts as much as the common one at so many calibration rows of its rarer label.
PRIOR_ROWS = 25


class Model(NamedTuple):
    embed: np.ndarray  # (2 * BUCKETS, DIM)
    filters: list[np.ndarray]  # (width * DIM, FILTERS) each
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: float
    shift: float
    thresholds: dict[str, float]


def word_ids(part: scan.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(words, 2) embedding rows and each row's first word (rows + 1 entries)."""
    w, hasher, _ = scan.words(part, lower=True, sep=scan.PUNCT)
    head = hasher(w.start, np.minimum(w.end, w.start + PREFIX_BYTES))
    mask = np.uint64(BUCKETS - 1)
    ids = np.stack([(w.hash & mask), ((head >> np.uint64(20)) & mask) + np.uint64(BUCKETS)], 1).astype(np.int32)
    return ids, w.first


def pooled(x: np.ndarray, first: np.ndarray, filters: list[np.ndarray], bias: np.ndarray, where: bool = False):
    """Max-pooled, rectified filter outputs of each row; with ``where`` also their words."""
    rows = len(first) - 1
    out = np.zeros((rows, len(WIDTHS) * FILTERS), np.float32)
    at = np.full(out.shape, -1, np.int64)
    sizes = np.diff(first)
    for k, width in enumerate(WIDTHS):
        span = slice(k * FILTERS, (k + 1) * FILTERS)
        n = len(x) - width + 1
        full = np.flatnonzero(sizes >= width)
        if n <= 0 or not len(full):
            continue
        z = x[:n] @ filters[k][:DIM]
        for j in range(1, width):
            z += x[j : n + j] @ filters[k][j * DIM : (j + 1) * DIM]
        starts, ends = first[full], first[full + 1] - width + 1
        bounds = np.stack([starts, ends], 1).ravel()
        cut = bounds[:-1] if bounds[-1] >= n else bounds
        top = np.maximum.reduceat(z, cut, axis=0)[::2]
        out[full, span] = np.maximum(0, top + bias[span])
        if where:
            for r, lo, hi in zip(full, starts, ends, strict=True):
                at[r, span] = lo + z[lo:hi].argmax(0)
    return (out, at) if where else out


class State(NamedTuple):
    """Embedding, filters, bias, output and its bias; and what Adagrad has seen of each."""

    params: list[np.ndarray]
    seen: list[np.ndarray]

    def copy(self) -> State:
        return State([x.copy() for x in self.params], [x.copy() for x in self.seen])

    def small(self) -> np.ndarray:
        """All but the embedding as one vector."""
        return np.concatenate([x.ravel() for x in (*self.params[1:], *self.seen[1:])]).astype(float)

    def move_small(self, by: np.ndarray) -> None:
        at = 0
        for x in (*self.params[1:], *self.seen[1:]):
            x += by[at : at + x.size].reshape(x.shape).astype(x.dtype)
            at += x.size


def first_state(seed: int = 5) -> State:
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (2 * BUCKETS, DIM)).astype(np.float32)
    filters = [rng.normal(0, 1 / np.sqrt(w * DIM), (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    units = len(WIDTHS) * FILTERS
    params = [embed, *filters, np.zeros(units, np.float32), rng.normal(0, 0.3, units).astype(np.float32), np.zeros(1)]
    return State(params, [np.full_like(x, 1e-3) for x in params])


def mini_batches(sizes: np.ndarray, order: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of ``order`` of at most ``BATCH`` texts and, but for single texts, ``BATCH_WORDS`` words."""
    lo = words = 0
    for k, r in enumerate(order):
        if k > lo and (k - lo == BATCH or words + sizes[r] > BATCH_WORDS):
            yield order[lo:k]
            lo, words = k, 0
        words += sizes[r]
    if lo < len(order):
        yield order[lo:]


def learn(state: State, ids: list[np.ndarray], y: np.ndarray, balance: np.ndarray, rng: np.random.Generator) -> None:
    """One pass of Adagrad over mini-batches, in place; only the pooled words carry a gradient. A row of label y weighs ``balance[y]``."""
    (embed, *filters, bias, out, out_bias), seen = state

    def step(k: int, grad: np.ndarray) -> None:
        seen[k] += grad * grad
        state.params[k] -= RATE * grad / np.sqrt(seen[k])

    for rows in mini_batches(np.array([len(x) for x in ids], np.int64), rng.permutation(len(ids))):
        flat = np.concatenate([ids[r] for r in rows])
        if not len(flat):
            continue
        first = np.concatenate([[0], np.cumsum([len(ids[r]) for r in rows])])
        x = embed[flat[:, 0]] + embed[flat[:, 1]]
        hidden, at = pooled(x, first, filters, bias, where=True)
        kept = (rng.random(hidden.shape) > 0.2) / np.float32(0.8)
        logit = (hidden * kept) @ out + out_bias[0]
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) * balance[y[rows].astype(np.int64)] / len(rows)).astype(np.float32)
        inner = error[:, None] * out * kept * (hidden > 0)
        for k, width in enumerate(WIDTHS):
            r, f = np.nonzero(inner[:, k * FILTERS : (k + 1) * FILTERS])
            if not len(r):
                continue
            g = inner[r, k * FILTERS + f].astype(np.float32)
            pos = at[r, k * FILTERS + f]
            grad = np.zeros_like(filters[k])
            touched, moves = [], []
            for j in range(width):
                seenx = x[pos + j]
                part = np.zeros((FILTERS, DIM), np.float32)
                np.add.at(part, f, g[:, None] * seenx)
                grad[j * DIM : (j + 1) * DIM] = part.T
                move = g[:, None] * filters[k][j * DIM : (j + 1) * DIM].T[f]
                touched += [flat[pos + j, 0], flat[pos + j, 1]]
                moves += [move, move]
            which, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(which), DIM), np.float32)
            np.add.at(total, inverse, np.concatenate(moves))
            seen[0][which] += total * total
            embed[which] -= RATE * total / np.sqrt(seen[0][which])
            step(1 + k, grad)
        step(len(WIDTHS) + 1, inner.sum(0))
        step(len(WIDTHS) + 2, ((hidden * kept) * error[:, None]).sum(0) + 1e-4 * out)
        step(len(WIDTHS) + 3, np.array([float(error.sum())]))


class Moves:
    """Sums of the shards' moves: of each embedding row with the shards that moved it, of the rest by rows learnt from."""

    def __init__(self) -> None:
        self.rows = np.zeros((2 * BUCKETS, 2 * DIM + 1))
        self.small: np.ndarray | float = 0.0

    def add(self, start: State, own: State, learnt: int) -> None:
        which = np.flatnonzero((own.seen[0] != start.seen[0]).any(1))
        self.rows[which, :DIM] += own.params[0][which] - start.params[0][which]
        self.rows[which, DIM : 2 * DIM] += own.seen[0][which] - start.seen[0][which]
        self.rows[which, 2 * DIM] += 1
        self.small = self.small + np.append((own.small() - start.small()) * learnt, learnt)


_MOVES = "chunk int, place binary, amounts binary"


def _moves_of(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [pa.array([k for k, *_ in parts], pa.int32()), *(pa.array([x[c].tobytes() for x in parts], pa.binary()) for c in (1, 2))]
    return pa.RecordBatch.from_arrays(columns, ["chunk", "place", "amounts"])


def _moves_in(rows: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(chunk, places within it, amounts); chunk -1 is all but the embedding."""
    for chunk, place, amounts in zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True):
        if chunk < 0:
            yield chunk, np.frombuffer(place, np.int32), np.frombuffer(amounts, float)
        else:
            yield chunk, np.frombuffer(place, np.int32), np.frombuffer(amounts, np.float32).reshape(-1, 2 * DIM + 1)


def _add_moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, place, amounts in _moves_in(batch):
            if chunk < 0:
                total[chunk] = total.get(chunk, 0.0) + amounts
            else:
                total.setdefault(chunk, np.zeros((_CHUNK, 2 * DIM + 1)))[place] += amounts
    none = np.zeros(0, np.int32)
    parts = []
    for chunk, amounts in total.items():
        place = np.flatnonzero(amounts[:, -1]).astype(np.int32) if chunk >= 0 else none
        parts.append((chunk, place, amounts[place].astype(np.float32) if chunk >= 0 else amounts))
    yield _moves_of(parts)


def trained(rows: DataFrame, balance: np.ndarray, shards: int = 1, seed: int = 5, epochs: int = EPOCHS) -> State:
    """Weights learnt from all ``rows`` (shard, y, ids; rows of a shard together), those of label y weighing ``balance[y]``."""
    context = rows.sparkSession.sparkContext
    state = first_state(seed)
    # a task adds up its shards' moves before they are shuffled
    dealt = rows.select("shard", "y", "ids").coalesce(max(context.defaultParallelism, -(-shards // TASK_SHARDS)))
    for turn in range(epochs):
        sent = context.broadcast((state, turn))  # of fixed size

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            start, turn = sent.value
            total, own, at, learnt = Moves(), start, None, 0
            for batch in batches:
                shard, y = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.float32)
                ids = [np.frombuffer(x, np.int32).reshape(-1, 2) for x in batch.column(2).to_pylist()]
                cut = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
                for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                    if lo == hi:
                        continue
                    if shard[lo] != at:
                        if learnt:
                            total.add(start, own, learnt)
                        own, at, learnt = start.copy(), shard[lo], 0
                        rng = np.random.default_rng([seed, turn, int(at)])
                    learn(own, ids[lo:hi], y[lo:hi], balance, rng)
                    learnt += hi - lo
            if not learnt:
                return
            total.add(start, own, learnt)
            parts = [(-1, np.zeros(0, np.int32), total.small)]
            for chunk in range(2 * BUCKETS // _CHUNK):
                own_rows = total.rows[chunk * _CHUNK : (chunk + 1) * _CHUNK]
                place = np.flatnonzero(own_rows[:, -1]).astype(np.int32)
                if len(place):
                    parts.append((chunk, place, own_rows[place].astype(np.float32)))
            yield _moves_of(parts)

        with shuffles_dropped(rows.sparkSession):
            got = dealt.mapInArrow(run, _MOVES).repartition("chunk").mapInArrow(_add_moves, _MOVES).toArrow()  # of bounded size
        for chunk, place, amounts in _moves_in(got):
            if chunk < 0:
                state.move_small(amounts[:-1] / amounts[-1])
            else:
                which, mean = chunk * _CHUNK + place, amounts[:, :-1] / amounts[:, -1:]
                state.params[0][which] += mean[:, :DIM]
                state.seen[0][which] += mean[:, DIM:]
        sent.destroy()
    return state


def logits(model: Model, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    x = model.embed[ids[:, 0]] + model.embed[ids[:, 1]]
    return pooled(x, first, model.filters, model.bias) @ model.out + model.out_bias


def newton(x: np.ndarray, goal: np.ndarray, weight: np.ndarray, start: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of a logistic fit held near ``start``; a step is halved until the loss falls, so it always converges."""

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((weight * (np.logaddexp(0, z) - goal * z)).sum() + ridge / 2 * ((v - start) ** 2).sum())

    v, best = start.astype(float), loss(start)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        g = x.T @ (weight * (p - goal)) + ridge * (v - start)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(v))
        step = np.linalg.solve(h, g)
        size = 1.0
        while size > 1e-6 and loss(v - size * step) > best - 1e-4 * size * float(g @ step):
            size /= 2
        if size <= 1e-6:
            break
        v = v - size * step
        now = loss(v)
        if best - now < 1e-10 * (1 + abs(best)):
            break
        best = now
    return v


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray, rows: np.ndarray | None = None) -> tuple[float, float]:
    """Scale and shift of a logistic calibration of weighted rows; an entry stands for as many as ``rows`` says."""
    rows = np.ones(len(z)) if rows is None else rows
    hits, total = (rows * y).sum(), rows.sum()
    weight = weight * rows
    weight = weight * (total / weight.sum())
    goal = np.where(y == 1, (hits + 1) / (hits + 2), 1 / (total - hits + 2))
    middle = float((rows * z).sum() / total)
    spread = max(float(np.sqrt((rows * (z - middle) ** 2).sum() / total)), 1e-6)  # in units of the scores' own spread, so that the ridge suits any scale
    a, b = newton(np.stack([(z - middle) / spread, np.ones(len(z))], 1), goal, weight, np.array([1.0, 0.0]), 1e-2)
    return float(a / spread), float(b - a * middle / spread)


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The threshold of the best F1 of weighted rows, in the middle of the gap below it; equal scores stay together."""
    order = np.argsort(-p)
    hits = np.cumsum((weight * y)[order])
    f1 = 2 * hits / (np.cumsum(weight[order]) + (weight * y).sum())
    f1[:-1][p[order][1:] == p[order][:-1]] = -1
    k = int(f1.argmax())
    below = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + below) / 2)


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in scan.slices(batch.column(1)):
            ids, first = word_ids(part)
            rows = [ids[first[k] : first[k + 1]].tobytes() for k in range(part.hi - part.lo)]
            own = batch.slice(part.lo, part.hi - part.lo)
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(2), own.column(3), own.column(4), pa.array(rows, pa.binary())], ["doc_id", "lang", "part", "y", "ids"])


def calibration_counts(rows: DataFrame, model: Model) -> tuple[np.ndarray, ...]:
    """lang, y, z and the number of ``rows`` of each; logits are told apart to 1 / ``GRID``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(x, np.int32).reshape(-1, 2) for x in batch.column(2).to_pylist()]
            z = np.empty(len(texts))
            for part in mini_batches(np.array([len(x) for x in texts], np.int64), np.arange(len(texts))):
                z[part] = logits(sent.value, np.concatenate([texts[k] for k in part]), np.concatenate([[0], np.cumsum([len(texts[k]) for k in part])]))
            step = np.round(np.clip(z, -MOST, MOST) * GRID).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(step)], ["lang", "y", "step"])

    # no more rows a language than steps, whatever the size of the table
    got = rows.select("lang", "y", "ids").mapInArrow(run, "lang string, y int, step int").groupBy("lang", "y", "step").count().toArrow()
    got = got.sort_by([("lang", "ascending"), ("y", "ascending"), ("step", "ascending")])
    lang = np.array([x or "" for x in got["lang"].to_pylist()], object)
    return lang, got["y"].to_numpy(), got["step"].to_numpy() / GRID, got["count"].to_numpy().astype(float)


def fit(docs: DataFrame, labels: DataFrame, per_class: int | None = None, max_chars: int | None = None) -> Model | None:
    """A calibrated model of all labelled rows: part 0 calibrates, parts 1 and 3 train.

    With ``per_class`` a sample of so many rows of each label, of texts of at most ``max_chars``, is used instead.
    """
    base = pick(docs, doc_id="bigint", text="string", lang="string")
    if per_class is None:
        known, weight = labelled(base, labels, "toxic"), np.ones(2)
        n = known.where("part <> 0").count()
        rows = base.join(known, "doc_id")
    else:
        rows, weight = sample(base, labels, "toxic", per_class, max_chars if max_chars is not None else 1 << 31)
        n = 2 * per_class
    shards = max(1, round(n / SHARD))
    rows = rows.select("doc_id", "text", "lang", "part", "y").mapInArrow(_sample_batches, "doc_id long, lang string, part int, y int, ids binary")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    rows = stored(rows.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "ids"), "labelled")
    have = {(r["tune"], r["y"]): r["count"] for r in rows.groupBy((F.col("part") == 0).alias("tune"), "y").count().collect()}
    if not {(False, 0), (False, 1)} <= have.keys():
        return None
    fits = rows.where("part <> 0")
    # both labels weigh the same in training; the calibration undoes it
    each = np.array([have[False, 0], have[False, 1]], float)
    embed, *filters, bias, out, out_bias = trained(fits, each.sum() / 2 / each, shards).params
    model = Model(embed, filters, bias, out, float(out_bias[0]), 1.0, 0.0, {})
    lang, y, z, count = calibration_counts(rows.where("part = 0") if {(True, 0), (True, 1)} <= have.keys() else fits, model)
    # a sample holds more of the rare label than the labelled rows do; weights undo that
    own_weight = weight[y]
    scale, shift = platt(z, y, own_weight, count)
    p = 1 / (1 + np.exp(-np.clip(scale * z + shift, -30, 30)))
    thresholds = {}
    for name in sorted(set(lang)):
        own = lang == name
        known = min((count * y)[own].sum(), (count * (1 - y))[own].sum())  # rows of the rarer label
        if known:
            best = best_threshold(p[own], y[own], (own_weight * count)[own])
            thresholds[name] = float((known * best + PRIOR_ROWS * THRESHOLD) / (known + PRIOR_ROWS))
    return model._replace(scale=scale, shift=shift, thresholds=thresholds)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, flagged of every row: ``flagged`` by the language's threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def score(part: scan.Slice, rows: pa.RecordBatch) -> dict[str, np.ndarray]:
        own = sent.value
        n = part.hi - part.lo
        if own is None:
            return {"score": np.zeros(n), "flagged": np.zeros(n, bool)}
        ids, first = word_ids(part)
        p = 1 / (1 + np.exp(-np.clip(own.scale * logits(own, ids, first).astype(float) + own.shift, -30, 30)))
        limit = np.array([own.thresholds.get(x or "", THRESHOLD) for x in rows.column(2).to_pylist()])
        return {"score": p, "flagged": p >= limit}

    return scores(docs, {"lang": "string"}, "score double, flagged boolean", score)


def clean_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the language's threshold does not flag."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            if own is None:
                yield batch
                continue
            keep = np.zeros(batch.num_rows, bool)
            langs = batch.column(names.index("lang")).to_pylist() if "lang" in names else [None] * batch.num_rows
            for part in scan.slices(batch.column(names.index("text")), 1 << 19):
                ids, first = word_ids(part)
                p = 1 / (1 + np.exp(-np.clip(own.scale * logits(own, ids, first).astype(float) + own.shift, -30, 30)))
                keep[part.lo : part.hi] = p < np.array([own.thresholds.get(x or "", THRESHOLD) for x in langs[part.lo : part.hi]])
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def op2_conv_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trains on ``labels`` and scores the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = scored(docs, model)
    return out.select("doc_id", (part_of(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "flagged")
