"""Compressed vector codes whose nearest entries are found by slices (operator 11).

A vector's components become integers, the vector is cut into ``PARTS`` equal parts,
and each part is replaced by the index of the nearest entry of its position's
codebook.

Nearest entries come from slices.  For each dimension the entries' coordinates are
sorted, and ``masks[r]`` has a bit for each of the first r of them.  The initial radius is
the median distance of an entry to its nearest fellow.  The range of a dimension is cut
out by two binary searches and is the difference of two prefix masks; the ranges of all
dimensions are ANDed, and only entries whose bit is left are compared.  A part whose best
entry lies beyond the radius is looked up once more, with that distance as the radius; one without
any candidate takes the distance of a neighbour in the widest dimension.  No entry
outside can be nearer, so the result is exact; ties go to the lower index.

Each round is one pass over the stored integers.  A task adds up its parts by entry, so
that what is shuffled are ``PARTS * entries`` rows a task, and the driver gets the
codebooks alone, whose size is fixed by the parameters.

Defined results: rows whose vector is null or holds a null or non-finite component,
or one of magnitude 2**40 or more, are dropped.  All vectors are measured against the
length of the one of the smallest vec_id; rows of another length stay, with null code and error, and take no
part in the codebooks.  Parts of a length that ``PARTS`` does not divide differ by one in
length, the longer ones first.  Rows that share a vec_id are rows of their own, ordered by their vectors; a
row without vec_id is coded but begins no entry.  With fewer rows than entries the codebooks are as much
smaller; empty tables give no rows.  An error that a long cannot hold is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raillark.llm.workspace import pick, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components from here on count as non-finite.
HUGE = float(1 << 40)
#: Components compared in one go.
AT_ONCE = 1 << 22


class Slices(NamedTuple):
    """Entries of one codebook by dimension: sorted coordinates, their entries, and the masks of all prefixes."""

    entries: np.ndarray  # (n, dims)
    sorted: np.ndarray  # (dims, n)
    order: np.ndarray  # (dims, n)
    masks: np.ndarray  # (dims, n + 1, words)
    widest: int
    radius: int


def sliced(entries: np.ndarray) -> Slices:
    n, dims = entries.shape
    order = np.argsort(entries, axis=0, kind="stable").T
    masks = np.zeros((dims, n + 1, -(-n // 64)), np.uint64)
    for r in range(n):
        masks[:, r + 1] = masks[:, r]
        masks[np.arange(dims), r + 1, order[:, r] // 64] |= np.uint64(1) << (order[:, r] % 64).astype(np.uint64)
    # half of the entries have no other within the radius
    apart = sorted(min(_squares(np.delete(entries, e, 0), entries[e]).tolist(), default=0) for e in range(n))
    radius = isqrt(apart[n // 2]) + 1
    span = [int(entries[:, k].max()) - int(entries[:, k].min()) for k in range(dims)]
    return Slices(entries, np.take_along_axis(entries.T, order, 1), order, masks, int(np.argmax(span)) if dims else 0, radius)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return (gap * gap).sum(1)


def _root(squared: np.ndarray) -> np.ndarray:
    """Whole numbers not below the roots."""
    return ((np.sqrt(squared.astype(np.float64)) * (1 + 1e-12)).astype(np.int64) + 1).astype(squared.dtype)


def candidates(x: np.ndarray, radius: np.ndarray, book: Slices) -> np.ndarray:
    """(rows, words): a bit for every entry within a row's radius in all dimensions."""
    left = np.full((len(x), book.masks.shape[2]), ~np.uint64(0))
    for k in range(x.shape[1]):
        lo = np.searchsorted(book.sorted[k], x[:, k] - radius, "left")
        hi = np.searchsorted(book.sorted[k], x[:, k] + radius, "right")
        left &= book.masks[k, hi] ^ book.masks[k, lo]
    return left


def _least(x: np.ndarray, left: np.ndarray, book: Slices) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of those whose bit is set, -1 for none, and its squared distance."""
    best = np.full(len(x), -1, np.int64)
    least = np.zeros(len(x), x.dtype)
    for e in range(len(book.entries)):
        rows = np.flatnonzero((left[:, e // 64] >> np.uint64(e % 64)) & np.uint64(1))
        found = _squares(x[rows], book.entries[e])
        nearer = (best[rows] < 0) | (found < least[rows])
        rows = rows[nearer]
        best[rows], least[rows] = e, found[nearer]
    return best, least


def nearest(x: np.ndarray, book: Slices) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each row; ties to the lower index."""
    if not x.shape[1]:
        return np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
    radius = np.full(len(x), book.radius).astype(x.dtype)
    best, least = _least(x, candidates(x, radius, book), book)
    wide = np.flatnonzero((best < 0) | (least > radius * radius))
    if len(wide):  # once more, within the distance of the best so far or of a neighbour
        own, none = x[wide], best[wide] < 0
        at = np.searchsorted(book.sorted[book.widest], own[none, book.widest])
        probe = book.order[book.widest][np.minimum(at, len(book.entries) - 1)]
        bound = least[wide]
        bound[none] = _squares(own[none], book.entries[probe])
        best[wide], least[wide] = _least(own, candidates(own, _root(bound), book), book)
    return best, least


def cuts(dims: int, parts: int) -> list[int]:
    """Bounds of the parts of a vector."""
    size, more = divmod(dims, parts)
    return [k * size + min(k, more) for k in range(parts + 1)]


Books = list[list[list[int]]]  # of each part: its entries


def _assigned(batch: pa.RecordBatch, column: int, books: Books, bounds: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, its rows, nearest entries, squared distances) of a batch, all vectors of which have one length."""
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, bounds[-1])
    most = max([int(np.abs(values).max(initial=0)), *(abs(c) for book in books for entry in book for c in entry)])
    kind = np.int64 if 4 * (most + 1) ** 2 * (bounds[-1] + 1) < 1 << 62 else object  # beyond it Python's integers take over
    for p, book in enumerate(books):
        own = sliced(np.array(book, kind).reshape(len(book), bounds[p + 1] - bounds[p]))
        x = values[:, bounds[p] : bounds[p + 1]].astype(kind)
        yield p, x, *nearest(x, own)


def _batches(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, AT_ONCE // max(1, dims))
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _sums(books: Books, bounds: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(part, entry, n, sums) over a task's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[[0] * (bounds[p + 1] - bounds[p]) for _ in book] for p, book in enumerate(books)]
        count = [[0] * len(book) for book in books]
        for batch in _batches(batches, bounds[-1]):
            for p, x, best, _ in _assigned(batch, 0, books, bounds):
                order = np.argsort(best, kind="stable")
                first = np.flatnonzero(np.r_[True, best[order][1:] != best[order][:-1]])
                sums = np.add.reduceat(x[order], first) if x.shape[1] else np.zeros((len(first), 0), x.dtype)
                for e, n, own in zip(best[order][first], np.diff(np.r_[first, len(best)]), sums.tolist(), strict=True):
                    count[p][e] += int(n)
                    total[p][e] = [a + b for a, b in zip(total[p][e], own, strict=True)]
        used = [(p, e) for p, book in enumerate(books) for e in range(len(book)) if count[p][e]]
        wide = pa.list_(pa.decimal128(38, 0))
        cols = [pa.array([u[0] for u in used], pa.int32()), pa.array([u[1] for u in used], pa.int32()), pa.array([count[p][e] for p, e in used], pa.int64())]
        yield pa.RecordBatch.from_arrays([*cols, pa.array([[Decimal(c) for c in total[p][e]] for p, e in used], wide)], ["part", "entry", "n", "sums"])

    return run


def _coded(books: Books, bounds: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row's label, code and error in place of its vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, bounds[-1]):
            codes = np.zeros((batch.num_rows, len(books)), np.int64)
            error: np.ndarray | int = 0
            for p, _, best, least in _assigned(batch, 2, books, bounds):
                codes[:, p], error = best, error + least
            text = ["".join(f"{e:02x}" for e in row) for row in codes.tolist()]
            errors = [e if e < 1 << 63 else None for e in error.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v: the kept rows with their integer vectors."""
    base = pick(vectors, vec_id="bigint", label="bigint", embedding="array<double>")
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < HUGE))
    return base.where(F.col("embedding").isNotNull() & sound).select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * scale)).alias("v"))


def fitted(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Books, list[int]]:
    """Codebooks of ``kept`` (vec_id, label, v) and the parts' bounds."""
    smallest = kept.where("vec_id is not null").orderBy("vec_id", "v").limit(1).collect()
    if not smallest:
        return [], []
    dims = len(smallest[0]["v"])
    bounds = cuts(dims, parts)
    same = kept.where(F.size("v") == dims)
    seeds = same.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).collect()
    books = [[list(s["v"][bounds[p] : bounds[p + 1]]) for s in seeds] for p in range(parts)]
    for _ in range(rounds):
        sums = same.select("v").mapInArrow(_sums(books, bounds), "part int, entry int, n long, sums array<decimal(38,0)>")
        longest = max(bounds[p + 1] - bounds[p] for p in range(parts))
        added = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.get("sums", F.lit(k))).cast("decimal(38,0)").alias(f"s{k}") for k in range(longest)))
        for row in added.collect():  # parts * entries rows at most
            p, e = row["part"], row["entry"]
            books[p][e] = [int(row[f"s{k}"]) // row["n"] for k in range(bounds[p + 1] - bounds[p])]
    return books, bounds


def digest(books: Books) -> str:
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


def coded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Books]:
    """(vec_id, label, code, error) of every kept row, and the codebooks.

    ``entries`` may be up to 256: a code has two hexadecimal digits a part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    kept = stored(integers(vectors, scale), "vectors")  # read once a round
    books, bounds = fitted(kept, parts, entries, rounds)
    if not books:
        return kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")), books
    same = F.size("v") == bounds[-1]
    out = kept.where(same).mapInArrow(_coded(books, bounds), "vec_id long, label long, code string, error long")
    other = kept.where(~same).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    return out.unionByName(other), books


def reconstructed(codes: DataFrame, books: Books, scale: int = SCALE) -> DataFrame:
    """``codes`` (with column ``code``) and the approximate vector, the named entries over ``scale``."""
    if not books:
        return codes.withColumn("approximate", F.lit(None).cast("array<double>"))
    table = F.array(*(F.array(*(F.array(*(F.lit(c / scale) for c in entry)) for entry in book)) for book in books))  # of a fixed size
    index = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("approximate", F.concat(*(F.get(F.get(table, F.lit(p)), index(p)) for p in range(len(books)))))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over the whole of ``embeddings``, errors added up by label."""
    out, books = coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    out = stored(out, "codes")
    by_label = out.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")).withColumnRenamed("label", "_label")
    # a hot label is split by skew handling, or its sums are broadcast where they measure small
    rows = out.join(by_label, out["label"].eqNullSafe(by_label["_label"]), "left")
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"), "label")


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in DuckDB SQL: every part against every entry of its codebook, round by round; vectors of one length."""
    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"dims AS (SELECT len(embedding) // {parts} AS width FROM kept ORDER BY vec_id LIMIT 1)",
        f"x AS MATERIALIZED (SELECT vec_id, (k - 1) // width AS p, (k - 1) % width AS d, CAST(floor({scale} * CAST(embedding[k] AS DOUBLE)) AS BIGINT) AS c FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS k FROM kept), dims)",
        f"b0 AS MATERIALIZED (SELECT p, e, d, c FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}) USING (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, arg_min(e, (s, e)) AS e, min(s) AS s FROM (SELECT vec_id, p, e, sum((x.c - b.c) * (x.c - b.c)) AS s FROM x JOIN b{r} b USING (p, d) GROUP BY vec_id, p, e) GROUP BY vec_id, p)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT p, e, d, sum(c) AS s, count(*) AS n FROM x JOIN a{r} USING (vec_id, p) GROUP BY p, e, d)")
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT p, e, d, CAST(CASE WHEN s IS NULL THEN c WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END AS BIGINT) AS c FROM b{r} LEFT JOIN m{r} USING (p, e, d))")
    steps.append(f"out AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(s) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)")
    steps.append(f"sha AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, d)) AS codebooks_sha256 FROM b{rounds})")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256, label FROM out JOIN kept USING (vec_id), sha"
