"""Slices against plain comparison, codebooks against plain Python, and edge rows."""

import hashlib
import math

import numpy as np
import pytest

from raillark.llm import vector_codes


@pytest.mark.parametrize("n, dims, spread, kind", [(1, 3, 5, np.int64), (16, 8, 3, np.int64), (16, 8, 4000, np.int64), (200, 4, 50, np.int64), (16, 2, 1 << 50, object)])
def test_nearest_is_exact(n, dims, spread, kind):
    rng = np.random.default_rng(n + dims)
    entries, x = (rng.integers(-spread, spread + 1, (k, dims)).astype(kind) for k in (n, 500))
    x[:50] = entries[rng.integers(0, n, 50)]
    best, least = vector_codes.nearest(x, vector_codes.sliced(entries))
    for row, e, d in zip(x.tolist(), best.tolist(), least.tolist(), strict=True):
        every = [sum((a - b) ** 2 for a, b in zip(row, entry, strict=True)) for entry in entries.tolist()]
        assert (d, e) == (min(every), every.index(min(every)))


def test_candidates_are_few():
    rng = np.random.default_rng(5)
    entries = rng.integers(0, 100_000, (256, 6))
    book = vector_codes.sliced(entries)
    left = vector_codes.candidates(entries + rng.integers(-50, 50, entries.shape), np.full(256, book.radius), book)
    assert np.bitwise_count(left).sum(1).mean() < 256 / 20


def plain(rows, entries=16, rounds=6):
    """Codes, errors and codebooks of (vec_id, vector) by plain loops."""
    kept = sorted((i, [math.floor(4096 * c) for c in v]) for i, v in rows)
    width = len(kept[0][1]) // 8
    parts = [[v[p * width : (p + 1) * width] for _, v in kept] for p in range(8)]
    books = [[list(x) for x in own[:entries]] for own in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            groups = {}
            for x in parts[p]:
                groups.setdefault(nearest(x, books[p])[1], []).append(x)
            for k, own in groups.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [[nearest(x, books[p]) for x in parts[p]] for p in range(8)]
    codes = {i: ("".join(f"{found[p][r][1]:02x}" for p in range(8)), sum(found[p][r][0] for p in range(8))) for r, (i, _) in enumerate(kept)}
    return codes, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


@pytest.mark.parametrize("scale", [1, 1000, 1e9])
def test_codes_equal_plain_loops(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(c) for c in rng.normal(size=16) * scale]) for i in rng.permutation(80)]
    rows += [(100, rows[0][1]), (101, rows[0][1])]
    out, books = vector_codes.coded(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    want, sha = plain(rows)
    assert {r.vec_id: (r.code, r.error) for r in out.collect()} == {i: (c, e if e < 1 << 63 else None) for i, (c, e) in want.items()}
    assert vector_codes.digest(books) == sha


def test_edges(spark):
    good = [float(k) / 7 for k in range(8)]
    nan, inf = float("nan"), float("inf")
    rows = [(3, good, 1, "x"), (3, good, 1, "x"), (None, good, None, "x"), (1, None, 1, "x"), (2, [*good[:7], None], 1, "x"), (4, [*good[:7], nan], 2, "x"), (5, [*good[:7], -inf], 2, "x"), (6, good[:5], 2, "x"), (7, [], 2, "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string").selectExpr("*", "1 as error", "2 as v", "3 as n")
    out, books = vector_codes.coded(vectors)
    got = sorted((r.vec_id or 0, r.code, r.error) for r in out.collect())
    assert got == [(0, "00" * 8, 0), (3, "00" * 8, 0), (3, "00" * 8, 0), (6, None, None), (7, None, None)]
    assert [len(b) for b in books] == [2] * 8
    near = {r.vec_id: r.approximate for r in vector_codes.reconstructed(out, books).collect()}
    assert near[3] == pytest.approx([math.floor(4096 * c) / 4096 for c in np.float32(good).tolist()]) and near[6] is None
    none, books = vector_codes.coded(vectors.where("false"))
    assert none.count() == 0 and vector_codes.digest(books) == hashlib.sha256(b"").hexdigest()
