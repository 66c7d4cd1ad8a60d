"""Token counts by heap-and-linked-list byte-pair merging (operator 8).

Per segment the symbols form a linked list and a heap holds the adjacent pairs
that make a piece; the pair of the lowest rank (the leftmost of equals) is
popped and merged until none is left.  The count is the number of initial
symbols less the merges; no id is made.  Characters outside the vocabulary count
as their UTF-8 bytes, as the model's byte fallback gives them.

Defined results: a null or empty text has no token; repeated rows each get their
row; very long texts are cut at word marks, where no piece can lie across.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from raillark.llm import scan
from raillark.llm.pieces import CACHE, Pieces, pieces
from raillark.llm.workspace import pick

LIMIT = 4096


def merged_count(segment: str, model: Pieces) -> int:
    """Tokens of one segment."""
    ids, scores = model.ids, model.scores
    part: list[str | None] = list(segment)
    n = len(part)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = []
    for i in range(n - 1):
        score = scores.get(part[i] + part[i + 1])
        if score is not None:
            heap.append((-score, i, part[i] + part[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, whole = heapq.heappop(heap)
        left = part[i]
        if left is None:
            continue
        j = after[i]
        if j < 0 or left + part[j] != whole:
            continue
        merges += 1
        part[i], part[j] = whole, None
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            score = scores.get(whole + part[k])
            if score is not None:
                heapq.heappush(heap, (-score, i, whole + part[k]))
        h = before[i]
        if h >= 0:
            score = scores.get(part[h] + whole)
            if score is not None:
                heapq.heappush(heap, (-score, h, part[h] + whole))
    return n - merges + sum(len(c.encode()) - 1 for c in part if c is not None and len(c) == 1 and c not in ids)


def count_tokens(docs: DataFrame, limit: int = LIMIT, model: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; ``model`` is a model file's path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        cut = own.segments
        known: dict[str, int] = {}
        for batch in batches:
            for part in scan.slices(batch.column(1)):
                sizes, counts = [], []
                edge = part.bounds
                raw = part.data.tobytes()
                for k in range(part.hi - part.lo):
                    body = raw[edge[k] : edge[k + 1]]
                    segments = cut(body.decode())
                    try:
                        counts.append(sum(map(known.__getitem__, segments)))
                    except KeyError:
                        for s in set(segments).difference(known):
                            known[s] = merged_count(s, own)
                        counts.append(sum(map(known.__getitem__, segments)))
                    sizes.append(len(body))
                    if len(known) > CACHE:
                        known.clear()
                n = pa.array(counts, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.lo, part.hi - part.lo), pa.array(sizes, pa.int64()), n, pa.array([c > limit for c in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return pick(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over the whole of ``documents``."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
