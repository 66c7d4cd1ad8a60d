"""Sentencepiece encoding and decoding by batched numpy Viterbi (operator 6).

Texts are cut at word marks, where no piece can lie across, and each distinct
segment is solved once.  Segments of one length form a matrix of code points
whose rows advance together: the hashes of the substrings that end at a position
probe the sorted piece keys, and one vectorised maximum stores the backpointers.
Long unbroken segments (over ``LONG``) are solved alone, from the list of all pieces
that occur in them, in time that grows with their length.

The result is the segmentation of the greatest total score over the model's
pieces (of equals the one whose last piece is longest), which is what the library gives
for such pieces under its unigram type.  The byte-pair merges of the same file
can cut words otherwise; ``token_counts`` follows those.  A character in no
piece becomes its bytes' pieces.

Defined results: a null or empty text has no id and decodes to the empty text.
A word mark (U+2581) inside a text decodes to a space, as the library's does.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raillark.llm import scan
from raillark.llm.pieces import CACHE, MARK, Pieces, pieces
from raillark.llm.workspace import pick

_BASE = np.uint64(0xD6E8FEB86659FD93)
#: Below any piece's score, so that a character in no piece is a last resort.
UNKNOWN = -10.0
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Longer segments are solved alone.
LONG = 256
#: Segments solved in one matrix hold at most this many characters.
MATRIX = 1 << 18


class Lattice:
    """Sorted piece keys with ids and scores."""

    def __init__(self, model: Pieces):
        self.model = model
        texts = list(model.ids)
        keys = np.array([self.key(t) for t in texts], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a key")
        self.ids = np.array([model.ids[t] for t in texts], np.int32)[order]
        self.scores = np.array([model.scores[t] for t in texts], np.float64)[order]
        self.lengths = sorted({len(t) for t in texts})
        self.least = float(self.scores.min()) + UNKNOWN

    @staticmethod
    def key(text: str) -> np.uint64:
        total = 0
        for c in text:
            total = (total * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(total)

    def solve_long(self, segment: str) -> np.ndarray:
        """Ids of one long segment: all pieces that occur anywhere are found length by length, then one walk over these."""
        size = len(segment)
        points = np.frombuffer(segment.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        up, down = np.full(size + 1, _BASE, np.uint64), np.full(size + 1, _BACK, np.uint64)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * down[:size])])
        ends, starts, places = [], [], []
        for n in reversed(self.lengths):
            if n > size:
                continue
            key = (sums[n:] - sums[:-n]) * up[n - 1 : size]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            s = np.flatnonzero(self.keys[at] == key)
            ends.append(s + n)
            starts.append(s)
            places.append(at[s])
        end, start, place = (np.concatenate(x) for x in (ends, starts, places))
        order = np.argsort(end, kind="stable")  # longer pieces first at each end
        first = np.searchsorted(end[order], np.arange(size + 2)).tolist()
        start, place = start[order].tolist(), place[order]
        score, place = self.scores[place].tolist(), place.tolist()
        best, back = [0.0] * (size + 1), [-1] * (size + 1)
        for e in range(1, size + 1):
            top, by, alone = -np.inf, -1, True
            for k in range(first[e], first[e + 1]):
                alone = alone and start[k] != e - 1
                value = best[start[k]] + score[k]
                if value > top:
                    top, by = value, k
            if alone and best[e - 1] + self.least > top:  # a character in no piece
                top, by = best[e - 1] + self.least, -1
            best[e], back[e] = top, by
        out, e = [], size
        while e:
            k = back[e]
            out += [int(self.ids[place[k]])] if k >= 0 else [self.model.byte_ids[b] for b in reversed(segment[e - 1].encode())]
            e = start[k] if k >= 0 else e - 1
        return np.array(out[::-1], np.int32)

    def solve(self, segments: list[str]) -> list[np.ndarray]:
        """Ids of segments of one length."""
        if len(segments[0]) > LONG:
            return [self.solve_long(x) for x in segments]
        size, rows = len(segments[0]), len(segments)
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).reshape(rows, size).astype(np.uint64) + np.uint64(1)
        sums = np.zeros((rows, size + 1), np.uint64)
        for e in range(size):
            sums[:, e + 1] = sums[:, e] * _BASE + points[:, e]
        power = np.full(size + 1, _BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        best = np.full((rows, size + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros((rows, size + 1), np.int32), np.full((rows, size + 1), -1, np.int32)
        for e in range(1, size + 1):
            for n in reversed(self.lengths):
                s = e - n
                if s < 0:
                    continue
                key = sums[:, e] - sums[:, s] * power[n]
                at = np.searchsorted(self.keys, key)
                at[at == len(self.keys)] = 0
                hit = self.keys[at] == key
                score = np.where(hit, best[:, s] + self.scores[at], -np.inf)
                if n == 1:
                    score = np.where(hit, score, best[:, s] + self.least)
                better = score > best[:, e]
                best[better, e], back[better, e] = score[better], s
                piece[better, e] = np.where(hit, self.ids[at], -1)[better]
        out = []
        for row, segment in enumerate(segments):
            found, e = [], size
            while e:
                s = int(back[row, e])
                p = int(piece[row, e])
                found += [p] if p >= 0 else [self.model.byte_ids[b] for b in reversed(segment[s:e].encode())]
                e = s
            out.append(np.array(found[::-1], np.int32))
        return out


@lru_cache(maxsize=2)
def lattice(path: str | None = None) -> Lattice:
    return Lattice(pieces(path))


def solve_all(segments: list[str], own: Lattice) -> dict[str, bytes]:
    """Ids, as bytes, of each distinct segment; segments of one length advance together."""
    by: dict[int, list[str]] = {}
    for s in segments:
        by.setdefault(len(s), []).append(s)
    out = {}
    for size, group in by.items():
        step = max(1, MATRIX // size)
        for lo in range(0, len(group), step):
            some = group[lo : lo + step]
            out.update(zip(some, (x.tobytes() for x in own.solve(some)), strict=True))
    return out


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text, ids of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model)
        known: dict[str, bytes] = {}
        for batch in batches:
            for part in scan.slices(batch.column(1)):
                raw, edge = part.data.tobytes(), part.bounds
                cut = [own.model.segments(raw[edge[k] : edge[k + 1]].decode()) for k in range(part.hi - part.lo)]
                if len(known) > CACHE:
                    known.clear()
                known.update(solve_all(list({s for x in cut for s in x}.difference(known)), own))
                ids = [np.frombuffer(b"".join(map(known.__getitem__, x)), np.int32) for x in cut]
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                flat = pa.array(np.concatenate(ids))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)
                rows = slice(part.lo, part.hi)
                yield pa.RecordBatch.from_arrays([batch.column(0)[rows], batch.column(1)[rows], lists], ["doc_id", "text", "ids"])

    return pick(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode_ids(ids: np.ndarray, own: Pieces) -> str:
    """The text of one row's ids."""
    out = bytearray()
    for i in ids.tolist():
        b = own.byte_of.get(i)
        out += own.text[i].encode() if b is None else bytes([b])
    return out.decode("utf-8", "replace").replace(MARK, " ")[1:]


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The rows of ``encode`` with ``decoded`` and digests of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        raw = [own.text[i].encode() if i not in own.byte_of else bytes([own.byte_of[i]]) for i in range(len(own.text))]
        for batch in batches:
            lists = batch.column(2)
            flat, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
            for lo in range(0, batch.num_rows, 256):
                hi = min(lo + 256, batch.num_rows)
                text, crc = [], []
                for k in range(lo, hi):
                    ids = flat[bounds[k] : bounds[k + 1]]
                    text.append(b"".join(map(raw.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")[1:])
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                count = pa.array(np.diff(bounds[lo : hi + 1]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(text, pa.string()), count, pa.array(crc, pa.int64())], ["doc_id", "text", "decoded", "n_tokens", "ids_crc32"])

    return encoded.select("doc_id", "text", "ids").mapInArrow(run, "doc_id long, text string, decoded string, n_tokens long, ids_crc32 long")


def op6_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes the whole of ``documents``; one row a document."""
    both = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    back = F.col("decoded") == F.coalesce("text", F.lit(""))
    return both.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), "n_tokens", "ids_crc32", back.alias("round_trip"), F.sha2("decoded", 256).alias("decoded_sha256"))
