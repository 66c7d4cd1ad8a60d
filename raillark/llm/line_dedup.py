"""Line dedup by an exact set-similarity join (operator 3).

A line is the set of its distinct lower-cased words.  In document order
(``doc_id``, then line number) a line goes if an earlier line has a Jaccard
similarity of ``PERCENT`` hundredths or more with it.

One scan gives each line's set key (128 bits and the size) and the counts of hashed
tokens.  Lines with an earlier equal key are copies.  Of the others, tokens are
ordered by rarity in a second scan.  Two similar lines share a token in the first
``n - ceil(t * n) + 1`` of each (prefix filter), so lines are posted under these
tokens only.  A set too small to match any but an equal one (fewer than four words
at 80) is not posted, nor is a token that occurs once in the table.  Within a
token's list a pair must pass the length filter (lists come sorted by size, so the
comparison of a line ends at the first that is too long), the positional filter and
a sketch filter: each line carries 32 counts (modulo 16) of its words by hash, whose
distances add up to no more than the words that two sets differ in.  All filters
only drop pairs that cannot match.  What is left is verified on the lines' own words.

One earlier match is enough to remove a line, so each line is first verified
against its earliest candidate, then, if that fails, against the others.  Lines with
more than ``KEEP`` candidates that are still unresolved are looked up once more
against all of them, in the lists of their own tokens only.  What is emitted follows
the number of lines, not the square of a group of copies, and no match is lost.

A list of more than ``BLOCK`` lines is dealt to block-by-block cells, so no task
holds more than two blocks of a list, however common its token.  In a long list the
earliest lines are tried first, and a line with enough candidates is not compared
any further, so a group of near copies costs a few comparisons a line.

The order of rarity comes from counts of hashed tokens (``BUCKETS`` numbers, a
fixed size); any order gives the same result.

Defined results: lines without a word are left alone; null and empty texts have no lines to remove; of equal lines the first stays;
rows of different texts that share a ``doc_id`` count as one document, its lines
numbered on from text to text, so each row loses only lines that matched; a null
``doc_id`` takes no part.  Only removed lines change a text, with the line break that follows them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.llm import scan
from raillark.llm.workspace import free_name, pick, stored

PERCENT = 80
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
_LOW = 26
#: A posting's key: 44 bits of token and 20 of the line's size; longer lines share the last size and pass every filter.
_SIZE = 20
LONGEST = (1 << _SIZE) - 1
#: The key of a token that occurs once and need not be posted (no set has size 0).
NONE = 0
KEEP, SHORT_LIST = 4, 64
BLOCK = 1 << 14
#: Postings that are compared in one go; whole lists always are.
AT_ONCE = 1 << 16
#: Parts that the counts of token buckets are added up in.
_CHUNK = 1 << 12
_SIDE, _SPLIT, _FLAG = 32, 60, 61


class Sets(NamedTuple):
    """Lines with a word: row and number of each, distinct words in line order, and their bounds."""

    row: np.ndarray
    number: np.ndarray
    size: np.ndarray
    words: np.ndarray
    at: np.ndarray


def line_bounds(part: scan.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of all non-empty lines, their rows and their numbers within the text."""
    breaks = np.flatnonzero(part.data == 0x0A)
    starts = np.unique(np.concatenate([part.bounds[:-1], breaks + 1]))
    starts = starts[starts < len(part.data)]
    row = np.searchsorted(part.bounds, starts, "right") - 1
    number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, part.bounds[row])
    return np.append(starts, len(part.data)), row, number


def distinct_words(w: scan.Words) -> np.ndarray:
    """Whether a word is the one that stands for its equals of the same row (or line)."""
    own = scan.mix(w.hash + w.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own)
    same = own[order]
    keep = np.zeros(len(own), bool)
    keep[order[np.r_[True, same[1:] != same[:-1]]]] = True
    return keep


def line_sets(part: scan.Slice) -> tuple[Sets, np.ndarray]:
    """The lines' sets, and the hashes of all words, repeats included."""
    bounds, row, number = line_bounds(part)
    w, _, _ = scan.words(part, lower=True, sep=scan.PUNCT, cut=bounds)
    if not len(w.hash):
        none = np.zeros(0, np.int64)
        return Sets(none, none, none, w.hash, np.zeros(1, np.int64)), w.hash
    keep = distinct_words(w)
    size = np.bincount(w.doc[keep], minlength=len(row))
    used = np.flatnonzero(size)
    size = size[used]
    return Sets(row[used], number[used], size, w.hash[keep], np.concatenate([[0], np.cumsum(size)])), w.hash


def set_keys(x: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set."""
    first, second = scan.mix(x.words + np.uint64(1)), scan.mix(x.words ^ np.uint64(0xA5A5A5A55A5A5A5A))
    return np.add.reduceat(first, x.at[:-1]).view(np.int64), np.add.reduceat(second, x.at[:-1]).view(np.int64)


def sketches(words: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit words of each set: 32 counts modulo 16 of its words by hash, four bits each."""
    part = (scan.mix(words + np.uint64(1)) >> np.uint64(59)).astype(np.int64)
    line = np.repeat(np.arange(len(at) - 1), np.diff(at))
    counts = np.bincount(line * 32 + part, minlength=32 * (len(at) - 1)).reshape(-1, 2, 16).astype(np.uint64) & np.uint64(15)
    packed = (counts << np.arange(0, 64, 4, dtype=np.uint64)).sum(2, dtype=np.uint64)
    return [np.ascontiguousarray(packed[:, k]).view(np.int64) for k in (0, 1)]


_TOP, _ONES, _PAIRS, _BYTES = (np.uint64(int(x * 8, 16)) for x in ("88", "11", "0f", "01"))


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum over the 16 counts of two words of their distances modulo 16; never more than the sets differ in words."""
    d = ((x | _TOP) - (y & ~_TOP)) ^ ((x ^ ~y) & _TOP)  # each count's difference modulo 16
    sign = (d & _TOP) >> np.uint64(3)
    d = (d ^ (sign * np.uint64(15))) + sign
    return (((d & _PAIRS) + ((d >> np.uint64(4)) & _PAIRS)) * _BYTES) >> np.uint64(56)


def postings(x: Sets, order_of: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Sets to post (indexes), their sketches, bounds of their postings, and each posting's key, in order of place."""
    enough = 100 * x.size >= percent * (x.size + 1)  # a smaller set matches only its equals
    used = np.flatnonzero(enough)
    size = x.size[used]
    words = x.words[np.repeat(enough, x.size)]
    at = np.concatenate([[0], np.cumsum(size)])
    if not len(used):
        none = np.zeros(0, np.int64)
        return used, [none, none], at, none
    rank = order_of[words >> np.uint64(64 - BUCKET_BITS)]
    line = np.repeat(np.arange(len(used)), size)
    token = (rank.astype(np.uint64) << np.uint64(_LOW)) | (words & np.uint64((1 << _LOW) - 1))
    if len(used) < 1 << (64 - BUCKET_BITS - _LOW):
        own = np.sort((line.astype(np.uint64) << np.uint64(BUCKET_BITS + _LOW)) | token) & np.uint64((1 << (BUCKET_BITS + _LOW)) - 1)
    else:
        own = token[np.lexsort((token, line))]
    place = np.arange(len(own)) - np.repeat(at[:-1], size)
    prefix = size - -(-percent * size // 100) + 1
    post = place < np.repeat(prefix, size)
    own, line = own[post], line[post]
    key = ((own << np.uint64(_SIZE)) | np.minimum(size, LONGEST).astype(np.uint64)[line]).view(np.int64)
    key[counts[own >> np.uint64(_LOW)] < 2] = NONE
    return used, sketches(words, at), np.searchsorted(line, np.arange(len(used) + 1)), key


def surveyed(base: DataFrame) -> DataFrame:
    """Rows of lines (doc_id, line_no, key, key2, n) and of counts (chunk, counts), from one scan."""
    names = ["doc_id", "line_no", "key", "key2", "n", "chunk", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            ids, before = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            for part in scan.slices(batch.column(1)):
                x, every = line_sets(part)
                total += np.bincount((every >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=BUCKETS)
                if not len(x.row):
                    continue
                key, key2 = set_keys(x)
                cols = [ids[part.lo + x.row], before[part.lo + x.row] + x.number, key, key2, x.size]
                blank = [pa.nulls(len(key), kinds[5]), pa.nulls(len(key), kinds[6])]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), *blank], names)
        parts = total.reshape(-1, _CHUNK)
        some = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(some), k) for k in kinds[:5]), pa.array(some, pa.int32()), pa.array([parts[k].tobytes() for k in some], pa.binary())], names)

    return base.mapInArrow(run, "doc_id long, line_no long, key long, key2 long, n long, chunk int, counts binary")


def token_ranks(survey: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each token bucket, the rarest first, and the count of each rank; ``BUCKETS`` numbers each."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals[chunk] = totals.get(chunk, 0) + np.frombuffer(raw, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([x.tobytes() for x in totals.values()], pa.binary())], ["chunk", "counts"])

    # within each input partition first, so that a chunk's task adds up few rows
    parts = survey.where("chunk is not null").select("chunk", "counts").mapInArrow(add, "chunk int, counts binary")
    parts = parts.repartition("chunk").mapInArrow(add, "chunk int, counts binary").toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    for chunk, raw in zip(parts["chunk"].to_pylist(), parts["counts"].to_pylist(), strict=True):
        counts[chunk * _CHUNK : (chunk + 1) * _CHUNK] = np.frombuffer(raw, np.int64)
    ranks = np.empty(BUCKETS, np.int32)
    ranks[np.argsort(counts, kind="stable")] = np.arange(BUCKETS, dtype=np.int32)
    return ranks, np.sort(counts)


def posted(base: DataFrame, copies: DataFrame, ranks: np.ndarray, counts: np.ndarray, percent: int) -> DataFrame:
    """Postings (key, doc_id, line_no, sketch, sketch2, mark) of the first line of each set; the mark is the place."""
    sent = base.sparkSession.sparkContext.broadcast((ranks, np.minimum(counts, 2).astype(np.int8)))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, before = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            for part in scan.slices(batch.column(1)):
                x, _ = line_sets(part)
                used, sketch, bounds, key = postings(x, *sent.value, percent)
                keys = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(key, pa.int64()))
                row = part.lo + x.row[used]
                cols = [ids[row], before[row] + x.number[used], *sketch]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), keys], ["doc_id", "line_no", "sketch", "sketch2", "keys"])

    rows = base.mapInArrow(run, "doc_id long, line_no long, sketch long, sketch2 long, keys array<long>")
    # copies of a set are known already; their ids are the small side, two numbers a row
    rows = rows.join(copies.hint("shuffle_hash"), ["doc_id", "line_no"], "left_anti")
    rows = stored(rows, "firsts", "snappy")  # read several times
    posts = rows.select("doc_id", "line_no", "sketch", "sketch2", F.posexplode("keys").alias("place", "key")).where(F.col("key") != NONE)
    return posts.select("key", "doc_id", "line_no", "sketch", "sketch2", F.col("place").cast("bigint").alias("mark"))


def _token(key: Column | str) -> Column:
    return F.shiftright(key, _SIZE)


def _dealt(posts: DataFrame, lists: DataFrame, common: int) -> DataFrame:
    """``posts`` with a row of a list of ``lists`` sent to a cell for each block; its mark tells the side.

    Only tokens of a rank from ``common`` on can have such a list.  A cell's key takes
    the place of the token in the posting's key.
    """
    may = F.shiftrightunsigned("key", _SIZE + _LOW) >= common
    many = posts.where(may).withColumn("token", _token("key")).join(lists, "token", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    many = many.withColumn("side", F.pmod(F.xxhash64("doc_id", "line_no"), F.col("blocks"))).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.xxhash64("token", F.least("side", "_other"), F.greatest("side", "_other"))
    size = F.col("key").bitwiseAND(F.lit(LONGEST))
    key = F.when(F.col("blocks") > 1, F.shiftleft(F.shiftright(cell, _SIZE), _SIZE).bitwiseOR(size)).otherwise(F.col("key"))
    split = F.when(F.col("side") != F.col("_other"), F.shiftleft(F.lit(1).cast("bigint"), _SPLIT)).otherwise(F.lit(0).cast("bigint"))
    mark = F.when(F.col("blocks") > 1, F.col("mark").bitwiseOR(F.shiftleft("side", _SIDE)).bitwiseOR(split)).otherwise(F.col("mark"))
    return posts.where(~may).unionByName(many.withColumns({"key": key, "mark": mark}).select(posts.columns))


class Posts(NamedTuple):
    """Columns of postings, sorted by list and size."""

    doc: np.ndarray
    line: np.ndarray
    n: np.ndarray
    place: np.ndarray
    rest: np.ndarray  # words after the place
    one: np.ndarray
    two: np.ndarray
    side: np.ndarray
    split: np.ndarray
    flag: np.ndarray


def _fits(p: Posts, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Indexes of the pairs that pass the length, positional and sketch filters and belong to this cell."""
    n_a, n_b = p.n[a], p.n[b]
    both, most = n_a + n_b, np.maximum(n_a, n_b)
    ok = (100 + percent) * (1 + np.minimum(p.rest[a], p.rest[b]) + np.minimum(p.place[a], p.place[b])) >= percent * both
    ok &= 100 * (both - most) >= percent * most
    ok |= most >= LONGEST
    at = np.flatnonzero(ok)
    a, b, both, long = a[at], b[at], both[at], most[at] >= LONGEST
    left = both - 2 * -(-percent * both // (100 + percent))  # words that the sets may differ in
    for sketch in (p.one, p.two):
        gap = apart(sketch[a], sketch[b]).astype(np.int32)
        ok = np.flatnonzero((gap <= left) | long)
        at, a, b, left, long = at[ok], a[ok], b[ok], (left - gap)[ok], long[ok]
    return at[~(p.split[a] & p.split[b] & (p.side[a] == p.side[b]))]


def _earlier(p: Posts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (p.doc[a] < p.doc[b]) | ((p.doc[a] == p.doc[b]) & (p.line[a] < p.line[b]))


def _merge(percent: int, flagged: bool):
    """Rows sorted by key: each line with earlier candidates of a list.

    Without ``flagged`` a line gets its ``KEEP`` earliest and a note if there may be
    more; with it only lines that carry the flag, and all candidates.
    """

    def short_lists(p: Posts, start: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the lists: each row with those after it until one is too long."""
        rows = np.repeat(start, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        ends = np.repeat(start + length, length)
        for d in range(1, SHORT_LIST):
            go = rows + d < ends
            rows, ends = rows[go], ends[go]
            near = (100 * p.n[rows] >= percent * p.n[rows + d]) | (p.n[rows + d] >= LONGEST)
            rows, ends = rows[near], ends[near]
            if not len(rows):
                return
            some = rows if not flagged else rows[p.flag[rows] | p.flag[rows + d]]
            ok = some[_fits(p, some, some + d, percent)]
            if len(ok):
                yield ok, ok + d

    def long_list(p: Posts, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Triples (later, earlier, more) of one list; the earliest lines are tried first."""
        by_age = lo + np.lexsort((p.line[lo:hi], p.doc[lo:hi]))
        goal = by_age if not flagged else by_age[p.flag[by_age]]
        age = np.empty(hi - lo, np.int64)
        age[by_age - lo] = np.arange(hi - lo)
        had = np.zeros(hi - lo, np.int64)
        width = 64
        at = 0
        while at < len(by_age) and len(goal):
            heads = by_age[at : at + width]
            for k in range(0, len(goal), max(1, (1 << 20) // len(heads))):
                g = goal[k : k + max(1, (1 << 20) // len(heads))]
                x, y = np.nonzero(age[heads - lo][None] < age[g - lo][:, None])
                at_once = _fits(p, g[x], heads[y], percent)
                x, y = x[at_once], y[at_once]
                full = np.zeros(len(x), bool)
                if not flagged:  # x is in order, and y within it
                    first = np.searchsorted(x, x)
                    rank = np.arange(len(x)) - first
                    had[g - lo] += np.bincount(x, minlength=len(g))
                    full = had[g[x] - lo] >= KEEP
                    x, y, full = x[rank < KEEP], y[rank < KEEP], full[rank < KEEP]
                yield g[x], heads[y], full
            at += len(heads)
            goal = goal[age[goal - lo] >= at]
            if not flagged:
                goal = goal[had[goal - lo] < KEEP]
            width = min(1024, 2 * width)

    def pairs(p: Posts, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        later, earlier, more = [], [], []
        few = (length >= 2) & (length <= SHORT_LIST)
        for a, b in short_lists(p, start[few], length[few]):
            first = _earlier(p, a, b)
            later.append(np.where(first, b, a))
            earlier.append(np.where(first, a, b))
            more.append(np.zeros(len(a), bool))
        for lo, hi in zip(start[length > SHORT_LIST], (start + length)[length > SHORT_LIST], strict=True):
            if flagged and not p.flag[lo:hi].any():
                continue
            for x, y, m in long_list(p, lo, hi):
                later.append(x)
                earlier.append(y)
                more.append(m)
        if not later:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        x, y, m = np.concatenate(later), np.concatenate(earlier), np.concatenate(more)
        keep = (p.doc[x] != p.doc[y]) | (p.line[x] != p.line[y])  # a repeated row is no earlier line
        if flagged:
            keep &= p.flag[x]
        return x[keep], y[keep], m[keep]

    def work(cols: list[np.ndarray]) -> pa.RecordBatch | None:
        key, doc, line, one, two, mark = cols
        if not len(key):
            return None
        token = key >> _SIZE
        start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        side = (mark >> _SIDE) & ((1 << (_SPLIT - _SIDE)) - 1)
        n, place = (key & LONGEST).astype(np.int32), np.minimum(mark & ((1 << _SIDE) - 1), LONGEST).astype(np.int32)
        p = Posts(doc, line, n, place, n - place - 1, one.view(np.uint64), two.view(np.uint64), side, (mark >> _SPLIT) & 1 == 1, (mark >> _FLAG) & 1 == 1)
        x, y, m = pairs(p, start, np.diff(np.r_[start, len(key)]))
        if not len(x):
            return None
        rows = np.stack([doc[x], line[x], doc[y], line[y]], 1)
        order = np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))
        rows, m = rows[order], m[order]
        fresh = np.r_[True, (rows[1:] != rows[:-1]).any(1)]
        own = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)])
        any_more = np.repeat(np.logical_or.reduceat(m, own), np.diff(np.r_[own, len(m)]))
        rows, m = rows[fresh], any_more[fresh]
        if not flagged:  # the earliest few of a line, whatever list they come from
            own = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)])
            count = np.diff(np.r_[own, len(m)])
            rank = np.arange(len(m)) - np.repeat(own, count)
            m = m | np.repeat(count > KEEP, count)
            rows, m = rows[rank < KEEP], m[rank < KEEP]
        return pa.RecordBatch.from_arrays([*(pa.array(rows[:, k]) for k in range(4)), pa.array(m)], ["doc_id", "line_no", "first_doc", "first_line", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(k).to_numpy() for k in range(6)])
            rows += batch.num_rows
            token = held[-1][0] >> _SIZE
            if rows < AT_ONCE or (token[0] == token[-1] and len(held) > 1 and held[-2][0][-1] >> _SIZE == token[0]):
                continue  # too few, or one list goes on
            cut = int(np.searchsorted(token, token[-1]))  # the last list may go on
            made = work([np.concatenate([*(h[k] for h in held[:-1]), held[-1][k][:cut]]) for k in range(6)])
            held = [[c[cut:] for c in held[-1]]]
            rows = len(held[0][0])
            if made is not None:
                yield made
        if held:
            made = work([np.concatenate(c) for c in zip(*held, strict=True)])
            if made is not None:
                yield made

    return run


def _verify(percent: int):
    """Pairs of lines whose word sets are similar."""

    def keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of (row, word), and the row of each."""
        own, row = [], []
        for part in scan.slices(column):
            w, _, _ = scan.words(part, lower=True, sep=scan.PUNCT)
            doc = part.lo + w.doc
            own.append(scan.mix(w.hash + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            row.append(doc)
        if not own:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        key, at = np.unique(np.concatenate(own), return_index=True)
        return key, np.concatenate(row)[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, row_x), (y, row_y) = keys(batch.column(2)), keys(batch.column(3))
            both = np.searchsorted(y, x)
            both[both == len(y)] = 0
            hit = y[both] == x if len(y) else np.zeros(len(x), bool)
            a, b, shared = (np.bincount(r, minlength=batch.num_rows) for r in (row_x, row_y, row_x[hit]))
            ok = (shared > 0) & (100 * shared >= percent * (a + b - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["doc_id", "line_no"]).filter(pa.array(ok))

    return run


def shared_ids(docs: DataFrame) -> DataFrame | None:
    """doc_id, hash, n, before: texts of the doc_ids that several rows have, their lines and the lines of those before; None where there are none."""
    base = pick(docs, doc_id="bigint", text="string").where("doc_id is not null")
    ids = stored(base.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "shared")  # reads ids alone
    if ids.isEmpty():
        return None
    texts = base.join(ids, "doc_id").select("doc_id", F.xxhash64("text").alias("hash"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("bigint").alias("n")).distinct()
    ahead = Window.partitionBy("doc_id").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    return stored(texts.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))), "shared")


def numbered(docs: DataFrame, shared: DataFrame | None) -> DataFrame:
    """doc_id, text, and the number at which the row's lines begin."""
    base = pick(docs, doc_id="bigint", text="string").where("doc_id is not null")
    if shared is None:
        return base.withColumn("before", F.lit(0).cast("bigint"))
    same = (base["doc_id"] == shared["doc_id"]) & (F.xxhash64(base["text"]) == shared["hash"])
    return base.join(shared, same, "left").select(base["doc_id"], base["text"], F.coalesce("before", F.lit(0)).cast("bigint").alias("before"))


def looked_up(posts: DataFrame, open_lines: DataFrame, percent: int) -> DataFrame:
    """The postings that ``open_lines`` have to be compared with: theirs, with the flag, and those that pass the length and positional filters with one of theirs.

    Lines of a size ratio within the percentage lie in the same or neighbouring bins of sizes, so
    the rows follow the comparisons to be made and not the length of the lists.
    """
    place = F.col("mark").bitwiseAND(F.lit((1 << _SIDE) - 1))
    n = F.col("key").bitwiseAND(F.lit(LONGEST))
    # a little wider than the ratio, so that rounding never moves a pair two bins apart
    width = math.log(100 / min(percent, 99)) * (1 + 1e-9)
    binned = F.floor(F.log(n) / width)
    own = posts.join(open_lines, ["doc_id", "line_no"], "left_semi").select(_token("key").alias("_t"), n.alias("_m"), place.alias("_at"), F.explode(F.sequence(binned - 1, binned + 1)).alias("_bin")).distinct()
    own = stored(own, "tokens")  # of a known size
    rows = posts.withColumns({"_n": n, "_place": place})
    shared = F.least(F.col("_n") - F.col("_place"), F.col("_m") - F.col("_at")) + F.least("_place", "_at")
    fits = (100 * F.least("_n", "_m") >= percent * F.greatest("_n", "_m")) & ((100 + percent) * shared >= percent * (F.col("_n") + F.col("_m")))
    fits |= F.greatest("_n", "_m") >= LONGEST
    met = rows.join(own, (_token("key") == F.col("_t")) & (F.floor(F.log("_n") / width) == F.col("_bin")) & fits, "left_semi").drop("_n", "_place")
    again = met.join(open_lines.withColumn("flag", F.lit(True)), ["doc_id", "line_no"], "left")
    return again.withColumn("mark", F.when(F.col("flag"), F.col("mark").bitwiseOR(F.lit(1 << _FLAG))).otherwise(F.col("mark"))).drop("flag")


def removed_lines(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK, *, shared: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, line_no, how) of every line that goes, and (doc_id, line_no, key, key2, n) of all lines with a word.

    ``how`` is 'copy' for a line whose word set occurred before, else 'near'.
    ``shared`` comes from :func:`shared_ids`, without which it is called here.
    """
    base = numbered(docs, shared if shared is not None else shared_ids(docs))
    survey = stored(surveyed(base), "survey")
    ranks, counts = token_ranks(survey)
    lines = survey.where("chunk is null").drop("chunk", "counts")
    # a line's place as one number: its minimum needs no sort
    place = F.col("doc_id").cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("line_no")
    same = ["key", "key2", "n"]
    firsts = lines.groupBy(*same).agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    copies = stored(lines.join(firsts.hint("shuffle_hash"), same).where(place != F.col("first")).select("doc_id", "line_no"), "copies")

    posts = posted(base, copies, ranks, counts, percent)
    # no list is longer than the count of its token's bucket, so only the commonest need be counted
    common = int(np.searchsorted(counts, block, "right"))
    lists = None
    if common < BUCKETS:
        lists = posts.where(F.shiftrightunsigned("key", _SIZE + _LOW) >= common).groupBy(_token("key").alias("token")).agg(F.count("*").alias("n")).where(F.col("n") > block)
        lists = stored(lists.select("token", F.ceil(F.col("n") / block).cast("bigint").alias("blocks")), "lists")

    def merged(rows: DataFrame, flagged: bool) -> DataFrame:
        """Candidate rows of the postings ``rows``."""
        dealt = (rows if lists is None else _dealt(rows, lists, common)).select("key", "doc_id", "line_no", "sketch", "sketch2", "mark")
        return dealt.repartition(_token("key")).sortWithinPartitions("key").mapInArrow(_merge(percent, flagged), "doc_id long, line_no long, first_doc long, first_line long, more boolean")

    found = merged(posts, False)
    found = stored(found.groupBy("doc_id", "line_no", "first_doc", "first_line").agg(F.max("more").alias("more")), "candidates")
    best = found.groupBy("doc_id", "line_no").agg(F.min(F.struct("first_doc", "first_line")).alias("best"), F.max("more").alias("more"))
    best = best.select("doc_id", "line_no", "best.*", "more")
    texts = _line_texts(base, found)

    def matched(some: DataFrame) -> DataFrame:
        ahead = texts.select(F.col("doc_id").alias("first_doc"), F.col("line_no").alias("first_line"), F.col("line").alias("first_text"))
        both = some.select("doc_id", "line_no", "first_doc", "first_line").join(texts, ["doc_id", "line_no"]).join(ahead, ["first_doc", "first_line"])
        return both.select("doc_id", "line_no", "line", "first_text").mapInArrow(_verify(percent), "doc_id long, line_no long").distinct()

    near = stored(matched(best), "near")
    rest = found.join(near, ["doc_id", "line_no"], "left_anti").join(best.drop("more"), ["doc_id", "line_no", "first_doc", "first_line"], "left_anti")
    near = stored(near.unionByName(matched(rest)), "near")
    open_lines = stored(best.where("more").select("doc_id", "line_no").join(near, ["doc_id", "line_no"], "left_anti"), "open")
    if not open_lines.isEmpty():
        again = looked_up(posts, open_lines, percent)
        more = stored(merged(again, True).distinct(), "more")
        texts = _line_texts(base, more)
        near = stored(near.unionByName(matched(more)), "near")
    gone = copies.distinct().withColumn("how", F.lit("copy")).unionByName(near.withColumn("how", F.lit("near")))
    return gone, lines


def _line_texts(base: DataFrame, pairs: DataFrame) -> DataFrame:
    """doc_id, line_no, line of all lines that the pairs name."""
    need = pairs.select("doc_id", "line_no").union(pairs.select("first_doc", "first_line")).distinct().groupBy("doc_id").agg(F.collect_list("line_no").alias("wanted"))
    need = stored(need, "need")  # of a known size
    cut = base.join(need, "doc_id").withColumn("cut", F.split("text", "\n"))
    rows = cut.select("doc_id", F.explode(F.transform("wanted", lambda k: F.struct(k.alias("line_no"), F.get("cut", (k - F.col("before")).cast("int")).alias("line")))).alias("x"))
    return stored(rows.select("doc_id", "x.line_no", "x.line").where("line is not null").distinct(), "texts")


def without(text: Column, gone: Column) -> Column:
    """``text`` less the lines of the numbers in ``gone``."""

    def joined(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)  # by hashing, in order
        return F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n")

    # the lines are bound once: an expression named in an inner function is worked out for each of its elements
    return F.get(F.transform(F.array(F.split(text, "\n")), joined), F.lit(0))


def cleaned(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with its columns, the removed lines cut from the texts.

    Rows that lose all their words go; rows without any word before stay.
    """
    shared = shared_ids(docs)
    gone, _ = removed_lines(docs, percent, shared=shared)
    id_, hash_, cut = (free_name(docs, x) for x in ("_id", "_hash", "_gone"))
    if shared is None:
        gone = gone.withColumn("hash", F.lit(None).cast("bigint")).withColumn("before", F.lit(0))
    else:  # a number belongs to the text in whose range it lies
        gone = gone.join(shared, "doc_id", "left").where("hash is null or line_no >= before and line_no < before + n")
    number = (F.col("line_no") - F.coalesce("before", F.lit(0))).cast("int")
    by_text = gone.groupBy(F.col("doc_id").alias(id_), F.col("hash").alias(hash_)).agg(F.collect_set(number).alias(cut))
    text = docs["text"].cast("string")
    both = docs.join(by_text, (docs["doc_id"].cast("bigint") == F.col(id_)) & (F.col(hash_).isNull() | (F.xxhash64(text) == F.col(hash_))), "left")
    both = both.withColumn("text", F.when(F.col(cut).isNull(), F.col("text")).otherwise(without(F.col("text"), F.col(cut))))
    both = both.where(F.col(cut).isNull() | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col(cut).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return both.select(*(f"`{c}`" for c in docs.columns))


def op3_line_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: lines looked at, lines removed as copies and as near matches, and their numbers."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    gone, lines = removed_lines(docs)
    n_lines = lines.groupBy("doc_id").agg(F.count_distinct("line_no").alias("n_lines"))
    n_gone = gone.groupBy("doc_id").agg(F.count("*").alias("n_removed"), F.count_if(F.col("how") == "copy").alias("n_copies"), F.array_sort(F.collect_list("line_no")).alias("removed"))
    out = pick(docs, doc_id="bigint").join(n_lines, "doc_id", "left").join(n_gone, "doc_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select("doc_id", zero("n_lines"), zero("n_removed"), zero("n_copies"), F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"))
