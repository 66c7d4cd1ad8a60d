"""Best-fit packing by a linear grouping scheme (operator 9).

The plan is made on the histogram of piece lengths, which has at most
``capacity`` entries however many documents there are:

1. large lengths are split into groups of equal cardinality and rounded up to
   their group's longest, which leaves a few sizes;
2. the linear programme over configurations of those sizes (fewest sequences that
   hold every rounded length) is solved by column generation: a knapsack at the
   current prices gives the next configuration, until none improves;
3. configurations are used a whole number of times, rounded down; the documents
   themselves take the places of their group's rounded size, and any room that
   rounding left is seen again as room;
4. small lengths and the few large ones that rounding down left over, longest first,
   go where they leave the least room (best fit), class by class; what fits nowhere
   opens further sequences.

Few sizes leave room that small documents fill, many sizes leave little where there
are none, so a plan is made for each number of groups in ``GROUPS``, and one of best fit
alone, longest first; the one with the fewest sequences is used.

Pieces are then matched to the plan by their rank among pieces of their length.
Ranks are dealt over salted parts of each length, so a third of all documents of
one length is no hot spot, and the sequence of a piece follows from arithmetic on
its rank.

Defined results: a null text counts as empty and is a piece of one token (the end
id); repeated rows are packed each; only documents over ``capacity`` are cut.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.llm import scan
from raillark.llm.workspace import pick, stored

CAPACITY, END = 4096, 1
MODEL = "word_bpe_49k.json"
CACHE = 1 << 20
#: Parts that the pieces of one length are ranked in: so many, and one more for each ``RANKED`` pieces.
SALTS, RANKED = 64, 1 << 18
#: Numbers of sizes over which configurations are optimised, each tried; lengths from a quarter of the capacity on are large.
GROUPS = (12, 24, 48, 96)
#: Gain in price below which a configuration no longer counts as better, and steps of the programme a size.
GAIN, STEPS = 1e-6, 60
#: White space that str.split() takes and the tokenizer may not.
_ODD = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_PLAIN = re.compile("[ \t\n\r\x0b\x0c]+")


class Chunks:
    """Ids of blank-separated chunks, as bytes.

    A chunk is looked up less its closing stops and in lower case (the tokenizer
    folds case and takes a run of stops after a letter for a word of its own).
    Chunks of letters alone are one word each: they are encoded as one text and
    told apart by the tokens that end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.ends = np.zeros(self.own.get_vocab_size() + 1, bool)
        self.ends[[i for t, i in self.own.get_vocab().items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _encode(self, chunks: list[str]) -> None:
        plain = [c for c in chunks if c.isalpha()]
        if plain:
            ids = np.array(self.own.encode(" ".join(plain), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(plain) and cuts[-1] == len(ids):
                body, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
                self.known.update(zip(plain, (body[at[k] : at[k + 1]] for k in range(len(plain))), strict=True))
            else:
                plain = []
        rest = chunks if not plain else [c for c in chunks if not c.isalpha()]
        for c, e in zip(rest, self.own.encode_batch(rest, add_special_tokens=False), strict=True):
            self.known[c] = np.array(e.ids, "<u4").tobytes()

    def learn(self, chunks: set[str]) -> None:
        """Makes every chunk known."""
        known = self.known
        if len(known) > CACHE:
            known.clear()
        new = [c for c in chunks if c not in known]
        core, stops = {}, {}
        for c in new:
            body = c.rstrip(".,!?;:")
            if not body or not body[-1].isalpha():
                body = c
            if max(body) < "\u0180" and "\u0130" not in body:
                body = body.lower()
            core[c], stops[c] = body, c[len(body) :] if len(body) < len(c) else ""
        need = {x for y in (core.values(), stops.values()) for x in y if x and x not in known}
        if need:
            self._encode(sorted(need))
        known[""] = b""
        known.update([(c, known[core[c]] + known[stops[c]]) for c in new])


@lru_cache(maxsize=2)
def chunks_of(path: str) -> Chunks:
    return Chunks(path)


def _token_batches(path: str | None, capacity: int, end: int):
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = chunks_of(path or public_tokenizers.path(MODEL))
        known = own.known
        for batch in batches:
            ids = batch.column(0)
            for part in scan.slices(batch.column(1)):
                raw, edge = part.data.tobytes(), part.bounds
                cut = []
                for k in range(part.hi - part.lo):
                    text = raw[edge[k] : edge[k + 1]].decode()
                    cut.append(text.split() if not _ODD.search(text) else [x for x in _PLAIN.split(text) if x])
                own.learn({w for x in cut for w in x})
                row, piece, start, length, crc = [], [], [], [], []
                for k, x in enumerate(cut, part.lo):
                    body = b"".join(map(known.__getitem__, x)) + tail
                    for p, at in enumerate(range(0, len(body), 4 * capacity)):
                        some = body[at : at + 4 * capacity]
                        row.append(k)
                        piece.append(p)
                        start.append(at // 4)
                        length.append(len(some) // 4)
                        crc.append(zlib.crc32(some))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, end: int = END, model: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece.

    The tokenizer drops white space and no token lies across it, so a text's ids
    are those of its blank-separated chunks; each distinct chunk is encoded once.
    """
    return pick(docs, doc_id="bigint", text="string").mapInArrow(_token_batches(model, capacity, end), "doc_id long, piece int, start long, length long, ids_crc32 long")


def dearest(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """How often each size occurs in the multiset of most worth that fits, and that worth."""
    worth, picks = np.zeros(capacity + 1), []
    for _ in range(capacity // min(sizes)):  # one more item a step
        better, pick = worth.copy(), np.full(capacity + 1, -1)
        for i in np.flatnonzero(prices > 0):
            size = sizes[i]
            offer = worth[:-size] + prices[i]
            at = np.flatnonzero(offer > better[size:] + 1e-12)
            better[size + at], pick[size + at] = offer[at], i
        if (pick < 0).all():
            break
        worth = better
        picks.append(pick)
    room = int(worth.argmax())
    best, times = float(worth[room]), np.zeros(len(sizes))
    for pick in reversed(picks):
        if pick[room] >= 0:
            times[pick[room]] += 1
            room -= sizes[pick[room]]
    return times, best


def configurations(stock: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Configurations of the sizes in ``stock`` and how often each is used in the linear programme, rounded down.

    Every basis met on the way holds the whole stock, so the bound on the steps costs at most some room.
    """
    sizes = sorted(stock, reverse=True)
    if not sizes:
        return []
    need = np.array([stock[s] for s in sizes], float)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(STEPS * len(sizes)):
        inverse = np.linalg.inv(basis)
        used = np.maximum(inverse @ need, 0)
        column, worth = dearest(sizes, inverse.sum(axis=0), capacity)
        if worth <= 1 + GAIN:
            break
        along = inverse @ column
        rising = along > 1e-9
        basis[:, np.where(rising, used / np.where(rising, along, 1), np.inf).argmin()] = column
    used = np.maximum(np.linalg.inv(basis) @ need, 0)
    return [({s: int(k) for s, k in zip(sizes, basis[:, j]) if k}, int(used[j] + GAIN)) for j in range(len(sizes))]


def best_plan(counts: dict[int, int], capacity: int) -> Plan:
    """The plan with the fewest sequences over ``GROUPS`` and best fit of everything; ties go to fewer groups, and to groups."""
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    best = None
    for groups in GROUPS:
        plan = Plan(counts, capacity, groups)
        if best is None or plan.sequences < best.sequences:
            best = plan
        if best.sequences == least:
            return best
    plain = Plan(counts, capacity, 1, capacity + 1)  # no length is large
    return plain if plain.sequences < best.sequences else best


class Plan:
    """Sequences as runs of bins that hold the same lengths.

    ``bins``: [number of bins, used room, lengths in order] each.
    """

    def __init__(self, counts: dict[int, int], capacity: int, groups: int, large: int | None = None):
        self.capacity = capacity
        self.bins: list[list] = []
        left = {n: c for n, c in counts.items() if c}
        left |= self._configure({n: left.pop(n) for n in sorted(left) if n >= (large or max(1, capacity // 4))}, groups)
        self._best_fit(left)
        self.sequences = sum(b[0] for b in self.bins)

    def _configure(self, big: dict[int, int], groups: int) -> dict[int, int]:
        """Groups of equal cardinality, rounded up; configurations of these few sizes. Returns the lengths left over."""
        total = sum(big.values())
        members: dict[int, list[list[int]]] = defaultdict(list)
        seen, share, run = 0, -(-total // groups), []
        for n in sorted(big, reverse=True):
            run.append([n, big[n]])
            seen += big[n]
            if seen >= share:
                members[run[0][0]] = run
                seen, run = 0, []
        if run:
            members[run[0][0]] = run
        stock = {size: sum(c for _, c in run) for size, run in members.items()}
        for config, times in configurations(stock, self.capacity):
            times = min([times, *(stock[s] // k for s, k in config.items())])
            if times:
                for s, k in config.items():
                    stock[s] -= k * times
                self._substitute(config, times, members)
        return {n: c for run in members.values() for n, c in run if c}

    def _substitute(self, config: dict[int, int], times: int, members: dict) -> None:
        """Real lengths, longest first, in the places of the rounded sizes."""
        while times:
            take, lengths = times, []
            for size, k in config.items():
                pos, need = 0, k
                run = members[size]
                while need:
                    n, c = run[pos]
                    use = min(need, c)
                    lengths += [n] * use
                    take = min(take, c // use)
                    need -= use
                    pos += 1
            used = defaultdict(int)
            for n in lengths:
                used[n] += 1
            for size in config:
                run = members[size]
                for entry in run:
                    if entry[0] in used:
                        entry[1] -= used.pop(entry[0]) * take
                members[size] = [e for e in run if e[1]]
            self.bins.append([take, sum(lengths), lengths])
            times -= take

    def _best_fit(self, small: dict[int, int]) -> None:
        rooms: dict[int, list[list]] = defaultdict(list)
        for b in self.bins:
            rooms[self.capacity - b[1]].append(b)
        order = sorted(rooms)
        done: list[list] = [b for b in self.bins if b[1] == self.capacity]

        def put(b: list) -> None:
            room = self.capacity - b[1]
            if room not in rooms or not rooms[room]:
                at = bisect_left(order, room)
                if at == len(order) or order[at] != room:
                    insort(order, room)
            rooms[room].append(b)

        rooms.pop(0, None)
        if order and order[0] == 0:
            order.pop(0)
        for n in sorted(small, reverse=True):
            count = small[n]
            while count:
                at = bisect_left(order, n)
                if at == len(order):
                    fit = self.capacity // n
                    whole, rest = divmod(count, fit)
                    for times, k in ((whole, fit), (1, rest)):
                        if times and k:
                            fresh = [times, k * n, [n] * k]
                            (done.append(fresh) if fresh[1] == self.capacity else put(fresh))
                    break
                room = order[at]
                bins = rooms[room]
                if not bins:
                    order.pop(at)
                    continue
                b = bins.pop()
                fit = min(room // n, count) if b[0] == 1 else room // n
                times = min(b[0], count // fit) if fit <= count else 0
                if not times:
                    fit, times = count, 1
                if times < b[0]:
                    bins.append([b[0] - times, b[1], b[2]])
                if not bins:
                    order.pop(at)
                count -= times * fit
                filled = [times, b[1] + fit * n, b[2] + [n] * fit]
                (done.append(filled) if filled[1] == self.capacity else put(filled))
        self.bins = done + [b for room in order for b in rooms[room] if room]

    def tables(self) -> dict[int, np.ndarray]:
        """Per length the intervals of ranks: first rank, first sequence, places a sequence, first offset."""
        out, seen, sequence = defaultdict(list), defaultdict(int), 0
        for times, _, lengths in self.bins:
            offset, k = 0, 0
            while k < len(lengths):
                n, per = lengths[k], 1
                while k + per < len(lengths) and lengths[k + per] == n:
                    per += 1
                out[n].append((seen[n], sequence, per, offset))
                seen[n] += times * per
                offset += per * n
                k += per
            sequence += times
        return {n: np.array(rows, np.int64).T for n, rows in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``pieces`` must be a stored table, as it is read twice."""
    spark = pieces.sparkSession
    total = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    salts = spark.createDataFrame([(n, SALTS + c // RANKED) for n, c in total.items()], "length long, _salts long")
    salted = pieces.join(F.broadcast(salts), "length").withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_salts")).cast("int")).select(*pieces.columns, "_salt")
    counts = salted.groupBy("length", "_salt").count().collect()  # at most SALTS a length and one for each RANKED pieces
    by: dict[int, np.ndarray] = {n: np.zeros(SALTS + c // RANKED, np.int64) for n, c in total.items()}
    for r in counts:
        by[r["length"]][r["_salt"]] = r["count"]
    plan = best_plan({int(n): int(c) for n, c in total.items()}, capacity).tables()
    before = {n: np.cumsum(c) - c for n, c in by.items()}
    sent = spark.sparkContext.broadcast((before, plan))  # bounded by the number of lengths, not of documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets, table = sent.value
        for batch in batches:
            length, salt, rank = (batch.column(batch.schema.get_field_index(k)).to_numpy() for k in ("length", "_salt", "_rank"))
            sequence, place = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                whole = offsets[n][salt[at]] + rank[at] - 1
                first, seq, per, offset = table[n]
                k = np.searchsorted(first, whole, "right") - 1
                own = whole - first[k]
                sequence[at] = seq[k] + own // per[k]
                place[at] = offset[k] + own % per[k] * n
            keep = [batch.column(k) for k in range(5)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(place)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(order).cast("bigint"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_salt", "_rank").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed(docs: DataFrame, capacity: int = CAPACITY, end: int = END, model: str | None = None) -> DataFrame:
    """Every piece of ``docs`` with its sequence and place."""
    return pack(stored(pieces_of(docs, capacity, end, model), "pieces"), capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over the whole of ``documents``."""
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
