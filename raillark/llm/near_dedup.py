"""MinHash near-dedup by an inverted join on signature coordinates (operator 7).

A signature has ``COORDS`` min-hashes; its elements are the pairs of a coordinate and
its value.  Two documents of the wanted similarity agree on ``matches(percent)``
coordinates at least, but for a chance below ``MISS``.

Prefix merging: the lists of all coordinate-value pairs are counted, and each
document's elements are put in order of their list's length.  Documents that agree on
T of K coordinates share one of the first K - T + 1 of either, so a document is posted
under these only.  Elements that no other document has come first and need no
posting, so a document with more than K - T of them is in no list at all; a passage
that thousands share comes last.  Lists are then worked in two rounds:

1. each document takes one partner, the list pivot that it collides with most often
   (collisions are counted by a plain aggregation); these links are confirmed on
   full shingle sets and closed to components;
2. skip merging: lists whose members already lie in one component are skipped.  In
   the others collisions are counted for members of different components only, a few
   coordinates at a time, and a pair that cannot reach T any more is skipped; pairs
   over the threshold are confirmed on full sets as well.  A pair is
   taken up in the list of its first common coordinate only.

Round 2 looks at every pair of a mixed list, so no link is lost to round 1; lists
longer than ``BLOCK``, or of larger sets than ``SET_BUDGET``, are dealt to block-by-block cells.  It first flags the
documents with a candidate partner and then confirms, with their texts at hand,
only pairs of components not yet joined: what it emits follows the number of
rows, never the pairs of a group.

Defined results: a document without words has no shingle and is linked with
nothing; a null text counts as empty; exact copies of a set form a class whose
smallest ``doc_id`` stands for it; rows that repeat a ``doc_id`` stay rows of
their own but count as one node, linked if any of their texts is; a null ``doc_id`` joins its class and is never a
representative.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raillark.llm import scan
from raillark.llm.workspace import pick, stored

COORDS = 32
#: The chance that documents of the wanted similarity agree on too few coordinates.
MISS = 1e-6
BLOCK = 2048
#: Shingles of the sets that one side of a cell holds on average when texts are confirmed (8 bytes each).
SET_BUDGET = 1 << 22
#: Coordinates compared before pairs that fall short are dropped.
_STRIDE = 8
_SEEDS = np.random.default_rng(7).integers(1, 1 << 32, (2, COORDS), dtype=np.uint64).astype(np.uint32)
_MULT = _SEEDS[0] | np.uint32(1)
_XOR = _SEEDS[1]


def matches(percent: int) -> int:
    """The number of coordinates on which documents of this similarity agree, but for a chance below ``MISS``."""
    p, below = percent / 100, 0.0
    for t in range(COORDS + 1):
        below += comb(COORDS, t) * p**t * (1 - p) ** (COORDS - t)
        if below > MISS:
            return max(1, t)
    return COORDS


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, COORDS) keys of coordinate-value pairs and the min-hashes themselves; no set may be empty."""
    sizes = np.array([len(s) for s in sets])
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    least = np.empty((COORDS, len(sets)), np.uint32)
    work, half = np.empty_like(flat), np.empty_like(flat)
    for k in range(COORDS):
        np.bitwise_xor(flat, _XOR[k], out=work)
        work *= _MULT[k]
        np.right_shift(work, 15, out=half)
        work ^= half
        work *= np.uint32(0x2C1B3C6D)
        least[k] = np.minimum.reduceat(work, at)
    keys = scan.mix((np.arange(COORDS, dtype=np.uint64)[:, None] << np.uint64(32)) | least)
    return np.ascontiguousarray(keys.T), np.ascontiguousarray(least.T)


def _sketch_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for part in scan.slices(batch.column(1)):
                w, _, _ = scan.words(part, lower=True)
                sets = scan.shingle_sets(w, shingle)
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                key_a, key_b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                coords: list = [None] * len(sets)
                sigs: list = [None] * len(sets)
                if len(full):
                    for k in full:
                        key_a[k] = sets[k].sum(dtype=np.uint64)
                        key_b[k] = scan.mix(sets[k] ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
                    posted, short = _signatures([sets[k] for k in full])
                    for row, k in enumerate(full):
                        coords[k], sigs[k] = posted[row].view(np.int64), short[row].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(part.lo, part.hi - part.lo), pa.array(n), pa.array(key_a.view(np.int64)), pa.array(key_b.view(np.int64)), pa.array(coords, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                    ["doc_id", "n_shingles", "key_a", "key_b", "coords", "sig"],
                )

    return run


def sketches(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """doc_id, n_shingles, two set keys, coordinate keys and min-hashes of each row."""
    return pick(docs, doc_id="bigint", text="string").mapInArrow(_sketch_batches(shingle), "doc_id long, n_shingles long, key_a long, key_b long, coords array<long>, sig binary")


def confirm(docs: DataFrame, pairs: DataFrame, percent: int, shingle: int = 5, per_group: int = 1000) -> DataFrame:
    """Of ``pairs`` (hub, member), those with 100 * shared >= percent * union on full sets.

    The hub's text is sent once to each group of about ``per_group`` members.
    """
    pairs = pairs.select("hub", "member").distinct()
    spread = pairs.groupBy("hub").agg((F.count("*") / per_group).cast("int").alias("salts"))
    members = pairs.join(spread, "hub").select("hub", F.pmod(F.xxhash64("member"), F.col("salts") + 1).cast("int").alias("salt"), F.col("member").alias("doc_id"), F.lit(1).alias("role"))
    hubs = spread.select("hub", F.explode(F.sequence(F.lit(0), "salts")).alias("salt"), F.col("hub").alias("doc_id"), F.lit(0).alias("role"))
    texts = pick(docs, doc_id="bigint", text="string")
    # sorted and merged at any size: the texts are the large side, and the plan stays the same
    dealt = members.unionByName(hubs).join(texts.hint("merge"), "doc_id").select("hub", "salt", "role", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub_sets, at = [], None
        for batch in batches:
            hub, salt, role, ids = (batch.column(k).to_numpy() for k in range(4))
            a, b = [], []
            for part in scan.slices(batch.column(4)):
                w, _, _ = scan.words(part, lower=True)
                for row, own in enumerate(scan.shingle_sets(w, shingle), part.lo):
                    if at != (hub[row], salt[row]):
                        hub_sets, at = [], (hub[row], salt[row])
                    if role[row] == 0:
                        hub_sets.append(own)
                    elif any(alike(own, x, percent) for x in hub_sets):
                        a.append(hub[row])
                        b.append(ids[row])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["hub", "member"])

    return dealt.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role").mapInArrow(run, "hub long, member long")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable over undirected ``edges`` (hub, member).

    Large-star and small-star steps by turns: each links the neighbours of a node to
    the least of them, which keeps components and adds no edge.  Paths shrink by more
    than half, so rounds grow with the logarithm of the longest; they end only when
    every node but the least of its component has one edge, to that least.  Each
    round is cut from its lineage.
    """
    nodes = edges.select(F.col("hub").alias("node")).union(edges.select("member")).distinct()
    links = stored(edges.where("hub <> member").select(F.greatest("hub", "member").alias("v"), F.least("hub", "member").alias("u")).distinct(), "edges")

    def stars(links: DataFrame) -> bool:
        ends = links.select(F.col("v").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("top")).union(links.select("u", F.lit(0), F.lit(1)))
        return ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("top").alias("top")).where("low > 1 or low = 1 and top = 1").isEmpty()

    while not stars(links):
        least = links.select("u", F.col("u").alias("m")).union(links.select("v", "u")).groupBy("u").agg(F.min("m").alias("m"))
        large = stored(links.join(least, "u").select("v", F.col("m").alias("u")).distinct(), "edges")
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        others = large.join(lowest, "v").where("u <> m").select("u", "m")
        links = stored(lowest.union(others).toDF("v", "u").distinct(), "edges")
    return stored(nodes.join(links, nodes["node"] == links["v"], "left").select("node", F.coalesce("u", "node").alias("label")), "labels")


def _alike(coord: int, split: bool, percent: int, rows: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one list that may join two components, by size, collisions and first common coordinate."""
    label, n, side, sig, mask = (rows[k] for k in ("label", "n", "side", "sig", "mask"))
    if len(label) < 2 or (label == label[0]).all():
        return
    least = matches(percent)
    bits = np.uint32(1) << np.arange(COORDS, dtype=np.uint32)
    step = max(1, (1 << 22) // len(label))
    for lo in range(0, len(label) - 1, step):
        hi = min(lo + step, len(label))
        ok = label[lo:hi, None] != label[None, lo + 1 :]
        ok &= np.arange(lo, hi)[:, None] < np.arange(lo + 1, len(label))[None, :]
        ok &= 100 * np.minimum(n[lo:hi, None], n[None, lo + 1 :]) >= percent * np.maximum(n[lo:hi, None], n[None, lo + 1 :])
        if split:
            ok &= side[lo:hi, None] != side[None, lo + 1 :]
        i, j = np.nonzero(ok)
        i, j = lo + i, lo + 1 + j
        for at in range(0, len(i), 1 << 16):
            x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            had = np.zeros(len(x), np.int64)
            for k in range(0, COORDS, _STRIDE):
                had += (sig[x, k : k + _STRIDE] == sig[y, k : k + _STRIDE]).sum(1)
                open_pairs = had + COORDS - min(COORDS, k + _STRIDE) >= least
                x, y, had = x[open_pairs], y[open_pairs], had[open_pairs]
            posted = (mask[x] & mask[y])[:, None] & bits
            own = ((sig[x] == sig[y]) & (posted != 0)).argmax(1) == coord
            if own.any():
                yield x[own], y[own]


def _by_list(work, with_text: bool, shingle: int):
    """Calls ``work(key, coord, split, rows)`` with the rows of each (key, cell), which come sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        at = None

        def close() -> Iterator[pa.RecordBatch]:
            rows = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
            yield from work(at[0], at[3], at[1] != at[2], rows)

        for batch in batches:
            key, i, j, coord, rep, label, n, side = (batch.column(k).to_numpy() for k in range(8))
            cols = {"rep": rep, "label": label, "n": n, "side": side, "sig": np.frombuffer(b"".join(batch.column(8).to_pylist()), np.uint32).reshape(-1, COORDS), "mask": batch.column(9).to_numpy().astype(np.uint32)}
            if with_text:
                sets = np.empty(batch.num_rows, object)
                for part in scan.slices(batch.column(10)):
                    w, _, _ = scan.words(part, lower=True)
                    for k, own in enumerate(scan.shingle_sets(w, shingle), part.lo):
                        sets[k] = own
                cols["set"] = sets
            edge = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for lo, hi in zip(np.r_[0, edge], np.r_[edge, len(key)], strict=True):
                if hi <= lo:
                    continue
                now = (key[lo], i[lo], j[lo], coord[lo])
                if at is not None and now[:3] != at[:3]:
                    yield from close()
                    held.clear()
                at = now
                held.append({k: v[lo:hi] for k, v in cols.items()})
        if held:
            yield from close()

    return run


def _flag(percent: int):
    """The rows of a list that have a partner."""

    def work(key: int, coord: int, split: bool, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        some = [np.unique(np.concatenate(pair)) for pair in _alike(coord, split, percent, rows)]
        if some:
            at = np.unique(np.concatenate(some))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), key)), pa.array(np.full(len(at), coord), pa.int32()), pa.array(rows["rep"][at]), pa.array(rows["label"][at]), pa.array(rows["mask"][at].astype(np.int64))], ["key", "coord", "rep", "label", "mask"])

    return _by_list(work, False, 0)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have the wanted similarity; an empty one is like nothing."""
    least, most = sorted((len(a), len(b)))
    if not least or 100 * least < percent * most:
        return False
    shared = shared_size(a, b)
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def shared_size(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted sets have in common."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _join_lists(percent: int, shingle: int):
    """Confirms pairs on full sets until a list's components are joined: no more links than rows."""

    def work(key: int, coord: int, split: bool, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, root = np.unique(rows["label"], return_inverse=True)
        above = list(range(int(root.max()) + 1))
        ids, sets = rows["rep"], rows["set"]

        def top(x: int) -> int:
            while above[x] != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        a, b = [], []
        for x, y in _alike(coord, split, percent, rows):
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                p, q = top(int(root[i])), top(int(root[j]))
                if p == q:
                    continue
                if alike(sets[i], sets[j], percent):
                    above[max(p, q)] = min(p, q)
                    a.append(min(ids[i], ids[j]))
                    b.append(max(ids[i], ids[j]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["hub", "member"])

    return _by_list(work, True, shingle)


def prefixes(reps: DataFrame, percent: int) -> DataFrame:
    """rep, mask, coord, key of the lists that a document is posted in: its rarest coordinate-value pairs."""
    least = matches(percent)
    posts = reps.select(F.col("doc_id").alias("rep"), F.posexplode("coords").alias("coord", "key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    by_rarity = posts.join(shared, "key").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("n", "key", "coord"))).alias("x"))  # COORDS entries at most
    first = by_rarity.where(F.size("x") >= least).select("rep", F.slice("x", F.lit(1), F.size("x") - (least - 1)).alias("x"))
    mask = F.aggregate("x", F.lit(0).cast("bigint"), lambda bits, e: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), e["coord"])))
    return first.withColumn("mask", mask).select("rep", "mask", F.explode("x").alias("e")).select("rep", "mask", "e.coord", "e.key")


def near_components(docs: DataFrame, percent: int = 85, shingle: int = 5, block: int = BLOCK, budget: int = SET_BUDGET) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    ``percent`` is the least similarity in hundredths.
    """
    sketch = stored(sketches(docs, shingle), "sketch")
    full = sketch.where("n_shingles > 0")
    same = ["key_a", "key_b", "n_shingles"]
    classes = full.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    # of rows that share a doc_id the class of the least keys gives the signature
    chosen = classes.where("rep is not null").groupBy("rep").agg(F.min(F.struct(*same)).alias("x")).select(F.col("rep").alias("doc_id"), "x.*")
    reps = stored(full.join(chosen, ["doc_id", *same], "left_semi").dropDuplicates(["doc_id"]), "reps")
    posts = stored(prefixes(reps, percent), "postings")

    lists = posts.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).where("n > 1").select("key", "pivot")
    met = posts.join(lists, "key").where("rep <> pivot").groupBy("rep", "pivot").agg(F.count("*").alias("hits"))
    first = met.groupBy("rep").agg(F.max(F.struct("hits", (-F.col("pivot")).alias("back"))).alias("best")).select((-F.col("best.back")).alias("hub"), F.col("rep").alias("member"))
    links = stored(confirm(docs, stored(first, "first"), percent, shingle), "links")
    labels = components(links)

    labelled = posts.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "mask", "coord", "key", F.coalesce("label", "rep").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("n")).where("least <> most")
    facts = reps.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sig")
    columns = ["key", "i", "j", "coord", "rep", "label", "n", "side", "sig", "mask"]

    def celled(rows: DataFrame, cells: DataFrame) -> DataFrame:
        """Rows dealt by list and, in lists of several blocks, by pairs of blocks."""
        rows = rows.join(cells, "key").withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).join(facts, "rep")
        return rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("side", "_other")).withColumn("j", F.greatest("side", "_other"))

    by_count = F.ceil(F.col("n") / block).cast("int")
    sorted_by_list = lambda rows: rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    flagged = sorted_by_list(celled(labelled, mixed.select("key", by_count.alias("blocks"))).select(*columns)).mapInArrow(_flag(percent), "key long, coord int, rep long, label long, mask long").distinct()
    flagged = stored(flagged, "flagged")
    if not flagged.isEmpty():
        texts = pick(docs, doc_id="bigint", text="string").withColumnRenamed("doc_id", "rep").hint("merge")
        # a flagged document's text is sent once for each of its lists that still hold two components, and each block of
        # them; blocks follow the sets' sizes too, so long texts are no heavier a cell than short ones
        weight = flagged.join(facts.select("rep", F.col("n").alias("_n")), "rep").groupBy("key").agg(F.count("*").alias("n"), F.sum("_n").alias("_n"))
        cells = weight.select("key", F.greatest(by_count, F.ceil(F.col("_n") / budget).cast("int")).alias("blocks"))
        again = celled(flagged, cells).join(texts, "rep")
        more = sorted_by_list(again.select(*columns, "text")).mapInArrow(_join_lists(percent, shingle), "hub long, member long")
        links = stored(links.unionByName(more.distinct()), "links")
        labels = components(links)

    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("key_a", "key_b", "n_shingles", F.coalesce("label", "rep").alias("label"))
    out = sketch.select("doc_id", "n_shingles", "key_a", "key_b").join(named, ["key_a", "key_b", "n_shingles"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over the whole of ``documents``, at similarity 0.85."""
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
