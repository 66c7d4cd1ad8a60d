"""Benchmark decontamination by a broadcast set of n-grams (operator 13), DataFrame functions only.

Test items are lower-cased and cut into windows of ``NGRAM`` words; an item of fewer
words is one window.  The distinct windows, with the items that hold them, are a small
table whose size is measured before it is broadcast.  A document's words are read once:
the hash of every window of each length that occurs in the set is exploded and looked
up, and a hit is verified on the words themselves in the same stage, so that the
document's words are never copied to its windows.  What is shuffled are one row a document and
the hits.

A set over ``BROADCAST_BYTES`` is not broadcast: hashes alone are joined by shuffle,
and the documents with a match are read again to verify it.  Both ways give the same rows.

Defined results: null and empty texts have no words and no hits; an item without words has no window; rows
that share an ``item_id`` are one item with several texts; an item without id marks words but is not
named; rows that share a ``doc_id`` are judged each by its own text; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.llm.workspace import free_name, pick, stored

NGRAM = 10
BROADCAST_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is no letter or digit of ASCII; everything beyond ASCII belongs to words.
_GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words (A to Z alone change)."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _GAP), lambda w: w != "")


def _hash(w: Column, at: Column, size: int) -> Column:
    """Hash of the ``size`` words from index ``at``."""
    return F.xxhash64(F.lit(size), *(F.get(w, at + k) for k in range(size)))


def window_hashes(w: Column, size: int) -> Column:
    """A hash for each window of ``size`` words, in order."""
    return F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: _hash(w, i, size))).otherwise(F.array().cast("array<bigint>"))


def grams(benchmark: DataFrame, size: int = NGRAM) -> DataFrame:
    """gram (its words), hash, items: the distinct windows of a benchmark and the ids, as text, of the items that hold each."""
    items = pick(benchmark, item_id="string", text="string").select("item_id", words(F.coalesce("text", F.lit(""))).alias("w")).where(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(size))
    each = items.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - width), lambda i: F.slice("w", i + 1, width))).alias("gram"))
    # collect_set drops a null id
    out = each.groupBy("gram").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    by_size = F.when(F.size("gram") == size, _hash(F.col("gram"), F.lit(0), size))
    for k in range(1, size):
        by_size = by_size.when(F.size("gram") == k, _hash(F.col("gram"), F.lit(0), k))
    return out.withColumn("hash", by_size)


def _windows(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, key, w, n_words and, of each row, all window hashes, one length after the other."""
    base = docs.select("doc_id", F.xxhash64("text").alias("key"), words(F.coalesce("text", F.lit(""))).alias("w"))
    return base.withColumn("hashes", F.concat(*(window_hashes(F.col("w"), k) for k in lengths), F.array(F.lit(None).cast("bigint"))))


def _start(at: Column, size: Column, n_words: Column, lengths: list[int]) -> Column:
    """The word at which the window begins whose hash is number ``at``, if it has ``size`` words."""
    before, out = F.lit(0), F.when(F.lit(False), F.lit(0))
    for k in lengths:
        out = out.when(size == k, at - before)
        before = before + F.greatest(n_words - (k - 1), F.lit(0))
    return out


def hits(docs: DataFrame, table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, key, n_words, start, size, items: verified windows, and one row a document whose start is null.

    ``docs`` has doc_id and text; ``table`` comes from :func:`grams`.
    """
    table = stored(table, "grams")
    # at most ten lengths; about 16 bytes of overhead a word and 100 a window
    facts = table.groupBy(F.size("gram").alias("size")).agg(F.sum(F.octet_length(F.array_join("gram", " ")) + 16 * F.size("gram") + F.octet_length(F.array_join("items", " ")) + 16 * F.size("items") + 100).alias("bytes")).collect()
    lengths = sorted((r["size"] for r in facts), reverse=True)
    cut = _windows(docs, lengths)
    named = table.select(F.col("hash").alias("_hash"), F.col("gram").alias("_gram"), F.col("items").alias("_items"))
    start = _start(F.col("at"), F.size("_gram"), F.col("n_words"), lengths)
    true_hit = lambda start: F.slice("w", F.greatest(start, F.lit(0)) + 1, F.size("_gram")) == F.col("_gram")
    out = ["doc_id", "key", "n_words", "start", "size", "items"]
    if sum(r["bytes"] for r in facts) <= limit:
        rows = cut.select("doc_id", "key", "w", F.size("w").alias("n_words"), F.posexplode_outer("hashes").alias("at", "hash"))
        rows = rows.join(F.broadcast(named), rows["hash"] == named["_hash"], "left")
        hit = F.col("_gram").isNotNull() & true_hit(start)
        rows = rows.where(F.col("hash").isNull() | hit)
        return rows.select("doc_id", "key", "n_words", start.alias("start"), F.size("_gram").alias("size"), F.col("_items").alias("items")).select(*out)
    rows = cut.select("doc_id", "key", F.size("w").alias("n_words"), F.posexplode_outer("hashes").alias("at", "hash"))
    found = rows.where("hash is not null").join(named.hint("merge"), rows["hash"] == named["_hash"])
    found = found.groupBy("doc_id", "key").agg(F.collect_set(F.struct(start.alias("start"), F.col("_gram"), F.col("_items"))).alias("found"))
    found = stored(found, "found").withColumnRenamed("doc_id", "_id").withColumnRenamed("key", "_key")
    again = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    again = again.join(found, again["doc_id"].eqNullSafe(found["_id"]) & (again["key"] == found["_key"]))
    again = again.select("doc_id", "key", words(F.coalesce("text", F.lit(""))).alias("w"), "found")
    checked = again.select("doc_id", "key", "w", F.size("w").alias("n_words"), F.explode("found").alias("x")).select("doc_id", "key", "w", "n_words", "x.*").where(true_hit(F.col("start")))
    none = F.lit(None)
    every = docs.select("doc_id", F.xxhash64("text").alias("key"), F.size(words(F.coalesce("text", F.lit("")))).alias("n_words"), none.cast("int").alias("start"), none.cast("int").alias("size"), none.cast("array<string>").alias("items"))
    return every.unionByName(checked.select("doc_id", "key", "n_words", "start", F.size("_gram").alias("size"), F.col("_items").alias("items")))


def judged(docs: DataFrame, benchmark: DataFrame, size: int = NGRAM, limit: int = BROADCAST_BYTES, spans: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted texts) of every row of ``docs``.

    With ``spans``, one row for each doc_id and text (column ``key`` has the text's
    hash) that has hits, and column ``spans``: disjoint ranges (lo, hi) of hit words.
    """
    rows = hits(pick(docs, doc_id="bigint", text="string"), grams(benchmark, size), limit)
    # repeated rows are counted before they meet; a document's windows are bounded by its text
    once = rows.groupBy("doc_id", "key", "n_words", "start", "size", "items").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("doc_id", "key").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    once = once.withColumn("lo", F.greatest("start", F.max(end).over(ahead))).withColumn("hi", end)
    new = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo"))
    facts = [
        F.max("n_words").cast("bigint").alias("n_words"),
        F.coalesce(F.sum(new), F.lit(0)).cast("bigint").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.sum(F.when(F.col("start").isNull(), F.col("n"))).alias("copies"),
    ]
    if spans:
        by_text = once.groupBy("doc_id", "key").agg(*facts, F.array_sort(F.collect_list(F.when(new.isNotNull(), F.struct("lo", "hi")))).alias("spans"))
        return by_text.where("n_hit > 0").drop("copies")
    by_text = once.groupBy("doc_id", "key").agg(*facts)
    return by_text.select("doc_id", "n_words", "n_hit", "items", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_")).drop("_")


def without(text: Column, spans: Column) -> Column:
    """``text`` less the words in ``spans`` and what follows each of them up to the next word."""
    own = F.filter(F.split(text, _GAP, -1), lambda w: w != "")
    gaps = F.split(text, _WORD, -1)  # one more than words
    gone = F.flatten(F.transform(spans, lambda s: F.sequence(s["lo"], s["hi"] - 1)))

    def joined(x: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(x["own"]) - 1), gone)
        return F.concat(F.get(x["gaps"], F.lit(0)), F.array_join(F.transform(kept, lambda i: F.concat(F.get(x["own"], i), F.get(x["gaps"], i + 1))), ""))

    # words and gaps are bound once: an expression named in an inner function is worked out for each of its elements
    return F.get(F.transform(F.array(F.struct(own.alias("own"), gaps.alias("gaps"))), joined), F.lit(0))


def cleaned(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", size: int = NGRAM, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with its columns; hit words are cut from the texts, or ("documents") rows with a hit go.

    A text that loses all its words stays, as what stood around them.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove must be 'spans' or 'documents'")
    found = judged(docs, benchmark, size, limit, spans=True)
    id_, key, spans = (free_name(docs, x) for x in ("_id", "_key", "_spans"))
    found = found.select(F.col("doc_id").alias(id_), F.col("key").alias(key), F.col("spans").alias(spans))
    same = docs["doc_id"].cast("bigint").eqNullSafe(found[id_]) & (F.xxhash64(docs["text"].cast("string")) == found[key])
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    both = docs.join(found, same, "left")
    both = both.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(without(F.col("text"), F.col(spans))))
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return both.select(*(f"`{c}`" for c in docs.columns))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over the whole of ``documents`` against the whole of ``benchmark``."""
    out = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    columns = ["doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")]
    return out.select(*columns, (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
#: The same in DuckDB SQL.
ORACLE = f"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
iw AS (SELECT item_id, w, least(len(w), {NGRAM}) AS l FROM (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, l, array_to_string(w[k:k + l - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS k FROM iw)),
x AS (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS k FROM dw, (SELECT DISTINCT l FROM g)),
h AS (SELECT r, k, l, item_id FROM (SELECT r, k, l, array_to_string(w[k:k + l - 1], ' ') AS gram FROM x) JOIN g USING (l, gram)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + l)) AS p FROM h) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN n USING (r) LEFT JOIN i USING (r)
"""
