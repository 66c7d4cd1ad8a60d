"""Threshold-scaled document sketches (operator 5), DataFrame functions only.

A sketch keeps every hash of a five-word shingle that lies below a fixed fraction
of the hash range.  Unlike a fixed-size sample, two sketches of any sizes can be
merged by a union and compared by an intersection, so containment between a
sentence and a book is as easy as likeness between two pages.

Defined results: a null text counts as empty; a text of one to four words gives
its whole word sequence as its one shingle; a text without words has no shingle.
Two equal fingerprints are alike 1.0; two sketches without any hash are alike
0.0.  The next document is the one with the next larger ``doc_id`` (after the
last: the first); of rows that share it, the least text.  A row whose ``doc_id`` is null
has no next document: its edited text only loses its last quarter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.llm.workspace import pick, stored

FRACTION = 1 / 8
SHINGLE = 5
_SPACES = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACES), lambda w: w != "")


def shingle_hashes(w: Column, size: int = SHINGLE) -> Column:
    """All shingle hashes of a word array, repeats included."""
    n = F.size(w)
    many = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    return F.when(n >= size, many).when(n > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))


def retained(hashes: Column, fraction: float = FRACTION) -> Column:
    """The distinct hashes below ``fraction`` of the range, in order."""
    limit = -(1 << 63) + int((1 << 64) * fraction) - 1
    return F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h <= F.lit(limit).cast("bigint"))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two sketches of one fraction."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first sketch's shingles that the second holds; null if it holds none."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two documents together."""
    return F.array_sort(F.array_union(a, b))


def fingerprint(key: Column, sketch: Column) -> Column:
    """Text form: the hash of the whole text, then the sketch's hashes in hexadecimal."""
    return F.concat_ws(":", F.lower(F.hex(key)), F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ""))


def with_sketch(df: DataFrame, text: str, sketch: str, key: str, fraction: float = FRACTION) -> DataFrame:
    """Adds the sketch of column ``text`` and the hash of the whole text, each step once."""
    out = df.withColumn("_words", words(F.col(text))).withColumn(sketch, retained(shingle_hashes(F.col("_words")), fraction)).drop("_words")
    return out.withColumn(key, F.xxhash64(text))


def next_ids(ids: DataFrame) -> DataFrame:
    """doc_id, next_id in ascending order, the last one followed by the first.

    Ids are range-partitioned and ordered within each range; only the ranges'
    first ids, one row a partition, are ordered in a single task.
    """
    dealt = stored(ids.where("doc_id is not null").distinct().repartitionByRange("doc_id").select("doc_id", F.spark_partition_id().alias("part")), "ids")
    firsts = dealt.groupBy("part").agg(F.min("doc_id").alias("first"))
    every = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first").over(Window.orderBy("first")), F.min("first").over(every)).alias("after"))
    lead = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return dealt.select("doc_id", "part", lead.alias("own")).join(after, "part").select("doc_id", F.coalesce("own", "after").alias("next_id"))


def edited_pairs(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Every row's fingerprint, its edited text's, and their likeness."""
    base = pick(docs, doc_id="bigint", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    order = next_ids(base.select("doc_id"))
    quarter = base.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 4)).alias("k"))
    order = order.join(quarter, "doc_id").select(F.col("doc_id").alias("prev_id"), "next_id", F.col("k").cast("int").alias("k"))
    # texts are dealt by id once: both joins below read this one exchange, so sketches are made after it
    own = base.where("doc_id is not null").repartition("doc_id")
    ahead = own.withColumnRenamed("doc_id", "next_id").hint("merge").join(order, "next_id")
    ahead = with_sketch(ahead, "text", "sketch", "key", fraction)
    heads = ahead.select("prev_id", F.struct(F.col("text").substr(F.lit(1), F.col("k")).alias("head"), "key", "sketch").alias("next"))
    heads = heads.groupBy("prev_id").agg(F.min("next").alias("next"))
    both = own.hint("merge").join(heads, own["doc_id"] == heads["prev_id"], "left").drop("prev_id")
    lone = base.where("doc_id is null").withColumn("next", F.lit(None).cast(both.schema["next"].dataType))
    both = with_sketch(both.unionByName(lone), "text", "sketch", "key", fraction).withColumn("n_chars", F.length("text").cast("bigint"))
    keep = (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    both = both.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), keep), F.coalesce("next.head", F.lit(""))))
    both = with_sketch(both, "edited", "edited_sketch", "edited_key", fraction)
    same = lambda key, sketch: (F.col("key") == F.col(key)) & (F.col("sketch") == F.col(sketch))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("key"), F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_key"), F.col("edited_sketch")).alias("edited_fingerprint"),
        F.when(same("edited_key", "edited_sketch"), 1.0).otherwise(likeness(F.col("sketch"), F.col("edited_sketch"))).alias("near_edited"),
        F.when(same("next.key", "next.sketch"), 1.0).otherwise(F.coalesce(likeness(F.col("sketch"), F.col("next.sketch")), F.lit(0.0))).alias("near_next"),
        F.size("sketch").alias("n_retained"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_in_edited"),
    )


def op5_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over the whole of ``documents``."""
    return edited_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
