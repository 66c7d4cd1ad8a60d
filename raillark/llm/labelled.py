"""Labelled documents for classifiers: all of them, or bounded, repeatable samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raillark.llm import scan
from raillark.llm.workspace import pick, stored


def part_of(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 4; part 2 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)).cast("int")


def labelled(docs: DataFrame, labels: DataFrame, target: str) -> DataFrame:
    """doc_id, part, y of every labelled document that is there, but for part 2."""
    known = pick(labels, doc_id="bigint", **{target: "int"}).where(f"doc_id is not null and {target} in (0, 1)").groupBy("doc_id").agg(F.max(target).alias("y"))
    known = known.withColumn("part", part_of(F.col("doc_id"))).where("part <> 2")
    return stored(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "labels")  # of a known size


def sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int, max_chars: int) -> tuple[DataFrame, np.ndarray]:
    """doc_id, part, y and the documents' columns of at most ``per_class`` rows of each label; the weight of either label.

    Only labels whose document is there, with up to ``max_chars`` characters, can be
    drawn, so no other label takes a place in the sample.  Rows are taken in the order of a hash of
    their id, never from part 2.  The sample is bounded, so it is small enough to send
    to every task.  A row of label y stands for ``weight[y]`` labelled documents (of any length): 1 where
    all of them are taken.
    """
    there = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.length(F.coalesce("text", F.lit("")))).alias("chars"))
    known = pick(labels, doc_id="bigint", **{target: "int"}).where(f"doc_id is not null and {target} in (0, 1)").groupBy("doc_id").agg(F.max(target).alias("y"))
    known = known.withColumn("part", part_of(F.col("doc_id"))).where("part <> 2").withColumn("order", F.xxhash64("doc_id"))
    known = stored(known.join(there, "doc_id"), "labelled")
    chosen = [known.where((F.col("y") == y) & (F.col("chars") <= max_chars)).orderBy("order", "doc_id").limit(per_class) for y in (0, 1)]
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    weight = np.array([max(1.0, counts.get(y, 0) / max(1, per_class)) for y in (0, 1)])
    few = F.broadcast(chosen[0].unionByName(chosen[1]).drop("order", "chars"))  # 2 * per_class rows at most
    return docs.where(F.length(F.coalesce("text", F.lit(""))) <= max_chars).join(few, "doc_id"), weight


def scores(docs: DataFrame, columns: dict[str, str], out: str, score: Callable[[scan.Slice, pa.RecordBatch], dict[str, np.ndarray]], limit: int = 1 << 19) -> DataFrame:
    """``score`` over slices of every text; doc_id and the text lead the columns."""
    schema = f"doc_id long, {out}"
    names = ["doc_id", *(x.split()[0] for x in out.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.slices(batch.column(1), limit):
                rows = batch.slice(part.lo, part.hi - part.lo)
                found = score(part, rows)
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(found[k]) for k in names[1:])], names)

    return pick(docs, doc_id="bigint", text="string", **columns).mapInArrow(run, schema)
