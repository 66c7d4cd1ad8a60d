"""A training corpus from ``documents``: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages
the rows are written as Parquet and read again.  All but the last stage return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raillark.llm import line_dedup, near_dedup, packing, quality_rules, toxicity
from raillark.llm.workspace import free_name, fresh_path, passing, remove


#: Rows of an Arrow batch: texts are long, and a task holds several copies of a batch.
BATCH_ROWS = 1000


def light_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for this session, unless they are smaller already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    light_batches(spark)
    return quality_rules.kept_rows(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents over their language's toxicity threshold go."""
    light_batches(spark)
    return toxicity.clean_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line are cut; a document that loses all its words goes."""
    light_batches(spark)
    return line_dedup.cleaned(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest doc_id."""
    light_batches(spark)
    name = free_name(docs, "_id")
    kept = near_dedup.near_components(docs).where("kept").select(F.col("doc_id").alias(name))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept[name]), "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences of 4096 tokens."""
    light_batches(spark)
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("toxicity", toxic),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("best_fit_packing", pack),
]

#: A trained classifier and a tokenizer cannot be written in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; only the last one's table stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        with passing(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
