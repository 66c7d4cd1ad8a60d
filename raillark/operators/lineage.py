"""Cutting a plan's lineage, and scratch paths, in the folder that the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder; only a local session without one gets a temporary folder."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read from there; the shuffle files of its making go when it is written."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, had = scratch(spark, name), df.sparkSession.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(key) if had is None else spark.conf.set(key, had)
    return spark.read.schema(df.schema).parquet(path)
