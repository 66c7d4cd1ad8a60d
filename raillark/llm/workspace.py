"""Shared scratch space of a job: the folder that ``spark.checkpoint.dir`` names.

Tables are cut from their lineage by writing them there, so that a lost
executor costs a re-read and no recomputation.  Only where the session names no
folder (tests, a notebook) is a temporary one made, and only in a local session.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, created only where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    have = spark.sparkContext.getCheckpointDir()
    if not have:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        have = spark.sparkContext.getCheckpointDir()
    return have.rstrip("/")


#: Paths that this process has named, in order.
_named: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    _named.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _named[-1]


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside go at the end; what is made of them must have been written by then."""
    had = len(_named)
    try:
        yield
    finally:
        while len(_named) > had:
            remove(spark, _named.pop())


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files when they end; for results that are read once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if had is None else spark.conf.set(name, had)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def pick(docs: DataFrame, **wanted: str) -> DataFrame:
    """Columns by exact name, cast; a column that is absent reads as null.

    Extra columns never reach an operator, so clashing names cannot matter.
    """
    have = dict(docs.dtypes)
    out = []
    for name, kind in wanted.items():
        if have.get(name) == kind:  # as it is: an alias would keep two equal exchanges from being one
            out.append(docs[f"`{name}`"])
        else:
            out.append((docs[f"`{name}`"].cast(kind) if name in have else F.lit(None).cast(kind)).alias(name))
    return docs.select(*out)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column of ``docs`` has it."""
    have = {c.lower() for c in docs.columns}
    while name.lower() in have:
        name += "_"
    return name
