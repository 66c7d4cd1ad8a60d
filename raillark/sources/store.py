"""A store of provider tables: Parquet folders partitioned by ``provider_id``.

Each provider's rows lie in partitions of its own, also those of entities that others
have too, so replacing a provider writes its partitions alone and shared entities
stay with their other owners.  Readers see an entity once, from its first owner by id.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Key columns of the tables that are read one row an entity.
KEYS = {"stops": ["stop_id"], "routes": ["route_id"], "trips": ["trip_id"], "entities": ["entity_type", "provider_id", "key_1"]}


def write_providers(tables: dict[str, DataFrame], folder: str, providers: list[str]) -> None:
    """Replaces the partitions of ``providers`` in each table by its rows; other partitions are not touched.

    Rows of other providers are an error of the caller and are left out.  A second write
    of the same rows gives the same store.
    """
    for name, df in tables.items():
        path = f"{folder}/{name}"
        own = df.where(F.col("provider_id").isin(providers)).repartition("provider_id", F.pmod(F.xxhash64(*df.columns), F.lit(16)))
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("provider_id").parquet(path)
        here = {r[0] for r in own.select("provider_id").distinct().collect()}  # of the named providers
        for gone in sorted(set(providers) - here):  # no row replaces what is there
            own.where(F.lit(False)).drop("provider_id").coalesce(1).write.mode("overwrite").parquet(f"{path}/provider_id={gone}")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """All rows of a table with their ``provider_id``."""
    return spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}").withColumn("provider_id", F.col("provider_id").cast("string"))


def read_entities(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One row an entity: of several owners the first by ``provider_id``."""
    rows = read_table(spark, folder, name)
    keys = [k for k in KEYS[name] if k != "provider_id"]
    others = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col("provider_id")).alias("x"))
    return first.select(*keys, "x.*")


def replace_provider(spark: SparkSession, folder: str, tables: dict[str, DataFrame], memberships: DataFrame, provider: str) -> DataFrame:
    """Puts a provider's new tables into the store; city_id, stop_id of every city that it was or is in.

    ``memberships``: city_id, stop_id, provider_id of the new rows.  A city that no
    provider serves any more comes with a null stop.
    """
    served = f"{folder}/memberships"
    try:
        before = read_table(spark, folder, "memberships").where(F.col("provider_id") == provider).select("city_id").distinct().collect()  # a provider's cities
    except AnalysisException as missing:  # the first write of a store
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        before = []
    write_providers(tables | {"memberships": memberships}, folder, [provider])
    now = spark.read.parquet(served).select("city_id", "stop_id", F.col("provider_id").cast("string").alias("provider_id"))
    cities = now.where(F.col("provider_id") == provider).select("city_id").union(spark.createDataFrame(before, "city_id string")).distinct()
    return cities.join(now.select("city_id", "stop_id").distinct(), "city_id", "left")
