"""Writers of published forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.functions.expr import search_name


def package_rows(df: DataFrame, kind: str, per_file: int = 100_000) -> DataFrame:
    """city_id, part and the one line of JSON that its file holds.

    A city of more than ``per_file`` rows is dealt to several parts by its stop ids, so
    that no row of the result holds more than about so many.
    """
    parts = df.groupBy("city_id").agg(F.ceil(F.count("*") / per_file).alias("_parts"))
    dealt = df.join(parts, "city_id").withColumn("part", F.pmod(F.xxhash64("stop_id"), F.col("_parts")).cast("int"))
    if kind == "stops":
        item = F.struct(search_name("stop_name").alias("k"), F.col("stop_id").alias("id"), F.col("stop_name").alias("name"), F.col("stop_lat").alias("latitude"), F.col("stop_lon").alias("longitude"))
        rows = dealt.groupBy("city_id", "part").agg(F.array_sort(F.collect_list(item)).alias("x"))
        shown = F.transform("x", lambda s: F.struct(s["id"].alias("id"), s["name"].alias("name"), s["k"].alias("search_name"), s["latitude"].alias("latitude"), s["longitude"].alias("longitude")))
        return rows.select("city_id", "part", F.to_json(shown).alias("value"))
    item = F.struct(F.col("departure_time").alias("t"), F.col("trip_id").alias("p"), F.col("stop_sequence").alias("q"), F.col("route_id").alias("r"), F.col("destination").alias("h"))
    stops = dealt.groupBy("city_id", "part", "stop_id").agg(F.array_sort(F.collect_list(item)).alias("d"))
    rows = stops.groupBy("city_id", "part").agg(F.array_sort(F.collect_list(F.struct("stop_id", "d"))).alias("x"))
    return rows.select("city_id", "part", F.to_json(F.map_from_entries("x")).alias("value"))


def write_city_package(df: DataFrame, folder: str, kind: str) -> None:
    """One folder a city with its compact file, and the rows as Parquet beside it."""
    package_rows(df, kind).drop("part").write.mode("overwrite").partitionBy("city_id").text(f"{folder}/json")
    df.write.mode("overwrite").partitionBy("city_id").parquet(f"{folder}/parquet")


def stop_shards(df: DataFrame) -> DataFrame:
    """stop_id, shard: the manifest of stop shards, named by the id's SHA-256."""
    return df.select("stop_id", F.sha2(F.col("stop_id").cast("binary"), 256).alias("shard")).distinct()


def write_stop_shards(df: DataFrame, folder: str, per_part: int = 1_000_000) -> DataFrame:
    """Rows in 256 buckets by the first two digits of their shard, and the manifest.

    A bucket's folder holds one file for each of its parts; a stop of more than
    ``per_part`` rows is dealt to several parts.  So files do not grow with stops or
    tasks, and no task holds more than one part.  Manifest: stop_id, shard, bucket,
    part, n_rows and offset, the rows before in the part's file, which is ordered by shard.
    """
    marked = df.withColumn("shard", F.sha2(F.col("stop_id").cast("binary"), 256)).withColumn("bucket", F.substr("shard", F.lit(1), F.lit(2)))
    counts = marked.groupBy("shard").agg(F.ceil(F.count("*") / per_part).alias("_parts"))
    dealt = marked.join(counts, "shard").withColumn("part", F.pmod(F.xxhash64(*df.columns), F.col("_parts")).cast("int")).drop("_parts")
    placed = dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "shard")
    placed.write.mode("overwrite").partitionBy("bucket", "part").parquet(f"{folder}/shards")
    back = df.sparkSession.read.schema(dealt.schema).parquet(f"{folder}/shards")
    rows = back.groupBy("bucket", "part", "shard", "stop_id").agg(F.count("*").alias("n_rows"))
    before = Window.partitionBy("bucket", "part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = rows.select("stop_id", "shard", "bucket", "part", "n_rows", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("offset"))
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return df.sparkSession.read.parquet(f"{folder}/manifest")


def read_stop_shard(spark: SparkSession, folder: str, stop_id: str) -> DataFrame:
    """The rows of one stop: its manifest rows name the folders, whose files skip other shards by their bounds."""
    named = spark.read.parquet(f"{folder}/manifest").where(F.col("stop_id") == stop_id).select("shard", "bucket", "part").collect()  # one row a part
    if not named:
        return spark.read.parquet(f"{folder}/shards").where(F.lit(False)).drop("shard", "bucket", "part")
    rows = spark.read.parquet(*(f"{folder}/shards/bucket={r.bucket}/part={r.part}" for r in named))
    return rows.where(F.col("shard") == named[0].shard).drop("shard")


def city_manifest(packages: list[DataFrame], cities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """City rows with stop counts in the order of (search name, id), and ids that two branches claim."""
    counts = None
    for k, p in enumerate(packages):
        one = p.groupBy("city_id").agg(F.count_distinct("stop_id").alias("stop_count")).withColumn("branch", F.lit(k))
        counts = one if counts is None else counts.unionByName(one)
    clash = counts.groupBy("city_id").agg(F.count("*").alias("n")).where("n > 1").select("city_id")
    rows = counts.join(cities.select("city_id", "name"), "city_id").select("city_id", "name", "stop_count", F.concat(F.lit("stops/"), "city_id", F.lit(".json")).alias("url"), search_name("name").alias("search_name"))
    return rows.orderBy("search_name", "city_id"), clash
