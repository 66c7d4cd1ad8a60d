"""Data-quality checks: each returns the violating rows, none means passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raillark.functions.expr import haversine_m

REQUIRED = ("stops", "routes", "trips", "stop_times")


def check_feed(tables: dict[str, DataFrame], required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Row counts of the required tables that are missing or empty."""
    spark = next(iter(tables.values())).sparkSession
    counts = [tables[t].agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") if t in tables else spark.range(1).select(F.lit(t).alias("table_name"), F.lit(0).cast("bigint").alias("n")) for t in required]
    return reduce(DataFrame.unionByName, counts).where("n = 0")


def conflicting(df: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Keys with more than one distinct value."""
    return df.select(*key, *values).distinct().groupBy(*key).agg(F.count("*").alias("n_values")).where("n_values > 1")


def orphans(entities: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Ownership rows whose entity is in no table."""
    parts = [entities.where(F.col("entity_type") == kind).join(rows.select(F.col(key).alias("key_1")), "key_1", "left_anti").select("entity_type", "provider_id", "key_1") for kind, (rows, key) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def check_aliases(aliases: DataFrame, cities: DataFrame) -> DataFrame:
    """city_id (the alias), problem: aliases (alias_city_id, canonical_city_id) that bear the id of another city, or whose target is none."""
    known = cities.select("city_id").distinct()
    shadows = aliases.where("alias_city_id <> canonical_city_id").join(known, F.col("alias_city_id") == F.col("city_id"), "left_semi")
    lost = aliases.join(known, F.col("canonical_city_id") == F.col("city_id"), "left_anti")
    return shadows.select(F.col("alias_city_id").alias("city_id"), F.lit("alias_shadows").alias("problem")).unionByName(lost.select(F.col("alias_city_id").alias("city_id"), F.lit("alias_target").alias("problem")))


def check_departures(index: DataFrame, packages: DataFrame, manifest: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """city_id, problem: unknown or repeated cities, stops outside the package, counts that differ from the manifest or are 0, wrong aliases."""
    unknown = index.select("city_id").distinct().join(manifest.select("city_id"), "city_id", "left_anti").select("city_id", F.lit("unknown_city").alias("problem"))
    outside = index.select("city_id", "stop_id").distinct().join(packages.select("city_id", "stop_id"), ["city_id", "stop_id"], "left_anti").select("city_id", F.lit("stop_outside_package").alias("problem")).distinct()
    counts = index.groupBy("city_id").agg(F.count("*").alias("n"))
    wrong = manifest.join(counts, "city_id", "left").where((F.coalesce("n", F.lit(0)) != F.col("departure_count")) | (F.col("departure_count") == 0)).select("city_id", F.lit("count").alias("problem"))
    twice = manifest.groupBy("city_id").agg(F.count("*").alias("n")).where("n > 1").select("city_id", F.lit("repeated_city").alias("problem"))
    found = unknown.unionByName(outside).unionByName(wrong).unionByName(twice)
    return found if aliases is None else found.unionByName(check_aliases(aliases, manifest))


def check_packages(packages: DataFrame, cities: DataFrame, manifest: DataFrame, near_m: float = 8000.0) -> DataFrame:
    """city_id, problem: wrong counts, repeated ids, bad coordinates, no stop near the centre."""
    both = packages.join(cities.select("city_id", "latitude", "longitude"), "city_id")
    bad = F.count_if(~(F.col("stop_lat").between(-90, 90) & F.col("stop_lon").between(-180, 180)))
    facts = both.groupBy("city_id").agg(F.count("*").alias("n"), F.count_distinct("stop_id").alias("ids"), bad.alias("bad"), F.min(haversine_m("latitude", "longitude", "stop_lat", "stop_lon")).alias("near"))
    facts = manifest.select("city_id", "stop_count").join(facts, "city_id", "left")
    problems = F.array_compact(F.array(F.when(F.coalesce("n", F.lit(0)) != F.col("stop_count"), "count"), F.when(F.col("n") != F.col("ids"), "repeated_id"), F.when(F.col("bad") > 0, "coordinate"), F.when(F.col("near") > near_m, "no_stop_near_center")))
    return facts.select("city_id", F.explode(problems).alias("problem"))


def check_store(tables: dict[str, DataFrame], needed: tuple[str, ...]) -> DataFrame:
    """table_name, problem of needed relations that are missing or empty; each is looked at for one row."""
    spark = next(iter(tables.values())).sparkSession
    gone = spark.createDataFrame([(t, "missing") for t in needed if t not in tables], "table_name string, problem string")
    seen = [tables[t].limit(1).agg(F.count("*").alias("n")).where("n = 0").select(F.lit(t).alias("table_name"), F.lit("empty").alias("problem")) for t in needed if t in tables]
    return reduce(DataFrame.unionByName, seen, gone)


def check_sources(registry: DataFrame, candidate: DataFrame, switches: list[str]) -> DataFrame:
    """source_id, problem: needed feeds not in the candidate, repeated ids, and importable feeds (column ``importable``) without a ``path``."""
    on = (F.col("class") == "required") | ((F.col("class") == "conditional") & F.col("source_id").isin(switches or [""]))
    missing = registry.where(on).join(candidate.select("source_id"), "source_id", "left_anti").select("source_id", F.lit("missing").alias("problem"))
    twice = registry.groupBy("source_id").agg(F.count("*").alias("n")).where("n > 1").select("source_id", F.lit("repeated").alias("problem"))
    found = missing.unionByName(twice)
    if "importable" not in registry.columns:
        return found
    bare = registry.where(F.col("importable") & (F.trim(F.coalesce("path", F.lit(""))) == ""))
    return found.unionByName(bare.select("source_id", F.lit("no_path").alias("problem")))


def check_ids(rows: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """id, problem: ids of ``rows`` that ``expected`` lacks, the other way round, and ids that several rows have."""
    have, want = rows.groupBy(key).agg(F.count("*").alias("_n")), expected.select(F.col(key).alias("_want")).distinct()
    both = have.join(want, F.col(key) == F.col("_want"), "full")
    problems = F.array_compact(F.array(F.when(F.col("_want").isNull(), "unexpected"), F.when(F.col("_n").isNull(), "missing"), F.when(F.col("_n") > 1, "repeated")))
    return both.select(F.coalesce(key, "_want").alias("id"), F.explode(problems).alias("problem"))


def check_counts(tables: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """table_name, expected, actual where row counts differ from ``expected`` (table_name, expected)."""
    actual = reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("actual")).select(F.lit(t).alias("table_name"), "actual") for t, df in tables.items()])
    return expected.join(actual, "table_name", "left").where("actual is null or actual <> expected")
