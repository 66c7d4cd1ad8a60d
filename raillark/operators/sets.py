"""Set operations over services, feeds, releases and providers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Weekday columns, Monday first.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def dates(spark, first: str, last: str) -> DataFrame:
    """service_date (yyyyMMdd) and weekday column name of each day."""
    day = F.explode(F.sequence(F.to_date(F.lit(first), "yyyyMMdd"), F.to_date(F.lit(last), "yyyyMMdd"))).alias("d")
    names = F.array(*map(F.lit, WEEKDAYS))
    return spark.range(1).select(day).select(F.date_format("d", "yyyyMMdd").alias("service_date"), F.get(names, F.weekday("d")).alias("weekday"))


def active_services(calendar: DataFrame, exceptions: DataFrame, days: DataFrame, variant: str = "union") -> DataFrame:
    """Services active on each day.

    ``union``: weekly services in range without a removal, and all additions.
    ``exception_first``: any exception of the day decides; only type 1 is active.
    ``additions``: additions alone.
    """
    added = exceptions.where("exception_type = 1").join(days, "service_date", "left_semi").select("service_id", "service_date")
    if variant == "additions":
        return added.distinct()
    flags = ", ".join(f"'{d}', {d}" for d in WEEKDAYS)
    weekly = calendar.selectExpr("service_id", "start_date", "end_date", f"stack(7, {flags}) as (weekday, runs)").where("runs = 1")
    weekly = weekly.join(days, "weekday").where(F.col("service_date").between(F.col("start_date"), F.col("end_date"))).select("service_id", "service_date")
    stop = exceptions if variant == "exception_first" else exceptions.where("exception_type = 2")
    return weekly.join(stop.select("service_id", "service_date"), ["service_id", "service_date"], "left_anti").union(added).distinct()


def merge_city(feeds: list[DataFrame], key: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of all feeds, one for each id, and the ids whose rows differ (an error)."""
    every = reduce(DataFrame.unionByName, feeds).select(key, *values).distinct()
    clash = every.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    return every.join(clash, key, "left_anti"), clash


def preserve(previous: DataFrame, new: DataFrame, key: str = "city_id") -> DataFrame:
    """The new rows, and previous rows of keys that the new ones lack."""
    return new.unionByName(previous.join(new.select(key).distinct(), key, "left_anti"))


def lost(previous: DataFrame, candidate: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Keys of the previous release that the candidate lacks and that are not allowed to go."""
    return previous.select(key).subtract(candidate.select(key)).join(allowed, key, "left_anti")


def provider_cities(stops: DataFrame, modes: DataFrame, providers: list[str]) -> DataFrame:
    """Cities of providers, from their stops or their modes."""
    own = lambda df: df.where(F.col("provider_id").isin(providers)).select("provider_id", "city_id")
    return own(stops).union(own(modes)).distinct()


def rebuild_city(provider_stops: DataFrame, provider_modes: DataFrame, cities: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """City stops, and each city's mode (of the first provider by id), rebuilt from provider rows."""
    pick = (lambda df: df.where(F.col("city_id").isin(cities))) if cities else (lambda df: df)
    modes = pick(provider_modes).groupBy("city_id").agg(F.min_by("mode", "provider_id").alias("mode"))
    return pick(provider_stops).select("city_id", "stop_id").distinct(), modes


def replace_provider(tables: dict[str, DataFrame], entities: DataFrame, providers: list[str], new: dict[str, DataFrame], new_entities: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Replaces the rows that only ``providers`` own; rows that others share stay.

    ``tables`` and ``new`` are keyed by entity type; each holds ``key_1``.
    """
    mine = entities.where(F.col("provider_id").isin(providers))
    others = entities.where(~F.col("provider_id").isin(providers))
    out = {}
    for kind, rows in tables.items():
        own = mine.where(F.col("entity_type") == kind).select("key_1").distinct()
        kept = others.where(F.col("entity_type") == kind).select("key_1").distinct()
        gone = own.join(kept, "key_1", "left_anti")
        stay = rows.join(gone, "key_1", "left_anti")
        fresh = new.get(kind)
        out[kind] = stay if fresh is None else stay.unionByName(fresh.join(stay.select("key_1"), "key_1", "left_anti"))
    return out, others.unionByName(new_entities)
