"""Aggregations over timetable and realtime rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.functions.expr import haversine_m, line_names, location_type, search_name
from raillark.operators.joins import canonical_stops


def lines_by_stop(calls: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """Distinct routes of each stop (canonical if ``stops`` is given) with names, agency and type."""
    served = calls.select("trip_id", "stop_id").join(trips.select("trip_id", "route_id"), "trip_id")
    if stops is not None:
        served = served.join(canonical_stops(stops).select("stop_id", "canonical_stop_id"), "stop_id").select(F.col("canonical_stop_id").alias("stop_id"), "route_id")
    named = routes.withColumn("names", line_names("short_name", "long_name")).where("names is not null")
    kind = F.coalesce(F.col("route_type").try_cast("int"), F.lit(3)).alias("route_type")
    return served.select("stop_id", "route_id").distinct().join(named, "route_id").select("stop_id", "route_id", "names", "agency_id", kind)


def city_lines(lines: DataFrame, city_stops: DataFrame) -> DataFrame:
    """Per city the lines over its stops, in the order of (search name of the first name, route)."""
    every = city_stops.join(lines, "stop_id").dropDuplicates(["city_id", "route_id"])
    entry = F.struct(search_name(F.col("names")[0]).alias("key"), "route_id", "names", "agency_id", "route_type")
    return every.groupBy("city_id").agg(F.array_sort(F.collect_list(entry)).alias("lines"))


def route_headsigns(trips: DataFrame) -> DataFrame:
    """Per route a map from direction to its first non-empty headsign in file order."""
    first = trips.where("headsign <> ''").groupBy("route_id", "direction_id").agg(F.min_by("headsign", F.struct("source_order", "trip_id")).alias("headsign"))
    return first.groupBy("route_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("direction_id", "headsign")))).alias("headsigns"))


def city_counts(departures: DataFrame) -> DataFrame:
    """Stops and departures of each city; cities without any do not appear."""
    return departures.groupBy("city_id").agg(F.count_distinct("stop_id").alias("stop_count"), F.count("*").alias("departure_count"))


def coverage_regions(points: DataFrame, pad: float = 0.015) -> DataFrame:
    """Box of each city's stops, padded, and their mean position."""
    lat, lon = F.col("stop_lat"), F.col("stop_lon")
    return points.groupBy("city_id").agg((F.min(lat) - pad).alias("min_lat"), (F.max(lat) + pad).alias("max_lat"), (F.min(lon) - pad).alias("min_lon"), (F.max(lon) + pad).alias("max_lon"), F.avg(lat).alias("center_lat"), F.avg(lon).alias("center_lon"), F.count("*").alias("n_stops"))


def duplicate_bins(stops: DataFrame) -> DataFrame:
    """Size of the largest group of one search name and one 0.01 degree position."""
    sizes = stops.groupBy(search_name("stop_name").alias("k"), F.bround("stop_lat", 2).alias("a"), F.bround("stop_lon", 2).alias("b")).agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("largest"))


def drop_unserved_twins(stops: DataFrame, served: DataFrame, apart_m: float = 150.0) -> DataFrame:
    """Removes an unserved stop near a served stop of the same name and 0.01 degree bin."""
    binned = stops.join(served.select("stop_id", F.lit(True).alias("_served")).distinct(), "stop_id", "left")
    binned = binned.withColumn("_k", search_name("stop_name")).withColumn("_a", F.bround("stop_lat", 2)).withColumn("_b", F.bround("stop_lon", 2))
    live = binned.where("_served").select("_k", "_a", "_b", F.col("stop_lat").alias("_lat"), F.col("stop_lon").alias("_lon"))
    dead = binned.where("_served is null").join(live, ["_k", "_a", "_b"]).where(haversine_m("stop_lat", "stop_lon", "_lat", "_lon") <= apart_m).select("stop_id").distinct()
    return stops.join(dead, "stop_id", "left_anti")


def display_names(packages: DataFrame) -> DataFrame:
    """A name that occurs more than once gains its state, and the bare name becomes an alias."""
    many = F.count("*").over(Window.partitionBy(search_name("name"))) > 1
    shown = F.when(many, F.concat("name", F.lit(" ("), "state", F.lit(")"))).otherwise(F.col("name"))
    return packages.withColumn("display_name", shown).withColumn("alias", F.when(many, F.col("name")))


def trip_variants(trips: DataFrame, calls: DataFrame, terminals: DataFrame, stops: DataFrame) -> DataFrame:
    """Groups trips of equal route, direction, shape, terminal, destination and stop pattern."""
    patterns = calls.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct("stop_sequence", "source_order", "stop_id"))).alias("p"))
    patterns = patterns.select("trip_id", F.transform("p", lambda x: x["stop_id"]).alias("stop_ids"), F.transform("p", lambda x: x["stop_sequence"]).alias("sequences"))
    names = stops.select(F.col("stop_id").alias("terminal_stop_id"), F.col("stop_name").alias("terminal_name"))
    whole = trips.join(patterns, "trip_id").join(terminals, "trip_id", "left").join(names, "terminal_stop_id", "left")
    whole = whole.withColumn("destination", F.coalesce(F.nullif("headsign", F.lit("")), "terminal_name", F.lit("")))
    keys = ["route_id", "direction_id", "shape_id", "terminal_stop_id", "destination", "stop_ids", "sequences"]
    return whole.groupBy(*keys).agg(F.array_sort(F.collect_set("trip_id")).alias("trip_ids"))


def platform_map(stops: DataFrame, resolved: DataFrame) -> DataFrame:
    """Public station to its sorted child platform ids."""
    both = stops.where(location_type("location_type") == 0).join(resolved, "stop_id").where("public_id <> stop_id")
    return both.groupBy(F.col("public_id").alias("station_id")).agg(F.array_sort(F.collect_set("stop_id")).alias("platform_ids"))


def service_dates(active: DataFrame) -> DataFrame:
    """Sorted active dates of each service."""
    return active.groupBy("service_id").agg(F.array_sort(F.collect_set("service_date")).alias("dates"))


def rt_counters(judged: DataFrame) -> DataFrame:
    """One row of counters over rows with a reject ``reason``."""
    kinds = ("stale", "skipped", "no_data", "unscheduled", "trip_relationship", "unknown_trip", "route_mismatch", "unknown_stop")
    return judged.agg(*(F.count_if(F.coalesce(F.col("reason") == k, F.lit(False))).alias(k) for k in kinds), F.count_if(F.col("reason").isNull()).alias("usable"), F.count("*").alias("entities"), F.count_distinct("route_id").alias("routes"), F.count_distinct("trip_id").alias("trips"))


def merge_feeds(feeds: list[DataFrame]) -> DataFrame:
    """One summary row over several feeds (feed_id, entities, feed_ts, stale, failed)."""
    every = reduce(DataFrame.unionByName, feeds)
    return every.agg(F.sum("entities").alias("entities"), F.max("feed_ts").alias("feed_ts"), F.bool_or("stale").alias("any_stale"), F.bool_or("failed").alias("partial"))


def topology_fanout(variants: DataFrame, segments: DataFrame) -> DataFrame:
    """Candidates, shapes and segments of each route."""
    sizes = segments.groupBy("shape_id").agg(F.count("*").alias("n_segments"))
    shaped = variants.select("route_id", "shape_id").distinct().join(sizes, "shape_id")
    by_shape = shaped.groupBy("route_id").agg(F.count("*").alias("shapes"), F.sum("n_segments").alias("segments"))
    return variants.groupBy("route_id").agg(F.count("*").alias("candidates")).join(by_shape, "route_id", "left").fillna(0)


def top_fanout(fanout: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` routes with most segments (a report)."""
    return fanout.orderBy(F.desc("segments"), F.desc("candidates"), "route_id").limit(k)


def latest_version(datasets: DataFrame) -> DataFrame:
    """Newest version of each dataset; versions are text years or (year, id) structs in ``versions``."""
    each = datasets.select("dataset", F.explode("versions").alias("v")).withColumn("year", F.col("v.year").try_cast("int"))
    return each.where("year is not null").groupBy("dataset").agg(F.max_by("v.id", F.struct("year", "v.id")).alias("id"), F.max("year").alias("year"))


def alert_counts(targets: DataFrame) -> DataFrame:
    """Alerts, those fully mapped, unmapped selectors and affected routes."""
    routes = targets.select(F.explode("route_ids").alias("r")).agg(F.count_distinct("r").alias("routes"))
    sums = targets.agg(F.count("*").alias("alerts"), F.count_if(F.size("unmapped") == 0).alias("mapped_alerts"), F.sum(F.size("unmapped")).alias("unmapped_selectors"))
    return sums.crossJoin(routes)  # one row each
