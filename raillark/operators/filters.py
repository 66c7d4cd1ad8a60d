"""Row filters; reject reasons are columns, so counters come from one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raillark.functions.expr import col, location_type


def finite(c: Column | str) -> Column:
    v = col(c)
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def stop_reason(stops: DataFrame) -> DataFrame:
    """Adds ``reason``: why a stop row is unusable, null if it is usable."""
    lat, lon = F.col("stop_lat").try_cast("double"), F.col("stop_lon").try_cast("double")
    ok = finite(lat) & finite(lon) & lat.between(-90, 90) & lon.between(-180, 180)
    reason = F.when(F.trim(F.coalesce("stop_id", F.lit(""))) == "", "empty_id").when(F.trim(F.coalesce("stop_name", F.lit(""))) == "", "empty_name").when(~F.coalesce(ok, F.lit(False)), "invalid_coordinate")
    return stops.withColumn("reason", reason)


def valid_stops(stops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable stops, and the number of rows by reject reason."""
    judged = stop_reason(stops)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def valid_positions(df: DataFrame, region: Column | None = None, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Finite positions on the globe, not at (0, 0), inside ``region`` (a box struct) if given."""
    a, b = F.col(lat), F.col(lon)
    ok = finite(a) & finite(b) & a.between(-90, 90) & b.between(-180, 180) & ~((a == 0) & (b == 0))
    if region is not None:
        ok &= a.between(region["min_lat"], region["max_lat"]) & b.between(region["min_lon"], region["max_lon"])
    return df.where(ok)


def fresh(df: DataFrame, now: int, max_stale: int, strict: bool, ts: str = "feed_ts") -> DataFrame:
    """Rows at most ``max_stale`` seconds old; a missing time passes unless ``strict``."""
    ok = F.lit(now) - F.col(ts) <= max_stale
    return df.where(F.coalesce(ok, F.lit(not strict)))


def route_type_filter(df: DataFrame, allow: list[str], deny: list[str] = ()) -> DataFrame:
    """Rows of allowed route types whose route is not on the deny list."""
    return df.where(F.col("route_type").isin(*allow) & ~F.col("route_id").isin(*deny or [""]))


def passenger_stops(stops: DataFrame, calls: DataFrame, passenger_ids: bool = False) -> DataFrame:
    """Stops that passengers see.

    A station stays if it or a child is served.  A platform stays if its station is
    not among ``stops`` (default) or always (``passenger_ids``).  Other types go.
    """
    kind = location_type("location_type")
    served = calls.select("stop_id").where("stop_id <> ''").distinct()
    parents = stops.join(served, "stop_id", "left_semi").where("parent_station <> ''").select(F.col("parent_station").alias("stop_id"))
    live = served.union(parents).distinct()
    stations = stops.where(kind == 1).join(live, "stop_id", "left_semi")
    platforms = stops.where(kind == 0)
    if not passenger_ids:
        known = stops.where(kind == 1).select(F.col("stop_id").alias("_station")).distinct()
        platforms = platforms.join(known, F.col("parent_station") == F.col("_station"), "left_anti")
    return stations.unionByName(platforms)


def update_reason(updates: DataFrame) -> DataFrame:
    """Adds ``cancelled`` and ``reason`` of a trip-update row; a null reason means usable."""
    stop, trip = F.coalesce("stop_relationship", F.lit(0)), F.coalesce("trip_relationship", F.lit(0))
    reason = F.when(~trip.isin(0, 3), "trip_relationship").when(stop == 1, "skipped").when(stop == 2, "no_data").when(stop == 3, "unscheduled")
    return updates.withColumn("cancelled", trip == 3).withColumn("reason", reason)


def usable_updates(updates: DataFrame) -> DataFrame:
    return update_reason(updates).where("reason is null").drop("reason")


def active_events(df: DataFrame, now: str, before_s: int, after_s: int, at: str = "ts", state: str = "state", cancelled: str | None = None) -> DataFrame:
    """Events around ``now`` that are not cancelled by flag or status word."""
    mid = F.lit(now).cast("timestamp_ntz")
    ok = F.col(at).between(mid - F.expr(f"INTERVAL {before_s} SECONDS"), mid + F.expr(f"INTERVAL {after_s} SECONDS"))
    ok &= ~F.lower(F.coalesce(F.col(state), F.lit(""))).isin("cancelled", "canceled", "error")
    if cancelled:
        ok &= ~F.coalesce(F.col(cancelled), F.lit(False))
    return df.where(ok)


def region_trips(calls: DataFrame, stops: DataFrame, box: dict[str, float]) -> DataFrame:
    """All calls of the trips that call at a stop inside the box."""
    inside = stops.where(F.col("stop_lat").between(box["min_lat"], box["max_lat"]) & F.col("stop_lon").between(box["min_lon"], box["max_lon"])).select("stop_id").distinct()
    trips = calls.join(inside, "stop_id", "left_semi").select("trip_id").distinct()
    return calls.join(trips, "trip_id", "left_semi")


def branch_cities(cities: DataFrame, mode: str, own: list[str]) -> DataFrame:
    """Cities of a package mode that no adapter of another branch claims (``adapters`` all in ``own``)."""
    return cities.where((F.col("mode") == mode) & (F.size(F.array_except("adapters", F.array(*map(F.lit, own)))) == 0))
