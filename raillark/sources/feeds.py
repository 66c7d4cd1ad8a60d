"""Readers of timetable folders, configuration, boundaries, open records and realtime snapshots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the timetable tables, all texts.
COLUMNS = {
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "location_type", "parent_station", "platform_code"],
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type"],
    "trips": ["trip_id", "route_id", "service_id", "trip_headsign", "direction_id", "shape_id"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time"],
    "calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "start_date", "end_date"],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "shapes": ["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"],
    "transfers": ["from_stop_id", "to_stop_id", "from_trip_id", "to_trip_id", "from_route_id", "to_route_id", "transfer_type", "min_transfer_time"],
    "pathways": ["pathway_id", "from_stop_id", "to_stop_id", "pathway_mode", "is_bidirectional"],
    "agency": ["agency_id", "agency_name", "agency_timezone"],
    "frequencies": ["trip_id", "start_time", "end_time", "headway_secs", "exact_times"],
    "fare_attributes": ["fare_id", "price", "currency_type", "payment_method", "transfers"],
    "fare_rules": ["fare_id", "route_id", "origin_id", "destination_id", "contains_id"],
    "feed_info": ["feed_publisher_name", "feed_publisher_url", "feed_lang", "feed_version"],
}
REQUIRED = ("stops", "routes", "trips", "stop_times")
#: Tables of numbers and ids only: no quoted line break, so a large file can be split.
SPLIT = ("stop_times", "shapes")


def gtfs_table(spark: SparkSession, feed_dir: str, name: str, required: bool | None = None, feed_id: str = "") -> DataFrame:
    """One table of a feed folder: all texts, absent columns '' and ``source_order`` by position in the file.

    A missing optional table is empty; a missing required one is an error.
    """
    must = name in REQUIRED if required is None else required
    names = COLUMNS[name]
    try:
        raw = spark.read.csv(f"{feed_dir}/{name}.txt", header=True, inferSchema=False, encoding="UTF-8", quote='"', escape='"', multiLine=name not in SPLIT)
    except AnalysisException as e:
        if must or e.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "feed_id"]] + [T.StructField("source_order", T.LongType())])
        return spark.createDataFrame([], empty)
    have = {c.replace("﻿", "").strip(): c for c in raw.columns}
    cols = [F.coalesce(raw[f"`{have[c]}`"], F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in names]
    extra = [raw[f"`{real}`"].alias(c) for c, real in have.items() if c not in names]
    # rows of one file are numbered in the order of its splits, which is the file's order
    return raw.select(*cols, *extra, F.lit(feed_id).alias("feed_id"), F.monotonically_increasing_id().alias("source_order"))


def cities(spark: SparkSession, path: str, provider: str | None = None) -> tuple[DataFrame, DataFrame]:
    """City rows and those that break a rule (city_id, problem)."""
    raw = spark.read.json(path, multiLine=True, schema="id string, name string, aliases array<string>, latitude double, longitude double, radiusMeters double, mode string, providers array<string>")
    rows = raw.select(F.col("id").alias("city_id"), "name", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), "latitude", "longitude", F.col("radiusMeters").alias("radius_m"), "mode", F.coalesce("providers", F.array().cast("array<string>")).alias("providers"))
    twice = rows.groupBy("city_id").agg(F.count("*").alias("n")).where("n > 1").select("city_id", F.lit("repeated").alias("problem"))
    ok = F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180) & (F.col("radius_m") > 0) & (F.trim("name") != "") & (F.trim("city_id") != "")
    bad = rows.where(~F.coalesce(ok, F.lit(False))).select("city_id", F.lit("value").alias("problem"))
    return (rows if provider is None else rows.where(F.array_contains("providers", provider))), twice.unionByName(bad)


def feeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Feed registry rows, and ids, prefixes or namespaces used twice outside one merge group."""
    rows = spark.read.json(path, multiLine=True, schema="id string, class string, timezone string, prefix string, namespace string, mergeGroup string, build boolean")
    each = rows.select("id", "mergeGroup", F.explode(F.map_from_arrays(F.array(F.lit("id"), F.lit("prefix"), F.lit("namespace")), F.array("id", "prefix", "namespace"))).alias("kind", "value")).where("value <> ''")
    group = F.when((F.col("kind") != "id") & F.col("mergeGroup").isNotNull(), F.col("mergeGroup")).otherwise(F.monotonically_increasing_id().cast("string"))
    clash = each.withColumn("owner", group).groupBy("kind", "value").agg(F.count_distinct("owner").alias("n")).where("n > 1")
    return rows, clash.select("kind", "value")


_POINT = "array<double>"
_RINGS = "array<array<array<double>>>"


def boundaries(spark: SparkSession, path: str) -> DataFrame:
    """One row a usable polygon feature: code, name, state, polygons and box; the first feature of a code."""
    schema = "features array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>"
    each = spark.read.json(path, multiLine=True, schema=schema).select(F.posexplode("features").alias("n", "f"))
    kind, raw = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    shapes = F.when(kind == "Polygon", F.array(F.from_json(raw, _RINGS))).when(kind == "MultiPolygon", F.from_json(raw, f"array<{_RINGS}>"))
    rows = each.select("n", F.col("f.properties")["code"].alias("code"), F.col("f.properties")["name"].alias("name"), F.col("f.properties")["state"].alias("state"), shapes.alias("polygons")).where("polygons is not null and code <> '' and name <> ''")
    points = F.flatten(F.transform("polygons", lambda p: p[0]))
    rows = rows.withColumn("_x", F.transform(points, lambda q: q[0])).withColumn("_y", F.transform(points, lambda q: q[1]))
    rows = rows.select("n", "code", "name", "state", "polygons", F.array_min("_x").alias("min_lon"), F.array_min("_y").alias("min_lat"), F.array_max("_x").alias("max_lon"), F.array_max("_y").alias("max_lat"))
    rows = rows.where((F.col("min_lon") < F.col("max_lon")) & (F.col("min_lat") < F.col("max_lat")))
    first = rows.groupBy("code").agg(F.min("n").alias("n"))
    return rows.join(first, ["code", "n"]).drop("n")


def open_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of open-data pages (total, records of text maps), and pages whose count differs from their total."""
    each = df.select("page", F.explode("records").alias("r"))

    def first(*names: str) -> Column:
        return F.coalesce(*(F.col("r")[n].try_cast("double") for n in names))

    point = F.from_json(F.col("r")["geometry"], "type string, coordinates array<double>")
    lat, lon = first("latitude", "lat", "stop_lat"), first("longitude", "lon", "stop_lon")
    rows = each.select("page", F.coalesce(point["coordinates"], F.array(lon, lat)).alias("point"), F.col("r").alias("properties"))
    counts = df.agg(F.sum(F.size("records")).alias("actual"), F.max("total").alias("expected")).where("actual <> expected")
    return rows.select("page", F.col("point")[0].alias("longitude"), F.col("point")[1].alias("latitude"), "properties"), counts


_TEXTS = "array<struct<language: string, text: string>>"
_EVENT = "struct<time: bigint, delay: int>"
RT_SCHEMA = (
    "header struct<timestamp: bigint>, entity array<struct<id: string,"
    "trip_update: struct<trip: struct<trip_id: string, route_id: string, direction_id: int, schedule_relationship: int>, timestamp: bigint,"
    f"stop_time_update: array<struct<stop_sequence: int, stop_id: string, arrival: {_EVENT}, departure: {_EVENT}, schedule_relationship: int>>>,"
    "vehicle: struct<trip: struct<trip_id: string, route_id: string, direction_id: int>, vehicle: struct<id: string>, position: struct<latitude: double, longitude: double, bearing: double, speed: double>, stop_id: string, current_stop_sequence: int, timestamp: bigint>,"
    f"alert: struct<informed_entity: array<struct<route_id: string, stop_id: string, direction_id: int>>, header_text: {_TEXTS}, description_text: {_TEXTS}, cause: string, effect: string>>>"
)


def rt_entities(df: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """Flat rows of one kind ('trip_update', 'vehicle' or 'alert') from snapshots in JSON text; works on streams too."""
    each = df.select(F.from_json(column, RT_SCHEMA).alias("s")).select(F.col("s.header.timestamp").alias("feed_ts"), F.explode("s.entity").alias("e"))
    if kind == "trip_update":
        u = each.where("e.trip_update is not null").select("feed_ts", F.col("e.trip_update").alias("u"))
        rows = u.select("feed_ts", "u", F.explode_outer("u.stop_time_update").alias("x"))
        return rows.select("feed_ts", "u.trip.trip_id", "u.trip.route_id", "u.trip.direction_id", "x.stop_id", "x.stop_sequence", F.coalesce("x.departure.time", "x.arrival.time").alias("effective_time"), F.coalesce("x.departure.delay", "x.arrival.delay").alias("delay_seconds"), F.coalesce("u.trip.schedule_relationship", F.lit(0)).alias("trip_relationship"), F.coalesce("x.schedule_relationship", F.lit(0)).alias("stop_relationship"))
    if kind == "vehicle":
        v = each.where("e.vehicle is not null").select("feed_ts", F.col("e.id").alias("entity_id"), F.col("e.vehicle").alias("v"))
        return v.select("feed_ts", F.coalesce("v.vehicle.id", "entity_id").alias("vehicle_id"), "v.trip.trip_id", "v.trip.route_id", "v.trip.direction_id", "v.stop_id", F.col("v.current_stop_sequence").alias("stop_sequence"), "v.position.latitude", "v.position.longitude", "v.position.bearing", "v.position.speed", F.coalesce("v.timestamp", "feed_ts").alias("ts"))
    a = each.where("e.alert is not null").select("feed_ts", F.col("e.id").alias("alert_id"), F.col("e.alert").alias("a"))
    return a.select("feed_ts", "alert_id", "a.informed_entity", "a.header_text", "a.description_text", "a.cause", "a.effect")


def read_package(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of published city files: 'stops' (arrays) or 'departures' (maps from stop to array)."""
    if kind == "stops":
        raw = spark.read.text(path, wholetext=False)
        rows = raw.select(F.col("city_id") if "city_id" in raw.columns else F.lit(None).cast("string").alias("city_id"), F.explode(F.from_json("value", "array<struct<id: string, name: string, search_name: string, latitude: double, longitude: double>>")).alias("s"))
        return rows.select("city_id", "s.*")
    raw = spark.read.text(path)
    rows = raw.select(F.col("city_id") if "city_id" in raw.columns else F.lit(None).cast("string").alias("city_id"), F.explode(F.from_json("value", "map<string, array<struct<t: string, p: string, r: string, h: string, q: int>>>")).alias("stop_id", "d"))
    return rows.select("city_id", "stop_id", F.explode("d").alias("x")).select("city_id", "stop_id", "x.*")


#: Files up to this many bytes are read as one row; longer ones are opened by path and hashed in pieces.
ONE_ROW = 256 << 20
_PIECE = 8 << 20


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the files that the rows name, read piece by piece."""
    for batch in batches:
        out = []
        for name in batch.column(0).to_pylist():
            store, inner = (pafs.LocalFileSystem(), name[len("file:") :]) if name.startswith("file:/") else pafs.FileSystem.from_uri(quote(name, safe=":/"))
            digest = hashlib.sha256()
            with store.open_input_stream(inner) as file:
                while piece := file.read(_PIECE):
                    digest.update(piece)
            out.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], ["path", "source_id", "size", "sha256"])


def artifact_digest(spark: SparkSession, path: str, one_row: int = ONE_ROW) -> tuple[DataFrame, DataFrame]:
    """SHA-256 and size of each file by its path in the folder, and of the folder: over the sorted paths, lengths and digests.

    The digest of digests stands for one over all bytes, which no second task could share.
    Files over ``one_row`` bytes are opened by the task that hashes them, so their size has no limit.
    The reader skips empty files; they have no row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = path.split("://")[-1].removeprefix("file:").rstrip("/") + "/"
    inner = F.element_at(F.split(F.col("path"), F.concat(F.lit("\\Q"), F.lit(root), F.lit("\\E")), 2), -1)
    small = files.where(F.col("length") <= one_row).select(inner.alias("source_id"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))
    # without the column of contents only names and lengths are listed
    long = files.where(F.col("length") > one_row).select("path", inner.alias("source_id"), F.col("length").alias("size"))
    long = long.repartition("path").mapInArrow(_hashed, "path string, source_id string, size long, sha256 string").select("source_id", "sha256", "size")
    each = small.unionByName(long)
    line = F.concat_ws(":", F.octet_length("source_id").cast("string"), "source_id", F.col("size").cast("string"), "sha256")
    return each, each.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n").cast("binary"), 256).alias("sha256"), F.sum("size").alias("size"))


def provenance(each: DataFrame, identity: dict[str, str]) -> DataFrame:
    """``each`` file with the digest of its record bound to an identity: SHA-256 of one JSON object, keys in order."""
    fields = {"sha256": F.col("sha256"), "size": F.col("size"), "source_id": F.col("source_id")} | {k: F.lit(v) for k, v in identity.items()}
    record = F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))))
    return each.withColumn("record_sha256", F.sha2(record, 256))
