"""Queries over sources: a view is written in the source's form, read back by its reader and compared with the view."""

from __future__ import annotations

from pyspark.sql import functions as F

from raillark.operators import joins
from raillark.operators.lineage import scratch
from raillark.plans import checks, jobs
from raillark.plans.base import Source, query
from raillark.sources import feeds, sinks


def _text(df, path: str, compression: str = "none") -> str:
    df.write.text(path, compression=compression)
    return path


@query("t_stops", "SELECT stop_id, CASE WHEN source_order % 9 = 0 THEN stop_name||chr(10)||'\"'||stop_id||'\", x' ELSE stop_name END AS stop_name, location_type, parent_station, platform_code FROM t_stops")
def src_gtfs_table(v: Source):
    folder = scratch(v.spark, "feed")
    odd = F.concat("stop_name", F.lit('\n"'), "stop_id", F.lit('", x'))
    rows = v("stops").withColumn("stop_name", F.when(F.col("source_order") % 9 == 0, odd).otherwise(F.col("stop_name"))).withColumn("stop_lat", F.col("stop_lat").cast("string"))
    rows.select("stop_id", "stop_name", "stop_lat", "location_type", "parent_station", "platform_code").write.csv(f"{folder}/stops.txt", header=True, quote='"', escape='"', emptyValue="")
    return feeds.gtfs_table(v.spark, folder, "stops").select("stop_id", "stop_name", "location_type", "parent_station", "platform_code")


@query("t_cities", "SELECT city_id, name, latitude, radius_m, name||'!' AS aliases FROM t_cities")
def src_city_config(v: Source):
    item = F.struct(F.col("city_id").alias("id"), "name", F.array(F.concat("name", F.lit("!"))).alias("aliases"), "latitude", "longitude", F.col("radius_m").alias("radiusMeters"))
    path = _text(v("cities").agg(F.to_json(F.collect_list(item)).alias("value")), scratch(v.spark, "cities"))  # one file by its form
    rows, _ = feeds.cities(v.spark, path)
    return rows.select("city_id", "name", "latitude", "radius_m", F.array_join("aliases", ",").alias("aliases"))


@query("t_boundaries", "SELECT 'prefix' AS kind, state||':' AS value FROM t_boundaries GROUP BY state HAVING count(*)>1")
def src_feed_registry(v: Source):
    item = F.struct(F.col("code").alias("id"), F.concat("state", F.lit(":")).alias("prefix"), F.col("name").alias("namespace"))
    path = _text(v("boundaries").select(F.to_json(item).alias("value")), scratch(v.spark, "feeds"))
    lines = v.spark.read.text(path).agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
    _, clash = feeds.feeds(v.spark, _text(lines, scratch(v.spark, "registry")))
    return clash


@query("t_boundaries", "SELECT code, name, state, round(min_lon,6) AS min_lon, round(max_lat,6) AS max_lat FROM t_boundaries")
def src_boundary_features(v: Source):
    rows = joins.box_polygons(v("boundaries"))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.col("polygons")[0].alias("coordinates"))
    feature = F.struct(F.struct("code", "name", "state").alias("properties"), geometry.alias("geometry"))
    path = _text(rows.agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value")), scratch(v.spark, "bounds"))
    return feeds.boundaries(v.spark, path).select("code", "name", "state", F.round("min_lon", 6).alias("min_lon"), F.round("max_lat", 6).alias("max_lat"))


@query("t_catalogue", "SELECT source_order // 100 AS page, CAST(source_order AS VARCHAR) AS key, round(longitude,6) AS longitude, round(latitude,6) AS latitude FROM t_catalogue")
def src_open_records(v: Source):
    page = F.floor(F.col("source_order") / 100).alias("page")
    record = F.create_map(F.lit("key"), F.col("source_order").cast("string"), F.when(F.col("source_order") % 2 == 0, F.lit("lat")).otherwise(F.lit("latitude")), F.col("latitude").cast("string"), F.lit("lon"), F.col("longitude").cast("string"))
    pages = v("catalogue").groupBy(page).agg(F.collect_list(record).alias("records"), F.count("*").alias("total"))
    path = scratch(v.spark, "records")
    pages.write.json(path)
    back = v.spark.read.json(path, schema="page bigint, total bigint, records array<map<string,string>>")
    rows, _ = feeds.open_records(back)
    return rows.select("page", F.col("properties")["key"].alias("key"), F.round("longitude", 6).alias("longitude"), F.round("latitude", 6).alias("latitude"))


@query("t_rt_updates", "SELECT feed_ts, trip_id, route_id, stop_id, stop_sequence, delay_seconds, trip_relationship, stop_relationship, count(*) AS n FROM t_rt_updates GROUP BY ALL")
def src_rt_entities(v: Source):
    trip = F.struct("trip_id", "route_id", F.col("trip_relationship").alias("schedule_relationship"))
    stop = F.struct("stop_sequence", "stop_id", F.struct(F.col("delay_seconds").alias("delay")).alias("departure"), F.col("stop_relationship").alias("schedule_relationship"))
    entity = F.struct(F.col("trip_id").alias("id"), F.struct(trip.alias("trip"), F.array(stop).alias("stop_time_update")).alias("trip_update"))
    snapshot = F.struct(F.struct(F.col("feed_ts").alias("timestamp")).alias("header"), F.array(entity).alias("entity"))
    path = _text(v("rt_updates").select(F.to_json(snapshot).alias("value")), scratch(v.spark, "snapshots"), "gzip")  # a row a call: its names and braces outweigh what they hold
    rows = feeds.rt_entities(v.spark.read.text(path), "trip_update")
    return rows.groupBy("feed_ts", "trip_id", "route_id", "stop_id", "stop_sequence", "delay_seconds", "trip_relationship", "stop_relationship").agg(F.count("*").alias("n"))


@query("radius", "SELECT city_id, stop_id AS id, stop_name AS name, round(stop_lat,6) AS latitude FROM radius")
def src_city_package(v: Source):
    folder = scratch(v.spark, "package")
    sinks.write_city_package(joins.within_radius(v("stops"), v("cities")), folder, "stops")
    return feeds.read_package(v.spark, f"{folder}/json", "stops").select("city_id", "id", "name", F.round("latitude", 6).alias("latitude"))


@query("t_cities", "SELECT 'city='||city_id AS folder, sha256(name||chr(10)) AS sha256, CAST(length(name)+1 AS BIGINT) AS size FROM t_cities")
def src_artifact_digest(v: Source):
    path = scratch(v.spark, "artifact")
    v("cities").select(F.col("city_id").alias("city"), F.col("name").alias("value")).repartition("city").write.partitionBy("city").text(path)
    each, _ = feeds.artifact_digest(v.spark, path)
    return each.where(F.contains("source_id", F.lit("city="))).select(F.element_at(F.split("source_id", "/"), 1).alias("folder"), "sha256", "size")


@query("t_catalogue t_stops", "SELECT 'stations' AS table_name, stop_id AS id, nullif(name,'') AS name FROM t_catalogue WHERE name<>'' UNION ALL SELECT 'interchanges', stop_id, nullif(parent_station,'') FROM t_stops")
def job_system_tables(v: Source):
    stations = v("catalogue").select(F.lit("metro").alias("system"), F.create_map(F.lit("code1"), "stop_id", F.lit("name"), "name").alias("record"))
    changes = v("stops").select(F.lit("metro").alias("system"), F.create_map(F.lit("from_code1"), "stop_id", F.lit("to_name"), F.concat(F.lit(" "), "parent_station")).alias("record"))
    tables, _ = jobs.system_tables({"stations": stations, "interchanges": changes})
    return tables["stations"].select(F.lit("stations").alias("table_name"), "id", "name").unionByName(tables["interchanges"].select(F.lit("interchanges").alias("table_name"), F.col("from_id").alias("id"), F.col("to_name").alias("name")))


@query("t_stops", "SELECT 'gone' AS table_name, 'missing' AS problem UNION ALL SELECT 'high', 'empty' FROM (SELECT count(*) AS n FROM t_stops WHERE stop_lat > 80) WHERE n=0")
def chk_store(v: Source):
    return checks.check_store({"stops": v("stops"), "high": v("stops").where("stop_lat > 80")}, ("stops", "high", "gone"))
