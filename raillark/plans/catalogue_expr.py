"""Queries over column functions, filters and the SQL function surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from raillark.functions import expr as e
from raillark.operators import filters
from raillark.plans.base import Source, query

_HAV = "2*6371000.0*asin(least(1.0, sqrt(pow(sin((radians({c})-radians({a}))/2),2)+cos(radians({a}))*cos(radians({c}))*pow(sin((radians({d})-radians({b}))/2),2))))"


@query("t_routes", "SELECT route_id, trim(replace(replace(replace(replace(lower(long_name),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss')) AS search_name FROM t_routes")
def fn_search_name(v: Source):
    return v("routes").select("route_id", e.search_name("long_name").alias("search_name"))


@query("t_routes", "SELECT route_id, coalesce(nullif(trim(regexp_replace(regexp_replace(strip_accents(replace(replace(replace(replace(lower(long_name),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss')), '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'stop') AS slug FROM t_routes")
def fn_slug(v: Source):
    return v("routes").select("route_id", e.slug("long_name").alias("slug"))


@query("t_stop_times", "SELECT trip_id, source_order, CAST(split_part(departure_time,':',1) AS INT)*3600+CAST(split_part(departure_time,':',2) AS INT)*60+CAST(split_part(departure_time,':',3) AS INT) AS seconds, CAST(NULL AS INT) AS bad FROM t_stop_times")
def fn_service_seconds(v: Source):
    bad = F.concat(F.substr("departure_time", F.lit(1), F.lit(3)), F.lit("60:30"))
    return v("stop_times").select("trip_id", "source_order", e.service_seconds("departure_time").alias("seconds"), e.service_seconds(bad).alias("bad"))


@query("t_stops", "SELECT stop_id, CASE WHEN parent_station='' THEN '' WHEN starts_with(parent_station,'s') THEN parent_station ELSE 's'||parent_station END AS once, CASE WHEN parent_station='' THEN '' ELSE 's'||parent_station END AS twice FROM t_stops")
def fn_prefix_id(v: Source):
    return v("stops").select("stop_id", e.prefix_id("parent_station", "s").alias("once"), e.prefix_id("parent_station", "s", False).alias("twice"))


@query("t_stops", "SELECT stop_id, CASE WHEN starts_with(stop_id,'p1') THEN substr(stop_id,3) WHEN starts_with(stop_id,'p') THEN substr(stop_id,2) ELSE stop_id END AS native, CASE WHEN starts_with(stop_id,'p') THEN substr(stop_id,2) ELSE '' END AS strict_native FROM t_stops")
def fn_native_id(v: Source):
    return v("stops").select("stop_id", e.native_id("stop_id", ["p", "p1"]).alias("native"), e.native_id("stop_id", ["p"], True).alias("strict_native"))


@query("t_routes", "SELECT route_id, coalesce(nullif(trim(short_name),''), nullif(trim(long_name),''), route_id) AS label FROM t_routes")
def fn_line_label(v: Source):
    return v("routes").select("route_id", e.line_label("short_name", "long_name", "route_id").alias("label"))


@query("t_routes", "SELECT route_id, concat_ws(',', nullif(short_name,''), CASE WHEN long_name<>short_name THEN nullif(long_name,'') END) AS names FROM t_routes WHERE short_name<>'' OR long_name<>''")
def fn_line_names(v: Source):
    return v("routes").select("route_id", F.array_join(e.line_names("short_name", "long_name"), ",").alias("names")).where("names is not null")


@query("t_trips", "SELECT trip_id, coalesce(nullif(headsign,''), nullif(shape_id,''), '?') AS board, coalesce(nullif(headsign,''), nullif(direction_id,''), route_id) AS compact FROM t_trips")
def fn_destination(v: Source):
    return v("trips").select("trip_id", e.destination("headsign", "shape_id", default="?").alias("board"), e.destination("headsign", "direction_id", "route_id").alias("compact"))


@query("t_trips", "SELECT trip_id, CASE WHEN shape_id<>'sh7' THEN route_id||'|direction:'||direction_id||'|destination-stop:'||shape_id ELSE route_id||'|direction:'||direction_id||'|destination:'||trim(regexp_replace(lower(headsign),'\\s+',' ','g')) END AS direction_key FROM t_trips")
def fn_direction_key(v: Source):
    return v("trips").select("trip_id", e.direction_key("route_id", "direction_id", F.when(F.col("shape_id") != "sh7", F.col("shape_id")).otherwise(""), "headsign").alias("direction_key"))


@query("t_routes", "SELECT route_id, CASE route_type WHEN '0' THEN 'tram' WHEN '1' THEN 'subway' WHEN '2' THEN 'train' WHEN '3' THEN 'bus' WHEN '700' THEN 'bus' END AS mode, CASE WHEN CAST(substr(route_id,2) AS INT) BETWEEN 900 AND 999 OR route_id='r0' THEN 'tram' WHEN CAST(substr(route_id,2) AS INT) BETWEEN 400 AND 499 OR route_id='r1' THEN 'subway' WHEN CAST(substr(route_id,2) AS INT) BETWEEN 100 AND 199 OR route_id='r2' THEN 'train' WHEN CAST(substr(route_id,2) AS INT) BETWEEN 700 AND 799 OR route_id='r3' THEN 'bus' WHEN CAST(substr(route_id,2) AS INT) BETWEEN 1000 AND 1099 OR route_id='r4' THEN 'ferry' END AS extended FROM t_routes")
def fn_mode_of_route_type(v: Source):
    return v("routes").select("route_id", e.mode_of_route_type("route_type").alias("mode"), e.mode_of_route_type(F.substr("route_id", F.lit(2))).alias("extended"))


@query("t_stops", "SELECT stop_id, CASE WHEN platform_code IN ('0','1','13','15','16') THEN 'regionalTrain' WHEN platform_code IN ('2','3') THEN 'subway' WHEN platform_code='4' THEN 'tram' WHEN platform_code IN ('5','6','7','8','11') THEN 'bus' WHEN platform_code='9' THEN 'ferry' WHEN lower(stop_name) LIKE 's%' THEN 'suburbanTrain' WHEN regexp_matches(lower(stop_name),'^(re|rb|ic|ec)') THEN 'regionalTrain' ELSE 'unknown' END AS mode FROM t_stops")
def fn_mode_of_product_class(v: Source):
    return v("stops").select("stop_id", e.mode_of_product_class("platform_code", "stop_name").alias("mode"))


@query("t_stops", "SELECT stop_id, CASE WHEN TRY_CAST(location_type AS INT) BETWEEN 0 AND 4 THEN CAST(location_type AS INT) ELSE 0 END AS kind, CASE WHEN platform_code IN ('1','2','3','4') THEN CAST(platform_code AS INT) ELSE 0 END AS odd FROM t_stops")
def fn_location_type(v: Source):
    return v("stops").select("stop_id", e.location_type("location_type").alias("kind"), e.location_type("platform_code").alias("odd"))


@query("t_stops", "SELECT stop_id, round(" + _HAV.format(a="stop_lat", b="stop_lon", c="48.1", d="8.1") + ", 6) AS metres FROM t_stops")
def fn_haversine_m(v: Source):
    return v("stops").select("stop_id", F.round(e.haversine_m("stop_lat", "stop_lon", F.lit(48.1), F.lit(8.1)), 6).alias("metres"))


@query("t_stops", "SELECT stop_id, round(sqrt(pow((radians(8.1)-radians(stop_lon))*cos((radians(stop_lat)+radians(48.1))/2),2)+pow(radians(48.1)-radians(stop_lat),2))*6371000.0, 6) AS metres FROM t_stops")
def fn_equirect_m(v: Source):
    return v("stops").select("stop_id", F.round(e.equirect_m("stop_lat", "stop_lon", F.lit(48.1), F.lit(8.1)), 6).alias("metres"))


@query("t_samples", "SELECT event_id, round(CASE WHEN d<0 THEN d+360 ELSE d END, 6) AS bearing, round(least(abs(bearing-90)%360, 360-abs(bearing-90)%360), 6) AS diff, round(CASE WHEN bearing<0 THEN bearing+360 WHEN bearing>=360 THEN bearing-360 ELSE bearing END, 6) AS norm FROM (SELECT *, degrees(atan2((radians(30.6)-radians(longitude))*cos((radians(latitude)+radians(50.5))/2), radians(50.5)-radians(latitude))) AS d FROM t_samples)")
def fn_bearing(v: Source):
    return v("samples").select("event_id", F.round(e.bearing("latitude", "longitude", F.lit(50.5), F.lit(30.6)), 6).alias("bearing"), F.round(e.bearing_diff("bearing", F.lit(90.0)), 6).alias("diff"), F.round(e.bearing_norm("bearing"), 6).alias("norm"))


@query("t_samples", "SELECT event_id, CASE WHEN bearing>0 THEN bearing END AS speed FROM t_samples")
def fn_positive_or_null(v: Source):
    return v("samples").select("event_id", e.positive_or_null("bearing").alias("speed"))


@query("t_cities", "SELECT city_id, round(longitude-radius_m/(111320.0*greatest(cos(radians(latitude)),0.2)),6) AS min_lon, round(latitude-radius_m/111320.0,6) AS min_lat, round(longitude+radius_m/(111320.0*greatest(cos(radians(latitude)),0.2)),6) AS max_lon, round(latitude+radius_m/111320.0,6) AS max_lat FROM t_cities")
def fn_radius_region(v: Source):
    rows = v("cities").select("city_id", e.radius_region("latitude", "longitude", "radius_m").alias("b"))
    return rows.select("city_id", *(F.round(f"b.{c}", 6).alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")))


@query("t_stops", "SELECT stop_id, CAST(floor(stop_lat/0.25) AS BIGINT) AS y, CAST(floor(stop_lon/0.25) AS BIGINT) AS x, CAST(floor(-stop_lon/0.01) AS BIGINT) AS west FROM t_stops")
def fn_grid_cell(v: Source):
    return v("stops").select("stop_id", e.grid_cell("stop_lat", 0.25).alias("y"), e.grid_cell("stop_lon", 0.25).alias("x"), e.grid_cell(-F.col("stop_lon"), 0.01).alias("west"))


@query("t_rt_updates", "SELECT DISTINCT feed_ts, strftime(make_timestamp(feed_ts*1000000), '%Y-%m-%dT%H:%M:%SZ') AS iso FROM t_rt_updates")
def fn_rt_timestamp(v: Source):
    return v("rt_updates").select("feed_ts").distinct().select("feed_ts", e.iso_utc("feed_ts").alias("iso"))


@query("t_stop_times", "SELECT trip_id, source_order, CAST(epoch(TIMESTAMP '2024-01-15' + to_seconds(CAST(departure_seconds AS BIGINT)))-3600 AS BIGINT) AS instant FROM t_stop_times")
def fn_service_instant(v: Source):
    at = e.service_instant(F.lit("20240115"), "departure_seconds", "Europe/Berlin")
    return v("stop_times").select("trip_id", "source_order", F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), at).alias("instant"))


@query("t_calendar_dates", "SELECT service_id, service_date, epoch(strptime(service_date,'%Y%m%d'))::BIGINT-3600+8*3600+30*60 AS instant FROM t_calendar_dates")
def fn_civil_timestamp(v: Source):
    d = F.to_date("service_date", "yyyyMMdd")
    parts = F.struct(F.year(d).alias("year"), F.month(d).alias("month"), F.day(d).alias("day"), F.lit(8).alias("hour"), F.lit(30).alias("minute"), F.lit(None).cast("int").alias("second"))
    at = e.civil_timestamp(parts, "Europe/Berlin")
    return v("calendar_dates").select("service_id", "service_date", F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), at).alias("instant"))


@query("t_samples", "SELECT event_id, nullif(CAST((event_id % 3)*60 AS BIGINT), 0) AS delay FROM t_samples")
def fn_delay_seconds(v: Source):
    later = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 3).cast("int"))
    return v("samples").select("event_id", e.delay_seconds("ts", later).alias("delay"))


@query("t_transfers", "SELECT transfer_key, count(*) AS n FROM (SELECT concat_ws(chr(31), from_stop_id, to_stop_id, from_trip_id, to_trip_id, from_route_id, to_route_id) AS transfer_key FROM t_transfers) GROUP BY 1")
def fn_composite_key(v: Source):
    key = e.transfer_key("from_stop_id", "to_stop_id", "from_trip_id", "to_trip_id", "from_route_id", "to_route_id")
    return v("transfers").groupBy(key.alias("transfer_key")).agg(F.count("*").alias("n"))


@query("t_trips", "SELECT trip_id, substr(sha256(route_id||'|'||direction_id||'|'||shape_id),1,24) AS content_key FROM t_trips")
def fn_content_key(v: Source):
    return v("trips").select("trip_id", e.content_key(["route_id", "direction_id", "shape_id"]).alias("content_key"))


@query("t_stops", "SELECT stop_id, CASE WHEN lower(trim(parent_station)) NOT IN ('','none','null','nan') THEN trim(parent_station) END AS parent FROM t_stops")
def fn_optional_text(v: Source):
    return v("stops").select("stop_id", e.optional_text("parent_station").alias("parent"))


@query("t_rt_updates", "SELECT trip_relationship, stop_relationship, CASE trip_relationship WHEN 0 THEN 'SCHEDULED' WHEN 1 THEN 'ADDED' WHEN 3 THEN 'CANCELED' END AS trip_name, CASE stop_relationship WHEN 0 THEN 'SCHEDULED' WHEN 1 THEN 'SKIPPED' WHEN 2 THEN 'NO_DATA' ELSE 'UNSCHEDULED' END AS stop_name, count(*) AS n FROM t_rt_updates GROUP BY ALL")
def fn_relationship_name(v: Source):
    return v("rt_updates").groupBy("trip_relationship", "stop_relationship", e.relationship_name("trip_relationship", "trip").alias("trip_name"), e.relationship_name("stop_relationship", "stop").alias("stop_name")).agg(F.count("*").alias("n"))


@query("t_routes", "SELECT route_id, coalesce(nullif(trim(long_name),''),nullif(trim(short_name),''),'-') AS last_text, CAST((trim(short_name)<>'')::INT+(trim(long_name)<>'')::INT AS INT) AS n_texts FROM t_routes")
def fn_localised_text(v: Source):
    item = lambda lang, c: F.struct(F.lit(lang).alias("language"), c.alias("text"))
    arr = F.array(item("de", F.col("short_name")), item("de", F.col("long_name")), item("en", F.lit(" ")))
    cleaned, last = e.localised_text(arr)
    return v("routes").select("route_id", F.coalesce(F.try_element_at(last, F.lit("de")), F.lit("-")).alias("last_text"), F.size(cleaned).alias("n_texts"))


@query("t_stops", "SELECT stop_id, trim(replace(replace(replace(replace(lower(stop_name),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss')) AS a, coalesce(nullif(trim(platform_code),''), nullif(trim(parent_station),''), stop_id) AS b, round(" + _HAV.format(a="stop_lat", b="stop_lon", c="48.1", d="8.1") + ", 6) AS metres, CAST(floor(stop_lat/0.25) AS BIGINT) AS y FROM t_stops")
def udf_surface(v: Source):
    e.register_functions(v.spark)
    return v("stops").selectExpr("stop_id", "tx_search_name(stop_name) AS a", "tx_line_label(platform_code, parent_station, stop_id) AS b", "round(tx_haversine_m(stop_lat, stop_lon, 48.1D, 8.1D), 6) AS metres", "tx_grid_cell(stop_lat, 0.25D) AS y")


_STOP_REASONS = "CASE WHEN platform_code='' THEN 'empty_id' WHEN platform_code='7' THEN 'empty_name' WHEN platform_code='9' THEN 'invalid_coordinate' ELSE 'ok' END"


@query("t_stops", f"SELECT {_STOP_REASONS} AS reason, count(*) AS n FROM t_stops GROUP BY 1")
def flt_valid_stop(v: Source):
    code = F.col("platform_code")
    rows = v("stops").select(F.when(code == "", "").otherwise(F.col("stop_id")).alias("stop_id"), F.when(code == "7", " ").otherwise(F.col("stop_name")).alias("stop_name"), F.when(code == "9", "91.5").otherwise(F.col("stop_lat").cast("string")).alias("stop_lat"), F.col("stop_lon").cast("string").alias("stop_lon"))
    good, bad = filters.valid_stops(rows)
    return good.agg(F.count("*").alias("n")).select(F.lit("ok").alias("reason"), "n").unionByName(bad)


@query("t_samples", "SELECT vehicle_id, count(*) AS n FROM t_samples WHERE longitude BETWEEN 30.52 AND 30.535 AND latitude BETWEEN 50.4 AND 50.5 GROUP BY 1")
def flt_valid_position(v: Source):
    region = F.struct(F.lit(50.4).alias("min_lat"), F.lit(50.5).alias("max_lat"), F.lit(30.52).alias("min_lon"), F.lit(30.535).alias("max_lon"))
    return filters.valid_positions(v("samples"), region).groupBy("vehicle_id").agg(F.count("*").alias("n"))


@query("t_rt_updates", "SELECT trip_id, count(*) AS n FROM t_rt_updates WHERE 1704067700-feed_ts <= 300 GROUP BY 1")
def flt_fresh(v: Source):
    return filters.fresh(v("rt_updates"), 1704067700, 300, True).groupBy("trip_id").agg(F.count("*").alias("n"))


@query("t_routes", "SELECT route_id, route_type FROM t_routes WHERE route_type IN ('0','3','11') AND route_id NOT IN ('r3','r6')")
def flt_route_type(v: Source):
    return filters.route_type_filter(v("routes"), ["0", "3", "11"], ["r3", "r6"]).select("route_id", "route_type")


@query("t_stops t_stop_times", "SELECT stop_id, location_type FROM t_stops s WHERE (location_type='1' AND (EXISTS (SELECT 1 FROM t_stop_times x WHERE x.stop_id=s.stop_id) OR EXISTS (SELECT 1 FROM t_stop_times x JOIN t_stops c ON c.stop_id=x.stop_id WHERE c.parent_station=s.stop_id))) OR (location_type='0' AND NOT EXISTS (SELECT 1 FROM t_stops p WHERE p.location_type='1' AND p.stop_id=s.parent_station))")
def flt_passenger_stops(v: Source):
    return filters.passenger_stops(v("stops"), v("stop_times")).select("stop_id", "location_type")


@query("usable", "SELECT trip_id, stop_sequence, stop_id, delay_seconds, cancelled FROM usable")
def flt_rt_relationship(v: Source):
    return filters.usable_updates(v("rt_updates")).select("trip_id", "stop_sequence", "stop_id", "delay_seconds", "cancelled")


@query("t_samples", "SELECT event_id FROM t_samples WHERE ts BETWEEN TIMESTAMP '2024-01-10' - INTERVAL 43200 SECOND AND TIMESTAMP '2024-01-10' + INTERVAL 86400 SECOND AND bearing IS NOT NULL")
def flt_active_window(v: Source):
    rows = v("samples").withColumn("state", F.when(F.col("bearing").isNull(), "CANCELLED"))
    return filters.active_events(rows, "2024-01-10 00:00:00", 43200, 86400).select("event_id")


@query("t_stop_times t_stops", "SELECT trip_id, stop_id, stop_sequence FROM t_stop_times WHERE trip_id IN (SELECT trip_id FROM t_stop_times JOIN t_stops USING (stop_id) WHERE stop_lat BETWEEN 48.0 AND 48.1 AND stop_lon BETWEEN 8.0 AND 8.05)")
def flt_region_trips(v: Source):
    return filters.region_trips(v("stop_times"), v("stops"), {"min_lat": 48.0, "max_lat": 48.1, "min_lon": 8.0, "max_lon": 8.05}).select("trip_id", "stop_id", "stop_sequence")


@query("t_cities", "SELECT city_id FROM t_cities WHERE city_id IN ('c0','c2')")
def flt_branch_cities(v: Source):
    number = F.substr("city_id", F.lit(2)).cast("int")
    rows = v("cities").withColumn("mode", F.when(number % 2 == 0, "radius").otherwise("boundary")).withColumn("adapters", F.when(number == 4, F.array(F.lit("x"))).otherwise(F.array(F.lit("own"))))
    return filters.branch_cities(rows, "radius", ["own"]).select("city_id")
