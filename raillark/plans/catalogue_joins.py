"""Queries over joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from raillark.operators import joins, sets, windows
from raillark.plans.base import Source, query

_BOX = "b.min_lon AND b.max_lon AND {lat} BETWEEN b.min_lat AND b.max_lat"


def public_stops(v: Source):
    return v("stops").where("location_type = '1'").select("stop_id")


@query("calls", "SELECT canonical_stop_id, service_date, departure_seconds, trip_id, stop_sequence, source_order, label, destination, direction_id, platform_code, terminal_stop_id FROM calls")
def join_calls(v: Source):
    f = v.feed()
    active = sets.active_services(f["calendar"], f["calendar_dates"], v.days())
    rows = joins.every_call(f["stop_times"], f["trips"], active, f["stops"], f["routes"])
    return rows.select("canonical_stop_id", "service_date", "departure_seconds", "trip_id", "stop_sequence", "source_order", "label", "destination", "direction_id", "platform_code", "terminal_stop_id")


@query("canon", "SELECT stop_id, canonical_stop_id FROM canon")
def join_parent_canonical(v: Source):
    return joins.canonical_stops(v("stops")).select("stop_id", "canonical_stop_id")


@query("resolved", "SELECT stop_id, public_id FROM resolved")
def join_ancestor_resolution(v: Source):
    return joins.resolve_stops(v("stops"), public_stops(v))


@query("t_stops", "SELECT c.stop_id AS source_stop_id, s.stop_id AS output_stop_id FROM t_stops s JOIN t_stops c ON c.parent_station=s.parent_station WHERE s.parent_station<>'' AND s.platform_code='' UNION ALL SELECT stop_id, stop_id FROM t_stops WHERE NOT (parent_station<>'' AND platform_code='')")
def join_station_group(v: Source):
    return joins.station_targets(v("stops"), v("stops"))


@query("radius", "SELECT city_id, stop_id, round(distance_m,6) AS distance_m FROM radius")
def join_radius(v: Source):
    return joins.within_radius(v("stops"), v("cities")).select("city_id", "stop_id", F.round("distance_m", 6).alias("distance_m"))


@query("boundary_hit", "SELECT stop_id, code FROM boundary_hit")
def join_point_in_polygon(v: Source):
    points = v("stops").withColumn("point_id", F.col("stop_id"))
    return joins.boundary_of(points, joins.box_polygons(v("boundaries"))).select("stop_id", "code")


@query("t_cities t_boundaries", "SELECT c.city_id, b.code FROM t_cities c, t_boundaries b WHERE c.longitude BETWEEN b.min_lon AND b.max_lon AND c.latitude BETWEEN b.min_lat AND b.max_lat AND CAST(substr(c.city_id,2) AS INT) % 2 = 0")
def join_city_claim(v: Source):
    bounds = joins.box_polygons(v("boundaries")).withColumn("name", F.lit("Claimed"))
    alias = F.when(F.substr("city_id", F.lit(2)).cast("int") % 2 == 0, F.array(F.lit("CLAIMED"))).otherwise(F.array().cast("array<string>"))
    return joins.city_claims(v("cities").withColumn("aliases", alias), bounds)


@query("t_stop_times t_stops", "SELECT trip_id, stop_id, stop_sequence, source_order FROM t_stop_times WHERE stop_id IN (SELECT stop_id FROM t_stops WHERE parent_station='s3')")
def join_semi_scope(v: Source):
    return joins.scope(v("stop_times"), v("stops").where("parent_station = 's3'"), "stop_id").select("trip_id", "stop_id", "stop_sequence", "source_order")


@query("weekly t_calendar_dates", "SELECT service_id, service_date FROM weekly w WHERE NOT EXISTS (SELECT 1 FROM t_calendar_dates c WHERE c.service_id=w.service_id AND c.service_date=w.service_date AND c.exception_type=2)")
def join_anti_exception(v: Source):
    none = v("calendar_dates").where("exception_type = 2")
    return sets.active_services(v("calendar"), none, v.days())


@query("t_routes t_trips t_stop_times t_stops t_calendar t_shapes", "SELECT 'routes' AS kind, count(*) AS n FROM t_routes WHERE agency_id='a3' UNION ALL SELECT 'trips', count(*) FROM t_trips WHERE route_id IN (SELECT route_id FROM t_routes WHERE agency_id='a3') UNION ALL SELECT 'stop_times', count(*) FROM t_stop_times WHERE trip_id IN (SELECT trip_id FROM t_trips JOIN t_routes USING (route_id) WHERE agency_id='a3') UNION ALL SELECT 'stops', count(DISTINCT stop_id) FROM (SELECT s.stop_id FROM t_stops s WHERE stop_id IN (SELECT stop_id FROM t_stop_times JOIN t_trips USING (trip_id) JOIN t_routes USING (route_id) WHERE agency_id='a3') UNION SELECT p.stop_id FROM t_stops s JOIN t_stops p ON p.stop_id=s.parent_station WHERE s.stop_id IN (SELECT stop_id FROM t_stop_times JOIN t_trips USING (trip_id) JOIN t_routes USING (route_id) WHERE agency_id='a3') UNION SELECT q.stop_id FROM t_stops s JOIN t_stops p ON p.stop_id=s.parent_station JOIN t_stops q ON q.stop_id=p.parent_station WHERE s.stop_id IN (SELECT stop_id FROM t_stop_times JOIN t_trips USING (trip_id) JOIN t_routes USING (route_id) WHERE agency_id='a3')) UNION ALL SELECT 'calendar', count(*) FROM t_calendar WHERE service_id IN (SELECT service_id FROM t_trips JOIN t_routes USING (route_id) WHERE agency_id='a3') UNION ALL SELECT 'shapes', count(*) FROM t_shapes WHERE shape_id IN (SELECT shape_id FROM t_trips JOIN t_routes USING (route_id) WHERE agency_id='a3')")
def join_agency_closure(v: Source):
    own = joins.agency_scope(v.feed("stops", "routes", "trips", "stop_times", "calendar", "shapes"), "a3")
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in own.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SUFFIX = "rt AS (SELECT DISTINCT CASE WHEN trip_id % 3 = 0 THEN 'x_'||m||'_'||trip_id ELSE m||'_'||trip_id END||CASE WHEN trip_id % 5 < 3 THEN '_wk' ELSE '' END AS trip_id FROM (SELECT o_orderkey AS trip_id, o_custkey % 5 AS m FROM orders))"


@query(sql="WITH " + _SUFFIX + ", ask AS (SELECT DISTINCT CAST(o_custkey % 5 AS STRING)||'_'||CAST(o_orderkey AS STRING)||CASE WHEN o_orderkey % 5 < 3 THEN '_wk' ELSE '' END AS rt_trip_id FROM orders UNION SELECT '_wk' UNION SELECT 'wk') SELECT rt_trip_id, trip_id FROM (SELECT a.rt_trip_id, min(t.trip_id) AS trip_id FROM ask a JOIN rt t ON a.rt_trip_id=t.trip_id GROUP BY 1 UNION ALL SELECT a.rt_trip_id, min(t.trip_id) FROM ask a JOIN rt t ON suffix(t.trip_id, a.rt_trip_id) WHERE a.rt_trip_id NOT IN (SELECT trip_id FROM rt) GROUP BY 1 HAVING count(*)=1)")
def join_suffix_unique(v: Source):
    rows = v.spark.read.parquet(f"{v.sf_dir}/orders.parquet")
    base = F.concat(F.concat_ws("_", (F.col("o_custkey") % 5).cast("string"), F.col("o_orderkey").cast("string")), F.when(F.col("o_orderkey") % 5 < 3, "_wk").otherwise(""))
    trips = rows.select(F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("x_"), base)).otherwise(base).alias("trip_id")).distinct()
    asked = rows.select(base.alias("rt_trip_id")).union(v.spark.sql("SELECT '_wk' UNION ALL SELECT 'wk'")).distinct()
    return joins.resolve_trip_suffix(asked, trips)


_STRICT = "SELECT u.trip_id, u.stop_id, u.stop_sequence, t.route_id, t.direction_id, u.delay_seconds FROM usable u JOIN t_trips t USING (trip_id) JOIN (SELECT DISTINCT stop_id FROM t_stops) s ON s.stop_id=u.stop_id WHERE u.route_id='' OR u.route_id=t.route_id"


@query("usable t_trips t_stops", _STRICT)
def join_rt_static(v: Source):
    from raillark.operators import filters

    rows = joins.rt_static_join(filters.usable_updates(v("rt_updates")), v("trips").select("trip_id", "route_id", "direction_id"), v("stops"), "strict")
    return rows.select("trip_id", "stop_id", "stop_sequence", "route_id", F.col("static_direction_id").alias("direction_id"), "delay_seconds")


@query("t_rt_updates t_trips", "SELECT trip_id, stop_sequence, route_id, provider_id, static_route_id, count(*) AS n FROM (SELECT u.rid, u.trip_id, u.stop_sequence, u.route_id, c.provider_id, c.static_route_id, row_number() OVER (PARTITION BY u.rid ORDER BY CASE WHEN u.route_id=c.static_route_id THEN 0 ELSE 1 END, c.provider_id DESC) AS r FROM (SELECT *, row_number() OVER () AS rid FROM t_rt_updates) u JOIN (SELECT 'pa' AS provider_id, trip_id AS native_trip_id, route_id AS static_route_id FROM t_trips UNION ALL SELECT 'pb', trip_id, 'rX' FROM t_trips) c ON c.native_trip_id=u.trip_id) WHERE r=1 GROUP BY ALL")
def join_rt_provider_context(v: Source):
    trips = v("trips")
    both = trips.select(F.lit("pa").alias("provider_id"), F.col("trip_id").alias("native_trip_id"), "trip_id", "route_id").unionByName(trips.select(F.lit("pb").alias("provider_id"), F.col("trip_id").alias("native_trip_id"), "trip_id", F.lit("rX").alias("route_id")))
    rows = joins.rt_context_join(v("rt_updates"), both, ["pb", "pa"])
    return rows.groupBy("trip_id", "stop_sequence", "route_id", "provider_id", "static_route_id").agg(F.count("*").alias("n"))


@query("t_rt_updates t_stop_times", "SELECT u.trip_id, u.stop_sequence, coalesce(nullif(u.stop_id,''), c.stop_id, '') AS stop_id, count(*) AS n FROM t_rt_updates u LEFT JOIN (SELECT trip_id, stop_sequence, arg_min(stop_id, source_order) AS stop_id FROM t_stop_times GROUP BY 1,2) c ON c.trip_id=u.trip_id AND c.stop_sequence=u.stop_sequence GROUP BY ALL")
def join_stop_by_sequence(v: Source):
    return joins.fill_stop_id(v("rt_updates"), v("stop_times")).groupBy("trip_id", "stop_sequence", "stop_id").agg(F.count("*").alias("n"))


_ALERTS = "SELECT s.alert_id, array_to_string(list_sort(list_distinct(list(r.route_id) FILTER (r.route_id IS NOT NULL))), ',') AS route_ids, array_to_string(list_sort(list_distinct(list(p.stop_id) FILTER (p.stop_id IS NOT NULL))), ',') AS stop_ids, array_to_string(list_sort(list_distinct(list(selector_value) FILTER (selector_type='direction_id'))), ',') AS directions, array_to_string(list_sort(list_distinct(list(selector_type||':'||selector_value) FILTER (r.route_id IS NULL AND p.stop_id IS NULL AND selector_type<>'direction_id'))), ',') AS unmapped FROM t_alert_selectors s LEFT JOIN t_routes r ON selector_type='route_short_name' AND r.short_name=selector_value AND r.short_name<>'' LEFT JOIN t_stops p ON selector_type='stop_code' AND substr(p.stop_id,2)=selector_value AND starts_with(p.stop_id,'p') GROUP BY 1"


def coded_stops(v: Source):
    return v("stops").where(F.startswith("stop_id", F.lit("p"))).select("stop_id", F.substr("stop_id", F.lit(2)).alias("stop_code"))


@query("t_alert_selectors t_routes t_stops", "SELECT alert_id, coalesce(route_ids,'') AS route_ids, coalesce(stop_ids,'') AS stop_ids, coalesce(directions,'') AS directions, coalesce(unmapped,'') AS unmapped FROM (" + _ALERTS + ")")
def join_alert_selectors(v: Source):
    return joins.alert_targets(v("alert_selectors"), v("routes"), coded_stops(v), text=True)


@query("t_stops", "SELECT stop_id FROM t_stops WHERE stop_id IN ('s1','s2','p5') UNION SELECT stop_id FROM t_stops WHERE parent_station IN ('s1','s2','p5') AND location_type='0'")
def join_child_platforms(v: Source):
    asked = v("stops").where(F.col("stop_id").isin("s1", "s2", "p5"))
    return joins.expand_platforms(asked, v("stops"))


@query("t_stops", "SELECT city_id, stop_id, provider_id FROM (SELECT 'c1' AS city_id, s.stop_id, CASE WHEN CAST(substr(s.stop_id,2) AS INT) % 3 = 0 THEN 'pb' WHEN CAST(substr(s.stop_id,2) AS INT) % 3 = 1 THEN 'pa' END AS provider_id FROM t_stops s WHERE starts_with(stop_id,'p'))")
def join_owner_resolution(v: Source):
    number = F.substr("stop_id", F.lit(2)).cast("int") % 3
    stops = v("stops").where(F.startswith("stop_id", F.lit("p")))
    package = stops.select(F.lit("c1").alias("city_id"), "stop_id")
    plain = stops.where(number <= 1).select(F.lit("pa").alias("provider_id"), F.col("stop_id").alias("key_1"))
    marked = stops.where(number == 0).select(F.lit("pb").alias("provider_id"), F.concat(F.lit("b:"), "stop_id").alias("key_1"))
    prefixes = v.spark.range(1).select(F.lit("pb").alias("provider_id"), F.lit("b:").alias("prefix"))
    return joins.stop_owners(package, plain.unionByName(marked), prefixes)


_HAV = "2*6371000.0*asin(least(1.0, sqrt(pow(sin((radians({c})-radians({a}))/2),2)+cos(radians({a}))*cos(radians({c}))*pow(sin((radians({d})-radians({b}))/2),2))))"


@query("t_catalogue t_stops t_cities", "SELECT c.city_id, k.stop_id, k.name FROM (SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY source_order) AS r FROM t_catalogue WHERE name<>'' AND stop_type IN (0,1)) k, t_cities c WHERE k.r=1 AND " + _HAV.format(a="c.latitude", b="c.longitude", c="k.latitude", d="k.longitude") + " <= c.radius_m AND NOT EXISTS (SELECT 1 FROM t_stops s WHERE abs(s.stop_lat-k.latitude)<0.01 AND " + _HAV.format(a="k.latitude", b="k.longitude", c="s.stop_lat", d="s.stop_lon") + " <= 150)")
def join_catalogue_fill(v: Source):
    return joins.catalogue_fill(v("catalogue"), v("stops"), v("cities"), [0, 1]).select("city_id", "stop_id", "name")


def shapes_of_routes(v: Source):
    """Segments of the shapes, and the shapes of each route."""
    return windows.shape_segments(v("shapes")).select(*joins.SEGMENT), v("trips").select("route_id", "shape_id").distinct()


_LOCATE = """, seg AS (SELECT s.*, progress2-progress1 AS length_m, r.route_id FROM segments s JOIN (SELECT DISTINCT route_id, shape_id FROM t_trips) r USING (shape_id)),
near AS (SELECT x.event_id, s.*, x.latitude, x.longitude, ((abs(floor(lat1/0.01)-floor(lat2/0.01))+1)*(abs(floor(lon1/0.01)-floor(lon2/0.01))+1)<=256 AND abs(floor(x.latitude/0.01) - greatest(least(floor(x.latitude/0.01), floor(greatest(lat1,lat2)/0.01)), floor(least(lat1,lat2)/0.01)))<=2 AND abs(floor(x.longitude/0.01) - greatest(least(floor(x.longitude/0.01), floor(greatest(lon1,lon2)/0.01)), floor(least(lon1,lon2)/0.01)))<=2) AS close FROM t_samples x JOIN seg s USING (route_id)),
cand AS (SELECT * FROM (SELECT *, bool_or(close) OVER (PARTITION BY event_id, shape_id) AS any_close FROM near) WHERE close OR NOT any_close),
proj AS (SELECT *, greatest(0.0, least(1.0, CASE WHEN q>0 THEN (px*dx+py*dy)/q ELSE 0.0 END)) AS t FROM (SELECT *, dx*dx+dy*dy AS q FROM (SELECT *, (lon2-lon1)*cos(radians((lat1+lat2)/2)) AS dx, lat2-lat1 AS dy, (longitude-lon1)*cos(radians((lat1+lat2)/2)) AS px, latitude-lat1 AS py FROM cand))),
dist AS (SELECT *, lat1+t*dy AS la, lon1+t*(lon2-lon1) AS lo FROM proj),
m AS (SELECT *, sqrt(pow((radians(lo)-radians(longitude))*cos((radians(latitude)+radians(la))/2),2)+pow(radians(la)-radians(latitude),2))*6371000.0 AS distance_m FROM dist),
m_all AS (SELECT event_id AS sample_id, shape_id, distance_m, progress1+t*length_m AS progress_m, (degrees(atan2((radians(lon2)-radians(lon1))*cos((radians(lat1)+radians(lat2))/2), radians(lat2)-radians(lat1)))+360)%360 AS segment_bearing FROM (SELECT *, row_number() OVER (PARTITION BY event_id, shape_id ORDER BY distance_m, seq) AS r FROM m) WHERE r=1)
"""
_MATCH = _LOCATE + "SELECT sample_id, shape_id, round(distance_m,4) AS distance_m, round(progress_m,4) AS progress_m FROM m_all"


@query("segments t_trips t_samples", _MATCH)
def join_map_match(v: Source):
    samples = v("samples").select(F.col("event_id").alias("sample_id"), "route_id", "latitude", "longitude")
    segments, routes = shapes_of_routes(v)
    rows = joins.map_match(samples, segments, routes=routes)
    return rows.select("sample_id", "shape_id", F.round("distance_m", 4).alias("distance_m"), F.round("progress_m", 4).alias("progress_m"))


def timed_calls(v: Source):
    """Calls with arrival, departure and place."""
    at = v("stops").select("stop_id", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"))
    return v("stop_times").join(at, "stop_id").select("trip_id", "stop_id", "stop_sequence", "source_order", (F.col("departure_seconds") - 30).alias("arrival"), F.col("departure_seconds").alias("departure"), "lat", "lon")


_PLACE = """SELECT trip_id, CASE rk WHEN 0 THEN 'dwell' WHEN 1 THEN 'moving' WHEN 2 THEN 'before' ELSE 'after' END AS state, round(CASE WHEN rk=1 THEN lat+(nlat-lat)*f ELSE lat END,6) AS latitude, round(CASE WHEN rk=1 THEN lon+(nlon-lon)*f ELSE lon END,6) AS longitude, CASE WHEN rk=1 THEN nstop ELSE stop_id END AS stop_id FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY rk, k) AS r FROM (SELECT *, CASE WHEN 40000 BETWEEN arrival AND departure THEN 0 WHEN 40000>departure AND 40000<narr THEN 1 WHEN k=1 AND 40000<arrival THEN 2 WHEN narr IS NULL AND 40000>departure THEN 3 END AS rk, (40000-departure)/greatest(1,narr-departure) AS f FROM (SELECT trip_id, stop_id, departure_seconds-30 AS arrival, departure_seconds AS departure, stop_lat AS lat, stop_lon AS lon, row_number() OVER w AS k, lead(departure_seconds-30) OVER w AS narr, lead(stop_lat) OVER w AS nlat, lead(stop_lon) OVER w AS nlon, lead(stop_id) OVER w AS nstop FROM t_stop_times JOIN t_stops USING (stop_id) WINDOW w AS (PARTITION BY trip_id ORDER BY stop_sequence, t_stop_times.source_order))) WHERE rk IS NOT NULL) WHERE r=1"""


@query("t_stop_times t_stops", _PLACE)
def join_schedule_interval(v: Source):
    rows = joins.schedule_position(timed_calls(v), 40000)
    return rows.select("trip_id", "state", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "stop_id")


@query("radius", "SELECT DISTINCT city_id, stop_id, 'pa' AS provider_id FROM (SELECT city_id, stop_id FROM radius UNION ALL SELECT city_id, parent_station FROM radius WHERE parent_station<>'')")
def join_city_membership(v: Source):
    source = F.when(F.col("parent_station") != "", F.array("parent_station")).otherwise(F.array().cast("array<string>"))
    packages = joins.within_radius(v("stops"), v("cities")).select("city_id", "stop_id", source.alias("source_ids"))
    return joins.city_memberships(packages, "pa")


@query("t_entities t_trips t_routes", "SELECT DISTINCT e.provider_id, t.trip_id, t.route_id, t.direction_id, coalesce(nullif(trim(r.short_name),''), nullif(trim(r.long_name),''), r.route_id) AS label, r.route_type FROM t_entities e JOIN t_trips t ON e.key_1=t.trip_id JOIN t_routes r ON r.route_id=t.route_id WHERE e.entity_type='trips' AND e.provider_id IN ('pa','pc')")
def join_provider_registry(v: Source):
    return joins.provider_registry(v("entities"), v("trips"), v("routes"), ["pa", "pc"])


@query("radius", "SELECT CASE city_id WHEN 'c1' THEN 'c0' ELSE city_id END AS city_id, count(*) AS n FROM radius GROUP BY 1")
def join_city_alias(v: Source):
    aliases = v("cities").where("city_id = 'c1'").select(F.col("city_id").alias("alias_city_id"), F.lit("c0").alias("canonical_city_id"))
    return joins.resolve_city(joins.within_radius(v("stops"), v("cities")), aliases).groupBy("city_id").agg(F.count("*").alias("n"))


@query("t_stops t_stop_times", "SELECT s.stop_id, CASE WHEN s.stop_id IN (SELECT stop_id FROM t_stop_times) THEN s.stop_id ELSE coalesce(p.stop_id, s.stop_id) END AS query_stop_id FROM t_stops s LEFT JOIN (SELECT DISTINCT stop_id FROM t_stops) p ON p.stop_id=s.parent_station")
def join_parent_fallback(v: Source):
    return joins.query_stop(v("stops"), v("stop_times"))


@query("radius", "SELECT DISTINCT city_id, stop_id, candidate FROM (SELECT city_id, stop_id, stop_id AS candidate FROM radius UNION ALL SELECT city_id, stop_id, CASE WHEN starts_with(stop_id,'p') THEN stop_id ELSE 'p'||stop_id END FROM radius UNION ALL SELECT city_id, stop_id, 'x:'||stop_id FROM radius WHERE city_id='c2')")
def join_prefix_candidates(v: Source):
    asked = joins.within_radius(v("stops"), v("cities")).select("city_id", "stop_id")
    cities = v("cities").select("city_id")
    modes = cities.select("city_id", F.lit("p").alias("prefix")).unionByName(cities.where("city_id = 'c2'").select("city_id", F.lit("x:").alias("prefix")))
    return joins.stop_candidates(modes, asked)


