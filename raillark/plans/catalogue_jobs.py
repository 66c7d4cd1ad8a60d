"""Queries over data products, manifests and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from raillark.functions import expr as e
from raillark.operators import joins
from raillark.operators.lineage import scratch
from raillark.plans import catalogue_joins as cj
from raillark.plans import catalogue_rows as cr
from raillark.plans import checks, jobs
from raillark.plans.base import WINDOW, Source, query
from raillark.sources import sinks, store


def city_stops(v: Source):
    return joins.within_radius(v("stops"), v("cities")).select("city_id", "stop_id")


@query("t_stop_times", "SELECT stop_id, sha256(stop_id) AS shard, substr(sha256(stop_id),1,2) AS bucket, count(*) AS n_rows FROM t_stop_times GROUP BY 1")
def snk_stop_shard(v: Source):
    folder = scratch(v.spark, "shards")
    manifest = sinks.write_stop_shards(v("stop_times").select("stop_id", "trip_id", "stop_sequence", "departure_time"), folder)
    return manifest.groupBy("stop_id", "shard", "bucket").agg(F.sum("n_rows").alias("n_rows"))


@query("radius t_cities", "SELECT city_id, name, stop_count, 'stops/'||city_id||'.json' AS url FROM (SELECT city_id, count(DISTINCT stop_id) AS stop_count FROM radius GROUP BY 1) JOIN t_cities USING (city_id)")
def snk_manifest(v: Source):
    rows, _ = sinks.city_manifest([city_stops(v)], v("cities"))
    return rows.select("city_id", "name", "stop_count", "url")


@query("radius", "SELECT city_id, count(*) AS n_stops, sum(length(stop_name)) AS name_chars FROM radius GROUP BY 1")
def snk_city_package(v: Source):
    rows = sinks.package_rows(joins.within_radius(v("stops"), v("cities")), "stops")
    back = rows.select("city_id", F.explode(F.from_json("value", "array<struct<id: string, name: string>>")).alias("s"))
    return back.groupBy("city_id").agg(F.count("*").alias("n_stops"), F.sum(F.length("s.name")).alias("name_chars"))


@query("calls radius three", "SELECT r.city_id, c.canonical_stop_id, c.service_date, c.departure_time, c.trip_id, c.stop_sequence, c.source_order, c.label, c.destination FROM calls c JOIN (SELECT DISTINCT city_id, stop_id FROM radius) r ON r.stop_id=c.canonical_stop_id JOIN three USING (service_date)")
def job_city_departures(v: Source):
    rows = jobs.city_departures(v.feed(), city_stops(v), v.days(*WINDOW))
    return rows.select("city_id", "canonical_stop_id", "service_date", "departure_time", "trip_id", "stop_sequence", "source_order", "label", "destination")


@query("t_stop_times t_trips active resolved t_stops t_routes term_b", "SELECT DISTINCT r.public_id, x.departure_time AS t, t.route_id AS r, coalesce(nullif(t.headsign,''), nullif(n.stop_name,''), nullif(o.short_name,''), nullif(o.long_name,''), t.route_id) AS h, t.direction_id AS d, x.trip_id AS p, x.stop_sequence AS q, CASE WHEN x.stop_id<>r.public_id THEN x.stop_id END AS s, CASE WHEN x.stop_id<>r.public_id THEN nullif(c.platform_code,'') END AS platform FROM t_stop_times x JOIN t_trips t USING (trip_id) JOIN (SELECT DISTINCT service_id FROM active) v USING (service_id) JOIN resolved r ON r.stop_id=x.stop_id JOIN t_stops c ON c.stop_id=x.stop_id JOIN t_routes o ON o.route_id=t.route_id LEFT JOIN term_b b ON b.trip_id=x.trip_id LEFT JOIN t_stops n ON n.stop_id=b.terminal_stop_id WHERE r.public_id IS NOT NULL")
def job_compact_departures(v: Source):
    return jobs.compact_departures(v.feed(), cj.public_stops(v), v.days())


@query("radius t_stops t_stop_times t_trips active_first t_routes term_c three", "SELECT g.output_stop_id, v.service_date, x.departure_time, x.trip_id, x.stop_sequence, x.source_order, coalesce(nullif(r.short_name,''), nullif(r.long_name,''), r.route_id) AS label, coalesce(nullif(t.headsign,''), n.stop_name, '?') AS destination, CASE r.route_type WHEN '0' THEN 'tram' WHEN '1' THEN 'subway' WHEN '2' THEN 'train' WHEN '3' THEN 'bus' WHEN '700' THEN 'bus' END AS mode FROM (SELECT c.stop_id AS source_stop_id, s.stop_id AS output_stop_id FROM t_stops s JOIN t_stops c ON c.parent_station=s.parent_station WHERE s.parent_station<>'' AND s.platform_code='' AND s.stop_id IN (SELECT stop_id FROM radius) UNION ALL SELECT stop_id, stop_id FROM t_stops WHERE NOT (parent_station<>'' AND platform_code='') AND stop_id IN (SELECT stop_id FROM radius)) g JOIN t_stop_times x ON x.stop_id=g.source_stop_id JOIN t_trips t ON t.trip_id=x.trip_id JOIN active_first v ON v.service_id=t.service_id JOIN t_routes r ON r.route_id=t.route_id LEFT JOIN term_c e ON e.trip_id=x.trip_id LEFT JOIN t_stops n ON n.stop_id=e.terminal_stop_id JOIN three ON three.service_date=v.service_date")
def job_station_departures(v: Source):
    rows = jobs.station_departures(v.feed(), v("cities"), v.days(*WINDOW))
    return rows.select("output_stop_id", "service_date", "departure_time", "trip_id", "stop_sequence", "source_order", "label", "destination", "mode")


_GROUPS = """, sel AS (SELECT * FROM t_stops WHERE stop_id IN (SELECT stop_id FROM radius)),
outs AS (SELECT CASE WHEN parent_station<>'' AND platform_code='' THEN 'parent:'||parent_station ELSE 'stop:'||stop_id END AS group_id, stop_id FROM sel),
mem AS (SELECT stop_id, 'parent:'||parent_station AS group_id FROM t_stops WHERE parent_station<>'' AND 'parent:'||parent_station IN (SELECT group_id FROM outs) UNION ALL SELECT stop_id, 'stop:'||stop_id FROM sel WHERE NOT (parent_station<>'' AND platform_code=''))
SELECT group_id, service_date, count(*) AS n_calls, max(n_outputs) AS n_outputs FROM mem JOIN t_stop_times x USING (stop_id) JOIN t_trips t USING (trip_id) JOIN t_routes USING (route_id) JOIN active_first a ON a.service_id=t.service_id JOIN three USING (service_date) JOIN (SELECT group_id, count(*) AS n_outputs FROM outs GROUP BY 1) USING (group_id) GROUP BY 1, 2"""


@query("radius t_stops t_stop_times t_trips t_routes active_first three", _GROUPS)
def job_station_calls(v: Source):
    rows, outputs = jobs.station_calls(v.feed(), v("cities"), v.days(*WINDOW))
    shown = outputs.groupBy("group_id").agg(F.count("*").alias("n_outputs"))
    return rows.groupBy("group_id", "service_date").agg(F.count("*").alias("n_calls")).join(shown, "group_id").select("group_id", "service_date", "n_calls", "n_outputs")


@query("radius t_stop_times t_trips t_calendar_dates", "SELECT x.stop_id, x.departure_time, x.trip_id, t.route_id, t.headsign, x.stop_sequence, row_number() OVER (PARTITION BY x.stop_id ORDER BY x.departure_time, x.trip_id, x.stop_sequence, x.source_order) AS rank FROM t_stop_times x JOIN t_trips t USING (trip_id) WHERE x.stop_id IN (SELECT stop_id FROM radius) AND t.service_id IN (SELECT service_id FROM t_calendar_dates WHERE service_date='20240115' AND exception_type=1)")
def job_day_departures(v: Source):
    return jobs.day_departures(v.feed(), city_stops(v), "20240115")


_NAMES = "concat_ws('/', nullif(short_name,''), CASE WHEN long_name<>short_name THEN nullif(long_name,'') END)"


@query("radius resolved t_stop_times t_trips t_routes", f"SELECT s.city_id, s.route_id, nullif({_NAMES},'') AS names, CAST(r.route_type AS INT) AS type, r.agency_id, h.n AS n_headsigns FROM (SELECT DISTINCT c.city_id, t.route_id FROM t_stop_times x JOIN resolved q USING (stop_id) JOIN radius c ON c.stop_id=q.public_id JOIN t_trips t ON t.trip_id=x.trip_id) s JOIN t_routes r ON r.route_id=s.route_id LEFT JOIN (SELECT route_id, count(DISTINCT direction_id) AS n FROM t_trips WHERE headsign<>'' GROUP BY 1) h ON h.route_id=s.route_id")
def job_route_index(v: Source):
    rows = jobs.route_index(v.feed(), city_stops(v), cj.public_stops(v))
    n = F.when(F.col("headsigns").isNotNull(), F.size(F.map_keys("headsigns"))).cast("bigint")
    return rows.select("city_id", "route_id", F.array_join("names", "/").alias("names"), "type", "agency_id", n.alias("n_headsigns"))


@query("radius t_stop_times t_trips", "SELECT c.city_id, t.trip_id, t.route_id, nullif(t.headsign,'') AS headsign FROM t_trips t JOIN (SELECT DISTINCT city_id, route_id FROM radius JOIN t_stop_times USING (stop_id) JOIN t_trips USING (trip_id)) c USING (route_id)")
def job_trip_index(v: Source):
    routes = city_stops(v).join(v("stop_times").select("stop_id", "trip_id"), "stop_id").join(v("trips").select("trip_id", "route_id"), "trip_id").select("city_id", "route_id")
    return jobs.trip_index(v.feed(), routes)


@query("radius", "SELECT city_id, stop_id, trim(replace(replace(replace(replace(lower(stop_name),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss')) AS search_name FROM radius")
def job_radius_packages(v: Source):
    rows, _ = jobs.radius_packages(v("stops"), v("cities"))
    return rows.select("city_id", "stop_id", "search_name")


@query("boundary_hit t_boundaries radius", "SELECT lower(regexp_replace(lower(b.name),'[^a-z0-9]+','-','g'))||'-'||h.code AS package_id, h.stop_id FROM boundary_hit h JOIN t_boundaries b USING (code) UNION ALL SELECT city_id, stop_id FROM radius")
def job_boundary_packages(v: Source):
    return jobs.boundary_packages(v("stops"), joins.box_polygons(v("boundaries")), v("cities"))


_PUBLIC = """, near AS (SELECT DISTINCT city_id, stop_id FROM radius),
inside AS (SELECT * FROM t_stops WHERE stop_id IN (SELECT stop_id FROM near)),
used AS (SELECT DISTINCT stop_id FROM t_stop_times),
seen AS (SELECT * FROM inside s WHERE (location_type='1' AND (stop_id IN (SELECT stop_id FROM used) OR stop_id IN (SELECT parent_station FROM inside WHERE stop_id IN (SELECT stop_id FROM used)))) OR (location_type='0' AND NOT EXISTS (SELECT 1 FROM inside p WHERE p.location_type='1' AND p.stop_id=s.parent_station))),
live AS (SELECT stop_id FROM used UNION SELECT parent_station FROM t_stops WHERE stop_id IN (SELECT stop_id FROM used)),
shown AS (SELECT * FROM seen s WHERE stop_id IN (SELECT stop_id FROM live) OR NOT EXISTS (SELECT 1 FROM seen o WHERE o.stop_id IN (SELECT stop_id FROM live) AND lower(o.stop_name)=lower(s.stop_name) AND round_even(o.stop_lat,2)=round_even(s.stop_lat,2) AND round_even(o.stop_lon,2)=round_even(s.stop_lon,2) AND {twin}<=150))
SELECT city_id, 'x:'||stop_id AS stop_id, stop_name FROM near JOIN shown USING (stop_id)
UNION ALL SELECT c.city_id, k.stop_id, k.name FROM (SELECT * FROM t_catalogue WHERE name<>'' AND stop_type IN (0,1) QUALIFY row_number() OVER (PARTITION BY stop_id ORDER BY source_order)=1) k, t_cities c WHERE {inside}<=c.radius_m AND NOT EXISTS (SELECT 1 FROM shown s WHERE abs(s.stop_lat-k.latitude)<0.01 AND {close}<=150)""".format(
    twin=cj._HAV.format(a="o.stop_lat", b="o.stop_lon", c="s.stop_lat", d="s.stop_lon"),
    inside=cj._HAV.format(a="c.latitude", b="c.longitude", c="k.latitude", d="k.longitude"),
    close=cj._HAV.format(a="k.latitude", b="k.longitude", c="s.stop_lat", d="s.stop_lon"),
)


@query("radius t_stops t_stop_times t_catalogue t_cities", _PUBLIC)
def job_public_packages(v: Source):
    return jobs.public_packages(v.feed(), v("cities"), v("catalogue"), "x:").select("city_id", "stop_id", "stop_name")


@query("boundary_hit t_stop_times t_trips t_routes t_stops", "SELECT code AS city_id, round(min(stop_lat)-0.015,6) AS min_lat, round(max(stop_lon)+0.015,6) AS max_lon, count(*) AS n_stops FROM boundary_hit JOIN t_stops USING (stop_id) WHERE stop_id IN (SELECT stop_id FROM t_stop_times JOIN t_trips USING (trip_id) JOIN t_routes USING (route_id) WHERE agency_id='a5') GROUP BY 1")
def job_operator_coverage(v: Source):
    regions, _ = jobs.operator_coverage(v.feed(), joins.box_polygons(v("boundaries")), "a5")
    return regions.select("city_id", F.round("min_lat", 6).alias("min_lat"), F.round("max_lon", 6).alias("max_lon"), "n_stops")


@query("t_trips t_stop_times term_a t_stops t_routes progress", ", " + cr._VARIANTS + ", l AS (SELECT shape_id, count(*) AS n_points, max(progress_m) AS length_m FROM progress GROUP BY 1) SELECT v.route_id, v.direction_id, v.shape_id, v.terminal_stop_id, v.destination, v.trip_ids, l.n_points, round(l.length_m,6) AS length_m FROM v JOIN l USING (shape_id) WHERE v.route_id IN (SELECT route_id FROM t_routes WHERE route_type IN ('0','3','11'))")
def job_radar_topology(v: Source):
    rows = jobs.radar_topology(v.feed("stops", "routes", "trips", "stop_times", "shapes"), ["0", "3", "11"])
    return rows.select("route_id", "direction_id", "shape_id", "terminal_stop_id", "destination", F.array_join("trip_ids", ",").alias("trip_ids"), "n_points", F.round("length_m", 6).alias("length_m"))


_UPDATES = """SELECT trip_id, route_id, stop_id, stop_sequence, delay_seconds, cancelled, CASE WHEN cancelled THEN 'CANCELED' ELSE 'SCHEDULED' END AS trip_status, strftime(make_timestamp(feed_ts*1000000), '%Y-%m-%dT%H:%M:%SZ') AS updated_at FROM (SELECT u.trip_id, t.route_id, u.stop_id, u.stop_sequence, u.delay_seconds, u.cancelled, u.feed_ts, row_number() OVER (PARTITION BY u.trip_id, u.stop_id, u.stop_sequence ORDER BY u.feed_ts DESC, u.delay_seconds) AS r FROM (SELECT x.* EXCLUDE (stop_id), coalesce(nullif(x.stop_id,''), c.stop_id, '') AS stop_id FROM usable x LEFT JOIN (SELECT trip_id, stop_sequence, arg_min(stop_id, source_order) AS stop_id FROM t_stop_times GROUP BY 1,2) c ON c.trip_id=x.trip_id AND c.stop_sequence=x.stop_sequence WHERE 1704067700-x.feed_ts<=400) u JOIN t_trips t USING (trip_id) JOIN (SELECT DISTINCT stop_id FROM t_stops) s ON s.stop_id=u.stop_id WHERE u.route_id='' OR u.route_id=t.route_id) WHERE r=1"""


@query("usable t_trips t_stops t_stop_times", _UPDATES)
def job_trip_updates(v: Source):
    return jobs.trip_updates_view(v("rt_updates"), v("trips").select("trip_id", "route_id", "direction_id"), v("stops"), v("stop_times"), 1704067700, 400)


@query("t_samples t_trips", "SELECT s.vehicle_id, CASE WHEN t.route_id IS NOT NULL THEN s.trip_id END AS trip_id, coalesce(t.route_id, s.route_id) AS route_id, t.direction_id, round(s.longitude,6) AS longitude, CASE WHEN s.bearing<0 THEN s.bearing+360 WHEN s.bearing>=360 THEN s.bearing-360 ELSE s.bearing END AS bearing, s.ts FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, event_id DESC) AS r FROM t_samples) s LEFT JOIN t_trips t ON t.trip_id=s.trip_id WHERE r=1")
def job_vehicle_positions(v: Source):
    return jobs.vehicle_view(v("samples"), v("trips")).withColumn("longitude", F.round("longitude", 6)).drop("latitude")


@query("t_alert_selectors t_routes t_stops", "SELECT alert_id, coalesce(route_ids,'') AS route_ids, coalesce(stop_ids,'') AS stop_ids, coalesce(directions,'') AS directions, coalesce(unmapped,'') AS unmapped FROM (" + cj._ALERTS + ")")
def job_alerts(v: Source):
    return jobs.alerts_view(v("alert_selectors"), v("routes"), cj.coded_stops(v))


@query("t_stop_times t_stops t_trips", "SELECT p.trip_id, p.state, p.latitude, p.longitude, t.route_id, t.direction_id, 'scheduleEstimate' AS source FROM (" + cj._PLACE + ") p JOIN t_trips t USING (trip_id)")
def job_schedule_vehicles(v: Source):
    rows = jobs.estimated_vehicles(cj.timed_calls(v), v("trips"), 40000)
    return rows.select("trip_id", "state", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "route_id", "direction_id", "source")


@query("t_stops t_routes t_trips", "SELECT 'stops' AS entity_type, 'x:'||stop_id AS key_1, 'pz' AS provider_id FROM t_stops UNION ALL SELECT 'routes', 'x:'||route_id, 'pz' FROM t_routes UNION ALL SELECT 'trips', 'x:'||trip_id, 'pz' FROM t_trips")
def job_import_entities(v: Source):
    return jobs.import_feed(v.feed("stops", "routes", "trips", "stop_times"), "pz", "x:")["entities"]


_GONE = "(SELECT key_1 FROM t_entities WHERE entity_type='{k}' AND provider_id='pb' EXCEPT SELECT key_1 FROM t_entities WHERE entity_type='{k}' AND provider_id<>'pb')"
_STORE = """, own AS (SELECT t.trip_id, t.route_id, e.provider_id FROM t_trips t JOIN t_entities e ON e.entity_type='trips' AND e.key_1=t.trip_id WHERE e.provider_id<>'pb'
  UNION ALL SELECT trip_id, 'new', 'pb' FROM t_trips WHERE CAST(substr(trip_id,2) AS BIGINT)%3=0),
one AS (SELECT trip_id, arg_min(route_id, provider_id) AS route_id, min(provider_id) AS provider_id FROM own GROUP BY 1)
SELECT provider_id, route_id='new' AS fresh, count(*) AS n, CAST(sum(CAST(substr(trip_id,2) AS BIGINT)) AS BIGINT) AS ids FROM one GROUP BY 1, 2"""


@query("t_trips t_entities", _STORE)
def job_provider_store(v: Source):
    """A provider replaced twice in a store: its old trips go, shared ones stay with their other owners."""
    folder = scratch(v.spark, "store")
    trips = v("trips").select("trip_id", "route_id")
    owned = trips.join(v("entities").where("entity_type = 'trips'").select(F.col("key_1").alias("trip_id"), "provider_id"), "trip_id")
    store.write_providers({"trips": owned}, folder, ["pa", "pb", "pc"])
    fresh = trips.where(F.substr("trip_id", F.lit(2)).cast("bigint") % 3 == 0).select("trip_id", F.lit("new").alias("route_id"), F.lit("pb").alias("provider_id"))
    for _ in range(2):
        store.write_providers({"trips": fresh}, folder, ["pb"])
    rows = store.read_entities(v.spark, folder, "trips").withColumn("fresh", F.col("route_id") == "new")
    return rows.groupBy("provider_id", "fresh").agg(F.count("*").alias("n"), F.sum(F.substr("trip_id", F.lit(2)).cast("bigint")).alias("ids"))


@query("t_entities t_trips t_routes", "SELECT 'trips' AS kind, trip_id AS id FROM t_trips WHERE trip_id NOT IN " + _GONE.format(k="trips") + " UNION ALL SELECT 'routes', route_id FROM t_routes WHERE route_id NOT IN " + _GONE.format(k="routes"))
def job_replace_provider(v: Source):
    tables = {"trips": v("trips").select(F.col("trip_id").alias("key_1")), "routes": v("routes").select(F.col("route_id").alias("key_1"))}
    kept, _ = jobs.replace_provider(tables, v("entities"), ["pb"])
    return kept["trips"].select(F.lit("trips").alias("kind"), F.col("key_1").alias("id")).unionByName(kept["routes"].select(F.lit("routes").alias("kind"), F.col("key_1").alias("id")))


def products(v: Source):
    """A small product table: two bundles."""
    rows = [("bundle.a", "a.monthly", "first", "monthly"), ("bundle.b", "b.lifetime", "second", "lifetime")]
    return v.spark.createDataFrame(rows, "bundle_id string, product_id string, app string, purchase_kind string")


HANDLED = {"first": ["SUBSCRIBED", "DID_RENEW", "REFUND"], "second": ["ONE_TIME_CHARGE", "REFUND"]}
_EVENTS = "SELECT notification_uuid, notification_type, bundle_id, product_id, environment, CASE bundle_id WHEN 'bundle.a' THEN 'first' ELSE 'second' END AS app, CASE WHEN bundle_id='bundle.a' AND product_id='a.monthly' THEN 'monthly' WHEN bundle_id='bundle.b' AND product_id='b.lifetime' THEN 'lifetime' ELSE 'unknown' END AS purchase_kind FROM t_store_events"
_HANDLED = f"SELECT *, purchase_kind<>'unknown' AND ((app='first' AND notification_type IN ('SUBSCRIBED','DID_RENEW','REFUND')) OR (app='second' AND notification_type IN ('ONE_TIME_CHARGE','REFUND'))) AS is_handled FROM ({_EVENTS})"


@query("t_store_events", _HANDLED)
def job_business_events(v: Source):
    return jobs.business_events(v("store_events"), products(v), HANDLED)


@query("t_store_events", f"SELECT notification_uuid, app||chr(10)||CASE WHEN notification_type='SUBSCRIBED' AND purchase_kind='monthly' THEN 'New monthly subscription' WHEN notification_type='DID_RENEW' AND purchase_kind='monthly' THEN 'Monthly subscription renewed' WHEN notification_type='REFUND' THEN 'Refund' ELSE 'Lifetime purchased' END||chr(10)||'Environment: Production'||chr(10)||'Product: '||product_id AS message FROM ({_HANDLED}) WHERE is_handled AND environment<>'Sandbox'")
def job_event_messages(v: Source):
    return jobs.event_messages(jobs.business_events(v("store_events"), products(v), HANDLED))


@query("t_stops", "SELECT stop_id AS source_id, CASE WHEN source_order % 50 = 0 THEN 'missing' WHEN source_order % 30 = 0 THEN 'digest' ELSE 'size' END AS problem FROM t_stops WHERE source_order % 50 = 0 OR source_order % 30 = 0 OR source_order % 70 = 0")
def job_provenance_join(v: Source):
    n = F.col("source_order")
    expected = v("stops").select(F.col("stop_id").alias("source_id"), e.content_key(["stop_id"], "sha256", 64).alias("sha256"), n.alias("size"))
    actual = v("stops").where(n % 50 != 0).select(F.col("stop_id").alias("source_id"), e.content_key([F.when(n % 30 == 0, F.concat("stop_id", F.lit("!"))).otherwise(F.col("stop_id"))], "sha256", 64).alias("sha256"), F.when(n % 70 == 0, n + 1).otherwise(n).alias("size"))
    return jobs.provenance_diff(expected, actual)


@query("t_stop_times t_trips active", "SELECT CAST(hour AS BIGINT) AS hour, count(DISTINCT trip_id) AS n_trips, count(DISTINCT stop_id) AS n_stops FROM (SELECT t.trip_id, unnest(range(CAST(floor((s.b+lo)/3600) AS BIGINT), CAST(floor((s.b+hi)/3600) AS BIGINT)+1)) AS hour FROM (SELECT trip_id, min(departure_seconds) AS lo, max(departure_seconds) AS hi FROM t_stop_times GROUP BY 1) x JOIN t_trips t USING (trip_id) JOIN (SELECT service_id, epoch(strptime(service_date,'%Y%m%d'))::BIGINT AS b FROM active WHERE service_date BETWEEN '20240114' AND '20240117') s USING (service_id)) JOIN (SELECT DISTINCT trip_id, stop_id FROM t_stop_times) USING (trip_id) GROUP BY 1")
def str_hourly_network(v: Source):
    return jobs.hourly_network(v.feed(), v.days("20240114", "20240117"), v("trips"))


@query("t_stop_times t_trips active", "SELECT DISTINCT CAST(hour AS BIGINT) AS hour, stop_id FROM (SELECT t.trip_id, unnest(range(CAST(floor((s.b+lo)/3600) AS BIGINT), CAST(floor((s.b+hi)/3600) AS BIGINT)+1)) AS hour FROM (SELECT trip_id, min(departure_seconds) AS lo, max(departure_seconds) AS hi FROM t_stop_times GROUP BY 1) x JOIN t_trips t USING (trip_id) JOIN (SELECT service_id, epoch(strptime(service_date,'%Y%m%d'))::BIGINT AS b FROM active WHERE service_date BETWEEN '20240114' AND '20240115') s USING (service_id)) JOIN (SELECT DISTINCT trip_id, stop_id FROM t_stop_times) USING (trip_id)")
def str_hourly_stops(v: Source):
    return jobs.hourly_stops(v.feed(), v.days("20240114", "20240115"), v("trips"))


@query("t_stops", "SELECT 'shapes' AS table_name, CAST(0 AS BIGINT) AS n")
def chk_feed_tables(v: Source):
    return checks.check_feed(v.feed("stops", "routes", "trips", "stop_times"), ("stops", "routes", "trips", "stop_times", "shapes"))


_KEY = "from_stop_id, to_stop_id, from_trip_id"


@query("t_transfers", f"SELECT {_KEY}, count(*) AS n_values FROM (SELECT DISTINCT {_KEY}, transfer_type, min_transfer_time FROM t_transfers) GROUP BY ALL HAVING count(*)>1")
def chk_conflicting_duplicates(v: Source):
    return checks.conflicting(v("transfers"), ["from_stop_id", "to_stop_id", "from_trip_id"], ["transfer_type", "min_transfer_time"])


@query("t_entities t_trips t_routes", "SELECT entity_type, provider_id, key_1 FROM t_entities WHERE (entity_type='trips' AND key_1 NOT IN (SELECT trip_id FROM t_trips)) OR (entity_type='routes' AND key_1 NOT IN (SELECT route_id FROM t_routes))")
def chk_orphans(v: Source):
    return checks.orphans(v("entities"), {"trips": (v("trips"), "trip_id"), "routes": (v("routes"), "route_id")})


@query("radius t_stop_times", "SELECT city_id, 'stop_outside_package' AS problem FROM radius JOIN t_stop_times USING (stop_id) WHERE t_stop_times.source_order=1 GROUP BY city_id HAVING count(*) FILTER (WHERE CAST(substr(stop_id,2) AS INT) % 11 = 0)>0 UNION ALL SELECT DISTINCT city_id, 'count' FROM radius JOIN t_stop_times USING (stop_id) WHERE city_id='c2' UNION ALL SELECT DISTINCT city_id, 'unknown_city' FROM radius JOIN t_stop_times USING (stop_id) WHERE t_stop_times.source_order=1 AND city_id='c4' UNION ALL SELECT 'c1', 'alias_shadows' UNION ALL SELECT 'old', 'alias_target'")
def chk_departure_index(v: Source):
    near = city_stops(v)
    calls = v("stop_times").where("source_order = 1").select("stop_id", "trip_id")
    index = near.join(calls, "stop_id")
    counts = near.join(v("stop_times"), "stop_id").select("city_id").distinct().join(index.groupBy("city_id").agg(F.count("*").alias("n")), "city_id", "left")
    manifest = counts.where("city_id <> 'c4'").select("city_id", (F.coalesce("n", F.lit(0)) + F.when(F.col("city_id") == "c2", 1).otherwise(0)).alias("departure_count"))
    packages = near.where(F.substr("stop_id", F.lit(2)).cast("int") % 11 != 0)
    aliases = v.spark.sql("SELECT 'c1' AS alias_city_id, 'c2' AS canonical_city_id UNION ALL SELECT 'c1', 'c1' UNION ALL SELECT 'old', 'c9' UNION ALL SELECT 'older', 'c0'")
    return checks.check_departures(index, packages, manifest, aliases)


@query("radius t_cities", "SELECT c.city_id, p.problem FROM (SELECT city_id, count(*) AS n, min(distance_m) AS near FROM radius GROUP BY 1) c, (SELECT unnest(['count','no_stop_near_center']) AS problem) p WHERE (p.problem='count' AND c.city_id='c1') OR (p.problem='no_stop_near_center' AND c.near>2000)")
def chk_public_package(v: Source):
    packages = joins.within_radius(v("stops"), v("cities"))
    manifest = packages.groupBy("city_id").agg(F.count("*").alias("n")).select("city_id", (F.col("n") + F.when(F.col("city_id") == "c1", 1).otherwise(0)).alias("stop_count"))
    return checks.check_packages(packages, v("cities"), manifest, 2000.0)


@query("t_routes", "SELECT route_id AS source_id, 'missing' AS problem FROM t_routes WHERE agency_id='a1' AND route_type IN ('0','1') OR route_id='r7' AND agency_id='a1' UNION ALL SELECT route_id, 'no_path' FROM t_routes WHERE route_type='2' AND short_name=''")
def chk_sources_active(v: Source):
    routes = v("routes")
    kind = F.when(F.col("route_type").isin("0", "1"), "required").when(F.col("route_id") == "r7", "conditional").otherwise("optional")
    registry = routes.select(F.col("route_id").alias("source_id"), kind.alias("class"), (F.col("route_type") == "2").alias("importable"), F.col("short_name").alias("path"))
    candidate = routes.where("agency_id <> 'a1'").select(F.col("route_id").alias("source_id"))
    return checks.check_sources(registry, candidate, ["r7"])


@query("t_stops t_routes", "SELECT 'routes' AS table_name, CAST(count(*)+1 AS BIGINT) AS expected, count(*) AS actual FROM t_routes")
def chk_expected_counts(v: Source):
    tables = v.feed("stops", "routes")
    n = {k: df.agg(F.count("*").alias("n")) for k, df in tables.items()}
    expected = n["stops"].select(F.lit("stops").alias("table_name"), F.col("n").alias("expected")).unionByName(n["routes"].select(F.lit("routes").alias("table_name"), (F.col("n") + 1).alias("expected")))
    return checks.check_counts(tables, expected)


@query("t_catalogue t_stops", "SELECT stop_id AS id, 'repeated' AS problem FROM t_catalogue GROUP BY 1 HAVING count(*)>1 UNION ALL SELECT DISTINCT stop_id, 'unexpected' FROM t_catalogue WHERE CAST(substr(stop_id,2) AS INT)%9=0 UNION ALL SELECT 'absent', 'missing'")
def chk_expected_ids(v: Source):
    rows = v("catalogue")
    expected = rows.where(F.substr("stop_id", F.lit(2)).cast("int") % 9 != 0).select("stop_id").union(v.spark.sql("SELECT 'absent'"))
    return checks.check_ids(rows, expected, "stop_id")


