"""Queries over aggregations, windows, sorts, set operations and batch forms of streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from raillark.operators import aggregates, filters, joins, sets, windows
from raillark.operators.lineage import cut
from raillark.plans import catalogue_joins as cj
from raillark.plans import jobs
from raillark.plans.base import Source, query
from raillark.plans.catalogue_joins import _HAV
from raillark.streaming import realtime, vehicles


def text(*names: str):
    return [F.array_join(n, ",").alias(n) for n in names]


_NAMES = "concat_ws('/', nullif(short_name,''), CASE WHEN long_name<>short_name THEN nullif(long_name,'') END)"
_LINES = f"SELECT DISTINCT x.stop_id, r.route_id, {_NAMES} AS names, r.agency_id, CAST(r.route_type AS INT) AS route_type FROM t_stop_times x JOIN t_trips t USING (trip_id) JOIN t_routes r ON r.route_id=t.route_id WHERE r.short_name<>'' OR r.long_name<>''"


@query("t_stop_times t_trips t_routes", _LINES)
def agg_lines_per_stop(v: Source):
    return aggregates.lines_by_stop(v("stop_times"), v("trips"), v("routes")).withColumn("names", F.array_join("names", "/"))


@query("radius t_stop_times t_trips t_routes", f"SELECT city_id, string_agg(route_id, ',' ORDER BY k, route_id) AS lines FROM (SELECT DISTINCT c.city_id, l.route_id, trim(lower(split_part(l.names,'/',1))) AS k FROM radius c JOIN ({_LINES}) l USING (stop_id)) GROUP BY 1")
def agg_city_lines(v: Source):
    near = joins.within_radius(v("stops"), v("cities")).select("city_id", "stop_id")
    lines = aggregates.lines_by_stop(joins.scope(v("stop_times"), near, "stop_id"), v("trips"), v("routes"))
    rows = aggregates.city_lines(lines, near)
    return rows.select("city_id", F.array_join(F.transform("lines", lambda x: x["route_id"]), ",").alias("lines"))


@query("t_trips", "SELECT route_id, string_agg(direction_id||'='||headsign, ';' ORDER BY direction_id) AS headsigns FROM (SELECT route_id, direction_id, arg_min(headsign, CAST(substr(trip_id,2) AS INT)) AS headsign FROM t_trips WHERE headsign<>'' GROUP BY 1,2) GROUP BY 1")
def agg_route_headsigns(v: Source):
    trips = v("trips").withColumn("source_order", F.substr("trip_id", F.lit(2)).cast("int"))
    pairs = F.transform(F.array_sort(F.map_entries("headsigns")), lambda x: F.concat_ws("=", x["key"], x["value"]))
    return aggregates.route_headsigns(trips).select("route_id", F.array_join(pairs, ";").alias("headsigns"))


@query("radius t_stop_times", "SELECT city_id, count(DISTINCT stop_id) AS stop_count, count(*) AS departure_count FROM radius JOIN t_stop_times USING (stop_id) GROUP BY 1")
def agg_city_counts(v: Source):
    near = joins.within_radius(v("stops"), v("cities")).select("city_id", "stop_id")
    return aggregates.city_counts(near.join(v("stop_times"), "stop_id"))


@query("boundary_hit t_stops", "SELECT code AS city_id, round(min(stop_lat)-0.015,6) AS min_lat, round(max(stop_lat)+0.015,6) AS max_lat, round(min(stop_lon)-0.015,6) AS min_lon, round(max(stop_lon)+0.015,6) AS max_lon, round(avg(stop_lat),6) AS center_lat, round(avg(stop_lon),6) AS center_lon, count(*) AS n_stops FROM boundary_hit JOIN t_stops USING (stop_id) GROUP BY 1")
def agg_city_bounds(v: Source):
    points = joins.boundary_of(v("stops").withColumn("point_id", F.col("stop_id")), joins.box_polygons(v("boundaries"))).withColumnRenamed("code", "city_id")
    rows = aggregates.coverage_regions(points)
    return rows.select("city_id", *(F.round(c, 6).alias(c) for c in rows.columns[1:-1]), "n_stops")


@query("t_stops", "SELECT max(n) AS largest FROM (SELECT count(*) AS n FROM t_stops GROUP BY trim(lower(stop_name)), round_even(stop_lat,2), round_even(stop_lon,2))")
def agg_duplicate_bins(v: Source):
    return aggregates.duplicate_bins(v("stops"))


@query("t_stops t_stop_times", "SELECT s.stop_id FROM t_stops s WHERE s.stop_id IN (SELECT stop_id FROM t_stop_times WHERE stop_sequence=2) OR NOT EXISTS (SELECT 1 FROM t_stops o WHERE o.stop_id IN (SELECT stop_id FROM t_stop_times WHERE stop_sequence=2) AND lower(o.stop_name)=lower(s.stop_name) AND round_even(o.stop_lat,2)=round_even(s.stop_lat,2) AND round_even(o.stop_lon,2)=round_even(s.stop_lon,2))")
def agg_unserved_twins(v: Source):
    served = v("stop_times").where("stop_sequence = 2").select("stop_id")
    return aggregates.drop_unserved_twins(v("stops"), served).select("stop_id")


@query("t_boundaries", "SELECT code, CASE WHEN count(*) OVER (PARTITION BY substr(name,1,1))>1 THEN substr(name,1,1)||' ('||state||')' ELSE substr(name,1,1) END AS display_name, CASE WHEN count(*) OVER (PARTITION BY substr(name,1,1))>1 THEN substr(name,1,1) END AS alias FROM t_boundaries")
def agg_duplicate_names(v: Source):
    rows = v("boundaries").withColumn("name", F.substr("name", F.lit(1), F.lit(1)))
    return aggregates.display_names(rows).select("code", "display_name", "alias")


_VARIANTS = "p AS (SELECT trip_id, string_agg(stop_id, ',' ORDER BY stop_sequence, source_order, stop_id) AS stop_ids, string_agg(CAST(stop_sequence AS STRING), ',' ORDER BY stop_sequence, source_order) AS sequences FROM t_stop_times GROUP BY 1), v AS (SELECT t.route_id, t.direction_id, t.shape_id, e.terminal_stop_id, coalesce(nullif(t.headsign,''), n.stop_name, '') AS destination, p.stop_ids, p.sequences, string_agg(t.trip_id, ',' ORDER BY t.trip_id) AS trip_ids FROM t_trips t JOIN p USING (trip_id) LEFT JOIN term_a e USING (trip_id) LEFT JOIN t_stops n ON n.stop_id=e.terminal_stop_id GROUP BY ALL)"


def variants(v: Source):
    return aggregates.trip_variants(v("trips"), v("stop_times"), windows.terminal_stops(v("stop_times"), "A"), v("stops"))


@query("t_trips t_stop_times term_a t_stops", ", " + _VARIANTS + " SELECT * FROM v")
def agg_trip_variants(v: Source):
    rows = variants(v).withColumn("sequences", F.col("sequences").cast("array<string>"))
    return rows.select("route_id", "direction_id", "shape_id", "terminal_stop_id", "destination", *text("stop_ids", "sequences", "trip_ids"))


@query("resolved t_stops", "SELECT public_id AS station_id, string_agg(DISTINCT s.stop_id, ',' ORDER BY s.stop_id) AS platform_ids FROM t_stops s JOIN resolved r USING (stop_id) WHERE s.location_type='0' AND public_id<>s.stop_id GROUP BY 1")
def agg_platforms_of_station(v: Source):
    resolved = joins.resolve_stops(v("stops"), cj.public_stops(v))
    return aggregates.platform_map(v("stops"), resolved).select("station_id", *text("platform_ids"))


@query("active", "SELECT service_id, string_agg(service_date, ',' ORDER BY service_date) AS dates FROM active GROUP BY 1")
def agg_service_dates(v: Source):
    active = sets.active_services(v("calendar"), v("calendar_dates"), v.days())
    return aggregates.service_dates(active).select("service_id", *text("dates"))


@query("t_rt_updates", "SELECT count_if(trip_relationship NOT IN (0,3)) AS trip_relationship, count_if(trip_relationship IN (0,3) AND stop_relationship=1) AS skipped, count_if(trip_relationship IN (0,3) AND stop_relationship=2) AS no_data, count_if(trip_relationship IN (0,3) AND stop_relationship=3) AS unscheduled, count_if(trip_relationship IN (0,3) AND stop_relationship=0) AS usable, count(*) AS entities, count(DISTINCT route_id) AS routes, count(DISTINCT trip_id) AS trips FROM t_rt_updates")
def agg_rt_counters(v: Source):
    rows = aggregates.rt_counters(filters.update_reason(v("rt_updates")))
    return rows.select("trip_relationship", "skipped", "no_data", "unscheduled", "usable", "entities", "routes", "trips")


@query("t_rt_updates", "SELECT sum(entities) AS entities, max(feed_ts) AS feed_ts, bool_or(stale) AS any_stale, bool_or(failed) AS partial FROM (SELECT trip_relationship AS feed, count(*) AS entities, max(feed_ts) AS feed_ts, max(feed_ts)<1704067799 AS stale, count(*)<1000 AS failed FROM t_rt_updates GROUP BY 1)")
def agg_feed_merge(v: Source):
    one = lambda k: v("rt_updates").where(F.col("trip_relationship") == k).groupBy(F.col("trip_relationship").alias("feed")).agg(F.count("*").alias("entities"), F.max("feed_ts").alias("feed_ts")).withColumn("stale", F.col("feed_ts") < 1704067799).withColumn("failed", F.col("entities") < 1000)
    return aggregates.merge_feeds([one(0), one(1), one(3)])


@query("t_trips t_stop_times term_a t_stops segments", ", " + _VARIANTS + ", s AS (SELECT shape_id, count(*) AS n FROM segments GROUP BY 1) SELECT route_id, candidates, coalesce(shapes,0) AS shapes, coalesce(segments,0) AS segments FROM (SELECT route_id, count(*) AS candidates FROM v GROUP BY 1) LEFT JOIN (SELECT route_id, count(*) AS shapes, sum(n) AS segments FROM (SELECT DISTINCT route_id, shape_id FROM v) JOIN s USING (shape_id) GROUP BY 1) USING (route_id) ORDER BY segments DESC, candidates DESC, route_id LIMIT 10")
def agg_topology_fanout(v: Source):
    return aggregates.top_fanout(aggregates.topology_fanout(variants(v), windows.shape_segments(v("shapes"))))


@query("t_trips", "SELECT dataset, arg_max(id, y*1000000000+k) AS id, CAST(max(y) AS INT) AS year FROM (SELECT shape_id AS dataset, trip_id AS id, 2000+CAST(substr(trip_id,2) AS BIGINT)%26 AS y, CAST(substr(trip_id,2) AS BIGINT) AS k FROM t_trips WHERE CAST(substr(trip_id,2) AS BIGINT)%7<>0) GROUP BY 1")
def agg_latest_version(v: Source):
    number = F.substr("trip_id", F.lit(2)).cast("int")
    year = F.when(number % 7 != 0, (2000 + number % 26).cast("string")).otherwise("none")
    rows = v("trips").select(F.col("shape_id").alias("dataset"), F.array(F.struct(year.alias("year"), F.lpad(number.cast("string"), 9, "0").alias("id"))).alias("versions"))
    return aggregates.latest_version(rows).select("dataset", F.concat(F.lit("t"), F.col("id").cast("int").cast("string")).alias("id"), "year")


@query("t_alert_selectors t_routes t_stops", ", a AS (" + cj._ALERTS + ") SELECT count(*) AS alerts, count_if(coalesce(unmapped,'')='') AS mapped_alerts, CAST(sum(CASE WHEN coalesce(unmapped,'')='' THEN 0 ELSE length(unmapped)-length(replace(unmapped,',',''))+1 END) AS BIGINT) AS unmapped_selectors, (SELECT count(DISTINCT r) FROM (SELECT unnest(string_split(route_ids,',')) AS r FROM a WHERE route_ids<>'')) AS routes FROM a")
def agg_alert_counts(v: Source):
    return joins.alert_counts(v("alert_selectors"), v("routes"), cj.coded_stops(v))


@query("term_a term_b term_c", "SELECT a.trip_id, a.terminal_stop_id AS a, b.terminal_stop_id AS b, c.terminal_stop_id AS c FROM term_a a LEFT JOIN term_b b USING (trip_id) JOIN term_c c USING (trip_id)")
def win_terminal_stop(v: Source):
    calls = v("stop_times")
    one = lambda k: windows.terminal_stops(calls, k).withColumnRenamed("terminal_stop_id", k.lower())
    return one("A").join(one("B"), "trip_id", "left").join(one("C"), "trip_id")


@query("t_catalogue", "SELECT stop_id, name, source_order FROM (SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY source_order) AS r FROM t_catalogue) WHERE r=1")
def win_first_wins(v: Source):
    return windows.first_wins(v("catalogue"), ["stop_id"]).select("stop_id", "name", "source_order")


@query("t_catalogue", "SELECT stop_id, name, source_order FROM (SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY source_order DESC) AS r FROM t_catalogue) WHERE r=1")
def win_last_wins(v: Source):
    return windows.last_wins(v("catalogue"), ["stop_id"]).select("stop_id", "name", "source_order")


@query("radius", "SELECT city_id, arg_min(stop_id, p*1000000000+source_order) AS stop_id, min(p) AS priority, string_agg(DISTINCT stop_id, ',' ORDER BY stop_id) AS stop_ids FROM (SELECT *, CASE WHEN starts_with(stop_id,'s') THEN 0 ELSE 1 END AS p FROM radius) GROUP BY city_id, lower(trim(stop_name)), round_even(stop_lat*20,0), round_even(stop_lon*20,0)")
def win_priority_dedupe(v: Source):
    rows = joins.within_radius(v("stops"), v("cities")).withColumn("priority", F.when(F.startswith("stop_id", F.lit("s")), 0).otherwise(1))
    return windows.priority_dedupe(rows).select("city_id", "stop_id", "priority", *text("stop_ids"))


@query("canon", "SELECT stop_id, stop_name FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(stop_name)), round_even(stop_lat*10000,0), round_even(stop_lon*10000,0) ORDER BY source_order) AS r FROM canon WHERE stop_id=canonical_stop_id) WHERE r=1")
def win_parent_dedupe(v: Source):
    return windows.canonical_packages_input(joins.canonical_stops(v("stops"))).select("stop_id", "stop_name")


@query("progress", "SELECT shape_id, shape_pt_sequence, round(progress_m,6) AS progress_m FROM progress")
def win_shape_progress(v: Source):
    return windows.shape_progress(v("shapes")).select("shape_id", "shape_pt_sequence", F.round("progress_m", 6).alias("progress_m"))


@query("segments", "SELECT shape_id, seq, round(progress2-progress1,6) AS length_m, CAST((abs(floor(lat1/0.01)-floor(lat2/0.01))+1)*(abs(floor(lon1/0.01)-floor(lon2/0.01))+1) AS BIGINT) AS n_cells FROM segments")
def win_shape_segments(v: Source):
    return windows.shape_segments(v("shapes")).select("shape_id", "seq", F.round("length_m", 6).alias("length_m"), "n_cells")


_PAIRS = "SELECT * FROM (SELECT vehicle_id, route_id, event_id, ts, latitude, longitude, bearing, lag(event_id) OVER w AS prev_event_id, lag(latitude) OVER w AS prev_latitude, lag(longitude) OVER w AS prev_longitude, lag(route_id) OVER w AS pr, datesub('second', lag(ts) OVER w, ts) AS elapsed_s FROM (SELECT * FROM t_samples QUALIFY row_number() OVER (PARTITION BY vehicle_id, ts ORDER BY event_id)=1) WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts)) WHERE elapsed_s>0 AND elapsed_s<=7200 AND pr=route_id"


@query("t_samples", f"SELECT event_id, prev_event_id, elapsed_s FROM ({_PAIRS})")
def win_previous_sample(v: Source):
    return windows.sample_pairs(v("samples"), 7200).select("event_id", "prev_event_id", "elapsed_s")


def pair_scores(v: Source):
    """Candidate scores of sample pairs; a shape is a candidate here.  Each sample is matched once."""
    pairs = windows.sample_pairs(v("samples"), 7200)
    segments, routes = cj.shapes_of_routes(v)
    samples = v("samples").select(F.col("event_id").alias("sample_id"), "route_id", "latitude", "longitude")
    found = cut(joins.map_match(samples, segments, most_m=1000.0, routes=routes))  # read for both ends
    named = lambda k, key: found.select(F.col("sample_id").alias(key), "shape_id", F.col("distance_m").alias(f"distance_{k}"), F.col("progress_m").alias(f"progress_{k}"), F.col("segment_bearing").alias(f"bearing_{k}"))
    both = pairs.select("event_id", "prev_event_id", "elapsed_s", "bearing").join(named("after", "event_id"), "event_id").join(named("before", "prev_event_id"), ["prev_event_id", "shape_id"])
    return windows.candidate_scores(both.withColumnRenamed("event_id", "pair_id").withColumnRenamed("shape_id", "candidate"))


def named_scores(v: Source):
    """The scores with a made up terminal and direction of each shape."""
    number = F.substr("candidate", F.lit(3)).cast("int")
    return pair_scores(v).withColumn("terminal_stop_id", F.concat(F.lit("s"), (number % 7).cast("string"))).withColumn("destination", F.lit("")).withColumn("direction_id", (number % 2).cast("string"))


_SCORES = f"""{cj._LOCATE},
hit AS (SELECT * FROM m_all WHERE distance_m<=1000),
pairs AS ({_PAIRS}),
ends AS (SELECT p.event_id AS pair_id, a.shape_id AS candidate, p.elapsed_s, p.bearing, a.distance_m AS da, b.distance_m AS db, a.progress_m-b.progress_m AS step, a.segment_bearing AS sb FROM pairs p JOIN hit a ON a.sample_id=p.event_id JOIN hit b ON b.sample_id=p.prev_event_id AND b.shape_id=a.shape_id),
weighed AS (SELECT *, exp(-(da+db)/2/500) AS w, coalesce(least(abs(bearing-sb)%360, 360-abs(bearing-sb)%360)>35, false) AS turned FROM ends WHERE abs(step)>=25 AND abs(step)/elapsed_s<=45),
scores AS (SELECT pair_id, candidate, sum(CASE WHEN step>0 THEN w ELSE 0 END) AS support, sum(CASE WHEN step>0 THEN 0 ELSE w END + CASE WHEN turned THEN w ELSE 0 END) AS contrary, count(*) AS usable_shapes, min(da) AS best_distance_m FROM weighed GROUP BY 1,2),
scored AS (SELECT *, greatest(0, (support-contrary)/(support+contrary)) AS score FROM scores WHERE support+contrary>0)
"""


@query("segments t_trips t_samples", _SCORES + "SELECT pair_id, candidate, round(support,6) AS support, round(contrary,6) AS contrary, round(score,6) AS score, round(best_distance_m,6) AS best_distance_m, usable_shapes FROM scored")
def win_candidate_score(v: Source):
    rows = pair_scores(v)
    return rows.select("pair_id", "candidate", *(F.round(c, 6).alias(c) for c in ("support", "contrary", "score", "best_distance_m")), "usable_shapes")


_FAMILIES = """, f AS (SELECT *, 's'||CAST(CAST(substr(candidate,3) AS INT)%7 AS VARCHAR) AS family, CAST(CAST(substr(candidate,3) AS INT)%2 AS VARCHAR) AS direction_id FROM scored WHERE best_distance_m<=5000),
own AS (SELECT *, min(best_distance_m) OVER (PARTITION BY pair_id, family) AS closest, row_number() OVER (PARTITION BY pair_id, family ORDER BY score DESC, support DESC, best_distance_m, candidate) AS r FROM f),
ranked AS (SELECT *, row_number() OVER w AS k, lead(score) OVER w AS s2, lead(best_distance_m) OVER w AS d2, lead(direction_id) OVER w AS dir2, min(closest) OVER (PARTITION BY pair_id) AS least FROM own WHERE r=1 WINDOW w AS (PARTITION BY pair_id ORDER BY score DESC, best_distance_m, family))
SELECT pair_id, family, candidate, direction_id, round(score,6) AS score, round(coalesce(score-s2,1),6) AS margin, score>=0.58 AND coalesce(score-s2,1)>=0.2 AND (coalesce(dir2,'')<>direction_id OR d2-best_distance_m>=20) AND NOT (best_distance_m-closest>=20 AND least<closest) AS confident FROM ranked WHERE k=1"""


@query("segments t_trips t_samples", _SCORES + _FAMILIES)
def win_family_decision(v: Source):
    out = windows.family_decision(named_scores(v), near_m=5000.0)
    return out.select("pair_id", "family", "candidate", "direction_id", F.round("score", 6).alias("score"), F.round("margin", 6).alias("margin"), "confident")


@query("t_stop_times", "SELECT * FROM (SELECT trip_id, stop_id, stop_sequence, source_order, departure_seconds, lead(stop_id) OVER w AS next_stop_id, lead(departure_seconds) OVER w AS next_departure_seconds FROM t_stop_times WINDOW w AS (PARTITION BY trip_id ORDER BY stop_sequence, source_order)) WHERE next_stop_id IS NOT NULL")
def win_consecutive_calls(v: Source):
    return windows.call_pairs(v("stop_times"))


def all_calls(v: Source):
    f = v.feed()
    active = sets.active_services(f["calendar"], f["calendar_dates"], v.days())
    return joins.calls(f["stop_times"], f["trips"], active, f["stops"], f["routes"], windows.terminal_stops(f["stop_times"], "A"))


def calls_at(v: Source, stop_id: str, *window: str):
    f = v.feed()
    return joins.calls_at(f, sets.active_services(f["calendar"], f["calendar_dates"], v.days(*window)), stop_id)


_BOARD = "service_date, departure_seconds, trip_id, stop_sequence, source_order"


@query("calls", f"SELECT service_date, departure_time, trip_id, stop_id, label, destination, direction_id, platform_code FROM calls WHERE canonical_stop_id='s3' AND service_date BETWEEN '20240114' AND '20240116' ORDER BY {_BOARD} LIMIT 100")
def top_departure_board(v: Source):
    rows = calls_at(v, "s3", "20240114", "20240116")
    return windows.departure_board(rows, "s3", 100).select("service_date", "departure_time", "trip_id", "stop_id", "label", "destination", "direction_id", "platform_code")


@query("calls", f"SELECT canonical_stop_id, service_date, departure_time, trip_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY canonical_stop_id ORDER BY {_BOARD}) AS rank FROM calls WHERE service_date='20240115') WHERE rank<=30")
def top_departure_boards(v: Source):
    rows = all_calls(v).where("service_date = '20240115'")
    return windows.departure_board(rows, None, 30).select("canonical_stop_id", "service_date", "departure_time", "trip_id", "rank")


@query("calls", "SELECT DISTINCT route_id, label, direction_id, destination, terminal_stop_id FROM calls WHERE canonical_stop_id='s3'")
def top_lines_at_stop(v: Source):
    return windows.lines_at_stop(calls_at(v, "s3"), "s3")


def _spread(rounds: int) -> str:
    """Counterpart of the picks: each round takes the best of the stops that are left, by their distance to all picks so far."""
    hav = _HAV.format
    steps = [f"""s AS MATERIALIZED (SELECT r.city_id, r.stop_id, r.stop_lat, r.stop_lon, coalesce(l.n, 0) AS lines, {hav(a="c.latitude", b="c.longitude", c="r.stop_lat", d="r.stop_lon")} AS center FROM radius r JOIN t_cities c USING (city_id) LEFT JOIN (SELECT stop_id, count(DISTINCT route_id) AS n FROM t_stop_times JOIN t_trips USING (trip_id) GROUP BY 1) l USING (stop_id))"""]
    steps.append("p1 AS MATERIALIZED (SELECT city_id, stop_id, stop_lat, stop_lon, 1 AS rank, CAST(NULL AS DOUBLE) AS apart FROM s QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY lines DESC, center, stop_id)=1)")
    steps.append("s1 AS MATERIALIZED (SELECT *, CAST(NULL AS DOUBLE) AS apart FROM s)")
    for k in range(2, rounds + 1):
        steps.append(f"s{k} AS MATERIALIZED (SELECT x.city_id, x.stop_id, x.stop_lat, x.stop_lon, x.lines, x.center, least(x.apart, {hav(a='x.stop_lat', b='x.stop_lon', c='p.stop_lat', d='p.stop_lon')}) AS apart FROM s{k - 1} x JOIN p{k - 1} p USING (city_id) WHERE x.stop_id<>p.stop_id)")
        steps.append(f"p{k} AS MATERIALIZED (SELECT city_id, stop_id, stop_lat, stop_lon, {k} AS rank FROM s{k} QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY apart+lines*1200-center*0.08 DESC, lines DESC, stop_id DESC)=1)")
    return ", " + ", ".join(steps) + " " + " UNION ALL ".join(f"SELECT city_id, rank, stop_id FROM p{k}" for k in range(1, rounds + 1))


@query("radius t_cities t_stop_times t_trips", _spread(12))
def top_spread_stops(v: Source):
    lines = v("stop_times").join(v("trips").select("trip_id", "route_id"), "trip_id").groupBy("stop_id").agg(F.count_distinct("route_id").alias("line_count"))
    stops = joins.within_radius(v("stops"), v("cities")).select("city_id", "stop_id", "stop_lat", "stop_lon").join(lines, "stop_id", "left").fillna(0, ["line_count"])
    return windows.spread_stops(stops, v("cities"), 12)


@query("t_stop_times", "SELECT trip_id, departure_time, stop_sequence, stop_id FROM t_stop_times ORDER BY departure_time, trip_id, stop_sequence")
def sort_published_order(v: Source):
    return windows.published_order(v("stop_times").select("trip_id", "departure_time", "stop_sequence", "stop_id"), "compact")


@query("active active_first t_calendar_dates days", "SELECT 'union' AS variant, * FROM active UNION ALL SELECT 'exception_first', * FROM active_first UNION ALL SELECT 'additions', * FROM (SELECT DISTINCT service_id, service_date FROM t_calendar_dates JOIN days USING (service_date) WHERE exception_type=1)")
def set_active_services(v: Source):
    parts = [sets.active_services(v("calendar"), v("calendar_dates"), v.days(), k).select(F.lit(k).alias("variant"), "service_id", "service_date") for k in ("union", "exception_first", "additions")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("t_stops", "SELECT stop_id, CASE WHEN count(DISTINCT nm)>1 THEN 'clash' ELSE min(nm) END AS stop_name FROM (SELECT stop_id, stop_name AS nm FROM t_stops WHERE source_order % 2 = 0 UNION ALL SELECT stop_id, CASE WHEN source_order % 10 = 0 THEN 'other' ELSE stop_name END FROM t_stops WHERE source_order % 5 = 0) GROUP BY 1")
def set_merge_namespaces(v: Source):
    stops = v("stops")
    a = stops.where("source_order % 2 = 0").select("stop_id", "stop_name")
    b = stops.where("source_order % 5 = 0").select("stop_id", F.when(F.col("source_order") % 10 == 0, "other").otherwise(F.col("stop_name")).alias("stop_name"))
    kept, clash = sets.merge_city([a, b], "stop_id", ["stop_name"])
    return kept.unionByName(clash.withColumn("stop_name", F.lit("clash")))


@query("radius", "SELECT city_id, stop_id FROM radius WHERE city_id IN ('c0','c1') UNION ALL SELECT city_id, stop_id FROM radius WHERE city_id NOT IN ('c0','c1')")
def set_preserve_previous(v: Source):
    rows = joins.within_radius(v("stops"), v("cities")).select("city_id", "stop_id")
    return sets.preserve(rows, rows.where(F.col("city_id").isin("c0", "c1")))


@query("t_stops", "SELECT stop_id FROM t_stops WHERE source_order % 50 = 0 AND stop_id NOT IN ('p0','p100')")
def set_release_difference(v: Source):
    stops = v("stops")
    allowed = stops.where(F.col("stop_id").isin("p0", "p100")).select("stop_id")
    return sets.lost(stops, stops.where("source_order % 50 <> 0"), allowed, "stop_id")


_MODES = "SELECT 'pa' AS provider_id, city_id, 'radius' AS mode FROM t_cities WHERE city_id<>'c3' UNION ALL SELECT 'pb', city_id, 'boundary' FROM t_cities WHERE city_id IN ('c3','c4')"


def provider_rows(v: Source):
    """Stops and modes of two providers."""
    stops = joins.within_radius(v("stops"), v("cities")).select(F.when(F.startswith("stop_id", F.lit("s")), "pb").otherwise("pa").alias("provider_id"), "city_id", "stop_id")
    cities = v("cities").select("city_id")
    modes = cities.where("city_id <> 'c3'").select(F.lit("pa").alias("provider_id"), "city_id", F.lit("radius").alias("mode")).unionByName(cities.where(F.col("city_id").isin("c3", "c4")).select(F.lit("pb").alias("provider_id"), "city_id", F.lit("boundary").alias("mode")))
    return stops, modes


@query("radius t_cities", f"SELECT DISTINCT provider_id, city_id FROM (SELECT 'pb' AS provider_id, city_id FROM radius WHERE starts_with(stop_id,'s') UNION ALL SELECT provider_id, city_id FROM ({_MODES}) WHERE provider_id='pb')")
def set_provider_cities(v: Source):
    stops, modes = provider_rows(v)
    return sets.provider_cities(stops, modes, ["pb"])


@query("radius t_cities", f"SELECT c.city_id, c.n, m.mode FROM (SELECT city_id, count(DISTINCT stop_id) AS n FROM radius GROUP BY 1) c LEFT JOIN (SELECT city_id, arg_min(mode, provider_id) AS mode FROM ({_MODES}) GROUP BY 1) m USING (city_id)")
def set_rebuild_city_rows(v: Source):
    stops, modes = sets.rebuild_city(*provider_rows(v))
    return stops.groupBy("city_id").agg(F.count("*").alias("n")).join(modes, "city_id", "left")


@query("t_samples", "SELECT vehicle_id, event_id, ts, date_diff('second', ts, TIMESTAMP '2024-02-01')>864000 AS stale FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC) AS r FROM t_samples) WHERE r=1 AND date_diff('second', ts, TIMESTAMP '2024-02-01')<=2592000")
def str_latest_snapshot(v: Source):
    return realtime.latest_view(v("samples"), ["vehicle_id"], "2024-02-01 00:00:00", 864000, 2592000).select("vehicle_id", "event_id", "ts", "stale")


@query("t_samples", "SELECT event_id FROM (SELECT *, max(ts) OVER (PARTITION BY vehicle_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM t_samples) WHERE before IS NULL OR ts>before")
def str_drop_late(v: Source):
    return realtime.in_order(v("samples"), "event_id").select("event_id")


@query("t_samples", "SELECT vehicle_id, run, min(ts) AS started, max(ts) AS ended, count(*) AS n_samples FROM (SELECT *, CAST(sum(brk) OVER (PARTITION BY vehicle_id ORDER BY ts) AS BIGINT) AS run FROM (SELECT *, CASE WHEN datesub('second', lag(ts) OVER (PARTITION BY vehicle_id ORDER BY ts), ts)>7200 THEN 1 ELSE 0 END AS brk FROM t_samples)) GROUP BY 1,2")
def str_gap_sessions(v: Source):
    return windows.gap_sessions(v("samples"), 7200)


@query("t_store_events", "SELECT notification_uuid, notification_type, source_order FROM (SELECT *, row_number() OVER (PARTITION BY notification_uuid ORDER BY source_order) AS r FROM t_store_events) WHERE r=1")
def str_event_once(v: Source):
    return windows.first_wins(v("store_events"), ["notification_uuid"]).select("notification_uuid", "notification_type", "source_order")


@query("t_samples", "SELECT vehicle_id, arg_max(event_id, event_id) AS event_id, count(*)-1 AS dropped FROM t_samples GROUP BY 1")
def str_dedupe_monitored(v: Source):
    return realtime.monitored_vehicles(v("samples"), "vehicle_id", "event_id").select("vehicle_id", "event_id", "dropped")


@query()
def str_direction_inference(v: Source):
    made = jobs.radar_topology(v.feed("stops", "routes", "trips", "stop_times", "shapes"), ["0", "1", "2", "3", "11", "700"])
    candidates = made.select("route_id", "variant_id", "direction_id", "destination", "terminal_stop_id", "trip_ids", "stop_ids", F.col("sequences").alias("stop_sequences"), F.array("shape_id").alias("shape_ids"))
    segments, routes = cj.shapes_of_routes(v)
    samples = v("samples").withColumn("stop_id", F.lit(None).cast("string")).withColumn("stop_sequence", F.lit(None).cast("int"))
    rows = vehicles.evidence(samples, candidates, segments, routes=routes)
    out = vehicles.replay_direction(rows, rules=vehicles.Rules(gap_s=7200, expire_s=86400))
    return out.select("vehicle_id", "event_id", "direction_id", "destination", F.round("confidence", 6).alias("confidence"), "reason")
