"""Plans and steps whose rows grow no faster than the tables."""

import pytest
from pyspark.sql import functions as F

from raillark.operators import joins


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_catalogue_fill_broadcasts_no_cells_of_stops(spark):
    stops = spark.range(4000).selectExpr("48.0 + id % 40 * 0.01 as stop_lat", "8.0 + id % 40 * 0.01 as stop_lon")
    catalogue = spark.range(400).selectExpr("concat('k', id) as stop_id", "'n' as name", "0 as stop_type", "48.0 + id * 0.001 as latitude", "8.0 + id * 0.001 as longitude", "id as source_order")
    cities = spark.sql("select 'c' as city_id, 48.2D as latitude, 8.2D as longitude, 90000D as radius_m")
    out = joins.catalogue_fill(catalogue, stops, cities, [0])
    assert "SortMergeJoin [_cx" in plan_of(out)
    assert out.columns == ["stop_id", "name", "stop_lat", "stop_lon", "city_id", "distance_m"]
    near = {r.stop_id for r in out.collect()}
    assert near == {f"k{k}" for k in range(400) if min(k % 10, 10 - k % 10) > 1 or k > 391}


def test_one_large_group_is_dealt_to_cells(spark):
    stops = spark.range(3000).selectExpr("concat('p', id) as stop_id", "if(id % 3 = 0, 'gone', concat('s', id div 20)) as parent_station", "if(id % 2 = 0, '', 'x') as platform_code")
    members, outputs = joins.station_groups(stops, stops)
    want = members.join(outputs, "group_id").select("source_stop_id", "output_stop_id")
    got = joins.by_output(members, members, outputs, F.col("source_stop_id"), 64, 128)
    assert got.exceptAll(members.join(outputs, "group_id").select(got.columns)).isEmpty() and got.count() == want.count() > 500_000
    # 500 outputs by 1,000 members in cells of some 64 by 128: the join's key tells them apart
    assert "SortMergeJoin [group_id" in plan_of(got) and "_i#" in plan_of(got).split("SortMergeJoin [group_id")[1].split("]")[0]


def test_alert_lists_are_made_once_a_value(spark):
    selectors = spark.range(60).selectExpr("concat('al', id div 6) as alert_id", "element_at(array('route_short_name', 'stop_code', 'direction_id'), int(id % 3 + 1)) as selector_type", "string(id % 4) as selector_value")
    routes = spark.range(40).selectExpr("concat('r', id) as route_id", "if(id % 7 = 0, '', string(id % 3)) as short_name")
    stops = spark.range(2).selectExpr("concat('p', id) as stop_id", "string(id) as stop_code")
    made = joins._selected(selectors, routes, stops)
    assert made.count() == selectors.distinct().count()  # no row a route
    got = {r.alert_id: r for r in joins.alert_targets(selectors, routes, stops).collect()}
    asked, named = selectors.collect(), [(r.short_name, r.route_id) for r in routes.collect() if r.short_name]
    for alert in {a.alert_id for a in asked}:
        own = [(a.selector_type, a.selector_value) for a in asked if a.alert_id == alert]
        assert got[alert].route_ids == sorted(i for n, i in named if ("route_short_name", n) in own)
        assert got[alert].stop_ids == sorted(f"p{v}" for k, v in own if k == "stop_code" and v in "01")
        assert got[alert].directions == sorted({v for k, v in own if k == "direction_id"})
        assert got[alert].unmapped == sorted({f"{k}:{v}" for k, v in own if (k, v) in {("route_short_name", "3"), ("stop_code", "2"), ("stop_code", "3")}})
    from raillark.operators import aggregates

    assert joins.alert_counts(selectors, routes, stops).collect() == aggregates.alert_counts(joins.alert_targets(selectors, routes, stops)).collect()


def test_samples_meet_a_shape_of_many_routes_once(spark):
    segments = spark.range(600).selectExpr("concat('sh', id div 30) as shape_id", "id as seq", "50.0 + id * 0.0001 as lat1", "30.0D as lon1", "50.0 + (id + 1) * 0.0001 as lat2", "30.0D as lon2", "id * 11.1D as progress1", "11.1D as length_m")
    routes = spark.range(4000).selectExpr("concat('r', id) as route_id", "concat('sh', id % 20) as shape_id")
    samples = spark.range(5000).selectExpr("id as sample_id", "concat('r', id % 2) as route_id", "50.0 + id % 30 * 0.0001 as latitude", "30.0 as longitude")
    for most_m in (None, 5000.0):
        got = joins.map_match(samples, segments, most_m=most_m, routes=routes)
        assert "SortMergeJoin [shape_id" in plan_of(got) and "_i#" in plan_of(got)
        want = joins.map_match(samples, segments.join(routes, "shape_id"), most_m=most_m)
        assert got.count() == 5000 and got.exceptAll(want).isEmpty()
    lists = spark.sql("select 'a' as shape_id, array(1, 2) as _s union all select 'b', array(3)")
    dealt = joins.meet(spark.range(900).selectExpr("id as sample_id", "if(id < 850, 'a', 'b') as shape_id"), lists, ["shape_id"], 100)
    assert dealt.groupBy("shape_id", "_s").count().orderBy("shape_id").collect() == [("a", [1, 2], 850), ("b", [3], 50)]


def test_dates_of_a_service_meet_a_call_last(spark):
    from raillark.operators import windows
    from raillark.plans.base import Source
    from raillark.plans.catalogue_rows import all_calls

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(all_calls(Source(spark, "/root/testdata/sf0.001")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = [line.split("SortMergeJoin [")[1].split("#")[0] for line in plan.splitlines() if "SortMergeJoin [" in line]
    assert joined[0] == "service_id" and joined[1] == "trip_id"
    calls = spark.sql("select 't' as trip_id, 1 as stop_sequence, 1 as source_order, 'a' as stop_id union all select 't', 1, 2, 'b' union all select 't', 0, 3, 'c'")
    assert {k: [r.terminal_stop_id for r in windows.terminal_stops(calls, k).collect()] for k in "ABC"} == {"A": ["b"], "B": [], "C": ["c"]}


def test_stops_outside_the_cities_are_not_joined_with_trips(spark):
    from raillark.plans import catalogue_jobs, catalogue_rows
    from raillark.plans.base import Source

    v = Source(spark, "/root/testdata/sf0.001")
    for build in (catalogue_jobs.job_city_departures, catalogue_rows.agg_city_lines):
        assert plan_of(build(v)).count("LeftSemi") >= 1


def test_rows_of_a_shared_feed_are_not_numbered(spark):
    trips = spark.createDataFrame([("a", "1", "t1", "r"), ("a", "1", "t0", "q"), ("b", "1", "t9", "q"), ("b", "x_2", "t2", "r"), ("c", "2", "t5", "r"), ("a", "2", "t4", "s")], "provider_id string, native_trip_id string, trip_id string, route_id string")
    rt = spark.createDataFrame([("1", "r", 0), ("1", "r", 0), ("1", "none", 1), ("x_2", "r", 2), ("y_2", "r", 3), ("z", "r", 4), (None, "r", 5)], "trip_id string, route_id string, n int")
    out = joins.rt_context_join(rt, trips, ["b", "a"])
    assert out.columns == ["trip_id", "route_id", "n", "provider_id", "static_trip_id", "static_route_id"]
    assert sorted((r.n, r.provider_id, r.static_trip_id) for r in out.collect()) == [(0, "a", "t1"), (0, "a", "t1"), (1, "b", "t9"), (2, "b", "t2"), (3, "a", "t4")]
    assert "Window" not in plan_of(out) and "_row" not in plan_of(out)


def test_snapshots_are_written_compressed(spark):
    from raillark.plans.base import Source
    from raillark.plans.catalogue_sources import src_rt_entities

    names = src_rt_entities(Source(spark, "/root/testdata/sf0.001")).inputFiles()
    assert names and all(x.endswith(".gz") for x in names)


def test_calls_of_few_stops_are_dealt_to_tasks(spark):
    """Two stops and twenty outputs are few pairs of stops, but their 200,000 calls are four million pairs."""
    from raillark.operators import sets
    from raillark.plans import jobs

    stops = spark.range(22).selectExpr("concat('k', id) as stop_id", "'big' as parent_station", "if(id < 2, '7', '') as platform_code", "50.0d as stop_lat", "8.0d as stop_lon", "'n' as stop_name", "id as source_order")
    times = spark.range(0, 200_000).selectExpr("concat('t', id div 50) as trip_id", "concat('k', id % 2) as stop_id", "id % 50 as stop_sequence", "'08:00:00' as departure_time", "id as source_order", "0 as departure_seconds")
    feed = {
        "stops": stops, "stop_times": times, "trips": spark.range(4000).selectExpr("concat('t', id) as trip_id", "'r' as route_id", "'w' as service_id", "'H' as headsign"),
        "routes": spark.sql("select 'r' as route_id, '1' as short_name, '' as long_name, '3' as route_type"), "calendar_dates": spark.sql("select 'w' as service_id, '20240115' as service_date, 1 as exception_type"),
        "calendar": spark.sql("select '' as service_id, '20240101' as start_date, '20240101' as end_date, 0 as monday, 0 as tuesday, 0 as wednesday, 0 as thursday, 0 as friday, 0 as saturday, 0 as sunday"),
    }
    cities = spark.sql("select 'c' as city_id, 50.0D as latitude, 8.0D as longitude, 500D as radius_m")
    rows = jobs.station_departures(feed, cities, sets.dates(spark, "20240114", "20240116"))
    shares = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    # 196 cells on four partitions, and the platforms' own groups
    assert sum(shares) == 200_000 * 20 + 200_000 and max(shares) < 0.5 * sum(shares)
    assert rows.groupBy("output_stop_id").count().where("count <> 200000 and output_stop_id not in ('k0', 'k1')").isEmpty()


def test_cells_of_few_bytes_stay_many_tasks(spark):
    """500 outputs by 1,000 members are a few kilobytes, but half a million pairs."""
    stops = spark.range(3000).selectExpr("concat('p', id) as stop_id", "if(id % 3 = 0, 'gone', concat('s', id div 20)) as parent_station", "if(id % 2 = 0, '', 'x') as platform_code")
    members, outputs = joins.station_groups(stops, stops)
    got = joins.by_output(members, members, outputs, F.col("source_stop_id"), 64, 32).where("group_id = 'parent:gone'")
    shares = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 500_000 and max(shares) < 0.4 * sum(shares)
    # one member of many outputs: no list is longer than a cell's
    one = joins.by_output(members.where("source_stop_id = 'p0'"), members.where("source_stop_id = 'p0'"), outputs, F.col("source_stop_id"), 64, 32)
    assert one.where("group_id = 'parent:gone'").select("output_stop_id").distinct().count() == 500


def small_feed(spark):
    """A stop and a trip that occur twice, unknown stops, routes and services, equal sequences."""
    stops = spark.sql("select * from values ('p1', 's1', '7', 'One'), ('p2', 'none', '', 'Two'), ('p2', 's1', '8', 'Two again'), ('s1', '', '', 'Station') as t(stop_id, parent_station, platform_code, stop_name)")
    times = spark.range(60).selectExpr("concat('t', id div 5) as trip_id", "element_at(array('p1', 'p2', 's1', 'gone'), int(id * 7 % 4 + 1)) as stop_id", "int(id % 5 div 2) as stop_sequence", "id * 60 as departure_seconds", "'x' as departure_time", "id as source_order")
    trips = spark.range(14).selectExpr("concat('t', id % 11) as trip_id", "concat('r', id % 3) as route_id", "concat('w', id % 4) as service_id", "if(id % 2 = 0, '', 'H') as headsign", "'0' as direction_id")
    routes = spark.sql("select * from values ('r0', '1', ''), ('r1', '', 'Long') as t(route_id, short_name, long_name)")
    active = spark.sql("select * from values ('w0', '20240101'), ('w0', '20240102'), ('w1', '20240102'), ('w2', '20240103') as t(service_id, service_date)")
    return times, trips, active, stops, routes


def test_every_call_equals_calls(spark):
    from raillark.operators.windows import terminal_stops

    times, *others = small_feed(spark)
    got = joins.every_call(times, *others)
    want = joins.calls(times, *others, terminal_stops(times, "A")).select(got.columns)
    assert got.count() == want.count() > 60 and got.exceptAll(want).isEmpty()


def test_whole_calls_leave_no_shuffle_files(spark):
    """The two steps that run when ``join_calls`` is made leave none; a call then meets its dates without a shuffle."""
    import os
    from pathlib import Path

    from raillark.plans.registry import QUERIES

    local = Path(spark.conf.get("spark.local.dir"))
    files = lambda: {f for d, _, fs in os.walk(local) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}
    had = files()
    out = QUERIES["join_calls"](spark, "/root/testdata/sf0.001")
    assert files() <= had
    plan = plan_of(out)
    assert "Window" not in plan and "service_id" not in plan
