"""Cells of polygons and segments against plain comparison with everything."""

import math
import random

import pytest
from pyspark.sql import functions as F

from raillark.operators import joins, polygons, windows


def star(rng, x, y, r, n):
    return [[x + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), y + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)] for k in range(n)]


def shapes(rng):
    out = [("star", [[star(rng, 8, 48, 1.1, 40), star(rng, 8, 48, 0.2, 12)]]), ("two", [[star(rng, 8.4, 48.3, 0.4, 7)], [star(rng, 7.2, 47.6, 0.3, 90)]])]
    box = [[7.5, 47.5], [8.5, 47.5], [8.5, 48.25], [7.5, 48.25], [7.5, 47.5]]
    out.append(("grid", [[box, [[7.75, 47.75], [8.0, 47.75], [8.0, 48.0], [7.75, 48.0]]]]))
    out.append(("stair", [[[[7.0, 47.0], [7.3, 47.0], [7.3, 47.3], [7.6, 47.3], [7.6, 47.6], [7.0, 47.6]]]]))
    out.append(("none", [[]]))
    return out


@pytest.mark.parametrize("size", [0.25, 0.1, 5.0])
def test_cover_equals_whole_rings(spark, size):
    rng = random.Random(4)
    bounds = spark.createDataFrame(shapes(rng), "code string, polygons array<array<array<array<double>>>>")
    places = [(rng.uniform(6.8, 9.2), rng.uniform(46.8, 49.2)) for _ in range(1500)]
    places += [(7 + a * 0.05, 47 + b * 0.05) for a in range(40) for b in range(30)]
    places += [tuple(p) for _, poly in shapes(random.Random(4)) for rings in poly for ring in rings for p in ring]
    points = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "point_id long, x double, y double")
    got = {tuple(r) for r in polygons.points_in(points, bounds, size, "y", "x").collect()}
    every = points.crossJoin(bounds.where("code <> 'none'")).where(joins.in_polygons(F.col("polygons"), F.col("y"), F.col("x")))
    want = {tuple(r) for r in every.select("point_id", "code").collect()}
    assert got == want and len(want) > 1000


def test_no_row_carries_a_ring(spark):
    ring = [[8 + math.cos(k / 5000 * 2 * math.pi), 48 + math.sin(k / 5000 * 2 * math.pi)] for k in range(5000)]
    bounds = spark.createDataFrame([("round", [[ring]])], "code string, polygons array<array<array<array<double>>>>")
    cells = polygons.cover(bounds, 0.05)
    row = cells.agg(F.max(F.size("edges")).alias("most"), F.count_if(F.col("edges").isNull()).alias("inside"), F.count("*").alias("n")).collect()[0]
    assert row.most < 120 and row.inside > 1000 and row.n < 1600


def test_points_of_one_cell_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(polygons, "DEAL", 1000)
    box = spark.createDataFrame([("box", [[[[8.0, 48.0], [9.0, 48.0], [9.0, 49.0], [8.0, 49.0]]]])], "code string, polygons array<array<array<array<double>>>>")
    points = spark.range(0, 40_000).selectExpr("id as point_id", "8.01 + id % 2 as x", "48.01 as y")
    placed = points.selectExpr("point_id", "x as _lon", "y as _lat", "cast(floor(x / 0.25) as bigint) as _cx", "cast(floor(y / 0.25) as bigint) as _cy")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        met = [r["count"] for r in polygons.meet(placed, polygons.cover(box, 0.25)).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(met) == 40_000 and max(met) < 18_000  # two cells
    assert polygons.points_in(points, box, 0.25, "y", "x").count() == 20_000


def test_suffixes_are_made_in_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "SUFFIXES", 1000)
    trips = spark.range(0, 5000).selectExpr("concat('x_', id % 5, '_', id, '_wk') as trip_id")
    asked = spark.createDataFrame([("3_4998_wk",), ("3_1003_wk",), ("1003_wk",), ("_wk",), ("wk",)], "rt_trip_id string")
    made = joins.suffixes(trips, asked, 5000)
    sizes = made.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2000
    rows = {r.rt_trip_id for r in made.select("rt_trip_id").distinct().collect()}
    assert {"3_1003_wk", "1003_wk", "_wk", "wk"} <= rows and not any(x.startswith("2_") for x in rows)
    got = {r.rt_trip_id: r.trip_id for r in joins.resolve_trip_suffix(asked, trips).collect()}
    assert got == {"3_1003_wk": "x_3_1003_wk", "1003_wk": "x_3_1003_wk", "3_4998_wk": "x_3_4998_wk"}
    monkeypatch.setattr(joins, "HEADS", 0)  # too many to list: lengths alone
    assert {r.rt_trip_id: r.trip_id for r in joins.resolve_trip_suffix(asked, trips).collect()} == got


def test_suffixes_of_one_shared_last_part(spark):
    trips = spark.range(0, 30_000).selectExpr("concat(id, '_wk') as trip_id")
    asked = spark.range(0, 30_000).selectExpr("concat(id + 15000, '_wk') as rt_trip_id").union(spark.sql("select '_wk' union all select 'k' union all select '' union all select null union all select '29999_wk'"))
    out = joins.resolve_trip_suffix(asked, trips)
    got = {r.rt_trip_id: r.trip_id for r in out.collect()}
    assert len(got) == 15_000 and all(a == b for a, b in got.items())
    assert "7_wk" not in got
    short = spark.createDataFrame([("9_wk",), ("9999_wk",)], "rt_trip_id string")
    only = {r.rt_trip_id: r.trip_id for r in joins.resolve_trip_suffix(short, trips.where("trip_id like '%99_wk'")).collect()}
    assert only == {"9999_wk": "9999_wk"}


def line(points, route="r", shape="a"):
    out, at = [], 0.0
    for k, ((a, b), (c, d)) in enumerate(zip(points, points[1:], strict=False)):
        length = math.hypot(c - a, (d - b) * math.cos(math.radians((a + c) / 2))) * 111_194.9
        out.append((shape, route, k, a, b, c, d, at, length))
        at += length
    return out


SEGMENT = "shape_id string, route_id string, seq long, lat1 double, lon1 double, lat2 double, lon2 double, progress1 double, length_m double"


def whole(samples, segments, most_m, reach=2, size=0.01):
    """The match of each sample by comparison with every segment."""
    cell = lambda x: math.floor(x / size)
    out = {}
    for sid, route, lat, lon in samples:
        for shape in {s[0] for s in segments if s[1] == route}:
            found = []
            for _, _, seq, a, b, c, d, p, n in (s for s in segments if s[0] == shape and s[1] == route):
                cells = (abs(cell(a) - cell(c)) + 1) * (abs(cell(b) - cell(d)) + 1)
                near = cells <= 256 and min(cell(a), cell(c)) - reach <= cell(lat) <= max(cell(a), cell(c)) + reach and min(cell(b), cell(d)) - reach <= cell(lon) <= max(cell(b), cell(d)) + reach
                scale = math.cos(math.radians((a + c) / 2))
                dx, dy, px, py = (d - b) * scale, c - a, (lon - b) * scale, lat - a
                t = max(0.0, min(1.0, (px * dx + py * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
                la, lo = math.radians(a + t * dy), math.radians(b + t * (d - b))
                away = math.hypot((lo - math.radians(lon)) * math.cos((math.radians(lat) + la) / 2), la - math.radians(lat)) * 6_371_000
                found.append((not near, away, seq, p + t * n))
            best = min(found)
            if most_m is None or best[1] <= most_m:
                out[sid, shape] = (round(best[1], 3), round(best[3], 2))
    return out


@pytest.mark.parametrize("most_m", [None, 1000.0])
def test_map_match_with_long_segments(spark, most_m):
    rng = random.Random(9)
    segments = line([(50 + k * 0.004, 30 + rng.uniform(0, 0.01)) for k in range(30)]) + line([(50.0, 30.0), (55.0, 35.0), (55.01, 35.01)], shape="b") + line([(69.5, 20.0), (69.51, 20.3), (69.52, 20.0)], "north", "c")
    samples = [(k, "r", rng.uniform(49.95, 50.2), rng.uniform(29.95, 30.2)) for k in range(150)] + [(200 + k, "r", 50 + x + rng.uniform(-0.005, 0.005), 30 + x + rng.uniform(-0.005, 0.005)) for k, x in enumerate(rng.uniform(0, 5) for _ in range(60))]
    samples += [(300 + k, "north", 69.51 + rng.uniform(-0.02, 0.02), 20 + rng.uniform(-0.1, 0.4)) for k in range(80)]
    grid = joins.segment_grid(spark.createDataFrame(segments, SEGMENT), most_m=most_m)
    assert grid.where("shape_id = 'b' and seq = 0").count() <= (400 if most_m else 0)
    got = joins.map_match(spark.createDataFrame(samples, "sample_id long, route_id string, latitude double, longitude double"), spark.createDataFrame(segments, SEGMENT), most_m=most_m)
    got = {(r.sample_id, r.shape_id): (round(r.distance_m, 3), round(r.progress_m, 2)) for r in got.collect()}
    want = whole(samples, segments, most_m)
    assert got.keys() == want.keys() and len(want) > 100
    assert all(abs(got[k][0] - want[k][0]) < 0.01 and abs(got[k][1] - want[k][1]) < 0.1 for k in want)


def test_previous_samples_with_ties(spark):
    at = lambda s: f"2024-01-01 00:00:{s:02d}"
    rows = [("v", 3, at(10), "r"), ("v", 1, at(0), "r"), ("v", 2, at(0), "r"), ("v", 5, at(20), "q"), ("v", 4, at(20), "r")]
    df = spark.createDataFrame(rows, "vehicle_id string, event_id long, ts string, route_id string").selectExpr("vehicle_id", "event_id", "cast(ts as timestamp_ntz) as ts", "route_id", "1.0d as latitude", "2.0d as longitude")
    got = {(r.event_id, r.prev_event_id) for r in windows.sample_pairs(df).collect()}
    assert got == {(3, 1), (4, 3)}
