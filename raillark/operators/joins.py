"""Joins of timetable, space and realtime rows.

Small dimensions join by plain equi-joins, so the engine broadcasts them where
their measured size allows it.  Spatial joins carry a grid cell as an equi-key;
the exact predicate follows, so no join is a nested loop.
"""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.functions.expr import DEGREE_M, EARTH_M, bearing, col, destination, grid_cell, haversine_m, line_label, search_name
from raillark.operators.id_lists import Lists, packed, targets
from raillark.operators.lineage import cut, stored
from raillark.operators.polygons import points_in
from raillark.operators.windows import terminal_stops


def canonical_stops(stops: DataFrame) -> DataFrame:
    """Adds ``canonical_stop_id``: the parent station if it exists, else the stop itself."""
    known = stops.select(F.col("stop_id").alias("_parent")).distinct()
    return stops.join(known, F.col("parent_station") == F.col("_parent"), "left").withColumn("canonical_stop_id", F.coalesce("_parent", "stop_id")).drop("_parent")


def calls(calls: DataFrame, trips: DataFrame, active: DataFrame, stops: DataFrame, routes: DataFrame, terminals: DataFrame) -> DataFrame:
    """Every call of every active trip with its canonical stop, line label and destination.

    What a trip has is joined once a trip, and a call meets the dates of its service last,
    so no row of a date goes through a shuffle.
    """
    place = canonical_stops(stops).select("stop_id", "canonical_stop_id", "platform_code")
    last = terminals.join(stops.select(F.col("stop_id").alias("terminal_stop_id"), F.col("stop_name").alias("terminal_name")), "terminal_stop_id", "left")
    named = trips.join(routes.select("route_id", "short_name", "long_name"), "route_id", "left").join(last, "trip_id", "left")
    label, to = line_label("short_name", "long_name", "route_id").alias("label"), destination("headsign", "terminal_name", default="?").alias("destination")
    named = named.select("trip_id", "service_id", "route_id", "direction_id", "terminal_stop_id", label, to)
    out = calls.join(place, "stop_id").join(named, "trip_id").join(active, "service_id")
    return out.select("canonical_stop_id", "service_date", "departure_seconds", "departure_time", "trip_id", "stop_id", "stop_sequence", "source_order", "route_id", "direction_id", "platform_code", "terminal_stop_id", "label", "destination")


def every_call(calls: DataFrame, trips: DataFrame, active: DataFrame, stops: DataFrame, routes: DataFrame) -> DataFrame:
    """``calls`` of whole tables, with the terminals (variant A) of the same calls, in steps whose shuffle files go when they end.

    The time as text is left out. The calls are stored once, for their terminals and themselves; then what a trip has, with its dates
    as one list, so no call is shuffled by service. Both steps run when this is called.
    """
    calls = stored(calls.drop("departure_time"), "calls")
    last = terminal_stops(calls, "A").join(stops.select(F.col("stop_id").alias("terminal_stop_id"), F.col("stop_name").alias("terminal_name")), "terminal_stop_id", "left")
    dates = active.groupBy("service_id").agg(F.collect_list("service_date").alias("_dates"))
    named = trips.join(routes.select("route_id", "short_name", "long_name"), "route_id", "left").join(last, "trip_id", "left").join(dates, "service_id")
    label, to = line_label("short_name", "long_name", "route_id").alias("label"), destination("headsign", "terminal_name", default="?").alias("destination")
    named = stored(named.select("trip_id", "route_id", "direction_id", "terminal_stop_id", label, to, "_dates"), "trips")
    place = canonical_stops(stops).select("stop_id", "canonical_stop_id", "platform_code")
    out = calls.join(place, "stop_id").join(named, "trip_id").withColumn("service_date", F.explode("_dates"))
    return out.select("canonical_stop_id", "service_date", "departure_seconds", "trip_id", "stop_id", "stop_sequence", "source_order", "route_id", "direction_id", "platform_code", "terminal_stop_id", "label", "destination")


def calls_at(feed: dict[str, DataFrame], active: DataFrame, stop_id: str) -> DataFrame:
    """``calls`` of one canonical stop: its platforms come first, so only their calls and trips are read on."""
    platforms = canonical_stops(feed["stops"]).where(F.col("canonical_stop_id") == stop_id).select("stop_id")
    here = feed["stop_times"].join(platforms, "stop_id", "left_semi")
    used = here.select("trip_id").distinct()
    trips = feed["trips"].join(used, "trip_id", "left_semi")
    last = terminal_stops(feed["stop_times"].join(used, "trip_id", "left_semi"), "A")
    return calls(here, trips, active, feed["stops"], feed["routes"], last).where(F.col("canonical_stop_id") == stop_id)


def resolve_stops(stops: DataFrame, public: DataFrame) -> DataFrame:
    """stop_id, public_id: the nearest ancestor (the stop first) in ``public``; null if none or in a cycle.

    Each round doubles the levels that a stop has climbed, by a join with the last
    round's rows, until no stop is left to climb or it has passed as many levels as
    there are stops, which only a cycle allows.
    """
    wanted = public.select(F.col("stop_id").alias("_public")).distinct()
    parent = stops.groupBy("stop_id").agg(F.nullif(F.max("parent_station"), F.lit("")).alias("parent"))
    rows = parent.join(wanted, F.col("stop_id") == F.col("_public"), "left").select("stop_id", F.col("_public").alias("public_id"), F.when(F.col("_public").isNull(), F.col("parent")).alias("at"))
    rows, levels, n = cut(rows), 1, None
    while not rows.where("at is not null").isEmpty():
        n = n or rows.count()
        if levels > n:
            break
        above = rows.select(F.col("stop_id").alias("_at"), F.col("public_id").alias("_hit"), F.col("at").alias("_up"))
        rows = rows.join(above, F.col("at") == F.col("_at"), "left").select("stop_id", F.coalesce("public_id", "_hit").alias("public_id"), F.when(F.col("_hit").isNull(), F.col("_up")).alias("at"))
        rows, levels = cut(rows), 2 * levels
    return rows.select("stop_id", "public_id")


def station_groups(stops: DataFrame, selected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source_stop_id, group_id) and (group_id, output_stop_id): what each output consumes, in factored form.

    A selected stop with a parent and no platform code is an output of its parent's
    group, whose members are all children of the parent; another is a group of its own.
    A stop is in two groups at most, so neither table outgrows ``stops``, however many
    outputs a parent has.
    """
    base = (F.col("parent_station") != "") & (F.col("platform_code") == "")
    of_parent, own = F.concat(F.lit("parent:"), "parent_station"), F.concat(F.lit("stop:"), "stop_id")
    outputs = selected.select(F.when(base, of_parent).otherwise(own).alias("group_id"), F.col("stop_id").alias("output_stop_id"))
    members = stops.where("parent_station <> ''").select(F.col("stop_id").alias("source_stop_id"), of_parent.alias("group_id"))
    members = members.join(outputs.select("group_id").distinct(), "group_id", "left_semi").select("source_stop_id", "group_id")
    return members.unionByName(selected.where(~base).select(F.col("stop_id").alias("source_stop_id"), own.alias("group_id"))), outputs


#: Outputs and rows that a cell of ``by_output`` holds on average.
CELL_OUTPUTS, CELL_ROWS = 2048, 1024


def by_output(rows: DataFrame, counted: DataFrame, outputs: DataFrame, own: Column, most_outputs: int = CELL_OUTPUTS, most_rows: int = CELL_ROWS) -> DataFrame:
    """``rows`` of groups with each output of their group; ``own`` tells the rows of a group apart.

    ``counted`` has the groups of the rows, as often as they occur (dates may be left out).
    A group with more pairs than a cell holds is dealt to cells of some ``most_outputs``
    outputs by ``most_rows`` rows, so one group's pairs are the work of many tasks. The
    outputs of a cell are one list that a row meets once.
    """
    both = counted.select("group_id", F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(outputs.select("group_id", F.lit(0).alias("i"), F.lit(1).alias("o")))
    sizes = both.groupBy("group_id").agg(F.sum("i").alias("i"), F.sum("o").alias("o")).where((F.col("i") * F.col("o") > most_outputs * most_rows) | (F.col("o") > most_outputs))
    # a large group has thousands of rows or outputs, or hundreds of both, so these are few
    large = F.broadcast(sizes.select("group_id", F.ceil(F.greatest("i", F.lit(1)) / most_rows).alias("_ni"), F.ceil(F.col("o") / most_outputs).alias("_no")))

    def dealt(df: DataFrame, key: Column, at: str, n_at: str) -> DataFrame:
        return df.join(large, "group_id", "left").withColumn(at, F.pmod(F.xxhash64(key), F.coalesce(n_at, F.lit(1))))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(n, F.lit(1)) - 1))

    keys = ["group_id", "_i", "_o"]
    # a set number: a part's few bytes stand for millions of pairs, which joining small parts would not see
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = dealt(rows, own, "_i", "_ni").withColumn("_o", every("_no")).drop("_ni", "_no").repartition(parts, *keys)
    lists = dealt(outputs, F.col("output_stop_id"), "_o", "_no").groupBy("group_id", "_ni", "_o").agg(F.collect_list("output_stop_id").alias("_outputs"))
    right = lists.withColumn("_i", every("_ni")).drop("_ni").repartition(parts, *keys)
    return left.join(right.hint("merge"), keys).select("group_id", *(c for c in rows.columns if c != "group_id"), F.explode("_outputs").alias("output_stop_id"))


def station_targets(stops: DataFrame, selected: DataFrame) -> DataFrame:
    """source_stop_id, output_stop_id: the groups expanded, a row for each member and output."""
    members, outputs = station_groups(stops, selected)
    return by_output(members, members, outputs, F.col("source_stop_id")).select("source_stop_id", "output_stop_id")


def _cells(df: DataFrame, box: Column, size: float) -> DataFrame:
    """A row for each grid cell that a box touches."""
    x = F.explode(F.sequence(grid_cell(box["min_lon"], size), grid_cell(box["max_lon"], size)))
    y = F.explode(F.sequence(grid_cell(box["min_lat"], size), grid_cell(box["max_lat"], size)))
    return df.withColumn("_cx", x).withColumn("_cy", y)


def within_radius(stops: DataFrame, cities: DataFrame, size: float = 0.1) -> DataFrame:
    """Stops inside a city's circle; one row for each city that holds the stop."""
    dy = F.col("radius_m") / DEGREE_M
    dx = F.col("radius_m") / (F.greatest(F.cos(F.radians("latitude")) - F.radians(dy), F.lit(0.01)) * DEGREE_M)
    box = F.struct((F.col("longitude") - dx).alias("min_lon"), (F.col("longitude") + dx).alias("max_lon"), (F.col("latitude") - dy * 1.001).alias("min_lat"), (F.col("latitude") + dy * 1.001).alias("max_lat"))
    near = _cells(cities.select("city_id", "latitude", "longitude", "radius_m"), box, size)
    placed = stops.withColumn("_cx", grid_cell("stop_lon", size)).withColumn("_cy", grid_cell("stop_lat", size))
    both = placed.join(near, ["_cx", "_cy"]).withColumn("distance_m", haversine_m("latitude", "longitude", "stop_lat", "stop_lon"))
    return both.where("distance_m <= radius_m").drop("_cx", "_cy", "latitude", "longitude", "radius_m")


def in_ring(ring: Column, lat: Column, lon: Column, edge: float = 1e-10) -> Column:
    """Ray casting over a closed ring of [lon, lat] points: 1 inside, 0 outside, 2 on an edge."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def side(a: Column, b: Column) -> Column:
        x1, y1, x2, y2 = a[0], a[1], b[0], b[1]
        cross = (lon - x1) * (y2 - y1) - (lat - y1) * (x2 - x1)
        on = (F.abs(cross) <= edge) & lon.between(F.least(x1, x2) - edge, F.greatest(x1, x2) + edge) & lat.between(F.least(y1, y2) - edge, F.greatest(y1, y2) + edge)
        crosses = ((y1 > lat) != (y2 > lat)) & (lon < (x2 - x1) * (lat - y1) / F.when(y2 == y1, F.lit(1.0)).otherwise(y2 - y1) + x1)
        return F.when(on, 2).when(crosses, 1).otherwise(0)

    sides = F.zip_with(ring, nxt, side)
    return F.when(F.array_contains(sides, 2), 2).otherwise(F.aggregate(sides, F.lit(0), lambda n, s: (n + s) % 2))


def in_polygons(polygons: Column, lat: Column, lon: Column) -> Column:
    """Inside any polygon: in or on its outer ring and not inside a hole."""
    return F.exists(polygons, lambda rings: (in_ring(rings[0], lat, lon) > 0) & ~F.exists(F.slice(rings, 2, F.size(rings)), lambda hole: in_ring(hole, lat, lon) == 1))


def boundary_of(points: DataFrame, boundaries: DataFrame, size: float = 0.25, lat: str = "stop_lat", lon: str = "stop_lon") -> DataFrame:
    """Adds the boundary ``code`` of each point, the one of the smallest box where several hold it; points outside drop.

    ``points`` carries a unique ``point_id``.
    """
    area = boundaries.select("code", ((F.col("max_lon") - F.col("min_lon")) * (F.col("max_lat") - F.col("min_lat"))).alias("area"))
    hits = points_in(points, boundaries, size, lat, lon).join(area, "code")
    best = hits.groupBy("point_id").agg(F.min(F.struct("area", "code")).alias("best"))
    return points.join(best.select("point_id", "best.code"), "point_id")


def box_polygons(boundaries: DataFrame) -> DataFrame:
    """Adds ``polygons`` of box boundaries: one closed ring of the corners."""
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("min_lon", "min_lat"), corner("max_lon", "min_lat"), corner("max_lon", "max_lat"), corner("min_lon", "max_lat"))
    return boundaries.withColumn("polygons", F.array(F.array(ring)))


def city_claims(cities: DataFrame, boundaries: DataFrame) -> DataFrame:
    """city_id, code: boundaries that hold a city's centre and bear its name or an alias."""
    hits = points_in(cities.withColumn("point_id", F.col("city_id")), boundaries, 0.25, "latitude", "longitude")
    known = hits.join(boundaries.select("code", F.col("name").alias("boundary_name")), "code").join(cities.select("city_id", "name", "aliases"), F.col("point_id") == F.col("city_id"))
    names = F.transform(F.concat(F.array("name"), "aliases"), search_name)
    return known.where(F.array_contains(names, search_name("boundary_name"))).select("city_id", "code").distinct()


def scope(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in an id set."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def agency_scope(tables: dict[str, DataFrame], agency_id: str) -> dict[str, DataFrame]:
    """A feed cut to one agency: routes, trips, calls, stops with all ancestors, services, shapes, frequencies, fares and ways.

    An agency without routes is an error.
    """
    routes = tables["routes"].where(F.col("agency_id") == agency_id)
    if routes.isEmpty():
        raise ValueError(f"no route of agency {agency_id}")
    trips = scope(tables["trips"], routes, "route_id")
    times = scope(tables["stop_times"], trips, "trip_id")
    used = scope(tables["stops"], times, "stop_id")
    parents = tables["stops"].where("parent_station <> ''").select("stop_id", F.col("parent_station").alias("_up"))
    ids, fresh = cut(used.select("stop_id").distinct()), None
    while fresh is None or not fresh.isEmpty():  # ancestors until none is new; a visited stop is not visited again
        fresh = cut(parents.join(ids if fresh is None else fresh, "stop_id", "left_semi").select(F.col("_up").alias("stop_id")).distinct().join(ids, "stop_id", "left_anti"))
        ids = ids.unionByName(fresh)
    closure = scope(tables["stops"], ids, "stop_id")
    out = {"routes": routes, "trips": trips, "stop_times": times, "stops": closure}
    for name, key in (("calendar", "service_id"), ("calendar_dates", "service_id"), ("shapes", "shape_id")):
        if name in tables:
            out[name] = scope(tables[name], trips, key)
    for name, key, of in (("frequencies", "trip_id", trips), ("fare_rules", "route_id", routes)):
        if name in tables:
            out[name] = scope(tables[name], of, key)
    if "pathways" in tables:
        ends = closure.select("stop_id")
        both = tables["pathways"].join(ends.withColumnRenamed("stop_id", "from_stop_id"), "from_stop_id", "left_semi")
        out["pathways"] = both.join(ends.withColumnRenamed("stop_id", "to_stop_id"), "to_stop_id", "left_semi")
    if "transfers" in tables:
        ends = closure.select("stop_id")
        both = tables["transfers"].join(ends.withColumnRenamed("stop_id", "from_stop_id"), "from_stop_id", "left_semi")
        out["transfers"] = both.join(ends.withColumnRenamed("stop_id", "to_stop_id"), "to_stop_id", "left_semi")
    return out


#: Ids that meet in one task, suffixes that one makes, about, and first characters listed for a length.
IDS, SUFFIXES, HEADS = 1 << 18, 1 << 21, 1000


def suffixes(known: DataFrame, asked: DataFrame, rows: int) -> DataFrame | None:
    """trip_id, rt_trip_id: the ends of ``rows`` static ids that have the length and first two characters of some asked id.

    Reads the asked lengths when it is called. None if nothing is asked.
    """
    head = F.substr("rt_trip_id", F.lit(1), F.lit(2))
    asks = asked.groupBy(F.length("rt_trip_id").alias("n")).agg(F.collect_set(head).alias("heads"))
    asks = asks.select("n", F.when(F.size("heads") <= HEADS, F.col("heads")).alias("heads")).orderBy("n").collect()  # no more than the longest id has characters
    if not asks:
        return None
    end = lambda n: F.substr("trip_id", F.length("trip_id") - n + 1)
    ends = [F.when((F.length("trip_id") >= n) & (F.lit(True) if heads is None else F.substr(end(F.lit(n)), F.lit(1), F.lit(2)).isin(heads)), end(F.lit(n))) for n, heads in asks]
    dealt = known.repartition(max(1, -(-rows * len(asks) // SUFFIXES)), "trip_id")
    return dealt.select("trip_id", F.explode(F.array_compact(F.array(*ends))).alias("rt_trip_id"))


def resolve_trip_suffix(rt: DataFrame, trips: DataFrame) -> DataFrame:
    """rt_trip_id, trip_id: an exact match, else the single static trip that ends with the realtime id.

    Static ids give their suffixes of the asked lengths, which are few, and each suffix
    is counted before it is joined: a text that ends any number of static ids is one
    row, and no pair of ids is made.  Counts both tables, to deal them to tasks, and reads the
    asked lengths when it is called.
    """
    asked, static = rt.count(), trips.count()
    tasks = max(1, -(-max(asked, static) // IDS))
    ids = rt.select("rt_trip_id").where("rt_trip_id <> ''").repartition(tasks, "rt_trip_id").distinct()
    known = trips.select("trip_id").where("trip_id is not null").repartition(tasks, "trip_id").distinct()
    found = ids.join(known, F.col("rt_trip_id") == F.col("trip_id"), "left")
    exact, rest = found.where("trip_id is not null"), found.where("trip_id is null").select("rt_trip_id")
    ends = suffixes(known, rest, static)
    if ends is None:
        return exact
    single = ends.groupBy("rt_trip_id").agg(F.count("*").alias("n"), F.min("trip_id").alias("trip_id")).where("n = 1").drop("n")
    return exact.unionByName(rest.join(single, "rt_trip_id"))


def rt_static_reason(rt: DataFrame, trips: DataFrame, stops: DataFrame, strict: bool) -> DataFrame:
    """Realtime rows with static route and a reject ``reason``.

    ``strict`` also needs a known stop; otherwise an unknown stop is blanked and
    an unknown trip is marked but kept by ``rt_static_join(mode="lenient")``.
    """
    static = trips.select("trip_id", F.col("route_id").alias("static_route_id"), F.col("direction_id").alias("static_direction_id"))
    known = stops.select(F.col("stop_id").alias("_stop")).distinct()
    out = rt.join(static, "trip_id", "left").join(known, F.col("stop_id") == F.col("_stop"), "left")
    reason = F.when(F.col("static_route_id").isNull(), "unknown_trip").when((F.col("route_id") != "") & (F.col("route_id") != F.col("static_route_id")), "route_mismatch")
    if strict:
        reason = reason.when(F.col("_stop").isNull(), "unknown_stop")
    return out.withColumn("reason", reason).withColumn("stop_id", F.coalesce("_stop", F.lit(""))).drop("_stop")


def rt_static_join(rt: DataFrame, trips: DataFrame, stops: DataFrame, mode: str = "plain") -> DataFrame:
    """Realtime rows with their static trip: ``plain``, ``strict`` or ``lenient``."""
    out = rt_static_reason(rt, trips, stops, mode == "strict")
    if mode != "lenient":
        out = out.where("reason is null")
    return out.withColumn("route_id", F.coalesce(F.nullif("route_id", F.lit("")), "static_route_id", F.lit(""))).drop("static_route_id")


def rt_context_join(rt: DataFrame, trips: DataFrame, providers: list[str]) -> DataFrame:
    """Rows of a shared feed with the provider trip they mean.

    ``trips``: provider_id, native_trip_id, trip_id, route_id.  Candidates match the
    native id, or the text after its first underscore; one whose route agrees comes
    first, then the earlier provider of ``providers``.
    """
    order = F.array_position(F.array(*map(F.lit, providers)), F.col("provider_id"))
    # the candidates of a native id are few: a list an id, so that a row meets them once and needs no number
    item = F.struct(order.alias("order"), F.col("trip_id").alias("static_trip_id"), F.col("route_id").alias("static_route_id"), "provider_id")
    known = trips.where(F.col("provider_id").isin(providers)).groupBy("native_trip_id").agg(F.collect_list(item).alias("_c"))
    agree = lambda c: F.when(F.col("route_id") == c["static_route_id"], 0).otherwise(1)
    first = F.array_min(F.transform("_c", lambda c: F.struct(agree(c).alias("agree"), c.alias("c"))))
    short = F.regexp_replace("trip_id", "^[^_]*_", "")

    def lookup(df: DataFrame, key: Column) -> DataFrame:
        return df.withColumn("_id", key).join(known, F.col("_id") == F.col("native_trip_id"), "left")

    found = lookup(rt, F.col("trip_id")).select(*rt.columns, first.alias("_best"))
    # a row that is found asks for its own id again, which spreads as the ids do
    found = lookup(found, F.when(F.col("_best").isNull(), short).otherwise(F.col("trip_id")))
    best = found.select(*rt.columns, F.coalesce("_best", first)["c"].alias("_best")).where("_best is not null")
    return best.select(*rt.columns, "_best.provider_id", "_best.static_trip_id", "_best.static_route_id")


def fill_stop_id(updates: DataFrame, calls: DataFrame) -> DataFrame:
    """Fills an empty stop id from the trip's stop sequence (the first such call in file order)."""
    by = calls.groupBy("trip_id", "stop_sequence").agg(F.min_by("stop_id", "source_order").alias("_stop"))
    return updates.join(by, ["trip_id", "stop_sequence"], "left").withColumn("stop_id", F.coalesce(F.nullif("stop_id", F.lit("")), "_stop", F.lit(""))).drop("_stop")


def _selected(selectors: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """Distinct selectors of each alert, with the lists of routes and stops that each means (null if none).

    A list is made once for each value that is asked for, not once a selector, and
    selectors are dealt by alert before they meet the lists.
    """
    kind, value = F.col("selector_type"), F.col("selector_value")
    # a set number: parts of equal selectors may hold any length of lists, which joining small parts would not see
    parts = int(selectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = selectors.select("alert_id", "selector_type", "selector_value").repartition(parts, "alert_id").distinct()

    def lists(df: DataFrame, of: str, name: str, ids: str) -> DataFrame:
        asked = selectors.where(kind == of).select(value.alias("_v")).distinct()
        return df.where(F.col(ids).isNotNull()).join(asked, "_v", "left_semi").groupBy("_v").agg(F.sort_array(F.collect_set(ids)).alias(name)).select(F.lit(of).alias("selector_type"), F.col("_v").alias("selector_value"), name)

    r = lists(routes.where("short_name <> ''").withColumn("_v", F.col("short_name")), "route_short_name", "_routes", "route_id")
    s = lists(stops.withColumn("_v", F.col("stop_code")), "stop_code", "_stops", "stop_id")
    on = ["selector_type", "selector_value"]
    direction = F.when(kind == "direction_id", value)
    # a known kind and value always has a list of one id at least
    unmapped = F.when(F.col("_routes").isNull() & F.col("_stops").isNull() & direction.isNull(), F.concat_ws(":", kind, value))
    return picked.join(r, on, "left").join(s, on, "left").select("alert_id", "selector_type", "selector_value", "_routes", "_stops", direction.alias("_direction"), unmapped.alias("_unmapped"))


#: Bytes of asked ids and their values that are sent to every task; a row's own lists are a large part of them.
LISTS_BYTES = 1 << 26


def _lists(selectors: DataFrame, routes: DataFrame, stops: DataFrame) -> dict[str, tuple[str, Lists]] | None:
    """The ids of the values that are asked for, by kind of selector; None if they are more than a task should hold."""
    pairs = routes.where("short_name <> ''").select(F.lit("route_short_name").alias("selector_type"), F.col("short_name").alias("selector_value"), F.col("route_id").alias("_id"))
    pairs = pairs.unionByName(stops.select(F.lit("stop_code").alias("selector_type"), F.col("stop_code").alias("selector_value"), F.col("stop_id").alias("_id")))
    asked = cut(pairs.where("_id is not null").join(selectors.select("selector_type", "selector_value").distinct(), ["selector_type", "selector_value"], "left_semi").distinct())
    size = asked.agg(F.sum(F.octet_length("_id") + F.octet_length("selector_value"))).first()[0] or 0
    if size > LISTS_BYTES:
        return None
    found = asked.toArrow()
    of = {k: found.filter(pc.equal(found["selector_type"], k)) for k in ("route_short_name", "stop_code")}
    return {k: (name, packed(of[k]["selector_value"].combine_chunks(), of[k]["_id"].combine_chunks())) for k, name in (("route_short_name", "route_ids"), ("stop_code", "stop_ids"))}


def alert_targets(selectors: DataFrame, routes: DataFrame, stops: DataFrame, text: bool = False) -> DataFrame:
    """Per alert the sorted route ids, stop ids and directions it names, and its unmapped selectors; ``text`` has them with commas.

    An alert's selectors become one row of asked values, which meets the lists of ids in its own
    task (``id_lists``): no list is shuffled. Only ids of more than ``LISTS_BYTES`` are joined as rows.
    """
    names = ["route_ids", "stop_ids", "directions", "unmapped"]
    lists = _lists(selectors, routes, stops)
    if lists is None:
        named = lambda c: F.sort_array(F.collect_set(c))
        merged = lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_list(c))))
        rows = _selected(selectors, routes, stops).groupBy("alert_id").agg(merged("_routes").alias("route_ids"), merged("_stops").alias("stop_ids"), named("_direction").alias("directions"), named("_unmapped").alias("unmapped"))
        return rows.select("alert_id", *(F.array_join(c, ",").alias(c) for c in names)) if text else rows
    kind, value = F.col("selector_type"), F.col("selector_value")
    # a set number: a part's few selectors stand for long lists, which joining small parts would not see
    parts = int(selectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of = lambda k: F.collect_set(F.when(kind == k, value))
    other = F.when(value.isNull() | ~F.coalesce(kind.isin(*lists, "direction_id"), F.lit(False)), F.concat_ws(":", kind, value))
    asked = selectors.repartition(parts, "alert_id").groupBy("alert_id").agg(*(of(k).alias(k) for k in lists), of("direction_id").alias("directions"), F.collect_set(other).alias("unmapped"))
    return targets(asked, lists, text)


def alert_counts(selectors: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """Alerts, those fully mapped, unmapped selectors and affected routes; as ``aggregates.alert_counts`` of the targets, without their lists."""
    rows = _selected(selectors, routes, stops)
    each = rows.groupBy("alert_id").agg(F.count_distinct("_unmapped").alias("n"))
    sums = each.agg(F.count("*").alias("alerts"), F.count_if(F.col("n") == 0).alias("mapped_alerts"), F.sum("n").alias("unmapped_selectors"))
    asked = selectors.where("selector_type = 'route_short_name'").select(F.col("selector_value").alias("short_name")).distinct()
    hit = routes.where("short_name <> ''").join(asked, "short_name", "left_semi").agg(F.count_distinct("route_id").alias("routes"))
    return sums.crossJoin(hit)  # one row each


def expand_platforms(asked: DataFrame, stops: DataFrame) -> DataFrame:
    """The asked stops and their child platforms (location type 0)."""
    own = stops.join(asked.select("stop_id").distinct(), "stop_id", "left_semi")
    parents = own.select(F.col("stop_id").alias("parent_station")).distinct()
    children = stops.where("location_type = '0'").join(parents, "parent_station", "left_semi")
    return own.select("stop_id").union(children.select("stop_id")).distinct()


def stop_owners(package: DataFrame, entities: DataFrame, prefixes: DataFrame) -> DataFrame:
    """city_id, stop_id, provider_id: providers that own a package stop, a prefixed match before a plain one.

    ``entities``: provider_id, key_1 of stops; ``prefixes``: provider_id, prefix.
    A stop without owner keeps a null provider.
    """
    plain = package.join(entities.select("provider_id", F.col("key_1").alias("_key")), F.col("stop_id") == F.col("_key")).withColumn("preferred", F.lit(0))
    marked = entities.join(prefixes, "provider_id").select("provider_id", F.col("key_1").alias("_key"), F.expr("substr(key_1, length(prefix) + 1)").alias("_native"), "prefix").where(F.startswith("_key", "prefix"))
    prefixed = package.join(marked, F.col("stop_id") == F.col("_native")).withColumn("preferred", F.lit(1)).drop("_native", "prefix")
    every = plain.unionByName(prefixed)
    best = Window.partitionBy("city_id", "stop_id")
    chosen = every.withColumn("_top", F.max("preferred").over(best)).where("preferred = _top").select("city_id", "stop_id", "provider_id").distinct()
    return package.select("city_id", "stop_id").distinct().join(chosen, ["city_id", "stop_id"], "left")


def neighbours(df: DataFrame, lat: str, lon: str, size: float) -> DataFrame:
    """Nine rows for each, one for every cell around its own."""
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    return df.withColumn("_dx", F.explode(step)).withColumn("_dy", F.explode(step)).withColumn("_cx", grid_cell(lon, size) + F.col("_dx")).withColumn("_cy", grid_cell(lat, size) + F.col("_dy")).drop("_dx", "_dy")


def catalogue_fill(catalogue: DataFrame, stops: DataFrame, cities: DataFrame, allowed: list[int], apart_m: float = 150.0) -> DataFrame:
    """Catalogue stops of allowed types inside a city with no stop within ``apart_m``; the first row of an id.

    Cells of 0.005 degrees are wider than ``apart_m`` up to 70 degrees of latitude.
    """
    rank = Window.partitionBy("stop_id").orderBy("source_order")
    rows = catalogue.where((F.col("name") != "") & F.col("stop_type").isin(allowed)).withColumn("_r", F.row_number().over(rank)).where("_r = 1").drop("_r")
    placed = within_radius(rows.select("stop_id", "name", F.col("latitude").alias("stop_lat"), F.col("longitude").alias("stop_lon")), cities)
    size = 0.005
    # one row a place; nine cells a stop outgrow what the files' size tells, so this side is never broadcast
    there = neighbours(stops.select(F.col("stop_lat").alias("_lat"), F.col("stop_lon").alias("_lon")).distinct(), "_lat", "_lon", size)
    here = placed.select("stop_lat", "stop_lon").distinct().withColumn("_cx", grid_cell("stop_lon", size)).withColumn("_cy", grid_cell("stop_lat", size))
    close = here.join(there.hint("merge"), ["_cx", "_cy"]).where(haversine_m("stop_lat", "stop_lon", "_lat", "_lon") <= apart_m).select("stop_lat", "stop_lon").distinct()
    return placed.join(close, ["stop_lat", "stop_lon"], "left_anti").select(placed.columns)


#: Columns of a segment, besides those of its routes.
SEGMENT = ["shape_id", "seq", "lat1", "lon1", "lat2", "lon2", "progress1", "length_m"]


def _reaches() -> tuple[tuple[Column, Column], tuple[Column, Column]]:
    """Least and greatest longitude and latitude of a segment."""
    return (F.least("lon1", "lon2"), F.greatest("lon1", "lon2")), (F.least("lat1", "lat2"), F.greatest("lat1", "lat2"))


def segment_level(size: float = 0.01, most_cells: int = 256) -> Column:
    """How many times the cells of ``size`` degrees are doubled for a segment; 0 up to ``most_cells`` cells."""
    lon, lat = _reaches()
    span = lambda lo, hi: grid_cell(hi, size) - grid_cell(lo, size) + 1
    side = int(most_cells**0.5) - 2
    doubled = F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(lon[1] - lon[0], lat[1] - lat[0]) / (size * side))))
    return F.when(span(*lon) * span(*lat) <= most_cells, 0).otherwise(doubled).cast("int")


def segment_grid(segments: DataFrame, size: float = 0.01, reach: int = 2, most_cells: int = 256, most_m: float | None = None) -> DataFrame:
    """``segments`` with a row for each cell (level, _cx, _cy) from which one may be the nearest.

    Segments of at most ``most_cells`` cells lie on the grid of ``size`` degrees, level
    0; ``near`` tells cells within ``reach``.  With ``most_m`` cells up to that distance are
    added, and longer segments lie on a grid of doubled cells, as many times as brings
    them to no more cells than the others; without it longer ones have no cell.
    """
    lon, lat = _reaches()
    rows = segments.withColumn("level", segment_level(size, most_cells))
    if most_m is None:
        rows = rows.where("level = 0")
    cell = F.lit(size) * F.pow(F.lit(2.0), F.col("level"))
    at = lambda c: F.floor(c / cell)
    wide_y = F.lit(0) if most_m is None else F.ceil(most_m * 1.001 / (cell * DEGREE_M))
    cosine = F.greatest(F.cos(F.radians(F.least(F.lit(90.0), F.greatest(F.abs(lat[0]), F.abs(lat[1])) + (most_m or 0) / DEGREE_M))), F.lit(0.01))
    wide_x = F.lit(0) if most_m is None else F.ceil(most_m * 1.001 / (cell * DEGREE_M * cosine))
    own = F.when(F.col("level") == 0, reach).otherwise(0)
    spread = lambda lo, hi, wide: F.explode(F.sequence(at(lo) - F.greatest(own, wide), at(hi) + F.greatest(own, wide)))
    cells = rows.withColumn("_cx", spread(*lon, wide_x)).withColumn("_cy", spread(*lat, wide_y))
    near = (F.col("level") == 0) & F.col("_cx").between(at(lon[0]) - reach, at(lon[1]) + reach) & F.col("_cy").between(at(lat[0]) - reach, at(lat[1]) + reach)
    return cells.withColumn("near", near)


def segment_list() -> Column:
    """A segment of :func:`segment_grid` as an item of a list: with it all that does not depend on a sample."""
    scale = F.cos(F.radians((F.col("lat1") + F.col("lat2")) / 2))
    dx, dy = (F.col("lon2") - F.col("lon1")) * scale, F.col("lat2") - F.col("lat1")
    return F.struct((~F.col("near")).alias("far"), "seq", "lat1", "lon1", (F.col("lon2") - F.col("lon1")).alias("dlon"), scale.alias("scale"), dx.alias("dx"), dy.alias("dy"), (dx * dx + dy * dy).alias("square"), "progress1", "length_m", bearing("lat1", "lon1", "lat2", "lon2").alias("bearing"))


def nearest(lat: Column, lon: Column, items: Column) -> Column:
    """The nearest of a list of :func:`segment_list`: struct of ``far`` and ``p`` (distance_m, seq, progress_m, segment_bearing).

    Each step is worked out once an item and named for the next one.
    """
    along = lambda s: F.when(s["square"] > 0, ((lon - s["lon1"]) * s["scale"] * s["dx"] + (lat - s["lat1"]) * s["dy"]) / s["square"]).otherwise(0.0)
    at = F.transform(items, lambda s: F.struct(s.alias("s"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), along(s))).alias("t")))
    foot = F.transform(at, lambda x: F.struct(x["s"].alias("s"), x["t"].alias("t"), F.radians(x["s"]["lat1"] + x["t"] * x["s"]["dy"]).alias("c"), F.radians(x["s"]["lon1"] + x["t"] * x["s"]["dlon"]).alias("d")))
    legs = F.transform(foot, lambda x: F.struct(x["s"].alias("s"), x["t"].alias("t"), ((x["d"] - F.radians(lon)) * F.cos((F.radians(lat) + x["c"]) / 2)).alias("x"), (x["c"] - F.radians(lat)).alias("y")))
    away = lambda x: F.sqrt(x["x"] * x["x"] + x["y"] * x["y"]) * EARTH_M
    place = lambda x: F.struct(away(x).alias("distance_m"), x["s"]["seq"].alias("seq"), (x["s"]["progress1"] + x["t"] * x["s"]["length_m"]).alias("progress_m"), x["s"]["bearing"].alias("segment_bearing"))
    return F.array_min(F.transform(legs, lambda x: F.struct(x["s"]["far"].alias("far"), place(x).alias("p"))))


#: Samples of a cell that one task takes on.
CELL_SAMPLES = 4096


def meet(samples: DataFrame, lists: DataFrame, on: list[str], most: int = CELL_SAMPLES) -> DataFrame:
    """``samples`` with the list of their cell; a cell of more than ``most`` is dealt to many tasks, with its list."""
    counts = samples.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    large = F.broadcast(counts.select(*on, F.ceil(F.col("_n") / most).alias("_n")))  # a row for thousands of samples
    left = samples.join(large, on, "left").withColumn("_i", F.pmod(F.xxhash64("sample_id"), F.coalesce("_n", F.lit(1)))).drop("_n")
    right = lists.join(large, on, "left").withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_n", F.lit(1)) - 1))).drop("_n")
    return left.join(right, [*on, "_i"]).drop("_i")


def map_match(samples: DataFrame, segments: DataFrame, size: float = 0.01, reach: int = 2, most_m: float | None = None, most_cells: int = 256, routes: DataFrame | None = None) -> DataFrame:
    """The nearest segment of each candidate shape to each sample.

    ``samples``: sample_id, route_id, latitude, longitude; ``segments``: shape_id,
    route_id, seq, lat1, lon1, lat2, lon2, progress1, length_m, or without route_id where
    ``routes`` (route_id, shape_id) tells the shapes of each route.  Short segments (up to
    ``most_cells`` cells) within ``reach`` cells come first, all segments of the shape
    where there are none.  With ``most_m`` matches farther than that drop, and the grid
    alone finds the others: no sample meets all segments of a shape.

    A shape of many routes lies on the grid once, and only if a sample's route has it.  A
    sample meets the segments of a shape in its cell as one list, so there is
    never a row for each sample and segment.
    """
    asked = samples.select("route_id").distinct()
    if routes is None:
        segments = segments.join(asked, "route_id", "left_semi")
        routes, segments = segments.select("route_id", "shape_id"), segments.drop("route_id").distinct()
    pairs = routes.join(asked, "route_id", "left_semi").select("route_id", "shape_id").distinct()
    segments = segments.select(*SEGMENT).join(pairs, "shape_id", "left_semi")
    levels = [0] if most_m is None else sorted(r[0] for r in segments.select(segment_level(size, most_cells)).distinct().collect())  # some twenty at most
    cell = ["shape_id", "level", "_cx", "_cy"]
    lists = segment_grid(segments, size, reach, most_cells, most_m).groupBy(*cell).agg(F.collect_list(segment_list()).alias("_s"))
    keys = [F.struct(F.lit(k).alias("level"), grid_cell("longitude", size * 2**k).alias("_cx"), grid_cell("latitude", size * 2**k).alias("_cy")) for k in levels or [0]]
    keyed = samples.select("sample_id", "route_id", "latitude", "longitude").join(pairs, "route_id").select("sample_id", "shape_id", "latitude", "longitude", F.explode(F.array(*keys)).alias("_k")).select("*", "_k.*").drop("_k")
    least = nearest(F.col("latitude"), F.col("longitude"), F.col("_s")).alias("b")
    found = meet(keyed, lists, cell).select("sample_id", "shape_id", least)
    if most_m is None:
        # shapes without a segment near the sample's cell: all their segments
        every = segments.withColumn("near", F.lit(False)).groupBy("shape_id").agg(F.collect_list(segment_list()).alias("_s"))
        found = found.unionByName(meet(keyed.join(lists.select(*cell), cell, "left_anti"), every, ["shape_id"]).select("sample_id", "shape_id", least))
    best = found.groupBy("sample_id", "shape_id").agg(F.min("b").alias("b")).select("sample_id", "shape_id", "b.p.distance_m", "b.p.progress_m", "b.p.segment_bearing")
    return best if most_m is None else best.where(F.col("distance_m") <= most_m)


def schedule_position(calls: DataFrame, now: int) -> DataFrame:
    """Where each trip is at ``now`` (service seconds) by its timetable.

    ``calls``: trip_id, stop_sequence, source_order, arrival, departure, lat, lon.
    Before the first call: there; dwelling: at the stop; else on the line to the
    next call; after the last: there.
    """
    order = Window.partitionBy("trip_id").orderBy("stop_sequence", "source_order")
    nxt = lambda c: F.lead(c).over(order).alias(f"next_{c}")
    pairs = calls.select("*", F.row_number().over(order).alias("k"), *(nxt(c) for c in ("arrival", "lat", "lon", "stop_id")))
    at = F.lit(now)
    moving = (at > F.col("departure")) & (at < F.col("next_arrival"))
    rank = F.when(at.between(F.col("arrival"), F.col("departure")), 0).when(moving, 1).when((F.col("k") == 1) & (at < F.col("arrival")), 2).when(F.col("next_arrival").isNull() & (at > F.col("departure")), 3)
    part = F.when(moving, (at - F.col("departure")) / F.greatest(F.lit(1), F.col("next_arrival") - F.col("departure"))).otherwise(0.0)
    lat = F.when(moving, F.col("lat") + (F.col("next_lat") - F.col("lat")) * part).otherwise(F.col("lat"))
    lon = F.when(moving, F.col("lon") + (F.col("next_lon") - F.col("lon")) * part).otherwise(F.col("lon"))
    state = F.element_at(F.array(*map(F.lit, ("dwell", "moving", "before", "after"))), F.col("rank") + 1)
    placed = pairs.withColumn("rank", rank).where("rank is not null").withColumn("x", F.struct("rank", "k", lat.alias("latitude"), lon.alias("longitude"), F.when(moving, F.col("next_stop_id")).otherwise(F.col("stop_id")).alias("stop_id")))
    best = placed.groupBy("trip_id").agg(F.min("x").alias("x")).select("trip_id", "x.*")
    return best.select("trip_id", state.alias("state"), "latitude", "longitude", "stop_id")


def city_memberships(packages: DataFrame, provider: str) -> DataFrame:
    """city_id, stop_id, provider_id for the public id and every source id of a package stop."""
    ids = F.explode(F.array_union(F.array("stop_id"), "source_ids"))
    return packages.select("city_id", ids.alias("stop_id"), F.lit(provider).alias("provider_id")).distinct()


def provider_registry(entities: DataFrame, trips: DataFrame, routes: DataFrame, providers: list[str]) -> DataFrame:
    """Trips of some providers with route, direction, line label and type."""
    own = entities.where((F.col("entity_type") == "trips") & F.col("provider_id").isin(providers)).select("provider_id", F.col("key_1").alias("trip_id")).distinct()
    label = line_label("short_name", "long_name", "route_id").alias("label")
    return own.join(trips, "trip_id").join(routes, "route_id").select("provider_id", "trip_id", "route_id", "direction_id", label, "route_type")


def resolve_city(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """Replaces an alias city by its canonical city."""
    a = aliases.select(F.col("alias_city_id").alias("_alias"), "canonical_city_id")
    return df.join(a, F.col("city_id") == F.col("_alias"), "left").withColumn("city_id", F.coalesce("canonical_city_id", "city_id")).drop("_alias", "canonical_city_id")


def query_stop(stops: DataFrame, calls: DataFrame) -> DataFrame:
    """stop_id, query_stop_id: the stop if it has a call, else its parent if any, else itself."""
    served = calls.select(F.col("stop_id").alias("_served")).distinct()
    known = stops.select(F.col("stop_id").alias("_parent")).distinct()
    out = stops.join(served, F.col("stop_id") == F.col("_served"), "left").join(known, F.col("parent_station") == F.col("_parent"), "left")
    return out.select("stop_id", F.when(F.col("_served").isNotNull(), F.col("stop_id")).otherwise(F.coalesce("_parent", "stop_id")).alias("query_stop_id"))


def stop_candidates(modes: DataFrame, asked: DataFrame) -> DataFrame:
    """One candidate id for each provider prefix of the city, and the id itself."""
    both = asked.join(modes, "city_id")
    marked = F.when(F.startswith("stop_id", "prefix"), F.col("stop_id")).otherwise(F.concat("prefix", "stop_id"))
    return both.select("city_id", "stop_id", marked.alias("candidate")).union(asked.select("city_id", "stop_id", F.col("stop_id").alias("candidate"))).distinct()
