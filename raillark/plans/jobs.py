"""Data products built from the operators.

Most are one lazy plan; those that resolve ancestors or scope an agency run the rounds
of that search when they are called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.functions.expr import destination, haversine_m, iso_utc, line_label, line_names, mode_of_route_type, optional_text, prefix_id, relationship_name, search_name, slug
from raillark.operators import aggregates, filters, joins, sets, windows

Feed = dict[str, DataFrame]


def city_departures(feed: Feed, city_stops: DataFrame, days: DataFrame, variant: str = "union") -> DataFrame:
    """Every dated departure at the canonical stops of the cities."""
    active = sets.active_services(feed["calendar"], feed["calendar_dates"], days, variant)
    near = city_stops.select("city_id", F.col("stop_id").alias("canonical_stop_id")).distinct()
    # the calls of the cities' stops alone go on; their terminals are those of all calls
    there = joins.canonical_stops(feed["stops"]).join(near, "canonical_stop_id", "left_semi").select("stop_id")
    here = feed["stop_times"].join(there, "stop_id", "left_semi")
    rows = joins.calls(here, feed["trips"], active, feed["stops"], feed["routes"], windows.terminal_stops(feed["stop_times"], "A"))
    return rows.join(near, "canonical_stop_id")


def compact_departures(feed: Feed, public: DataFrame, days: DataFrame) -> DataFrame:
    """One row a call of any trip active in the window, not multiplied by its dates."""
    active = sets.active_services(feed["calendar"], feed["calendar_dates"], days).select("service_id").distinct()
    trips = feed["trips"].join(active, "service_id", "left_semi")
    resolved = joins.resolve_stops(feed["stops"], public).where("public_id is not null")
    last = windows.terminal_stops(feed["stop_times"], "B").join(feed["stops"].select(F.col("stop_id").alias("terminal_stop_id"), F.col("stop_name").alias("terminal_name")), "terminal_stop_id")
    place = feed["stops"].select("stop_id", "platform_code").join(resolved, "stop_id")
    named = trips.join(feed["routes"], "route_id").join(last, "trip_id", "left")
    named = named.select("trip_id", "route_id", "direction_id", destination("headsign", "terminal_name", "short_name", "long_name", "route_id").alias("h"))
    # stops first, trips last: the rows lie by trip, as the distinct rows need them
    rows = feed["stop_times"].join(place, "stop_id").join(named, "trip_id")
    child = F.col("stop_id") != F.col("public_id")
    return rows.select(
        "public_id", F.col("departure_time").alias("t"), F.col("route_id").alias("r"), "h",
        F.col("direction_id").alias("d"), F.col("trip_id").alias("p"), F.col("stop_sequence").alias("q"), F.when(child, F.col("stop_id")).alias("s"), F.when(child, F.nullif("platform_code", F.lit(""))).alias("platform"),
    ).distinct()


def station_calls(feed: Feed, cities: DataFrame, days: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Departures by station group, and the outputs (group_id, output_stop_id) that show each group.

    Calls have a row a group, not a row an output: a station of any number of outputs
    costs no more than its calls.
    """
    rows, _, outputs = _grouped_calls(feed, cities, days)
    return rows, outputs


def _grouped_calls(feed: Feed, cities: DataFrame, days: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``station_calls``, the groups of all calls before dates, and the outputs of the groups."""
    active = sets.active_services(feed["calendar"], feed["calendar_dates"], days, "exception_first")
    selected = feed["stops"].join(joins.within_radius(feed["stops"], cities).select("stop_id").distinct(), "stop_id", "left_semi")
    members, outputs = joins.station_groups(feed["stops"], selected)
    last = windows.terminal_stops(feed["stop_times"], "C").join(feed["stops"].select(F.col("stop_id").alias("terminal_stop_id"), F.col("stop_name").alias("terminal_name")), "terminal_stop_id", "left")
    named = feed["trips"].join(active, "service_id").join(feed["routes"].select("route_id", "short_name", "long_name", "route_type"), "route_id").join(last.drop("terminal_stop_id"), "trip_id", "left")
    named = named.select("trip_id", "service_date", line_label("short_name", "long_name", "route_id").alias("label"), destination("headsign", "terminal_name", default="?").alias("destination"), mode_of_route_type("route_type").alias("mode"))
    times = feed["stop_times"].select("trip_id", F.col("stop_id").alias("source_stop_id"), "departure_time", "stop_sequence", "source_order").join(members, "source_stop_id")
    rows = times.join(named, "trip_id")
    return rows.select("group_id", "service_date", "departure_time", "trip_id", "stop_sequence", "source_order", "label", "destination", "mode"), times.select("group_id"), outputs


def station_departures(feed: Feed, cities: DataFrame, days: DataFrame) -> DataFrame:
    """Departures at station groups near the cities, with the mode of transport, a row an output."""
    rows, counted, outputs = _grouped_calls(feed, cities, days)
    short = F.element_at(F.split("output_stop_id", ":"), -1)
    own = F.struct("trip_id", "service_date", "stop_sequence", "source_order")
    return joins.by_output(rows, counted, outputs, own).select("output_stop_id", short.alias("stop_key"), "service_date", "departure_time", "trip_id", "stop_sequence", "source_order", "label", "destination", "mode")


def day_departures(feed: Feed, city_stops: DataFrame, today: str) -> DataFrame:
    """Departures of services added on one day, with their rank by time text at each stop."""
    added = feed["calendar_dates"].where((F.col("service_date") == today) & (F.col("exception_type") == 1)).select("service_id").distinct()
    rows = feed["stop_times"].join(city_stops.select("stop_id").distinct(), "stop_id", "left_semi").join(feed["trips"], "trip_id").join(added, "service_id", "left_semi")
    order = Window.partitionBy("stop_id").orderBy("departure_time", "trip_id", "stop_sequence", "source_order")
    return rows.select("stop_id", "departure_time", "trip_id", "route_id", "headsign", "stop_sequence", F.row_number().over(order).alias("rank"))


def route_index(feed: Feed, city_stops: DataFrame, public: DataFrame) -> DataFrame:
    """Routes of each city with names, type, agency and headsigns by direction."""
    resolved = joins.resolve_stops(feed["stops"], public).where("public_id is not null")
    at = feed["stop_times"].select("trip_id", "stop_id").join(resolved, "stop_id").select("trip_id", F.col("public_id").alias("stop_id")).distinct()
    served = at.join(city_stops, "stop_id").join(feed["trips"].select("trip_id", "route_id"), "trip_id").select("city_id", "route_id").distinct()
    heads = aggregates.route_headsigns(feed["trips"].withColumn("source_order", F.lit(0)) if "source_order" not in feed["trips"].columns else feed["trips"])
    named = feed["routes"].withColumn("names", line_names("short_name", "long_name")).withColumn("type", F.coalesce(F.col("route_type").try_cast("int"), F.lit(3)))
    return served.join(named.select("route_id", "names", "type", "agency_id"), "route_id").join(heads, "route_id", "left")


def trip_index(feed: Feed, city_routes: DataFrame) -> DataFrame:
    """Trips of the cities' routes with their headsign if known."""
    return feed["trips"].join(city_routes.select("city_id", "route_id").distinct(), "route_id").select("city_id", "trip_id", "route_id", F.nullif("headsign", F.lit("")).alias("headsign"))


def radius_packages(stops: DataFrame, cities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stops of each city with search name, and the cities without any (an error)."""
    placed = joins.within_radius(stops, cities).withColumn("search_name", search_name("stop_name"))
    return placed, cities.join(placed.select("city_id").distinct(), "city_id", "left_anti")


def boundary_packages(stops: DataFrame, boundaries: DataFrame, cities: DataFrame) -> DataFrame:
    """Stops of each boundary, and of each configured city by radius, under one package id."""
    inside = joins.boundary_of(stops.withColumn("point_id", F.col("stop_id")), boundaries).join(boundaries.select("code", "name"), "code")
    by_code = inside.select(F.concat_ws("-", slug("name"), F.lower("code")).alias("package_id"), "stop_id")
    by_city = joins.within_radius(stops, cities).select(F.col("city_id").alias("package_id"), "stop_id")
    return by_code.unionByName(by_city)


def public_packages(feed: Feed, cities: DataFrame, catalogue: DataFrame, prefix: str) -> DataFrame:
    """A feed's public stops by city: radius, passenger rule, twins, prefix, catalogue fill."""
    near = joins.within_radius(feed["stops"], cities)
    inside = feed["stops"].join(near.select("stop_id").distinct(), "stop_id", "left_semi")
    shown = filters.passenger_stops(inside, feed["stop_times"])
    served = feed["stop_times"].select("stop_id").distinct()
    served = served.union(feed["stops"].join(served, "stop_id", "left_semi").select("parent_station")).distinct()
    shown = aggregates.drop_unserved_twins(shown, served)
    own = near.select("city_id", "stop_id").join(shown, "stop_id").select("city_id", prefix_id("stop_id", prefix).alias("stop_id"), "stop_name", "stop_lat", "stop_lon")
    more = joins.catalogue_fill(catalogue, shown, cities, [0, 1]).select("city_id", "stop_id", F.col("name").alias("stop_name"), "stop_lat", "stop_lon")
    return own.unionByName(more)


def operator_coverage(feed: Feed, boundaries: DataFrame, agency_id: str) -> tuple[DataFrame, DataFrame]:
    """Regions that an operator's stops touch, and its routes with their trips."""
    own = joins.agency_scope(feed, agency_id)
    places = own["stops"].join(own["stop_times"].select("stop_id").distinct(), "stop_id", "left_semi").withColumn("point_id", F.col("stop_id"))
    regions = aggregates.coverage_regions(joins.boundary_of(places, boundaries).withColumnRenamed("code", "city_id"))
    lists = own["trips"].groupBy("route_id").agg(F.array_sort(F.collect_set("trip_id")).alias("trip_ids"))
    return regions, lists


def radar_topology(feed: Feed, allow: list[str]) -> DataFrame:
    """Direction variants of surface routes with their shape's points and length."""
    routes = filters.route_type_filter(feed["routes"], allow)
    trips = feed["trips"].join(routes.select("route_id"), "route_id", "left_semi")
    variants = aggregates.trip_variants(trips, feed["stop_times"], windows.terminal_stops(feed["stop_times"], "A"), feed["stops"])
    lengths = windows.shape_progress(feed["shapes"]).groupBy("shape_id").agg(F.count("*").alias("n_points"), F.max("progress_m").alias("length_m"))
    key = F.concat_ws("|", "route_id", "direction_id", "shape_id", F.coalesce("terminal_stop_id", F.lit("")), F.array_join(F.zip_with("sequences", "stop_ids", lambda q, s: F.concat_ws(":", q.cast("string"), s)), "|"))
    return variants.join(lengths, "shape_id").withColumn("variant_id", F.substr(F.sha1(key.cast("binary")), F.lit(1), F.lit(16)))


def trip_updates_view(rt: DataFrame, trips: DataFrame, stops: DataFrame, calls: DataFrame, now: int, max_stale: int, most_stops: DataFrame | None = None) -> DataFrame:
    """Usable, fresh trip updates with static trip, stop filled from the sequence; the last of each call."""
    rows = filters.fresh(filters.usable_updates(rt), now, max_stale, False)
    rows = joins.fill_stop_id(rows, calls)
    rows = joins.rt_static_join(rows, trips, stops, "strict")
    if most_stops is not None:
        rows = joins.scope(rows, most_stops, "stop_id")
    key = Window.partitionBy("trip_id", "stop_id", "stop_sequence").orderBy(F.desc("feed_ts"), "delay_seconds")
    rows = rows.withColumn("_r", F.row_number().over(key)).where("_r = 1").drop("_r")
    return rows.select("trip_id", "route_id", "stop_id", "stop_sequence", "delay_seconds", "cancelled", relationship_name("trip_relationship", "trip").alias("trip_status"), iso_utc("feed_ts").alias("updated_at"))


def vehicle_view(samples: DataFrame, trips: DataFrame, region: Column | None = None) -> DataFrame:
    """Latest valid position of each vehicle, with its trip where that is known."""
    rows = filters.valid_positions(samples, region)
    key = Window.partitionBy("vehicle_id").orderBy(F.desc("ts"), F.desc("event_id"))
    rows = rows.withColumn("_r", F.row_number().over(key)).where("_r = 1").drop("_r")
    static = trips.select("trip_id", F.col("route_id").alias("static_route_id"), "direction_id")
    out = rows.join(static, "trip_id", "left")
    return out.select("vehicle_id", F.when(F.col("static_route_id").isNotNull(), F.col("trip_id")).alias("trip_id"), F.coalesce("static_route_id", "route_id").alias("route_id"), "direction_id", "latitude", "longitude", F.pmod("bearing", F.lit(360.0)).alias("bearing"), "ts")


def alerts_view(selectors: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """Alerts with their targets as text lists."""
    return joins.alert_targets(selectors, routes, stops, text=True)


def estimated_vehicles(calls: DataFrame, trips: DataFrame, now: int) -> DataFrame:
    """Positions by timetable, marked as estimates."""
    return joins.schedule_position(calls, now).join(trips.select("trip_id", "route_id", "direction_id"), "trip_id").withColumn("source", F.lit("scheduleEstimate"))


def import_feed(feed: Feed, provider: str, prefix: str) -> Feed:
    """Typed entity tables with prefixed ids and an ownership row for each entity."""
    p = lambda c: prefix_id(c, prefix).alias(c)
    stops = feed["stops"].select(p("stop_id"), p("parent_station"), "stop_name", "platform_code", F.col("stop_lat").cast("double"), F.col("stop_lon").cast("double"), "source_order")
    routes = feed["routes"].select(p("route_id"), "short_name", "long_name", F.col("route_type").try_cast("int").alias("route_type"), "agency_id")
    trips = feed["trips"].select(p("trip_id"), p("route_id"), p("service_id"), "headsign", "direction_id")
    times = feed["stop_times"].select(p("trip_id"), p("stop_id"), F.col("stop_sequence").cast("int"), "departure_time", "departure_seconds", "source_order")
    out = {"stops": stops, "routes": routes, "trips": trips, "stop_times": times}
    key = {"stops": "stop_id", "routes": "route_id", "trips": "trip_id"}
    owned = [out[k].select(F.lit(k).alias("entity_type"), F.lit(provider).alias("provider_id"), F.col(c).alias("key_1")) for k, c in key.items()]
    out["entities"] = owned[0].unionByName(owned[1]).unionByName(owned[2])
    return {k: v.withColumn("provider_id", F.lit(provider)) for k, v in out.items()}


def replace_provider(tables: Feed, entities: DataFrame, providers: list[str]) -> tuple[Feed, DataFrame]:
    """The tables and ownership rows without what only ``providers`` own."""
    none = entities.where(F.lit(False))
    return sets.replace_provider(tables, entities, providers, {}, none)


def business_events(raw: DataFrame, products: DataFrame, handled: dict[str, list[str]]) -> DataFrame:
    """Store events with product class, the app of the bundle and whether the app handles the type.

    ``products``: bundle_id, product_id, app, purchase_kind; ``handled``: event types by app.
    """
    first = products.groupBy("bundle_id").agg(F.min_by("app", "product_id").alias("bundle_app"))
    out = raw.join(products, ["bundle_id", "product_id"], "left").join(first, "bundle_id", "left")
    app, kind = F.coalesce("app", "bundle_app", F.lit("unknown")), F.coalesce("purchase_kind", F.lit("unknown"))
    known = F.lit(False)
    for name, types in handled.items():
        known |= (F.col("_app") == name) & F.col("notification_type").isin(types)
    out = out.withColumn("_app", app).withColumn("_kind", kind)
    return out.select("notification_uuid", "notification_type", "bundle_id", "product_id", "environment", F.col("_app").alias("app"), F.col("_kind").alias("purchase_kind"), (known & (F.col("_kind") != "unknown")).alias("is_handled"))


# Message titles by event type.
TITLES = {
    "ONE_TIME_CHARGE": "Lifetime purchased",
    "REFUND": "Refund",
    "REFUND_REVERSED": "Refund reversed",
    "DID_FAIL_TO_RENEW": "Subscription renewal failed",
    "EXPIRED": "Subscription expired",
    "GRACE_PERIOD_EXPIRED": "Subscription grace period expired",
    "DID_CHANGE_RENEWAL_STATUS": "Renewal status changed",
    "DID_CHANGE_RENEWAL_PREF": "Renewal preference changed",
}


def event_messages(events: DataFrame, sandbox: bool = False) -> DataFrame:
    """Text of each handled event; sandbox events only if asked for."""
    kind, period = F.col("notification_type"), F.when(F.col("purchase_kind").isin("monthly", "yearly"), F.col("purchase_kind"))
    title = F.when((kind == "SUBSCRIBED") & period.isNotNull(), F.concat(F.lit("New "), period, F.lit(" subscription"))).when(kind == "SUBSCRIBED", "Lifetime purchased")
    title = title.when((kind == "DID_RENEW") & period.isNotNull(), F.concat(F.initcap(period), F.lit(" subscription renewed"))).when(kind == "DID_RENEW", "Subscription renewed")
    for name, text in TITLES.items():
        title = title.when(kind == name, text)
    test = F.lower("environment") == "sandbox"
    lines = [F.col("app"), title.otherwise("Store event"), F.concat(F.lit("Environment: "), F.when(test, "Sandbox").otherwise("Production")), F.when(F.col("product_id").isNotNull(), F.concat(F.lit("Product: "), F.col("product_id")))]
    rows = events.where("is_handled")
    return (rows if sandbox else rows.where(~test)).select("notification_uuid", F.concat_ws("\n", *lines).alias("message"))


def provenance_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """source_id, problem where digests or sizes of two inventories differ."""
    both = expected.select("source_id", F.col("sha256").alias("e"), F.col("size").alias("es")).join(actual.select("source_id", F.col("sha256").alias("a"), F.col("size").alias("s")), "source_id", "full_outer")
    problem = F.when(F.col("e").isNull(), "unexpected").when(F.col("a").isNull(), "missing").when(F.col("e") != F.col("a"), "digest").when(F.col("es") != F.col("s"), "size")
    return both.select("source_id", problem.alias("problem")).where("problem is not null")


def hourly_trips(feed: Feed, days: DataFrame, trips: DataFrame) -> DataFrame:
    """trip_id, hour: the clock hours that each trip runs through."""
    active = sets.active_services(feed["calendar"], feed["calendar_dates"], days)
    span = feed["stop_times"].groupBy("trip_id").agg(F.min("departure_seconds").alias("lo"), F.max("departure_seconds").alias("hi"))
    rows = trips.select("trip_id", "service_id").join(span, "trip_id").join(active, "service_id")
    start = F.unix_seconds(F.to_timestamp("service_date", "yyyyMMdd"))
    return rows.select("trip_id", F.explode(F.sequence(F.floor((start + F.col("lo")) / 3600), F.floor((start + F.col("hi")) / 3600))).alias("hour")).distinct()


def hourly_stops(feed: Feed, days: DataFrame, trips: DataFrame) -> DataFrame:
    """hour, stop_id: the stops on the way of any trip of an hour, a row each."""
    served = feed["stop_times"].select("trip_id", "stop_id").distinct()
    return hourly_trips(feed, days, trips).join(served, "trip_id").select("hour", "stop_id").distinct()


def hourly_network(feed: Feed, days: DataFrame, trips: DataFrame) -> DataFrame:
    """Number of trips and of distinct stops on their way by clock hour; pairs are made distinct first, so no row holds an hour's lists."""
    runs = hourly_trips(feed, days, trips).groupBy("hour").agg(F.count("*").alias("n_trips"))
    places = hourly_stops(feed, days, trips).groupBy("hour").agg(F.count("*").alias("n_stops"))
    return runs.join(places, "hour", "left").select("hour", "n_trips", F.coalesce("n_stops", F.lit(0)).alias("n_stops"))


# Our field, the record's field, and how it is read. An optional text
# may be a word for nothing, a filled one is null if empty; needed ones must not be empty.
SYSTEM_FIELDS = {
    "stations": [("id", "code1", "needed"), ("name", "name", "needed"), ("name_english", "name_eng", "optional"), ("line", "line", "optional"), ("line_english", "line_eng", "optional"), ("transfer_station", "transf_st", "optional"), ("latitude", "latitude", "number"), ("longitude", "longitude", "number")],
    "edges": [("id", "globalid", "text"), ("from_id", "from_code1", "needed"), ("to_id", "to_code1", "needed"), ("line", "num_route", "text"), ("line_english", "num_r_eng", "filled"), ("direction", "napryamok", "text"), ("position", "order_", "number")],
    "stop_times": [("station_id", "code1", "needed"), ("name", "name", "filled"), ("line", "line", "filled"), ("direction", "napryamok", "filled"), ("first", "first_trn1", "filled"), ("last", "last_trn1", "filled")],
    "train_times": [("station_id", "code1", "needed"), ("train_id", "train", "needed"), ("name", "name", "filled"), ("route", "num_route", "text"), ("route_english", "num_r_eng", "filled"), ("direction", "napryamok", "text"), ("service", "type", "text"), ("arrival", "arrival", "filled"), ("departure", "departure", "filled")],
    "periods": [("line", "line", "text"), ("time_period", "timeperiod", "text"), ("weekday_forward", "st_weekday", "text"), ("weekday_reverse", "rv_weekday", "text"), ("holiday_forward", "st_holiday", "text"), ("holiday_reverse", "rv_holiday", "text")],
    "calendar": [("station_id", "code1", "text"), ("line", "line", "filled"), ("opening", "open_max", "filled"), ("closing", "close_min", "filled")],
    "interchanges": [("from_id", "from_code1", "text"), ("to_id", "to_code1", "text"), ("from_name", "from_name", "filled"), ("to_name", "to_name", "filled"), ("comment", "comment", "filled")],
}


def system_tables(records: dict[str, DataFrame]) -> tuple[Feed, DataFrame]:
    """Stations, edges, stop and train times, periods, calendar and interchanges of small systems, and the problems.

    Each input has ``system`` and ``record``, a map of texts.  Problems (table_name,
    system, problem): rows that lack a needed field, and station ids used twice.
    """
    out, problems = {}, []
    for name, df in records.items():
        text = lambda field: F.trim(F.coalesce(F.col("record")[field], F.lit("")))
        read = {"needed": text, "text": text, "filled": lambda f: F.nullif(text(f), F.lit("")), "optional": lambda f: optional_text(F.col("record")[f]), "number": lambda f: F.col("record")[f].try_cast("double")}
        rows = df.select("system", *(read[kind](field).alias(own) for own, field, kind in SYSTEM_FIELDS[name]))
        needed = [own for own, _, kind in SYSTEM_FIELDS[name] if kind == "needed"]
        lacks = F.lit(False)
        for c in needed:
            lacks |= F.col(c) == ""
        problems.append(rows.where(lacks).select(F.lit(name).alias("table_name"), "system", F.lit("incomplete").alias("problem")))
        out[name] = rows.where(~lacks)
        if name == "stations":
            twice = out[name].groupBy("system", "id").agg(F.count("*").alias("n")).where("n > 1")
            problems.append(twice.select(F.lit(name).alias("table_name"), "system", F.lit("repeated").alias("problem")))
    return out, reduce(DataFrame.unionByName, problems)


def nearest_center(packages: DataFrame, cities: DataFrame) -> DataFrame:
    """Least distance of a city's stops to its centre."""
    both = packages.join(cities.select("city_id", "latitude", "longitude"), "city_id")
    return both.groupBy("city_id").agg(F.min(haversine_m("latitude", "longitude", "stop_lat", "stop_lon")).alias("nearest_m"))
