"""Ordered logic: file order, sequences, shapes and vehicle samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.functions.expr import bearing_diff, equirect_m, haversine_m, search_name, service_instant
from raillark.operators.lineage import cut


def terminal_stops(calls: DataFrame, variant: str = "A") -> DataFrame:
    """trip_id, terminal_stop_id.  A: the greatest sequence, of equals the last row.
    B: that only if it is also the last row.  C: the last row in file order."""
    by_seq = F.max(F.struct("stop_sequence", "source_order", "stop_id"))
    by_row = F.max(F.struct("source_order", "stop_id"))
    asked = {"A": [by_seq.alias("s")], "B": [by_seq.alias("s"), by_row.alias("r")], "C": [by_row.alias("s")]}[variant]
    ends = calls.groupBy("trip_id").agg(*asked)
    if variant == "B":
        ends = ends.where("s.source_order = r.source_order")
    return ends.select("trip_id", F.col("s.stop_id").alias("terminal_stop_id"))


def first_wins(df: DataFrame, keys: list[str], order: str = "source_order") -> DataFrame:
    """The first row of each key in file order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_r = 1").drop("_r")


def last_wins(df: DataFrame, keys: list[str], order: str = "source_order") -> DataFrame:
    """The last row of each key in file order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where("_r = 1").drop("_r")


def priority_dedupe(stops: DataFrame, factor: float = 20.0) -> DataFrame:
    """Of stops of one city, name and coarse place, the one of the lowest priority; all their ids are kept."""
    key = ["city_id", "_k", "_a", "_b"]
    rows = stops.withColumn("_k", search_name("stop_name")).withColumn("_a", F.rint(F.col("stop_lat") * factor)).withColumn("_b", F.rint(F.col("stop_lon") * factor))
    group = rows.groupBy(*key).agg(F.min(F.struct("priority", "source_order", "stop_id", "stop_name", "stop_lat", "stop_lon")).alias("best"), F.array_sort(F.collect_set("stop_id")).alias("stop_ids"))
    return group.select("city_id", "best.stop_id", "best.stop_name", "best.priority", "stop_ids")


def canonical_packages_input(canonical: DataFrame) -> DataFrame:
    """Parent-canonical stops, the first of each (search name, 4-decimal place)."""
    rows = canonical.where("stop_id = canonical_stop_id").withColumn("_k", search_name("stop_name")).withColumn("_a", F.rint(F.col("stop_lat") * 10000)).withColumn("_b", F.rint(F.col("stop_lon") * 10000))
    return first_wins(rows, ["_k", "_a", "_b"]).drop("_k", "_a", "_b")


def shape_progress(shapes: DataFrame) -> DataFrame:
    """Cumulative metres along each shape; shapes of one point drop."""
    order = Window.partitionBy("shape_id").orderBy("shape_pt_sequence")
    step = equirect_m(F.lag("shape_pt_lat").over(order), F.lag("shape_pt_lon").over(order), "shape_pt_lat", "shape_pt_lon")
    rows = shapes.withColumn("_n", F.count("*").over(Window.partitionBy("shape_id"))).where("_n > 1").drop("_n").withColumn("_step", F.coalesce(step, F.lit(0.0)))
    return rows.withColumn("progress_m", F.sum("_step").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def shape_segments(shapes: DataFrame, size: float = 0.01, most_cells: int = 256) -> DataFrame:
    """Consecutive point pairs with their length and number of grid cells; ``indexed`` is false over ``most_cells``."""
    order = Window.partitionBy("shape_id").orderBy("shape_pt_sequence")
    nxt = lambda c: F.lead(c).over(order)
    rows = shape_progress(shapes).select("shape_id", F.col("shape_pt_sequence").alias("seq"), F.col("shape_pt_lat").alias("lat1"), F.col("shape_pt_lon").alias("lon1"), F.col("progress_m").alias("progress1"), nxt("shape_pt_lat").alias("lat2"), nxt("shape_pt_lon").alias("lon2"), nxt("progress_m").alias("progress2"))
    rows = rows.where("lat2 is not null").withColumn("length_m", F.col("progress2") - F.col("progress1"))
    span = lambda a, b: F.abs(F.floor(F.col(a) / size) - F.floor(F.col(b) / size)) + 1
    return rows.withColumn("n_cells", span("lat1", "lat2") * span("lon1", "lon2")).withColumn("indexed", F.col("n_cells") <= most_cells)


def sample_pairs(samples: DataFrame, gap_s: int = 300) -> DataFrame:
    """Each sample with the one before it of its vehicle, if that is earlier, on the same route and within the gap.

    Of samples of one time the least ``event_id`` counts, the others drop.
    """
    same = Window.partitionBy("vehicle_id", "ts").orderBy("event_id")
    once = samples.withColumn("_r", F.row_number().over(same)).where("_r = 1").drop("_r")
    order = Window.partitionBy("vehicle_id").orderBy("ts")
    prev = lambda c: F.lag(c).over(order).alias(f"prev_{c}")
    rows = once.select("*", *(prev(c) for c in ("event_id", "ts", "route_id", "latitude", "longitude")))
    rows = rows.withColumn("elapsed_s", F.timestamp_diff("SECOND", "prev_ts", "ts"))
    return rows.where((F.col("elapsed_s") > 0) & (F.col("elapsed_s") <= gap_s) & (F.col("prev_route_id") == F.col("route_id")))


def gap_sessions(samples: DataFrame, gap_s: int = 300) -> DataFrame:
    """Runs of each vehicle: a gap of more than ``gap_s`` begins a new one."""
    order = Window.partitionBy("vehicle_id").orderBy("ts")
    broken = F.coalesce((F.timestamp_diff("SECOND", F.lag("ts").over(order), F.col("ts")) > gap_s).cast("int"), F.lit(0))
    rows = samples.withColumn("_new", broken).withColumn("run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("vehicle_id", "run").agg(F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count("*").alias("n_samples"))


def candidate_scores(matches: DataFrame, most_m: float = 1000.0, least_step_m: float = 25.0, most_speed: float = 45.0, scale_m: float = 500.0, most_turn: float = 35.0) -> DataFrame:
    """Score of each candidate of a sample pair.

    ``matches``: pair_id, candidate, elapsed_s, bearing, and distance, progress and
    segment bearing of both ends on one shape of the candidate.
    """
    step = F.col("progress_after") - F.col("progress_before")
    ok = (F.greatest("distance_before", "distance_after") <= most_m) & (F.abs(step) >= least_step_m) & (F.abs(step) / F.col("elapsed_s") <= most_speed)
    conflict = F.coalesce(bearing_diff("bearing", "bearing_after") > most_turn, F.lit(False))
    weight = F.exp(-(F.col("distance_before") + F.col("distance_after")) / 2 / scale_m)
    rows = matches.where(ok).withColumn("w", weight).withColumn("plus", F.when(step > 0, F.col("w")).otherwise(0.0))
    rows = rows.withColumn("minus", F.when(step > 0, 0.0).otherwise(F.col("w")) + F.when(conflict, F.col("w")).otherwise(0.0))
    sums = rows.groupBy("pair_id", "candidate").agg(F.sum("plus").alias("support"), F.sum("minus").alias("contrary"), F.count("*").alias("usable_shapes"), F.min("distance_after").alias("best_distance_m"))
    total = F.col("support") + F.col("contrary")
    return sums.where(total > 0).withColumn("score", F.greatest(F.lit(0.0), (F.col("support") - F.col("contrary")) / total))


def family_decision(scores: DataFrame, near_m: float = 100.0, least_score: float = 0.58, least_margin: float = 0.20, least_gap_m: float = 20.0) -> DataFrame:
    """Best destination family (terminal and destination) of each pair and whether it is confident.

    ``scores`` also carries terminal_stop_id, destination and direction_id.
    """
    family = F.coalesce(F.nullif("terminal_stop_id", F.lit("")), F.nullif("destination", F.lit("")), F.lit("unknown"))
    rows = scores.where(F.col("best_distance_m") <= near_m).withColumn("family", family)
    rows = rows.withColumn("_t", F.nullif("terminal_stop_id", F.lit(""))).withColumn("_d", F.nullif("destination", F.lit("")))
    own = Window.partitionBy("pair_id", "_t", "_d")
    best = rows.withColumn("closest_m", F.min("best_distance_m").over(own)).withColumn("_r", F.row_number().over(own.orderBy(F.desc("score"), F.desc("support"), "best_distance_m", "candidate"))).where("_r = 1")
    rank = Window.partitionBy("pair_id").orderBy(F.desc("score"), "best_distance_m", "family", "_d")
    nxt = lambda c: F.lead(c).over(rank)
    best = best.withColumn("_r", F.row_number().over(rank)).withColumn("second_score", nxt("score")).withColumn("second_m", nxt("best_distance_m")).withColumn("second_direction", nxt("direction_id"))
    best = best.withColumn("least_m", F.min("closest_m").over(Window.partitionBy("pair_id"))).where("_r = 1")
    margin = F.coalesce(F.col("score") - F.col("second_score"), F.lit(1.0))
    apart = F.coalesce(F.col("second_m") - F.col("best_distance_m") >= least_gap_m, F.lit(True))
    same = F.coalesce(F.col("second_direction") == F.col("direction_id"), F.lit(False))
    dominated = (F.col("best_distance_m") - F.col("closest_m") >= least_gap_m) & (F.col("least_m") < F.col("closest_m"))
    sure = (F.col("score") >= least_score) & (margin >= least_margin) & (~same | apart) & ~dominated
    return best.select("pair_id", "family", "candidate", "direction_id", "score", margin.alias("margin"), "best_distance_m", sure.alias("confident"))


def call_pairs(calls: DataFrame) -> DataFrame:
    """Each call with the next call of its trip."""
    order = Window.partitionBy("trip_id").orderBy("stop_sequence", "source_order")
    nxt = lambda c: F.lead(c).over(order).alias(f"next_{c}")
    return calls.select("trip_id", "stop_id", "stop_sequence", "source_order", "departure_seconds", nxt("stop_id"), nxt("departure_seconds")).where("next_stop_id is not null")


def departure_board(calls: DataFrame, stop_id: str | None, limit: int = 30, frm: str | None = None, to: str | None = None, tz: str = "UTC") -> DataFrame:
    """Next departures of one stop, or of every stop if ``stop_id`` is None; ``limit`` is held to 1 to 100.

    ``frm`` and ``to`` (UTC wall time) filter exact instants before the limit.
    """
    rows = calls if stop_id is None else calls.where(F.col("canonical_stop_id") == stop_id)
    if frm or to:
        at = service_instant("service_date", "departure_seconds", tz)
        rows = rows.where((at >= F.lit(frm or "0001-01-01").cast("timestamp_ntz")) & (at <= F.lit(to or "9999-12-31").cast("timestamp_ntz")))
    k = max(1, min(100, limit))
    order = ["service_date", "departure_seconds", "trip_id", "stop_sequence", "source_order"]
    if stop_id is not None:
        return rows.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy("canonical_stop_id").orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def lines_at_stop(calls: DataFrame, stop_id: str) -> DataFrame:
    """Distinct lines and directions at a stop, by label and route."""
    keys = ["route_id", "label", "direction_id", "destination", "terminal_stop_id"]
    return calls.where(F.col("canonical_stop_id") == stop_id).select(*keys).distinct().orderBy("label", "route_id", "direction_id", "destination", "terminal_stop_id")


def spread_stops(stops: DataFrame, cities: DataFrame, k: int = 12) -> DataFrame:
    """At most ``k`` monitor stops of each city, spread over it and rich in lines.

    ``stops``: city_id, stop_id, stop_lat, stop_lon, line_count.  The first pick has
    the most lines; each further one the best of least distance to the picks, lines
    and nearness to the centre.  A round handles all cities; the number of rounds
    is ``k``, the rows stay those of ``stops``.
    """
    rows = stops.join(cities.select("city_id", F.col("latitude").alias("_a"), F.col("longitude").alias("_b")), "city_id").withColumn("center_m", haversine_m("_a", "_b", "stop_lat", "stop_lon")).drop("_a", "_b").withColumn("apart_m", F.lit(None).cast("double"))
    order = F.struct((-F.col("line_count")).alias("l"), "center_m", "stop_id")
    pick = rows.groupBy("city_id").agg(F.min_by(F.struct("stop_id", "stop_lat", "stop_lon"), order).alias("p"))
    picks = pick.select("city_id", F.lit(1).alias("rank"), "p.stop_id")
    for rank in range(2, k + 1):
        last = pick.select("city_id", F.col("p.stop_id").alias("_id"), F.col("p.stop_lat").alias("_a"), F.col("p.stop_lon").alias("_b"))
        rows = rows.join(last, "city_id").where("stop_id <> _id").withColumn("apart_m", F.least("apart_m", haversine_m("stop_lat", "stop_lon", "_a", "_b"))).drop("_id", "_a", "_b")
        if rank % 4 == 0:
            rows = cut(rows)
        score = F.struct((F.col("apart_m") + F.col("line_count") * 1200 - F.col("center_m") * 0.08).alias("s"), "line_count", "stop_id")
        pick = rows.groupBy("city_id").agg(F.max_by(F.struct("stop_id", "stop_lat", "stop_lon"), score).alias("p"))
        if rank % 4 == 0:
            pick = cut(pick)
        picks = picks.unionByName(pick.select("city_id", F.lit(rank).alias("rank"), "p.stop_id"))
    return picks


# Sort columns of the published forms.
PUBLISHED_ORDER = {
    "stops": ["search_name", "stop_id"],
    "updates": ["effective_time", "route_id", "trip_id"],
    "vehicles": ["vehicle_id"],
    "compact": ["departure_time", "trip_id", "stop_sequence"],
    "city": ["service_date", "departure_seconds", "trip_id", "stop_sequence", "source_order"],
}


def published_order(df: DataFrame, kind: str) -> DataFrame:
    return df.orderBy(*PUBLISHED_ORDER[kind])
