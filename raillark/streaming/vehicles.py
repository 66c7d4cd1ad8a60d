"""Vehicle samples with keyed state: late samples dropped, pairs, and the direction of travel.

What can be known of one sample alone is a plan of joins with static tables
(:func:`evidence`): which candidate its trip or stop names, and where it lies on each
shape of its route.  It is the same for a table and a stream.  What depends on the samples
before is a small state a vehicle: the last accepted sample and the confirmed
direction.  On a stream it lives in ``transformWithState`` and goes by an event-time
timer; in batch the sorted rows of a vehicle pass through the same moves.

Samples of a vehicle count in the order of ``arrival``.  One that is not later than the
last accepted is dropped (late or repeated); its direction is that of the state.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from math import exp
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from raillark.functions.expr import grid_cell
from raillark.operators.joins import SEGMENT, nearest, segment_grid, segment_level, segment_list
from raillark.streaming.realtime import EXPIRE_S, step

#: Fixed values of the rules: metres, metres a second, degrees, shares.
MOST_M, STEP_M, APART_M = 1000.0, 25.0, 20.0
MOST_SPEED, SCALE_M, MOST_TURN, LEAST_SCORE, LEAST_MARGIN = 45.0, 500.0, 35.0, 0.58, 0.20


class Rules(NamedTuple):
    """A longer gap between samples begins anew, a vehicle idle for longer is forgotten, a shape farther off decides nothing."""

    gap_s: int = 300
    expire_s: int = EXPIRE_S
    near_m: float = 100.0


RULES = Rules()

DECISION = "vehicle_id string, event_id long, direction_id string, destination string, confidence double, margin double, reason string, variant_id string"
PAIR = "vehicle_id string, event_id long, prev_event_id long, elapsed_s long"
_STATE = "route_id string, at double, matches string, family string, direction_id string, score double, confident_at double, seen_at double, pending string, pending_count int, variant_id string, destination string"
_NAMES = [x.split()[0] for x in _STATE.split(", ")]
_MOVES = ("family", "direction_id", "score", "confident_at", "seen_at", "pending", "pending_count")
_FRESH = {"family": None, "direction_id": None, "score": 0.0, "confident_at": None, "pending": None, "pending_count": 0, "variant_id": None, "destination": None}


def evidence(samples: DataFrame, candidates: DataFrame, segments: DataFrame, most_m: float = MOST_M, size: float = 0.01, routes: DataFrame | None = None) -> DataFrame:
    """``samples`` with ``identity``, ``matches`` and ``candidates``, a row a sample.

    ``samples``: vehicle_id, route_id, event_id, ts, latitude, longitude, trip_id, stop_id,
    stop_sequence, bearing.  ``candidates``: route_id, variant_id, direction_id,
    destination, terminal_stop_id, and arrays trip_ids, stop_ids, stop_sequences, shape_ids;
    ``segments`` and ``routes`` as in :func:`raillark.operators.joins.map_match`.  All are tables.
    A table of samples tells its routes, and only their candidates and shapes are worked out.
    """
    if routes is None:
        routes, segments = segments.select("route_id", "shape_id"), segments.drop("route_id").distinct()
    pairs = routes.select("route_id", "shape_id").distinct()
    if not samples.isStreaming:
        asked = samples.select("route_id").distinct()
        candidates, pairs = candidates.join(asked, "route_id", "left_semi"), pairs.join(asked, "route_id", "left_semi")
    segments = segments.select(*SEGMENT).join(pairs, "shape_id", "left_semi")
    own = F.struct("variant_id", "direction_id", "destination", F.coalesce(F.nullif("terminal_stop_id", F.lit("")), F.nullif("destination", F.lit("")), F.lit("unknown")).alias("family"))
    by_trip = candidates.select("route_id", "variant_id", F.explode(F.array_distinct("trip_ids")).alias("trip_id"), own.alias("c")).groupBy("route_id", "trip_id").agg(F.count("*").alias("_trips"), F.min("c").alias("_trip"))
    stops = candidates.select("route_id", F.explode(F.array_distinct("stop_ids")).alias("stop_id"), F.struct(own.alias("c"), "stop_sequences").alias("x"))
    by_stop = stops.groupBy("route_id", "stop_id").agg(F.collect_list("x").alias("_stops"))  # the variants of one route
    variants = candidates.groupBy("route_id").agg(F.sort_array(F.collect_list(F.struct("variant_id", "direction_id", "destination", "terminal_stop_id", "shape_ids"))).alias("candidates"))
    rows = samples.join(by_trip, ["route_id", "trip_id"], "left").join(by_stop, ["route_id", "stop_id"], "left").join(variants, "route_id", "left")

    cell = ["level", "_cx", "_cy"]
    lists = segment_grid(segments, size, most_m=most_m).groupBy("shape_id", *cell).agg(F.collect_list(segment_list()).alias("_i"))
    lists = lists.join(pairs, "shape_id").groupBy("route_id", *cell).agg(F.collect_list(F.struct("shape_id", "_i")).alias("_s"))
    levels = sorted(r[0] for r in segments.select(segment_level(size)).distinct().collect())  # some twenty at most
    found = []
    for k in levels:
        at = lists.where(F.col("level") == k).select("route_id", F.col("_cx").alias(f"_x{k}"), F.col("_cy").alias(f"_y{k}"), F.col("_s").alias(f"_s{k}"))
        rows = rows.withColumn(f"_x{k}", grid_cell("longitude", size * 2**k)).withColumn(f"_y{k}", grid_cell("latitude", size * 2**k)).join(at, ["route_id", f"_x{k}", f"_y{k}"], "left").drop(f"_x{k}", f"_y{k}")
        found.append(F.coalesce(f"_s{k}", F.array().cast(lists.schema["_s"].dataType)))
    near = F.concat(*found) if found else F.array().cast(lists.schema["_s"].dataType)

    place = F.transform(near, lambda x: F.struct(x["shape_id"].alias("shape_id"), nearest(F.col("latitude"), F.col("longitude"), x["_i"]).alias("q")))
    rows = rows.withColumn("_p", place)  # one item a shape and level
    shapes = F.array_distinct(F.transform("_p", lambda x: x["shape_id"]))
    best = F.transform(shapes, lambda s: F.struct(s.alias("shape_id"), F.array_min(F.transform(F.filter("_p", lambda x: x["shape_id"] == s), lambda x: x["q"]))["p"].alias("p")))
    flat = F.transform(F.filter(best, lambda x: x["p"]["distance_m"] <= most_m), lambda x: F.struct(x["shape_id"].alias("shape_id"), x["p"]["distance_m"].alias("distance_m"), x["p"]["progress_m"].alias("progress_m"), x["p"]["segment_bearing"].alias("segment_bearing")))
    here = F.filter("_stops", lambda x: F.col("stop_sequence").isNull() | (F.size(x["stop_sequences"]) == 0) | F.array_contains(x["stop_sequences"], F.col("stop_sequence")))
    identity = F.when(F.col("_trips") == 1, F.col("_trip")).when(F.col("_trips").isNull() & (F.size(here) == 1), F.get(here, F.lit(0))["c"])
    return rows.select(*samples.columns, identity.alias("identity"), flat.alias("matches"), "candidates")


def _turn(a: float, b: float) -> float:
    gap = abs(a - b) % 360
    return min(gap, 360 - gap)


def score_candidates(before: dict[str, tuple], after: dict[str, tuple], candidates: list, elapsed: float, bearing: float | None) -> list[dict[str, Any]]:
    """Score of each candidate with a usable shape; places are (distance, progress, segment bearing) by shape."""
    out = []
    for c in candidates:
        plus = minus = 0.0
        nearest = None
        for shape in c["shape_ids"]:
            if shape not in before or shape not in after:
                continue
            (d0, p0, _), (d1, p1, heading) = before[shape], after[shape]
            moved = p1 - p0
            if max(d0, d1) > MOST_M or abs(moved) < STEP_M or abs(moved) / elapsed > MOST_SPEED:
                continue
            weight = exp(-(d0 + d1) / 2 / SCALE_M)
            nearest = d1 if nearest is None else min(nearest, d1)
            plus += weight if moved > 0 else 0.0
            minus += (0.0 if moved > 0 else weight) + (weight if bearing is not None and heading is not None and _turn(bearing, heading) > MOST_TURN else 0.0)
        if nearest is not None and plus + minus > 0:
            out.append({"c": c, "score": max(0.0, (plus - minus) / (plus + minus)), "plus": plus, "distance": nearest})
    return out


def decide(scores: list[dict[str, Any]], near_m: float = RULES.near_m) -> dict[str, Any] | None:
    """The best destination of the candidates near enough, its margin and whether it is sure; None if none is near."""
    families: dict[tuple, list] = {}
    for s in scores:
        if s["distance"] <= near_m:
            families.setdefault((s["c"]["terminal_stop_id"] or None, s["c"]["destination"] or None), []).append(s)
    if not families:
        return None
    named = lambda key: key[0] or key[1] or "unknown"
    best_of = [(key, max(own, key=lambda s: (s["score"], s["plus"], -s["distance"])), min(s["distance"] for s in own), len(own)) for key, own in families.items()]
    ranked = sorted(best_of, key=lambda x: (-x[1]["score"], x[1]["distance"], named(x[0]), x[0][1] or ""))
    key, best, closest, variants = ranked[0]
    second = ranked[1][1] if len(ranked) > 1 else None
    margin = best["score"] - second["score"] if second else 1.0
    rival = second is not None and second["c"]["direction_id"] == best["c"]["direction_id"]
    dominated = best["distance"] - closest >= APART_M and min(x[2] for x in best_of) < closest
    sure = best["score"] >= LEAST_SCORE and margin >= LEAST_MARGIN and (not rival or second["distance"] - best["distance"] >= APART_M) and not dominated
    return {"family": named(key), "destination": key[1], "direction_id": best["c"]["direction_id"], "variant_id": best["c"]["variant_id"] if variants == 1 else None, "score": best["score"], "margin": margin, "sure": sure}


def observe(state: dict[str, Any] | None, row: Any, rules: Rules = RULES) -> tuple[dict[str, Any], tuple]:
    """One sample's move: the new state and the decision row.  ``matches`` of a state is a place by shape."""
    at = row["ts"].timestamp()
    if state is not None and (state["route_id"] != row["route_id"] or at - state["seen_at"] > rules.expire_s):
        state = None
    if state is None:
        state = {"route_id": row["route_id"], "at": None, "matches": None, "seen_at": at} | _FRESH
    now = max(at, state["seen_at"])
    state = state | {"seen_at": now}
    places = {m["shape_id"]: (m["distance_m"], m["progress_m"], m["segment_bearing"]) for m in row["matches"] or []}
    kept = {"at": at, "matches": places}
    decision = lambda direction, destination, confidence, margin, reason, variant: (row["vehicle_id"], row["event_id"], direction, destination, confidence, margin, reason, variant)
    held = lambda s, reason: decision(s["direction_id"], s["destination"], s["score"] if s["direction_id"] is not None else None, None, reason, s["variant_id"])

    if row["identity"] is not None:
        c = row["identity"]
        moved, *_ = step({k: state[k] for k in _MOVES}, now, c["family"], c["direction_id"], 1.0, 1.0, True, unique=True)
        state = state | kept | moved | {"variant_id": c["variant_id"], "destination": c["destination"]}
        return state, decision(c["direction_id"], c["destination"], 1.0, 1.0, "identity", c["variant_id"])
    if state["at"] is None:
        return state | kept, held(state, "first-sample")
    if at <= state["at"]:
        return state, held(state, "non-monotonic-sample")
    if at - state["at"] > rules.gap_s:
        state = state | kept | _FRESH
        return state, held(state, "sample-gap-reset")

    found = decide(score_candidates(state["matches"], places, row["candidates"] or [], at - state["at"], row["bearing"]), rules.near_m)
    found = found or {"family": None, "direction_id": None, "score": 0.0, "margin": 0.0, "sure": False, "destination": None, "variant_id": None}
    moved, direction, family, reason = step({k: state[k] for k in _MOVES}, now, found["family"], found["direction_id"], found["score"], found["margin"], found["sure"])
    state = state | kept | moved
    if family is not None:
        state = state | {"variant_id": found["variant_id"], "destination": found["destination"]}
        return state, decision(direction, found["destination"], found["score"], found["margin"], reason, found["variant_id"])
    if moved["family"] is None:
        state = state | {"variant_id": None, "destination": None}
    return state, decision(None, None, moved["score"] if moved["family"] is not None else None, None, reason, None)


def replay_direction(rows: DataFrame, arrival: str = "event_id", rules: Rules = RULES) -> DataFrame:
    """Batch replay: the evidence of each vehicle, in order of arrival, through the same moves.

    A vehicle's history is sorted and streamed; only the state and one batch of rows are held.
    """
    schema = DECISION

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, route, candidates = None, None, None, None
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            out = []
            listed = batch.column("candidates")
            for i, row in enumerate(batch.drop_columns(["candidates"]).to_pylist()):
                if row["vehicle_id"] != at:
                    at, state, route = row["vehicle_id"], None, None
                if row["route_id"] != route:  # the candidates are those of the route
                    route, candidates = row["route_id"], listed[i].as_py()
                row["candidates"] = candidates
                state, made = observe(state, row, rules)
                out.append(dict(zip(names, made, strict=True)))
            kinds = pa.schema([("vehicle_id", pa.string()), ("event_id", pa.int64()), ("direction_id", pa.string()), ("destination", pa.string()), ("confidence", pa.float64()), ("margin", pa.float64()), ("reason", pa.string()), ("variant_id", pa.string())])
            yield pa.RecordBatch.from_pylist(out, kinds)

    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    columns = ["vehicle_id", "route_id", "event_id", "ts", "bearing", "identity", "matches", "candidates"]
    return rows.repartition("vehicle_id").sortWithinPartitions("vehicle_id", arrival, "event_id").select(*columns).mapInArrow(run, schema)


class _Keyed(StatefulProcessor):
    """State of one vehicle under a timer: cleared when the watermark passes ``idle`` seconds after its last sample."""

    schema, names, output = _STATE, _NAMES, DECISION

    def __init__(self, arrival: str, rules: Rules = RULES):
        self.arrival, self.rules, self.idle = arrival, rules, max(rules.expire_s, rules.gap_s)
        self.columns = [x.split()[0] for x in self.output.split(", ")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("vehicle", self.schema)

    def read(self, state: dict) -> dict:
        return state | {"matches": None if state["matches"] is None else {k: tuple(x) for k, x in json.loads(state["matches"]).items()}}

    def written(self, state: dict) -> dict:
        return state | {"matches": None if state["matches"] is None else json.dumps(state["matches"])}

    def move(self, state: dict | None, row: Row) -> tuple[dict, tuple | None]:
        return observe(state, row, self.rules)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        now = self.held.get()
        state = None if now is None else self.read(dict(zip(self.names, now, strict=True)))
        for row in sorted(rows, key=lambda r: (r[self.arrival], r["event_id"])):
            state, made = self.move(state, row)
            if made is not None:
                yield Row(**dict(zip(self.columns, made, strict=True)))
        if state is not None:
            held = self.written(state)
            self.held.update(tuple(held[n] for n in self.names))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int((state["seen_at"] + self.idle) * 1000))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def _keyed(rows: DataFrame, processor: _Keyed, late: str) -> DataFrame:
    timed = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy("vehicle_id").transformWithState(processor, processor.output, "Append", "EventTime")


def infer_direction(rows: DataFrame, arrival: str = "event_id", late: str = "1 hour", rules: Rules = RULES) -> DataFrame:
    """Direction decisions of a stream of :func:`evidence` rows, one keyed state a vehicle."""
    return _keyed(rows, _Keyed(arrival, rules), late)


class _Pairs(_Keyed):
    """The last accepted sample; each later one on the same route within the gap makes a pair."""

    schema = "event_id long, at double, route_id string, seen_at double"
    names, output = ("event_id", "at", "route_id", "seen_at"), PAIR

    def read(self, state: dict) -> dict:
        return state

    written = read

    def move(self, state: dict | None, row: Row) -> tuple[dict, tuple | None]:
        at = row["ts"].timestamp()
        if state is not None and at <= state["at"]:
            return state, None
        new = {"event_id": row["event_id"], "at": at, "route_id": row["route_id"], "seen_at": at}
        apart = None if state is None else int(at - state["at"])
        if apart is None or not 0 < apart <= self.rules.gap_s or state["route_id"] != row["route_id"]:
            return new, None
        return new, (row["vehicle_id"], row["event_id"], state["event_id"], apart)


class _Accepted(_Pairs):
    """Samples later than all before them of their vehicle."""

    output = "vehicle_id string, event_id long"

    def move(self, state: dict | None, row: Row) -> tuple[dict, tuple | None]:
        new, _ = super().move(state, row)
        return new, None if new is state else (row["vehicle_id"], row["event_id"])


def pairs_stream(samples: DataFrame, arrival: str = "event_id", late: str = "1 hour", rules: Rules = RULES) -> DataFrame:
    """vehicle_id, event_id, prev_event_id, elapsed_s of accepted samples: as ``sample_pairs`` of ``in_order``."""
    return _keyed(samples, _Pairs(arrival, rules), late)


def in_order_stream(samples: DataFrame, arrival: str = "event_id", late: str = "1 hour", rules: Rules = RULES) -> DataFrame:
    """vehicle_id, event_id of samples later than all before them of their vehicle: as ``in_order`` of a table.

    A vehicle is forgotten when the watermark has passed its last sample by the rules' time.
    """
    return _keyed(samples, _Accepted(arrival, rules), late)
