"""Direction of travel from raw samples: identity, resets, moves, and streams against their batch forms."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from raillark.operators import windows
from raillark.streaming import realtime, vehicles

SAMPLE = "vehicle_id string, event_id long, second long, route_id string, latitude double, longitude double, trip_id string, stop_id string, stop_sequence int, bearing double"
CANDIDATE = "route_id string, variant_id string, direction_id string, destination string, terminal_stop_id string, trip_ids array<string>, stop_ids array<string>, stop_sequences array<int>, shape_ids array<string>"
SEGMENT = "route_id string, shape_id string, seq long, lat1 double, lon1 double, lat2 double, lon2 double, progress1 double, length_m double"
CANDIDATES = [
    ("r", "east", "0", "East", "sE", ["t1", "both"], ["s1", "s2"], [1, 2], ["E"]),
    ("r", "west", "1", "West", "sW", ["t2", "both"], ["s2", "s3"], [3], ["W"]),
    ("q", "only", "0", "Only", None, ["t9"], ["s1"], [], ["E"]),
]


def samples(spark, rows):
    return spark.createDataFrame(rows, SAMPLE).withColumn("ts", F.timestamp_seconds(F.col("second") + 1_704_067_200)).drop("second")


def topology(spark):
    """A street of 3 km along 50 degrees north, there and back."""
    step = 0.001
    length = math.radians(step) * math.cos(math.radians(50)) * 6_371_000
    east = [("r", "E", k, 50.0, 30 + k * step, 50.0, 30 + (k + 1) * step, k * length, length) for k in range(40)]
    west = [("r", "W", k, 50.0, 30.04 - k * step, 50.0, 30.04 - (k + 1) * step, k * length, length) for k in range(40)]
    return spark.createDataFrame(CANDIDATES, CANDIDATE), spark.createDataFrame(east + west + [("q", *e[1:]) for e in east], SEGMENT)


def shown(spark, rows):
    out = vehicles.replay_direction(vehicles.evidence(samples(spark, rows), *topology(spark)))
    return [(r.direction_id, r.reason) for r in sorted(out.collect(), key=lambda r: (r.vehicle_id, r.event_id))]


def at(event, second, lon, route="r", trip=None, stop=None, sequence=None, bearing=None, vehicle="v"):
    return (vehicle, event, second, route, 50.0001, lon, trip, stop, sequence, bearing)


def test_geometry_confirms_keeps_and_switches(spark):
    there = [at(k, 30 * k, 30.002 + 0.002 * k) for k in range(4)]
    back = [at(4 + k, 120 + 30 * k, 30.006 - 0.002 * k) for k in range(3)]
    still = [at(7, 220, 30.002), at(8, 600, 30.004)]
    assert shown(spark, there + back + still) == [
        (None, "first-sample"), ("0", "confident"), ("0", "stable"), ("0", "stable"),
        (None, "pending-switch"), ("1", "switched"), ("1", "stable"), (None, "retained"), (None, "sample-gap-reset"),
    ]


def test_identity_decides(spark):
    rows = [at(1, 0, 30.002, trip="t2"), at(2, 30, 30.004, trip="both"), at(3, 60, 30.006, trip="t1"), at(4, 90, 30.006, stop="s1"), at(5, 120, 30.006, stop="s2"), at(6, 150, 30.006, stop="s2", sequence=3), at(7, 180, 30.006, stop="s3", sequence=1)]
    # a trip of two candidates decides nothing, nor does its stop; a stop of both needs its sequence
    assert shown(spark, rows) == [("1", "identity"), (None, "pending-switch"), ("0", "identity"), ("0", "identity"), (None, "retained"), ("1", "identity"), (None, "retained")]


def test_route_change_gap_and_late_samples(spark):
    rows = [at(1, 0, 30.002), at(2, 30, 30.004), at(3, 20, 30.001), at(4, 30, 30.009), at(5, 60, 30.006, route="q"), at(6, 90, 30.008, route="q"), at(7, 500, 30.004), at(8, 530, 30.002), at(9, 900, 30.001), at(10, 1600, 30.001)]
    assert shown(spark, rows) == [
        (None, "first-sample"), ("0", "confident"), ("0", "non-monotonic-sample"), ("0", "non-monotonic-sample"), (None, "first-sample"), ("0", "confident"),
        (None, "first-sample"), ("1", "confident"), (None, "sample-gap-reset"), (None, "first-sample"),
    ]


def test_evidence_of_the_other_way_after_a_gap(spark):
    """Sure evidence after a gap is taken up at once; the state from before it is gone."""
    rows = [at(1, 0, 30.002), at(2, 30, 30.004), at(3, 400, 30.030), at(4, 430, 30.028), at(5, 460, 30.028)]
    assert shown(spark, rows) == [(None, "first-sample"), ("0", "confident"), (None, "sample-gap-reset"), ("1", "confident"), (None, "retained")]


def test_weak_evidence_after_retention_forgets(spark):
    rows = [at(1, 0, 30.002), at(2, 30, 30.004), at(3, 150, 30.004), at(4, 270, 30.004), at(5, 300, 30.002)]
    assert shown(spark, rows) == [(None, "first-sample"), ("0", "confident"), (None, "retained"), (None, "low-confidence"), ("1", "confident")]


def test_bearing_and_distance(spark):
    turned = [at(1, 0, 30.002), at(2, 30, 30.004, bearing=270.0)]
    assert shown(spark, turned)[1] == ("1", "confident") or shown(spark, turned)[1][0] is None
    far = [("v", 1, 0, "r", 50.003, 30.002, None, None, None, None), ("v", 2, 30, "r", 50.003, 30.004, None, None, None, None)]
    assert shown(spark, far) == [(None, "first-sample"), (None, "low-confidence")]  # over 300 m from the street


def wandering(seed, n=160):
    rng = random.Random(seed)
    rows, place = [], {}
    for k in range(n):
        v = f"v{rng.randrange(6)}"
        second, lon, way = place.get(v, (rng.randrange(50), 30.02, rng.choice([-1, 1])))
        way = -way if rng.random() < 0.15 else way
        second += rng.choice([-10, 0, 15, 30, 60, 60, 200, 400])
        lon = min(30.039, max(30.001, lon + way * rng.uniform(0, 0.003)))
        place[v] = (second, lon, way)
        rows.append(at(k, second, lon, route="r" if rng.random() < 0.95 else "q", trip=rng.choice([None] * 12 + ["t1", "t2", "both"]), bearing=rng.choice([None, 90.0, 270.0]), vehicle=v))
    return rows


def stream(spark, df, plan, name, schema, parts=4):
    """The rows that a stream over ``parts`` files, in order of arrival, gives by ``plan``."""
    folder = spark.conf.get("spark.local.dir") + f"/{name}-{time.time_ns()}"
    rows = df.orderBy("event_id").collect()
    size = -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(rows[k * size : (k + 1) * size], df.schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # files are taken by their time
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    conf = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    q = plan(source).writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    try:
        assert q.awaitTermination(240)
    finally:
        q.stop()
        spark.conf.set("spark.sql.shuffle.partitions", conf)
    return sorted(map(tuple, spark.sql(f"select * from {name}").collect()), key=repr)


def test_direction_stream_equals_replay(spark):
    rows = samples(spark, wandering(3))
    parts = topology(spark)
    want = sorted(map(tuple, vehicles.replay_direction(vehicles.evidence(rows, *parts)).collect()), key=repr)
    got = stream(spark, rows, lambda s: vehicles.infer_direction(vehicles.evidence(s, *parts)), "directions", SAMPLE)
    assert got == want and len({r[6] for r in want}) >= 7


def test_pair_and_order_streams_equal_batch(spark):
    rows = samples(spark, wandering(5))
    kept = realtime.in_order(rows, "event_id")
    pairs = windows.sample_pairs(kept).select("vehicle_id", "event_id", "prev_event_id", "elapsed_s")
    assert stream(spark, rows, vehicles.pairs_stream, "pairs", SAMPLE) == sorted(map(tuple, pairs.collect()), key=repr)
    assert stream(spark, rows, vehicles.in_order_stream, "accepted", SAMPLE) == sorted(map(tuple, kept.select("vehicle_id", "event_id").collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_scores_equal_the_table_form(spark, seed):
    """The small scorer of the state gives what the windows over tables give."""
    rng = random.Random(seed)
    names = [f"sh{k}" for k in range(6)]
    facts = {n: (rng.choice(["sA", "sB", ""]), rng.choice(["x", "y", ""]), rng.choice("01")) for n in names}
    rows, wanted = [], {}
    for pair in range(80):
        before, after = ({n: (rng.choice([5.0, 60.0, 300.0, 1200.0]), rng.uniform(0, 600), rng.uniform(0, 360)) for n in names if rng.random() < 0.8} for _ in range(2))
        bearing = rng.choice([None, 10.0, 200.0])
        cands = [{"variant_id": n, "direction_id": facts[n][2], "destination": facts[n][1], "terminal_stop_id": facts[n][0], "shape_ids": [n]} for n in names]
        scores = vehicles.score_candidates(before, after, cands, 30.0, bearing)
        found = vehicles.decide(scores)
        for s in scores:
            wanted[pair, s["c"]["variant_id"]] = (round(s["score"], 9), round(s["distance"], 6))
        if found is not None:
            wanted[pair] = (found["family"], found["direction_id"], round(found["score"], 9), round(found["margin"], 9), found["sure"])
        rows += [(pair, n, 30, bearing, before[n][0], after[n][0], before[n][1], after[n][1], after[n][2]) for n in names if n in before and n in after]
    schema = "pair_id long, candidate string, elapsed_s long, bearing double, distance_before double, distance_after double, progress_before double, progress_after double, bearing_after double"
    scored = windows.candidate_scores(spark.createDataFrame(rows, schema))
    got = {(r.pair_id, r.candidate): (round(r.score, 9), round(r.best_distance_m, 6)) for r in scored.collect()}
    known = spark.createDataFrame([(n, *facts[n]) for n in names], "candidate string, terminal_stop_id string, destination string, direction_id string")
    for r in windows.family_decision(scored.join(known, "candidate")).collect():
        got[r.pair_id] = (r.family, r.direction_id, round(r.score, 9), round(r.margin, 9), r.confident)
    assert got == wanted


def test_state_in_memory_holds_places_not_text(spark):
    rows = [("v", k, k * 20, "r", 50.0, 30.002 + k * 0.001, None, None, None, 90.0) for k in range(6)]
    found = vehicles.evidence(samples(spark, rows), *topology(spark)).orderBy("event_id").collect()
    state, made = None, []
    for row in found:
        state, out = vehicles.observe(state, row)
        made.append(out)
    assert set(state["matches"]) == {"E", "W"} and all(len(x) == 3 for x in state["matches"].values())
    keyed = vehicles._Keyed("event_id")
    assert keyed.read(keyed.written(state)) == state
    assert shown(spark, rows) == [(x[2], x[6]) for x in made]
