"""Stores, snapshots, shards, digests and station groups on small fixtures."""

import glob
import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from raillark.operators import joins
from raillark.plans import checks, jobs
from raillark.sources import feeds, sinks, store
from raillark.streaming import realtime


def files(folder):
    return {f: (os.stat(f).st_mtime_ns, os.stat(f).st_size) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def feed(spark, provider, ids, name):
    stops = spark.createDataFrame([(i, f"{name} {i}", provider) for i in ids], "stop_id string, stop_name string, provider_id string")
    cities = spark.createDataFrame([("c" + i[-1], i, provider) for i in ids], "city_id string, stop_id string, provider_id string")
    return {"stops": stops}, cities


def test_replacing_a_provider_twice(spark, tmp_path):
    folder = f"file://{tmp_path}/store"
    for provider, ids in (("pa", ["s1", "s2"]), ("pb", ["s2", "s3", "s4"])):
        store.replace_provider(spark, folder, *feed(spark, provider, ids, "old"), provider)
    others = files(f"{tmp_path}/store/stops/provider_id=pa")
    seen = []
    for _ in range(2):
        affected = store.replace_provider(spark, folder, *feed(spark, "pb", ["s4", "s5"], "new"), "pb")
        seen.append(sorted(map(tuple, affected.collect()), key=repr))
        rows = {(r.stop_id, r.stop_name, r.provider_id) for r in store.read_entities(spark, folder, "stops").collect()}
        assert rows == {("s1", "old s1", "pa"), ("s2", "old s2", "pa"), ("s4", "new s4", "pb"), ("s5", "new s5", "pb")}
    assert files(f"{tmp_path}/store/stops/provider_id=pa") == others and others
    # cities before and after: c3 lost its stop, c2 keeps that of the other provider
    assert seen[0] == sorted([("c2", "s2"), ("c3", None), ("c4", "s4"), ("c5", "s5")], key=repr) and seen[1] == [("c4", "s4"), ("c5", "s5")]
    gone = store.replace_provider(spark, folder, *feed(spark, "pb", [], "new"), "pb")
    assert {r.stop_id for r in store.read_table(spark, folder, "stops").collect()} == {"s1", "s2"}
    assert {(r.city_id, r.stop_id) for r in gone.collect()} == {("c4", None), ("c5", None)}


def test_snapshot_survives_a_replay(spark, tmp_path):
    folder = f"file://{tmp_path}/snapshot"
    rows = lambda x: spark.createDataFrame(x, "vehicle_id string, event_id long, s long").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    write = realtime.snapshot_writer(folder, ["vehicle_id"], 600)
    batches = [rows([("a", 1, 0), ("b", 2, 100), ("b", 3, 90)]), rows([("a", 4, 500), ("c", 5, 500)]), rows([("d", 6, 1100)])]
    shown = lambda: {(r.vehicle_id, r.event_id, r.stale) for r in realtime.read_snapshot(spark, folder, 300).collect()}
    write(batches[0], 0)
    assert shown() == {("a", 1, False), ("b", 2, False)}
    write(batches[1], 1)
    once = shown()
    write(batches[1], 1)  # the batch runs again
    assert shown() == once == {("a", 4, False), ("b", 2, True), ("c", 5, False)}
    write(batches[2], 2)
    assert shown() == {("a", 4, True), ("c", 5, True), ("d", 6, False)}
    assert len(glob.glob(f"{tmp_path}/snapshot/version=*")) == 2


def test_snapshot_stream_restarts(spark, tmp_path):
    schema = "vehicle_id string, event_id long, ts timestamp"
    source, folder = f"{tmp_path}/in", f"file://{tmp_path}/snapshot"
    rows = [("v" + str(k % 3), k, k * 40) for k in range(12)]
    df = spark.createDataFrame(rows, "vehicle_id string, event_id long, s long").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    for part in range(2):
        df.where((F.col("event_id") >= part * 6) & (F.col("event_id") < part * 6 + 6)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        q = stream.writeStream.foreachBatch(realtime.snapshot_writer(folder, ["vehicle_id"], 200)).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        time.sleep(1.1)
    want = realtime.latest_view(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), ["vehicle_id"], str(df.agg(F.max("ts")).collect()[0][0]), 60, 200)
    got = realtime.read_snapshot(spark, folder, 60)
    assert {(r.vehicle_id, r.event_id, r.stale) for r in got.collect()} == {(r.vehicle_id, r.event_id, r.stale) for r in want.collect()}


def test_shards_read_back_by_their_manifest(spark, tmp_path):
    rows = [(f"s{k % 400}", k) for k in range(2000)] + [("hot", k) for k in range(3000)]
    folder = f"{tmp_path}/out"
    df = spark.createDataFrame(rows, "stop_id string, n long").repartition(7)
    manifest = sinks.write_stop_shards(df, folder, per_part=1000).collect()
    assert sum(r.n_rows for r in manifest) == 5000 and len({r.stop_id for r in manifest}) == 401
    assert sum(r.stop_id == "hot" for r in manifest) == 3
    assert len(files(folder + "/shards")) <= 256 + 2 * 1 + 2  # a bucket has one file, but for parts of the hot stop
    for r in [r for r in manifest if r.stop_id in ("hot", "s1", "s399")]:
        inner = spark.read.parquet(f"{folder}/shards/bucket={r.bucket}/part={r.part}").toPandas()
        assert set(inner.stop_id[r.offset : r.offset + r.n_rows]) == {r.stop_id} and (inner.stop_id == r.stop_id).sum() == r.n_rows
    for stop in ("hot", "s7", "none"):
        got = sorted(r.n for r in sinks.read_stop_shard(spark, folder, stop).collect())
        assert got == sorted(n for s, n in rows if s == stop)


@pytest.mark.parametrize("one_row", [feeds.ONE_ROW, 10, 0])
def test_digest_of_files_of_any_size(spark, tmp_path, one_row):
    os.makedirs(f"{tmp_path}/a/b c")
    texts = {"a/one.bin": b"x" * 9, "a/b c/two%20.bin": b"y" * 20_000_000, "three": b"3", "five é": b"12345678901"}
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    each, folder = feeds.artifact_digest(spark, str(tmp_path), one_row)
    got = {r.source_id: (r.sha256, r.size) for r in each.collect()}
    assert got == {k: (hashlib.sha256(v).hexdigest(), len(v)) for k, v in texts.items()}
    lines = sorted(f"{len(k.encode())}:{k}:{len(v)}:{hashlib.sha256(v).hexdigest()}" for k, v in texts.items())
    assert folder.collect()[0].sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    bound = {r.source_id: r.record_sha256 for r in feeds.provenance(each, {"origin": "o", "status": "used"}).collect()}
    record = f'{{"origin":"o","sha256":"{got["three"][0]}","size":1,"source_id":"three","status":"used"}}'
    assert bound["three"] == hashlib.sha256(record.encode()).hexdigest() and len(set(bound.values())) == 4


def test_station_of_ten_thousand_outputs(spark):
    """Ten thousand children without platform code: a hundred million pairs, none of which is made."""
    stops = spark.range(0, 10_000).selectExpr("concat('k', id) as stop_id", "'big' as parent_station", "'' as platform_code", "50.0d as stop_lat", "8.0d as stop_lon", "'n' as stop_name")
    stops = stops.union(spark.sql("select 'big', '', '', 50.0d, 8.0d, 'n' union all select 'p1', 'big', '7', 50.0d, 8.0d, 'n' union all select 'alone', 'other', '', 50.0d, 8.0d, 'n'"))
    members, outputs = joins.station_groups(stops, stops)
    assert members.count() == 10_000 + 2 + 2 and outputs.count() == 10_003
    few = stops.where("stop_id in ('k1', 'k2', 'p1', 'big', 'alone')")
    want = {("k1", "k1"), ("k1", "k2"), ("k2", "k1"), ("k2", "k2"), ("p1", "k1"), ("p1", "k2"), ("p1", "p1"), ("big", "big"), ("alone", "alone")}
    assert {tuple(r) for r in joins.station_targets(few, few).collect()} == want
    cities = spark.createDataFrame([("c", 50.0, 8.0, 500.0)], "city_id string, latitude double, longitude double, radius_m double")
    times = spark.range(0, 300).selectExpr("'t' as trip_id", "concat('k', id) as stop_id", "id as stop_sequence", "'08:00:00' as departure_time", "id as source_order", "0 as departure_seconds")
    tables = {
        "stops": stops.withColumn("source_order", F.lit(0)), "stop_times": times, "trips": spark.sql("select 't' as trip_id, 'r' as route_id, 'w' as service_id, 'H' as headsign"),
        "routes": spark.sql("select 'r' as route_id, '1' as short_name, '' as long_name, '3' as route_type"), "calendar_dates": spark.sql("select 'w' as service_id, '20240115' as service_date, 1 as exception_type"),
        "calendar": spark.sql("select '' as service_id, '20240101' as start_date, '20240101' as end_date, 0 as monday, 0 as tuesday, 0 as wednesday, 0 as thursday, 0 as friday, 0 as saturday, 0 as sunday"),
    }
    from raillark.operators import sets

    rows, shown = jobs.station_calls(tables, cities, sets.dates(spark, "20240114", "20240116"))
    assert rows.count() == 300 and shown.where("group_id = 'parent:big'").count() == 10_001 - 1 + 0


def test_aliases_paths_and_ids(spark):
    cities = spark.createDataFrame([("a",), ("b",)], "city_id string")
    aliases = spark.createDataFrame([("a", "b"), ("b", "b"), ("x", "a"), ("y", "z")], "alias_city_id string, canonical_city_id string")
    assert {tuple(r) for r in checks.check_aliases(aliases, cities).collect()} == {("a", "alias_shadows"), ("y", "alias_target")}
    registry = spark.createDataFrame([("f", "required", True, ""), ("g", "optional", True, "x"), ("h", "optional", False, None)], "source_id string, class string, importable boolean, path string")
    assert {tuple(r) for r in checks.check_sources(registry, registry.where("source_id <> 'f'"), []).collect()} == {("f", "missing"), ("f", "no_path")}
    rows = spark.createDataFrame([("1",), ("1",), ("2",), ("3",)], "id string")
    expected = spark.createDataFrame([("1",), ("2",), ("4",)], "id string")
    assert {tuple(r) for r in checks.check_ids(rows, expected, "id").collect()} == {("1", "repeated"), ("3", "unexpected"), ("4", "missing")}
