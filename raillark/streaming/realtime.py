"""Realtime views and keyed state: batch forms, and the same rules on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rules of the direction state: seconds, scores and counts.
RETAIN_S, EXPIRE_S = 180, 600
STRONG_SCORE, STRONG_MARGIN, SWITCH_SAMPLES = 0.78, 0.25, 2


def latest_view(df: DataFrame, keys: list[str], now: str, ttl_s: int, max_stale_s: int, ts: str = "ts") -> DataFrame:
    """Latest row of each key until it is ``max_stale_s`` old, marked stale past ``ttl_s``."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), ts).alias("x")).select(*keys, "x.*")
    age = F.timestamp_diff("SECOND", F.col(ts), F.lit(now).cast("timestamp_ntz"))
    return best.withColumn("stale", age > ttl_s).where(age <= max_stale_s)


def latest_stream(df: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """The latest row of each key of a stream, for update mode."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), ts).alias("x")).select(*keys, "x.*")


def snapshot_writer(folder: str, keys: list[str], max_stale_s: int, ts: str = "ts"):
    """A ``foreachBatch`` function that keeps ``folder`` the latest view of a stream: see :func:`read_snapshot`.

    Batch n reads version n - 1 and writes version n, so a batch that runs again after a
    failure gives the same table; older versions go.  "Now" is the latest time seen so far;
    rows older than ``max_stale_s`` leave the table, which so holds no more than the keys of that time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        have = _versions(spark, folder)
        earlier = [v for v in have if v < batch_id]
        rows = batch.select(*batch.columns)
        if earlier:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{folder}/version={max(earlier)}"))
        others = [c for c in batch.columns if c not in keys]
        best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(ts, *others)).alias("x")).select(*keys, "x.*")
        now = F.lit(rows.agg(F.max(ts)).collect()[0][0]).cast(batch.schema[ts].dataType)
        best.where(F.timestamp_diff("SECOND", F.col(ts), now) <= max_stale_s).select(*batch.columns).write.mode("overwrite").parquet(f"{folder}/version={batch_id}")
        for v in sorted(earlier)[:-1]:
            _remove(spark, f"{folder}/version={v}")

    return write


def read_snapshot(spark: SparkSession, folder: str, ttl_s: int, ts: str = "ts") -> DataFrame:
    """The table that a snapshot writer keeps, with ``stale`` past ``ttl_s`` of its latest time."""
    rows = spark.read.parquet(f"{folder}/version={max(_versions(spark, folder))}")
    now = F.lit(rows.agg(F.max(ts)).collect()[0][0]).cast(rows.schema[ts].dataType)
    return rows.withColumn("stale", F.timestamp_diff("SECOND", F.col(ts), now) > ttl_s)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Versions that were written whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.listStatus(path) if store.exists(path) else []
    done = lambda f: store.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))
    return [int(f.getPath().getName().split("=")[1]) for f in found if f.getPath().getName().startswith("version=") and done(f)]


def _remove(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_order(df: DataFrame, arrival: str, ts: str = "ts", key: str = "vehicle_id") -> DataFrame:
    """Rows in arrival order that are later than all before them of their vehicle (batch form)."""
    before = F.max(ts).over(Window.partitionBy(key).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_b", before).where("_b is null or " + ts + " > _b").drop("_b")


def vehicle_runs(stream: DataFrame, gap: str = "300 seconds", late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Runs of a vehicle on a stream, closed by the watermark."""
    return stream.withWatermark(ts, late).groupBy("vehicle_id", F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n_samples")).select("vehicle_id", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n_samples")


def events_once(stream: DataFrame, key: str = "notification_uuid", ts: str | None = None, late: str = "1 day") -> DataFrame:
    """Each event once; with an event time, replays within the watermark are dropped in bounded state."""
    return stream.dropDuplicates([key]) if ts is None else stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def monitored_vehicles(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each vehicle over several monitored stops, and how many were dropped."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("x"), (F.count("*") - 1).alias("dropped")).select(key, "x.*", "dropped")


def step(state: dict | None, at: float, family: str | None, direction: str | None, score: float, margin: float, confident: bool, unique: bool = False) -> tuple[dict, str | None, str | None, str]:
    """One sample's move: new state, published direction and family, reason.

    ``unique``: the sample's own trip or stop names one candidate, which decides.
    """
    if state is None or at - state["seen_at"] > EXPIRE_S:
        state = {"family": None, "direction_id": None, "score": 0.0, "confident_at": None, "seen_at": at, "pending": None, "pending_count": 0}
    state = state | {"seen_at": at}

    def confirm(why: str) -> tuple[dict, str | None, str | None, str]:
        new = state | {"family": family, "direction_id": direction, "score": score, "confident_at": at, "pending": None, "pending_count": 0}
        return new, direction, family, why

    def retain(why: str) -> tuple[dict, None, None, str]:
        new = state | {"pending": None, "pending_count": 0}
        if new["confident_at"] is not None and at - new["confident_at"] <= RETAIN_S:
            return new, None, None, "retained"
        return new | {"family": None, "direction_id": None, "score": 0.0, "confident_at": None}, None, None, why

    if unique:
        return confirm("identity")
    if family is None or not confident:
        return retain("low-confidence")
    if state["family"] is None:
        return confirm("confident")
    if state["family"] == family:
        return confirm("stable")
    if score >= STRONG_SCORE and margin >= STRONG_MARGIN:
        count = state["pending_count"] + 1 if state["pending"] == family else 1
        if count >= SWITCH_SAMPLES:
            return confirm("switched")
        return state | {"pending": family, "pending_count": count}, None, None, "pending-switch"
    return retain("opposite-evidence")
