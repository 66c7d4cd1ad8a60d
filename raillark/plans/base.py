"""How a query is registered: a DataFrame plan and the SQL text of its counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from raillark.operators import sets
from raillark.plans import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

FIRST, LAST = "20240101", "20240130"
#: The days that the departure jobs are built for.
WINDOW = ("20240114", "20240116")


class Source:
    """The derived views of one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return views.load(self.spark, self.sf_dir, f"t_{name}")

    def feed(self, *names: str) -> dict[str, DataFrame]:
        return {n: self(n) for n in names or ("stops", "routes", "trips", "stop_times", "calendar", "calendar_dates")}

    def days(self, first: str = FIRST, last: str = LAST) -> DataFrame:
        return sets.dates(self.spark, first, last)


#: Common table expressions that several counterparts share, with the views they need.
PARTS: dict[str, tuple[list[str], str]] = {
    "days": ([], "SELECT strftime(d,'%Y%m%d') AS service_date, isodow(d) AS wd FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS d)"),
    "weekly": (["t_calendar", "days"], "SELECT service_id, service_date FROM t_calendar, days WHERE service_date BETWEEN start_date AND end_date AND CASE wd WHEN 1 THEN monday WHEN 2 THEN tuesday WHEN 3 THEN wednesday WHEN 4 THEN thursday WHEN 5 THEN friday WHEN 6 THEN saturday ELSE sunday END = 1"),
    "active": (["weekly", "t_calendar_dates", "days"], "SELECT w.service_id, w.service_date FROM weekly w WHERE NOT EXISTS (SELECT 1 FROM t_calendar_dates c WHERE c.service_id=w.service_id AND c.service_date=w.service_date AND c.exception_type=2) UNION SELECT service_id, service_date FROM t_calendar_dates JOIN days USING (service_date) WHERE exception_type=1"),
    "active_first": (["weekly", "t_calendar_dates", "days"], "SELECT w.service_id, w.service_date FROM weekly w WHERE NOT EXISTS (SELECT 1 FROM t_calendar_dates c WHERE c.service_id=w.service_id AND c.service_date=w.service_date) UNION SELECT service_id, service_date FROM t_calendar_dates JOIN days USING (service_date) WHERE exception_type=1"),
    "three": ([], "SELECT strftime(d,'%Y%m%d') AS service_date FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-14', TIMESTAMP '2024-01-16', INTERVAL 1 DAY)) AS d)"),
    "canon": (["t_stops"], "SELECT s.*, coalesce(p.stop_id, s.stop_id) AS canonical_stop_id FROM t_stops s LEFT JOIN (SELECT DISTINCT stop_id FROM t_stops) p ON s.parent_station=p.stop_id"),
    "term_a": (["t_stop_times"], "SELECT trip_id, stop_id AS terminal_stop_id FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY stop_sequence DESC, source_order DESC) AS r FROM t_stop_times) WHERE r=1"),
    "term_c": (["t_stop_times"], "SELECT trip_id, stop_id AS terminal_stop_id FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY source_order DESC) AS r FROM t_stop_times) WHERE r=1"),
    "term_b": (["t_stop_times"], "SELECT a.trip_id, a.stop_id AS terminal_stop_id FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY stop_sequence DESC, source_order DESC) AS r FROM t_stop_times) a JOIN (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY source_order DESC) AS r FROM t_stop_times) b ON a.trip_id=b.trip_id AND a.source_order=b.source_order WHERE a.r=1 AND b.r=1"),
    "calls": (["t_stop_times", "t_trips", "active", "canon", "t_routes", "term_a", "t_stops"], "SELECT c.canonical_stop_id, v.service_date, x.departure_seconds, x.departure_time, x.trip_id, x.stop_id, x.stop_sequence, x.source_order, t.route_id, t.direction_id, c.platform_code, e.terminal_stop_id, coalesce(nullif(trim(r.short_name),''), nullif(trim(r.long_name),''), t.route_id) AS label, coalesce(nullif(trim(t.headsign),''), nullif(trim(n.stop_name),''), '?') AS destination FROM t_stop_times x JOIN t_trips t USING (trip_id) JOIN active v USING (service_id) JOIN canon c USING (stop_id) LEFT JOIN t_routes r ON r.route_id=t.route_id LEFT JOIN term_a e ON e.trip_id=x.trip_id LEFT JOIN t_stops n ON n.stop_id=e.terminal_stop_id"),
    "radius": (["t_stops", "t_cities"], "SELECT c.city_id, s.*, 2*6371000.0*asin(least(1.0, sqrt(pow(sin((radians(s.stop_lat)-radians(c.latitude))/2),2)+cos(radians(c.latitude))*cos(radians(s.stop_lat))*pow(sin((radians(s.stop_lon)-radians(c.longitude))/2),2)))) AS distance_m FROM t_stops s, t_cities c WHERE distance_m <= c.radius_m"),
    "public_set": (["t_stops"], "SELECT stop_id FROM t_stops WHERE location_type='1'"),
    "resolved": (["t_stops", "public_set"], "SELECT s.stop_id, CASE WHEN a.stop_id IS NOT NULL THEN s.stop_id WHEN b.stop_id IS NOT NULL THEN s.parent_station WHEN c.stop_id IS NOT NULL THEN p.parent_station END AS public_id FROM t_stops s LEFT JOIN public_set a ON a.stop_id=s.stop_id LEFT JOIN public_set b ON b.stop_id=s.parent_station LEFT JOIN t_stops p ON p.stop_id=s.parent_station LEFT JOIN public_set c ON c.stop_id=p.parent_station"),
    "usable": (["t_rt_updates"], "SELECT *, trip_relationship=3 AS cancelled FROM t_rt_updates WHERE trip_relationship IN (0,3) AND stop_relationship=0"),
    "progress": (["t_shapes"], "SELECT shape_id, shape_pt_sequence, shape_pt_lat, shape_pt_lon, sum(coalesce(step,0)) OVER (PARTITION BY shape_id ORDER BY shape_pt_sequence) AS progress_m FROM (SELECT *, sqrt(pow(radians(shape_pt_lon-lag(shape_pt_lon) OVER w)*cos(radians((shape_pt_lat+lag(shape_pt_lat) OVER w)/2)),2)+pow(radians(shape_pt_lat-lag(shape_pt_lat) OVER w),2))*6371000.0 AS step, count(*) OVER (PARTITION BY shape_id) AS np FROM t_shapes WINDOW w AS (PARTITION BY shape_id ORDER BY shape_pt_sequence)) WHERE np>1"),
    "segments": (["progress"], "SELECT * FROM (SELECT shape_id, shape_pt_sequence AS seq, shape_pt_lat AS lat1, shape_pt_lon AS lon1, progress_m AS progress1, lead(shape_pt_lat) OVER w AS lat2, lead(shape_pt_lon) OVER w AS lon2, lead(progress_m) OVER w AS progress2 FROM progress WINDOW w AS (PARTITION BY shape_id ORDER BY shape_pt_sequence)) WHERE lat2 IS NOT NULL"),
    "boundary_hit": (["t_stops", "t_boundaries"], "SELECT stop_id, code FROM (SELECT s.stop_id, b.code, row_number() OVER (PARTITION BY s.stop_id ORDER BY (b.max_lon-b.min_lon)*(b.max_lat-b.min_lat), b.code) AS r FROM t_stops s, t_boundaries b WHERE s.stop_lon BETWEEN b.min_lon AND b.max_lon AND s.stop_lat BETWEEN b.min_lat AND b.max_lat) WHERE r=1"),
}


def with_parts(*names: str) -> str:
    """The WITH clause of views and shared parts, each after what it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for need in PARTS[name][0] if name in PARTS else []:
            add(need)
        order.append(name)

    for n in names:
        add(n)
    text = lambda n: PARTS[n][1] if n in PARTS else views.VIEWS[n].strip()
    return "WITH " + ", ".join(f"{n} AS ({text(n)})" for n in order) + " "


def query(needs: str = "", sql: str | None = None, name: str | None = None):
    """Registers a function of a ``Source`` as a query; ``sql`` runs on the views in ``needs``."""

    def register(build: Callable[[Source], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, sf_dir: build(Source(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[key] = (with_parts(*needs.split()) if needs else "") + sql
        return build

    return register
