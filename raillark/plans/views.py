"""Timetable views derived from the test tables; one text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    "t_stops": """
SELECT 'p'||CAST(p_partkey AS STRING) AS stop_id,
       CASE WHEN p_partkey % 60 = 7 THEN 'Äußere Straße 7' WHEN p_partkey % 60 = 8 THEN 'Évry Øst 8' WHEN p_partkey % 60 = 9 THEN 'Вокзальна 9' ELSE 'Stop '||CAST(p_partkey % 60 AS STRING) END AS stop_name,
       CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN 'gone' ELSE 's'||CAST(CAST(floor(p_partkey / 20) AS BIGINT) + 1 AS STRING) END AS parent_station,
       CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(p_size AS STRING) END AS platform_code,
       CASE WHEN p_partkey % 23 = 0 THEN '2' ELSE '0' END AS location_type,
       CAST(48.0 AS DOUBLE) + (p_partkey % 97) * CAST(0.01 AS DOUBLE) AS stop_lat,
       CAST(8.0 AS DOUBLE) + (p_partkey % 89) * CAST(0.01 AS DOUBLE) AS stop_lon,
       p_partkey AS source_order
  FROM part
  UNION ALL SELECT 's'||CAST(s_suppkey AS STRING), s_name, CASE WHEN s_suppkey % 5 = 4 THEN 's'||CAST(s_suppkey - 1 AS STRING) ELSE '' END, '', '1', CAST(48.0 AS DOUBLE) + (s_suppkey % 97) * CAST(0.01 AS DOUBLE), CAST(8.0 AS DOUBLE) + (s_suppkey % 89) * CAST(0.01 AS DOUBLE), 100000000 + s_suppkey
  FROM supplier
""",
    "t_routes": """
SELECT 'r'||CAST(c_custkey AS STRING) AS route_id,
       CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'L'||CAST(c_custkey % 40 AS STRING) END AS short_name,
       CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'Évry–Čerčany Ñ '||CAST(c_custkey AS STRING) WHEN c_custkey % 13 = 0 THEN 'Größe Süd '||CAST(c_custkey AS STRING) ELSE c_name END AS long_name,
       CASE c_custkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' WHEN 4 THEN '11' ELSE '700' END AS route_type,
       'a'||CAST(c_nationkey AS STRING) AS agency_id
  FROM customer
""",
    "t_trips": """
SELECT 't'||CAST(o_orderkey AS STRING) AS trip_id,
       'r'||CAST(o_custkey AS STRING) AS route_id,
       'w'||CAST(o_custkey AS STRING) AS service_id,
       CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS headsign,
       CASE o_orderstatus WHEN 'O' THEN '0' WHEN 'F' THEN '1' ELSE '' END AS direction_id,
       'sh'||CAST(CAST(floor(o_custkey / 30) AS BIGINT) AS STRING) AS shape_id
  FROM orders
""",
    "t_stop_times": """
SELECT 't'||CAST(l_orderkey AS STRING) AS trip_id,
       'p'||CAST(l_partkey AS STRING) AS stop_id,
       l_linenumber AS stop_sequence,
       (l_orderkey * 131) % 90000 + l_linenumber * 240 AS departure_seconds,
       lpad(CAST(CAST(floor(((l_orderkey * 131) % 90000 + l_linenumber * 240) / 3600) AS BIGINT) AS STRING), 2, '0')||':'||lpad(CAST(CAST(floor((((l_orderkey * 131) % 90000 + l_linenumber * 240) % 3600) / 60) AS BIGINT) AS STRING), 2, '0')||':'||lpad(CAST(((l_orderkey * 131) % 90000 + l_linenumber * 240) % 60 AS STRING), 2, '0') AS departure_time,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_tax) AS source_order
  FROM lineitem
""",
    "t_calendar": """
SELECT 'w'||CAST(c_custkey AS STRING) AS service_id,
       CASE WHEN c_custkey % 2 = 0 THEN '20240101' ELSE '20240110' END AS start_date,
       CASE WHEN c_custkey % 3 = 0 THEN '20240120' ELSE '20240131' END AS end_date,
       CASE WHEN (c_custkey + 0) % 3 <> 0 THEN 1 ELSE 0 END AS monday,
       CASE WHEN (c_custkey + 1) % 3 <> 0 THEN 1 ELSE 0 END AS tuesday,
       CASE WHEN (c_custkey + 2) % 3 <> 0 THEN 1 ELSE 0 END AS wednesday,
       CASE WHEN (c_custkey + 3) % 4 <> 0 THEN 1 ELSE 0 END AS thursday,
       CASE WHEN (c_custkey + 4) % 5 <> 0 THEN 1 ELSE 0 END AS friday,
       CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS saturday,
       CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS sunday
  FROM customer
""",
    "t_calendar_dates": """
SELECT 'w'||CAST(o_custkey AS STRING) AS service_id,
       '202401'||lpad(CAST(1 + o_orderkey % 30 AS STRING), 2, '0') AS service_date,
       min(1 + o_orderkey % 2) AS exception_type
  FROM orders
  GROUP BY 1, 2
""",
    "t_cities": """
SELECT 'c'||CAST(r_regionkey AS STRING) AS city_id,
       r_name AS name,
       CAST(48.1 AS DOUBLE) + r_regionkey * CAST(0.2 AS DOUBLE) AS latitude,
       CAST(8.1 AS DOUBLE) + r_regionkey * CAST(0.15 AS DOUBLE) AS longitude,
       CAST(9000 + r_regionkey * 2500 AS DOUBLE) AS radius_m
  FROM region
""",
    "t_boundaries": """
SELECT 'b'||CAST(n_nationkey AS STRING) AS code,
       n_name AS name,
       'st'||CAST(n_regionkey AS STRING) AS state,
       CAST(8.005 AS DOUBLE) + (n_nationkey % 5) * CAST(0.2 AS DOUBLE) AS min_lon,
       CAST(48.005 AS DOUBLE) + floor(n_nationkey / 5) * CAST(0.2 AS DOUBLE) AS min_lat,
       CAST(8.205 AS DOUBLE) + (n_nationkey % 5) * CAST(0.2 AS DOUBLE) + (n_nationkey % 3) * CAST(0.03 AS DOUBLE) AS max_lon,
       CAST(48.205 AS DOUBLE) + floor(n_nationkey / 5) * CAST(0.2 AS DOUBLE) AS max_lat
  FROM nation
""",
    "t_samples": """
SELECT 'v'||CAST(user_id AS STRING) AS vehicle_id,
       'r'||CAST(user_id % 50 AS STRING) AS route_id,
       ts, event_id, CASE WHEN event_type = 'signup' THEN 't'||CAST(event_id % 1500 AS STRING) END AS trip_id,
       CAST(50.4501 AS DOUBLE) AS latitude,
       CAST(30.518 AS DOUBLE) + value * CAST(0.00005 AS DOUBLE) AS longitude,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id * 37 % 720 - 180 AS DOUBLE) END AS bearing
  FROM events
""",
    "t_rt_updates": """
SELECT CASE WHEN l_orderkey % 13 = 0 THEN 'zz' ELSE 't' END||CAST(l_orderkey AS STRING) AS trip_id,
       CASE WHEN l_orderkey % 10 = 0 THEN 'rX' WHEN l_orderkey % 10 = 1 THEN '' ELSE 'r'||CAST(o_custkey AS STRING) END AS route_id,
       CASE WHEN l_suppkey % 6 = 0 THEN '' ELSE 'p'||CAST(l_partkey AS STRING) END AS stop_id,
       l_linenumber AS stop_sequence,
       l_suppkey % 4 AS stop_relationship,
       CASE WHEN l_orderkey % 9 = 0 THEN 3 WHEN l_orderkey % 9 = 1 THEN 1 ELSE 0 END AS trip_relationship,
       CAST(l_quantity AS INT) * 10 AS delay_seconds,
       1704067200 + l_orderkey % 600 AS feed_ts
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
""",
    "t_store_events": """
SELECT 'n'||CAST(event_id - event_id % 5 % 2 AS STRING) AS notification_uuid,
       CASE event_type WHEN 'purchase' THEN 'SUBSCRIBED' WHEN 'view' THEN 'DID_RENEW' WHEN 'click' THEN 'REFUND' WHEN 'signup' THEN 'ONE_TIME_CHARGE' ELSE 'TEST' END AS notification_type,
       CASE WHEN user_id % 2 = 0 THEN 'bundle.a' ELSE 'bundle.b' END AS bundle_id,
       CASE user_id % 4 WHEN 0 THEN 'a.monthly' WHEN 1 THEN 'b.lifetime' WHEN 2 THEN 'a.unknown' END AS product_id,
       CASE WHEN event_id % 10 = 0 THEN 'Sandbox' ELSE 'Production' END AS environment,
       event_id AS source_order
  FROM events
""",
    "t_shapes": """
SELECT 'sh'||CAST(CAST(floor(p_partkey / 40) AS BIGINT) AS STRING) AS shape_id,
       CASE WHEN p_partkey = 59 THEN CAST(55.45 AS DOUBLE) ELSE CAST(50.4485 AS DOUBLE) + (floor(p_partkey / 40) % 7) * CAST(0.0005 AS DOUBLE) END AS shape_pt_lat,
       CASE WHEN p_partkey = 59 THEN CAST(35.0 AS DOUBLE) WHEN floor(p_partkey / 40) % 2 = 0 THEN CAST(30.518 AS DOUBLE) + (p_partkey % 40) * CAST(0.0006 AS DOUBLE) ELSE CAST(30.542 AS DOUBLE) - (p_partkey % 40) * CAST(0.0006 AS DOUBLE) END AS shape_pt_lon,
       CAST(p_partkey % 40 AS BIGINT) AS shape_pt_sequence
  FROM part
""",
    "t_transfers": """
SELECT 'p'||CAST(l_partkey % 40 AS STRING) AS from_stop_id,
       's'||CAST(l_suppkey % 10 AS STRING) AS to_stop_id,
       CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE 't'||CAST(l_orderkey % 50 AS STRING) END AS from_trip_id,
       '' AS to_trip_id,
       '' AS from_route_id,
       '' AS to_route_id,
       CASE WHEN l_partkey % 40 < 30 THEN 0 ELSE l_linenumber % 3 END AS transfer_type,
       CASE WHEN l_partkey % 40 < 30 THEN 0 ELSE l_linenumber * 60 END AS min_transfer_time
  FROM lineitem
""",
    "t_entities": """
SELECT 'trips' AS entity_type,
       CASE WHEN o_custkey % 2 = 0 THEN 'pa' ELSE 'pb' END AS provider_id,
       't'||CAST(o_orderkey AS STRING) AS key_1
  FROM orders
  UNION ALL SELECT 'trips', 'pc', 't'||CAST(o_orderkey AS STRING)
  FROM orders
  WHERE o_orderkey % 25 = 0
  UNION ALL SELECT 'trips', 'pa', 'lost'||CAST(o_orderkey AS STRING)
  FROM orders
  WHERE o_orderkey % 100 = 7
  UNION ALL SELECT 'routes', CASE WHEN c_custkey % 2 = 0 THEN 'pa' ELSE 'pb' END, 'r'||CAST(c_custkey AS STRING)
  FROM customer
""",
    "t_catalogue": """
SELECT 'k'||CAST(c_custkey - c_custkey % 10 % 2 AS STRING) AS stop_id,
       CASE WHEN c_custkey % 12 = 0 THEN '' ELSE c_name END AS name,
       c_custkey % 3 AS stop_type,
       CAST(48.0002 AS DOUBLE) + (c_custkey % 101) * CAST(0.007 AS DOUBLE) AS latitude,
       CAST(8.0003 AS DOUBLE) + (c_custkey % 103) * CAST(0.007 AS DOUBLE) AS longitude,
       c_custkey AS source_order
  FROM customer
""",
    "t_alert_selectors": """
SELECT 'al'||CAST(CAST(floor(o_orderkey / 32) AS BIGINT) AS STRING) AS alert_id,
       CASE o_orderkey % 3 WHEN 0 THEN 'route_short_name' WHEN 1 THEN 'stop_code' ELSE 'direction_id' END AS selector_type,
       CASE o_orderkey % 3 WHEN 0 THEN 'L'||CAST(o_custkey % 55 AS STRING) WHEN 1 THEN CAST(o_custkey % 120 AS STRING) ELSE CAST(o_custkey % 2 AS STRING) END AS selector_value
  FROM orders
""",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view over the tables of ``sf_dir``."""
    text = VIEWS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f" {t}\n" in f"{text} \n" or f"FROM {t}" in text or f"JOIN {t}" in text}
    for t in tables:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(text, **tables)


def ctes(*names: str) -> str:
    """The views as the WITH clause of a second engine's query."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
