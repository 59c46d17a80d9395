"""Registration of queries and of the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return add


def with_tables(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# The logical tables of ``dockline.sources.tables`` in SQL.
INFO = """info AS (
  SELECT CAST(p_partkey AS VARCHAR) AS station_id, p_name AS name,
         CAST(45 AS DOUBLE) + CAST(p_partkey * 37 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
         CAST(-74.5 AS DOUBLE) + CAST(p_partkey * 91 % 1500 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lon,
         p_size AS capacity, p_partkey AS position
  FROM part)"""
STATUS = """status AS (
  SELECT CAST(l_partkey AS VARCHAR) AS station_id,
         CAST(floor(l_quantity) AS INTEGER) - 1 AS num_bikes_available,
         CAST(l_suppkey % 30 AS INTEGER) AS num_docks_available,
         l_returnflag <> 'R' AS is_installed, l_linestatus = 'O' AS is_renting, l_returnflag = 'N' AS is_returning,
         CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400 AS last_reported,
         l_partkey AS position
  FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
                ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS newest FROM lineitem)
  WHERE newest = 1)"""
MERGED = """merged AS (
  SELECT i.station_id, i.name, i.lat, i.lon, i.capacity, s.num_bikes_available, s.num_docks_available,
         s.is_installed, s.is_renting, s.is_returning, s.last_reported, i.position,
         CASE WHEN i.capacity <> 0
              THEN floor(1000 * CAST(coalesce(s.num_bikes_available, 0) AS DOUBLE) / i.capacity + 0.5) / CAST(10 AS DOUBLE)
         END AS utilization_pct
  FROM status s JOIN info i ON s.station_id = i.station_id)"""
ALL_STATIONS = MERGED.replace("merged AS", "everything AS").replace("status s JOIN info i", "info i LEFT JOIN status s")
ZONES = """zones AS (
  SELECT CAST(c_custkey AS INTEGER) AS code, n_name AS zone FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
TRIPS = """trips AS (
  SELECT CAST(o_custkey + o_orderkey % 10 AS INTEGER) AS start_station_code,
         CAST(o_custkey + o_orderkey % 50 AS INTEGER) AS end_station_code,
         o_orderdate AS start_date
  FROM orders)"""
ZONE_DAYS = """zone_days AS (
  SELECT zone AS start_zone, CAST(start_date AS DATE) AS start_date, count(*) AS trip_count,
         CAST(isodow(CAST(start_date AS DATE)) - 1 AS INTEGER) AS day_of_week,
         CAST(month(start_date) AS INTEGER) AS month,
         isodow(CAST(start_date AS DATE)) IN (6, 7) AS is_weekend
  FROM trips JOIN zones ON start_station_code = code
  GROUP BY ALL)"""
SNAPSHOTS = """snapshots AS (
  SELECT ts AS snapshot_time, CAST(user_id AS VARCHAR) AS station_id,
         CAST(((CAST(floor(value) AS BIGINT) % 50) + 50) % 50 AS INTEGER) AS num_bikes_available,
         CAST(event_id % 20 AS INTEGER) AS num_docks_available,
         event_type <> 'error' AS is_renting
  FROM events)"""
HISTORY = """history AS (
  SELECT snapshot_time, p.station_id, name AS station_name, lat, lon, capacity,
         num_bikes_available, num_docks_available, is_renting,
         CASE WHEN capacity <> 0
              THEN floor(1000 * CAST(num_bikes_available AS DOUBLE) / capacity + 0.5) / CAST(10 AS DOUBLE)
         END AS utilization_pct,
         CAST(snapshot_time AS DATE) AS snapshot_date
  FROM snapshots p LEFT JOIN info i ON p.station_id = i.station_id)"""
LOG = """log AS (
  SELECT ts AS timestamp, props AS question, event_type AS tool_used,
         CAST(floor(value) AS BIGINT) AS execution_time_ms, event_type <> 'error' AS success
  FROM events)"""
QUESTIONS = """questions AS (
  SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user')"""
