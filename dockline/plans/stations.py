"""Station searches, projections, proximity and system metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockline import schemas as S
from dockline.functions import columns as C
from dockline.operators import metrics as M
from dockline.operators import neighbourhood as N
from dockline.operators import proximity as P
from dockline.operators import stations as O
from dockline.plans.registry import ALL_STATIONS, INFO, MERGED, STATUS, query, with_tables
from dockline.sources import tables as T

BASE = with_tables(INFO, STATUS, MERGED)
LEFT = with_tables(INFO, STATUS, ALL_STATIONS)
STATION = ("station_id, name, lat, lon, capacity, num_bikes_available, num_docks_available, "
           "is_installed, is_renting, is_returning, last_reported")
FIELDS = STATION.split(", ")
VIEW_FIELDS = ("station_id, name, lat, lon, capacity, num_bikes_available, num_docks_available, "
               "is_renting, is_returning")


def _feeds(spark, folder):
    return T.station_status(spark, folder), T.station_information(spark, folder)


def _live(spark, folder, how="inner"):
    merged = O.merge_stations(*_feeds(spark, folder), how=how)
    return O.live_view(merged).drop("queried_at")


@query("top_stations_with_bikes", BASE + """
    SELECT station_id, name, capacity, num_bikes_available, num_docks_available, utilization_pct
    FROM merged WHERE num_bikes_available >= 10 AND is_renting AND is_installed
    ORDER BY num_bikes_available DESC, station_id LIMIT 10""")
def top_stations_with_bikes(spark, folder):
    """Stations with enough bikes, joined with their information, ten largest."""
    status, info = _feeds(spark, folder)
    found = O.find_with_bikes(status, info, 10).withColumn("utilization_pct", C.utilization_pct())
    return O.top_by(found, "num_bikes_available", 10).select(
        "station_id", "name", "capacity", "num_bikes_available", "num_docks_available", "utilization_pct")


@query("top_stations_with_docks", BASE + """
    SELECT station_id, name, num_docks_available FROM merged
    WHERE num_docks_available >= 5 AND is_returning AND is_installed
    ORDER BY num_docks_available DESC, station_id LIMIT 5""")
def top_stations_with_docks(spark, folder):
    found = O.find_with_docks(*_feeds(spark, folder), 5)
    return O.top_by(found, "num_docks_available", 5).select("station_id", "name", "num_docks_available")


@query("find_stations_with_bikes", BASE + f"""
    SELECT {STATION} FROM merged WHERE num_bikes_available >= 1 AND is_renting AND is_installed""")
def find_stations_with_bikes(spark, folder):
    return O.find_with_bikes(*_feeds(spark, folder)).select(*FIELDS)


@query("find_stations_with_docks", BASE + f"""
    SELECT {STATION} FROM merged WHERE num_docks_available >= 1 AND is_returning AND is_installed""")
def find_stations_with_docks(spark, folder):
    return O.find_with_docks(*_feeds(spark, folder)).select(*FIELDS)


@query("station_by_name", LEFT + f"""
    SELECT {STATION} FROM everything WHERE contains(lower(name), lower('WIDGET'))
    ORDER BY position LIMIT 1""")
def station_by_name(spark, folder):
    return O.find_by_name(*_feeds(spark, folder), "WIDGET").select(*FIELDS)


@query("station_by_name_missing", LEFT + f"""
    SELECT {STATION} FROM everything WHERE contains(name, '%_no such name') LIMIT 1""")
def station_by_name_missing(spark, folder):
    return O.find_by_name(*_feeds(spark, folder), "%_no such name").select(*FIELDS)


@query("all_stations_summary", BASE + f"SELECT {STATION} FROM merged")
def all_stations_summary(spark, folder):
    return O.merge_stations(*_feeds(spark, folder)).select(*FIELDS)


@query("all_stations_summary_left", LEFT + f"SELECT {STATION} FROM everything")
def all_stations_summary_left(spark, folder):
    return O.merge_stations(*_feeds(spark, folder), how="left").select(*FIELDS)


@query("station_reports_merged", with_tables(INFO) + """
    SELECT CAST(l_partkey AS VARCHAR) AS station_id, name, l_orderkey AS report_key, l_linenumber AS report_line,
           CAST(floor(l_quantity) AS INTEGER) - 1 AS num_bikes_available
    FROM lineitem JOIN info ON CAST(l_partkey AS VARCHAR) = station_id
    WHERE floor(l_quantity) - 1 >= 40 AND l_linestatus = 'O' AND l_returnflag <> 'R'""")
def station_reports_merged(spark, folder):
    """The search over every status row: the driving side keeps its duplicates."""
    reports = T.status_reports(spark, folder)
    return O.find_with_bikes(reports, T.station_information(spark, folder), 40).select(
        "station_id", "name", "report_key", "report_line", "num_bikes_available")


@query("known_station_status", with_tables(INFO, STATUS) + """
    SELECT station_id, num_bikes_available, num_docks_available FROM status
    WHERE station_id IN (SELECT station_id FROM info)""")
def known_station_status(spark, folder):
    return O.known_status(*_feeds(spark, folder)).select("station_id", "num_bikes_available", "num_docks_available")


@query("latest_status_per_station", """
    SELECT CAST(l_partkey AS VARCHAR) AS station_id,
           arg_max(l_orderkey, row(l_shipdate, l_orderkey, l_linenumber)) AS report_key,
           arg_max(l_linenumber, row(l_shipdate, l_orderkey, l_linenumber)) AS report_line
    FROM lineitem GROUP BY l_partkey""")
def latest_status_per_station(spark, folder):
    """Last row wins per key, with an ordering of several columns."""
    reports = T.status_reports(spark, folder).drop("position")
    ordered = reports.withColumn("position", F.struct("reported_at", "report_key", "report_line"))
    return O.latest_per_key(ordered).select("station_id", "report_key", "report_line")


@query("find_stations_with_bikes_json", BASE + f"""
    SELECT {VIEW_FIELDS} FROM merged WHERE num_bikes_available >= 10 AND is_renting AND is_installed""")
def find_stations_with_bikes_json(spark, folder):
    """JSON arrays of the result, read back into typed rows."""
    pages = O.json_pages(O.find_with_bikes(*_feeds(spark, folder), 10), FIELDS)
    return O.parse_pages(pages, S.STATION_ARRAY)


@query("find_stations_with_docks_json", BASE + f"""
    SELECT {VIEW_FIELDS} FROM merged WHERE num_docks_available >= 5 AND is_returning AND is_installed""")
def find_stations_with_docks_json(spark, folder):
    pages = O.json_pages(O.find_with_docks(*_feeds(spark, folder), 5), FIELDS)
    return O.parse_pages(pages, S.STATION_ARRAY)


@query("station_by_name_json", LEFT + """
    SELECT name AS station_name, num_bikes_available AS bikes, num_docks_available AS docks, capacity,
           lat AS latitude, lon AS longitude
    FROM everything WHERE contains(lower(name), 'bolt') ORDER BY position LIMIT 1""")
def station_by_name_json(spark, folder):
    """One JSON object, taken apart by path."""
    document = O.json_documents(O.find_by_name(*_feeds(spark, folder), "bolt"), FIELDS)
    value = lambda path, kind: F.get_json_object("station_json", f"$.{path}").try_cast(kind)
    return document.select(
        value("name", "string").alias("station_name"),
        value("num_bikes_available", "int").alias("bikes"),
        value("num_docks_available", "int").alias("docks"),
        value("capacity", "int").alias("capacity"),
        value("lat", "double").alias("latitude"),
        value("lon", "double").alias("longitude"),
    )


@query("live_stations_well_stocked", LEFT + f"""
    SELECT {VIEW_FIELDS}, utilization_pct FROM everything WHERE num_bikes_available > 10""")
def live_stations_well_stocked(spark, folder):
    return _live(spark, folder, "left").filter(F.col("num_bikes_available") > 10)


@query("station_display_text", BASE + """
    SELECT station_id, printf('Station: %s\nLocation: (%.6f, %.6f)\nCapacity: %d\nAvailable Bikes: %d\nAvailable Docks: %d\n'
             || 'Status: Installed %s | Renting %s | Returning %s',
             name, lat, lon, capacity, num_bikes_available, num_docks_available,
             CASE WHEN is_installed THEN '✓' ELSE '✗' END, CASE WHEN is_renting THEN '✓' ELSE '✗' END,
             CASE WHEN is_returning THEN '✓' ELSE '✗' END) AS display_text
    FROM merged""")
def station_display_text(spark, folder):
    return O.with_display_text(O.merge_stations(*_feeds(spark, folder)))


@query("station_labels", LEFT + """
    SELECT station_id,
           CASE WHEN coalesce(num_bikes_available, 0) = 0 THEN 'Empty' WHEN num_bikes_available < 3 THEN 'Low (1-2)'
                WHEN num_bikes_available < 6 THEN 'Medium (3-5)' WHEN num_bikes_available < 10 THEN 'Good (6-9)'
                ELSE 'Excellent (10+)' END AS availability_tier,
           CASE WHEN utilization_pct >= 75 THEN 'Busy (75%+)' WHEN utilization_pct >= 50 THEN 'Moderate (50-75%)'
                WHEN utilization_pct >= 25 THEN 'Quiet (25-50%)' ELSE 'Very Quiet (<25%)' END AS status
    FROM everything""")
def station_labels(spark, folder):
    """Availability tier and use level of each station."""
    return _live(spark, folder, "left").select(
        "station_id",
        C.availability_tier(C.count_of("num_bikes_available")).alias("availability_tier"),
        C.use_level(F.col("utilization_pct")).alias("status"))


@query("station_quality", BASE + """
    SELECT count(*) AS rows_checked,
           count(*) FILTER (NOT (lat > 45.0 AND lat < 46.0)) AS lat_violations,
           count(*) FILTER (NOT (lon > -74.5 AND lon < -73.0)) AS lon_violations,
           count(*) FILTER (num_bikes_available + num_docks_available > capacity + 5) AS capacity_violations
    FROM merged""")
def station_quality(spark, folder):
    return O.quality_violations(O.merge_stations(*_feeds(spark, folder)))


@query("stations_within_radius", BASE + """
    SELECT station_id, name, sqrt((lat - 45.5) * (lat - 45.5) + (lon + 73.6) * (lon + 73.6)) AS distance
    FROM (SELECT * REPLACE (lat AS lat), CAST(0 AS DOUBLE) AS z FROM merged)
    WHERE sqrt((lat - 45.5) * (lat - 45.5) + (lon + 73.6) * (lon + 73.6)) < 0.1
    ORDER BY distance, station_id LIMIT 5""")
def stations_within_radius(spark, folder):
    merged = O.merge_stations(*_feeds(spark, folder))
    return P.within_radius(merged, 45.5, -73.6, radius=0.1, k=5).select("station_id", "name", "distance")


NEAR = with_tables(INFO, """points AS (
  SELECT vec_id AS location_id, CAST(45.5 AS DOUBLE) + CAST(embedding[1] AS DOUBLE) AS lat,
         CAST(-73.75 AS DOUBLE) + CAST(embedding[2] AS DOUBLE) AS lon FROM embeddings)""", """near AS (
  SELECT location_id, station_id,
         sqrt((i.lat - p.lat) * (i.lat - p.lat) + (i.lon - p.lon) * (i.lon - p.lon)) AS distance
  FROM points p JOIN info i ON i.lat BETWEEN p.lat - 0.06 AND p.lat + 0.06 AND i.lon BETWEEN p.lon - 0.06 AND p.lon + 0.06)""")


@query("stations_near_locations", NEAR + """
    SELECT location_id, count(*) AS stations, min(distance) AS distance FROM near WHERE distance < 0.05 GROUP BY location_id""")
def stations_near_locations(spark, folder):
    """Stations within the radius of every location, counted."""
    return N.near_counts(T.locations(spark, folder), T.station_information(spark, folder), radius=0.05)


@query("nearest_stations_per_location", NEAR + """
    SELECT location_id, station_id, distance, CAST(place AS INTEGER) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY distance, station_id) AS place
      FROM near WHERE distance < 0.05) WHERE place <= 5""")
def nearest_stations_per_location(spark, folder):
    return N.nearest_stations(
        T.locations(spark, folder), T.station_information(spark, folder), radius=0.05, k=5,
    ).select("location_id", "station_id", "distance", "place")


# --- metrics ---------------------------------------------------------------

def _status_metric(name, sql, build):
    query(name, with_tables(STATUS) + sql)(lambda spark, folder: build(T.station_status(spark, folder)))


def _info_metric(name, sql, build):
    query(name, with_tables(INFO) + sql)(lambda spark, folder: build(T.station_information(spark, folder)))


_status_metric("total_bikes_available",
               "SELECT CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes FROM status", M.total_bikes)
_status_metric("total_docks_available",
               "SELECT CAST(sum(num_docks_available) AS BIGINT) AS total_docks FROM status", M.total_docks)
_info_metric("system_capacity", "SELECT CAST(sum(capacity) AS BIGINT) AS capacity FROM info", M.system_capacity)
_info_metric("count_total_stations", "SELECT count(*) AS total_stations FROM info", M.count_stations)
_status_metric("count_operational_stations",
               "SELECT count(*) FILTER (is_renting) AS operational_stations FROM status", M.count_operational)
_status_metric("count_installed_stations",
               "SELECT count(*) FILTER (is_installed) AS installed_stations FROM status", M.count_installed)
_status_metric("count_stations_with_bikes",
               "SELECT count(*) FILTER (num_bikes_available >= 10 AND is_renting AND is_installed) AS stations FROM status",
               lambda status: M.count_with_bikes(status, 10))
_status_metric("count_stations_with_docks",
               "SELECT count(*) FILTER (num_docks_available >= 10 AND is_returning AND is_installed) AS stations FROM status",
               lambda status: M.count_with_docks(status, 10))
_status_metric("empty_and_full_stations",
               "SELECT count(*) FILTER (num_bikes_available = 0) AS empty_stations, "
               "count(*) FILTER (num_docks_available = 0) AS full_stations FROM status", M.count_empty_and_full)


def _both(function):
    def run(spark, folder):
        status, info = _feeds(spark, folder)
        return function(info, status)

    return run


TOTALS = """SELECT (SELECT count(*) FROM info) AS total_stations,
    (SELECT count(*) FILTER (is_renting) FROM status) AS operational_stations,
    (SELECT CAST(sum(num_bikes_available) AS BIGINT) FROM status) AS total_bikes,
    (SELECT CAST(sum(num_docks_available) AS BIGINT) FROM status) AS total_docks,
    (SELECT CAST(sum(capacity) AS BIGINT) FROM info) AS capacity"""
BOTH = with_tables(INFO, STATUS, f"totals AS ({TOTALS})")

query("system_utilization", BOTH + """
    SELECT CASE WHEN capacity = 0 THEN CAST(0 AS DOUBLE)
                ELSE CAST(total_bikes AS DOUBLE) / capacity * CAST(100 AS DOUBLE) END AS utilization
    FROM totals""")(_both(M.system_utilization))
query("system_report", BOTH + """
    SELECT *, floor(10000 * CAST(total_bikes AS DOUBLE) / capacity + 0.5) / CAST(100 AS DOUBLE) AS utilization_pct
    FROM totals""")(_both(M.system_report))


def _rung(label, count, flag, n):
    return (f"SELECT '{label}' AS category, count(*) AS count FROM status "
            f"WHERE {count} >= {n} AND {flag} AND is_installed")


query("availability_ladder", with_tables(INFO, STATUS) + " UNION ALL ".join(
    ["SELECT 'All stations' AS category, count(*) AS count FROM info"]
    + [_rung(f"{n}+ bikes", "num_bikes_available", "is_renting", n) for n in (5, 10, 20)]
    + [_rung(f"{n}+ docks", "num_docks_available", "is_returning", n) for n in (5, 10)]
))(_both(M.availability_ladder))
query("system_dashboard", BOTH + """
    SELECT 'System Overview' AS metric_group, 'Total Stations' AS metric, total_stations AS value FROM totals
    UNION ALL SELECT 'System Overview', 'Operational Stations', operational_stations FROM totals
    UNION ALL SELECT 'Availability', 'Total Bikes', total_bikes FROM totals
    UNION ALL SELECT 'Availability', 'Total Docks', total_docks FROM totals
    UNION ALL SELECT 'Capacity', 'System Capacity', capacity FROM totals
    UNION ALL SELECT 'Utilization', 'Utilization %', CAST(trunc(CAST(total_bikes AS DOUBLE) / capacity * 100) AS BIGINT) FROM totals
""")(_both(M.dashboard))


@query("merged_station_summary", BASE + """
    SELECT *, CAST(total_bikes AS DOUBLE) / capacity * CAST(100 AS DOUBLE) AS utilization FROM (
      SELECT count(*) AS total_stations, CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes,
             CAST(sum(num_docks_available) AS BIGINT) AS total_docks, CAST(sum(capacity) AS BIGINT) AS capacity
      FROM merged)""")
def merged_station_summary(spark, folder):
    return M.merged_summary(O.merge_stations(*_feeds(spark, folder)))


def _shares(label_sql, source, where=""):
    return f"""SELECT *, floor(CAST(station_count AS DOUBLE) * 1000 / (sum(station_count) OVER ()) + 0.5) / CAST(10 AS DOUBLE) AS percentage
    FROM (SELECT {label_sql}, count(*) AS station_count FROM {source} {where} GROUP BY 1)"""


@query("availability_tiers", BASE + _shares("""
    CASE WHEN num_bikes_available = 0 THEN 'Empty' WHEN num_bikes_available < 3 THEN 'Low (1-2)'
         WHEN num_bikes_available < 6 THEN 'Medium (3-5)' WHEN num_bikes_available < 10 THEN 'Good (6-9)'
         ELSE 'Excellent (10+)' END AS availability_tier""", "merged"))
def availability_tiers(spark, folder):
    return M.tier_distribution(_live(spark, folder))


@query("use_levels", BASE + _shares("""
    CASE WHEN utilization_pct >= 75 THEN 'Busy (75%+)' WHEN utilization_pct >= 50 THEN 'Moderate (50-75%)'
         WHEN utilization_pct >= 25 THEN 'Quiet (25-50%)' ELSE 'Very Quiet (<25%)' END AS status""",
    "merged", "WHERE capacity > 0"))
def use_levels(spark, folder):
    return M.use_distribution(_live(spark, folder))
