"""The SQL function catalogue and its views, called from SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dockline.functions import catalog as FN
from dockline.plans.registry import ALL_STATIONS, INFO, STATUS, query, with_tables
from dockline.plans.stations import BOTH, LEFT, VIEW_FIELDS
from dockline.schemas import STATION_ARRAY
from dockline.session import shared_path
from dockline.sinks import tables as K
from dockline.sources import tables as T


def _documents(spark, folder):
    system = T.table(spark, folder, "supplier").select(
        F.to_json(F.struct(F.col("s_name").alias("name"))).alias("json"), F.lit("en").alias("lang"))
    alerts = T.table(spark, folder, "events").select(
        F.to_json(F.struct("event_id", F.col("event_type").alias("summary"))).alias("json"), F.lit("en").alias("lang"))
    return system, alerts


def _registered(spark, folder):
    FN.register_sources(spark, T.station_status(spark, folder), T.station_information(spark, folder),
                        *_documents(spark, folder))
    FN.register_all(spark)


@query("sql_system_functions", BOTH + """
    SELECT *, CAST(total_bikes AS DOUBLE) / capacity * CAST(100 AS DOUBLE) AS utilization FROM totals""")
def sql_system_functions(spark, folder):
    _registered(spark, folder)
    return spark.sql("""
        SELECT count_total_stations('en') AS total_stations, count_operational_stations('en') AS operational_stations,
               get_total_bikes_available('en') AS total_bikes, get_total_docks_available() AS total_docks,
               get_system_capacity(language => 'en') AS capacity, get_system_utilization() AS utilization""")


@query("sql_count_functions", with_tables(STATUS) + """
    SELECT count(*) FILTER (num_bikes_available >= 1 AND is_renting AND is_installed) AS any_bikes,
           count(*) FILTER (num_bikes_available >= 20 AND is_renting AND is_installed) AS bikes_20,
           count(*) FILTER (num_docks_available >= 5 AND is_returning AND is_installed) AS docks_5,
           CAST(0 AS BIGINT) AS other_language
    FROM status""")
def sql_count_functions(spark, folder):
    _registered(spark, folder)
    return spark.sql("""
        SELECT count_stations_with_bikes() AS any_bikes, count_stations_with_bikes(20, 'en') AS bikes_20,
               count_stations_with_docks(5) AS docks_5, count_stations_with_bikes(1, 'fr') AS other_language""")


def _paged(name, call, sql):
    def run(spark, folder):
        _registered(spark, folder)
        return spark.sql(f"SELECT s.* FROM (SELECT explode(from_json(stations_json, '{STATION_ARRAY}')) AS s FROM {call})")

    query(name, sql)(run)


_paged("sql_find_bikes_json", "find_stations_with_bikes_json(10, 'en')", LEFT + f"""
    SELECT {VIEW_FIELDS} FROM everything WHERE num_bikes_available >= 10 AND is_renting AND is_installed""")
_paged("sql_find_docks_json", "find_stations_with_docks_json(10)", LEFT + f"""
    SELECT {VIEW_FIELDS} FROM everything WHERE num_docks_available >= 10 AND is_returning AND is_installed""")
_paged("sql_all_stations_json", "get_all_stations_summary_json()", LEFT + f"SELECT {VIEW_FIELDS} FROM everything")


@query("sql_raw_json_functions", with_tables(INFO, STATUS) + """
    SELECT (SELECT count(*) FROM status) AS status_rows, (SELECT count(*) FROM info) AS information_rows,
           (SELECT count(*) FROM supplier) AS system_documents, (SELECT count(*) FROM events) AS alert_documents""")
def sql_raw_json_functions(spark, folder):
    """Raw documents of the four feeds, counted after parsing."""
    _registered(spark, folder)
    items = lambda call: (f"(SELECT count(*) FROM (SELECT explode(from_json(stations_json, 'array<struct<station_id:string>>')) "
                          f"AS s FROM {call}) WHERE s.station_id IS NOT NULL)")
    return spark.sql(f"""
        SELECT {items('get_station_status_json()')} AS status_rows,
               {items('get_station_information_json()')} AS information_rows,
               (SELECT count(get_json_object(document, '$.name')) FROM get_system_information_json()) AS system_documents,
               (SELECT count(get_json_object(document, '$.summary')) FROM get_system_alerts_json()) AS alert_documents""")


@query("sql_station_by_name", LEFT + """
    SELECT name AS station_name, num_bikes_available AS bikes, capacity, lat AS latitude
    FROM everything WHERE contains(lower(name), 'widget') ORDER BY position LIMIT 1""")
def sql_station_by_name(spark, folder):
    """A scalar JSON function taken apart by path; a missing station gives no row."""
    _registered(spark, folder)
    return spark.sql("""
        SELECT get_json_object(station_json, '$.name') AS station_name,
               CAST(get_json_object(station_json, '$.num_bikes_available') AS INT) AS bikes,
               CAST(get_json_object(station_json, '$.capacity') AS INT) AS capacity,
               CAST(get_json_object(station_json, '$.lat') AS DOUBLE) AS latitude
        FROM (SELECT get_station_by_name_json('Widget') AS station_json
              UNION ALL SELECT get_station_by_name_json('no such %'))
        WHERE station_json != 'null'""")


@query("sql_live_view", LEFT + f"""
    SELECT {VIEW_FIELDS}, utilization_pct FROM everything WHERE num_bikes_available >= 10
    ORDER BY num_bikes_available DESC, station_id LIMIT 20""")
def sql_live_view(spark, folder):
    _registered(spark, folder)
    FN.create_views(spark)
    return spark.sql("""
        SELECT * EXCEPT (queried_at) FROM live_stations WHERE num_bikes_available >= 10
        ORDER BY num_bikes_available DESC, station_id LIMIT 20""")


@query("sql_metrics_view", BOTH + """
    SELECT total_stations, total_bikes, CAST(total_bikes AS DOUBLE) / capacity * CAST(100 AS DOUBLE) AS utilization_pct FROM totals""")
def sql_metrics_view(spark, folder):
    _registered(spark, folder)
    FN.create_views(spark)
    return spark.sql("SELECT total_stations, total_bikes, utilization_pct FROM system_metrics")


@query("permanent_functions", BOTH + """
    SELECT total_bikes, total_stations, CAST((SELECT count(*) FROM status WHERE num_bikes_available >= 20 AND is_renting AND is_installed) AS BIGINT)
           AS stations_20 FROM totals""")
def permanent_functions(spark, folder):
    """Functions created from their listed statements in a schema of their own, over tables saved there."""
    home = f"dockline_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {home} LOCATION '{shared_path(spark, 'schema')}'")
    system, alerts = _documents(spark, folder)
    for view, frame in ((FN.STATUS_VIEW, T.station_status(spark, folder)), (FN.INFO_VIEW, T.station_information(spark, folder)),
                        (FN.SYSTEM_VIEW, system), (FN.ALERT_VIEW, alerts)):
        K.overwrite_table(frame, f"{home}.{view}")
    wanted = {"get_total_bikes_available", "count_total_stations", "count_stations_with_bikes"}
    names = [n for n in FN.list_available_functions() if n in wanted]
    FN.create_functions(spark, names[:2], schema=home)
    spark.sql(FN.get_function_sql(names[2], schema=home, include_schema=False).rstrip(";"))
    return spark.sql(f"""SELECT {home}.get_total_bikes_available() AS total_bikes, {home}.count_total_stations() AS total_stations,
                                {home}.count_stations_with_bikes(20) AS stations_20""")
