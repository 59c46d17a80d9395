"""The function catalogue: SQL functions over station views.

Bodies are plain SQL, so a call is inlined into the plan of its query; no
Python worker and no fetch per row. Functions whose result grows with the
system return a table of bounded JSON pages instead of one string.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from dockline.schemas import STATION_ARRAY

# Views the bodies read; rows carry their language in ``lang``.
STATUS_VIEW = "feed_station_status"
INFO_VIEW = "feed_station_information"
SYSTEM_VIEW = "feed_system_information"
ALERT_VIEW = "feed_system_alerts"

LANGUAGE = "language STRING DEFAULT 'en'"
PAGED = "TABLE(page BIGINT, stations_json STRING)"
DOCUMENTS = "TABLE(document STRING)"
PAGE_SIZE = 1000

_INFO = ["name", "lat", "lon", "capacity"]
_STATUS = ["num_bikes_available", "num_docks_available", "is_installed", "is_renting", "is_returning", "last_reported"]
_LAST_STATUS = (
    f"SELECT lang, station_id, max_by(struct({', '.join(_STATUS)}), position) AS s "
    f"FROM {STATUS_VIEW} GROUP BY lang, station_id"
)
_STATION = (
    "struct(i.station_id, " + ", ".join(f"i.{c}" for c in _INFO) + ", "
    + ", ".join(f"l.s.{c} AS {c}" for c in _STATUS) + ")"
)
# The language of the information row carries over to the status side through the join.
_MERGED = f"{INFO_VIEW} i LEFT JOIN ({_LAST_STATUS}) l ON i.station_id = l.station_id AND i.lang = l.lang"


def _pages(fields: str, source: str, condition: str = "TRUE") -> str:
    return (
        f"SELECT page, to_json(transform(array_sort(collect_list(struct(position, station))), e -> e.station)) "
        f"FROM (SELECT i.position DIV {PAGE_SIZE} AS page, i.position AS position, {fields} AS station "
        f"FROM {source} WHERE i.lang = language AND {condition}) GROUP BY page"
    )


def _total(column: str, view: str) -> str:
    return f"SELECT COALESCE(SUM(CAST({column} AS BIGINT)), 0) FROM {view} WHERE lang = language"


def _usable(prefix: str, count: str, flag: str, minimum: str) -> str:
    return (f"COALESCE({prefix}{count}, 0) >= {minimum} AND COALESCE({prefix}{flag}, FALSE) "
            f"AND COALESCE({prefix}is_installed, FALSE)")


@dataclass(frozen=True)
class SqlFunction:
    name: str
    returns: str
    comment: str
    body: str
    params: str = LANGUAGE

    @property
    def is_table(self) -> bool:
        return self.returns.startswith("TABLE")

    def ddl(self, name: str, home: str | None = None) -> str:
        """Statement for the session, or for the schema ``home`` and the tables in it."""
        kind, body = "TEMPORARY FUNCTION", self.body
        if home:
            kind = "FUNCTION"
            # A permanent body is resolved wherever it is called, so it names its schema.
            for view in (STATUS_VIEW, INFO_VIEW, SYSTEM_VIEW, ALERT_VIEW):
                body = body.replace(view, f"{home}.{view}")
            name = f"{home}.{name}"
        if not self.is_table:
            body = f"({body})"
        return (f"CREATE OR REPLACE {kind} {name}({self.params}) RETURNS {self.returns} "
                f"COMMENT '{self.comment}' RETURN {body}")


_ANY_BIKES = "min_bikes INT DEFAULT 1, " + LANGUAGE
_ANY_DOCKS = "min_docks INT DEFAULT 1, " + LANGUAGE

FUNCTIONS = (
    SqlFunction("get_total_bikes_available", "BIGINT", "Bikes available over all stations",
                _total("num_bikes_available", STATUS_VIEW)),
    SqlFunction("get_total_docks_available", "BIGINT", "Docks available over all stations",
                _total("num_docks_available", STATUS_VIEW)),
    SqlFunction("get_system_capacity", "BIGINT", "Dock spaces of the whole system",
                _total("capacity", INFO_VIEW)),
    SqlFunction("get_system_utilization", "DOUBLE", "Bikes in percent of capacity",
                "SELECT CASE WHEN COALESCE(SUM(c), 0) = 0 THEN 0D ELSE CAST(SUM(b) AS DOUBLE) / CAST(SUM(c) AS DOUBLE) * 100D END "
                f"FROM (SELECT CAST(num_bikes_available AS BIGINT) AS b, 0L AS c FROM {STATUS_VIEW} WHERE lang = language "
                f"UNION ALL SELECT 0L, CAST(capacity AS BIGINT) FROM {INFO_VIEW} WHERE lang = language)"),
    SqlFunction("count_total_stations", "BIGINT", "Number of stations",
                f"SELECT COUNT(*) FROM {INFO_VIEW} WHERE lang = language"),
    SqlFunction("count_operational_stations", "BIGINT", "Number of stations that rent bikes",
                f"SELECT COUNT_IF(COALESCE(is_renting, FALSE)) FROM {STATUS_VIEW} WHERE lang = language"),
    SqlFunction("count_stations_with_bikes", "BIGINT", "Number of usable stations with enough bikes",
                f"SELECT COUNT(*) FROM {STATUS_VIEW} WHERE lang = language AND "
                + _usable("", "num_bikes_available", "is_renting", "min_bikes"), _ANY_BIKES),
    SqlFunction("count_stations_with_docks", "BIGINT", "Number of usable stations with enough docks",
                f"SELECT COUNT(*) FROM {STATUS_VIEW} WHERE lang = language AND "
                + _usable("", "num_docks_available", "is_returning", "min_docks"), _ANY_DOCKS),
    SqlFunction("get_station_status_json", PAGED, "Station status as JSON arrays",
                _pages("struct(i.station_id, " + ", ".join(f"i.{c}" for c in _STATUS) + ")", f"{STATUS_VIEW} i")),
    SqlFunction("get_station_information_json", PAGED, "Station information as JSON arrays",
                _pages("struct(i.station_id, " + ", ".join(f"i.{c}" for c in _INFO) + ")", f"{INFO_VIEW} i")),
    SqlFunction("get_system_information_json", DOCUMENTS, "System information documents",
                f"SELECT json FROM {SYSTEM_VIEW} WHERE lang = language"),
    SqlFunction("get_system_alerts_json", DOCUMENTS, "System alert documents",
                f"SELECT json FROM {ALERT_VIEW} WHERE lang = language"),
    SqlFunction("find_stations_with_bikes_json", PAGED, "Usable stations with enough bikes as JSON arrays",
                _pages(_STATION, _MERGED, _usable("l.s.", "num_bikes_available", "is_renting", "min_bikes")), _ANY_BIKES),
    SqlFunction("find_stations_with_docks_json", PAGED, "Usable stations with enough docks as JSON arrays",
                _pages(_STATION, _MERGED, _usable("l.s.", "num_docks_available", "is_returning", "min_docks")), _ANY_DOCKS),
    SqlFunction("get_station_by_name_json", "STRING", "First station whose name contains the text, NULL if none",
                f"SELECT min_by(to_json({_STATION}), struct(i.position, i.station_id)) FROM {_MERGED} "
                "WHERE i.lang = language AND contains(lower(i.name), lower(station_name))",
                "station_name STRING, " + LANGUAGE),
    SqlFunction("get_all_stations_summary_json", PAGED, "All stations with status and information as JSON arrays",
                _pages(_STATION, _MERGED)),
)


def list_available_functions(prefix: str = "") -> list[str]:
    return [prefix + f.name for f in FUNCTIONS]


def _find(name: str, prefix: str) -> SqlFunction:
    for function in FUNCTIONS:
        if name in (function.name, prefix + function.name):
            return function
    raise ValueError(f"no function is named {name!r}; there are {', '.join(list_available_functions(prefix))}")


def get_function_sql(name: str, catalog: str = "spark_catalog", schema: str = "default",
                     include_schema: bool = True, prefix: str = "") -> str:
    """Statements that create one permanent function over the source tables of its schema."""
    function = _find(name, prefix)
    home = f"{catalog}.{schema}"
    statements = [f"CREATE SCHEMA IF NOT EXISTS {home};"] if include_schema else []
    statements.append(function.ddl(prefix + function.name, home) + ";")
    return "\n".join(statements)


def create_functions(spark: SparkSession, names: list[str], catalog: str = "spark_catalog", schema: str = "default",
                     prefix: str = "") -> list[str]:
    """Creates permanent functions; the source tables must exist in the same schema.

    Spark calls table functions without a schema name, so ``USE`` the schema for those.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {catalog}.{schema}")
    for name in names:
        spark.sql(_find(name, prefix).ddl(prefix + _find(name, prefix).name, f"{catalog}.{schema}"))
    return [f"{catalog}.{schema}.{prefix}{_find(n, prefix).name}" for n in names]


def register_sources(spark: SparkSession, status: DataFrame, info: DataFrame,
                     system: DataFrame | None = None, alerts: DataFrame | None = None) -> None:
    """Names the frames the functions read. ``system`` and ``alerts`` have columns json, lang."""
    empty = spark.createDataFrame([], "json string, lang string")
    for view, frame in ((STATUS_VIEW, status), (INFO_VIEW, info), (SYSTEM_VIEW, system), (ALERT_VIEW, alerts)):
        (empty if frame is None else frame).createOrReplaceTempView(view)


def register(spark: SparkSession, names: list[str], prefix: str = "") -> list[str]:
    """Creates the chosen functions for this session; returns their full names."""
    created = []
    for name in names:
        function = _find(name, prefix)
        spark.sql(function.ddl(prefix + function.name))
        created.append(prefix + function.name)
    return created


def register_all(spark: SparkSession, prefix: str = "") -> list[str]:
    return register(spark, [f.name for f in FUNCTIONS], prefix)


def quick_register(spark: SparkSession) -> list[str]:
    return register_all(spark)


def example_call(name: str, prefix: str = "") -> str:
    """A query that calls the function with its defaults, for trying it out."""
    function = _find(name, prefix)
    argument = "'a'" if "station_name" in function.params else ""
    call = f"{prefix}{function.name}({argument})"
    return f"SELECT * FROM {call}" if function.is_table else f"SELECT {call} AS result"


def create_views(spark: SparkSession, prefix: str = "") -> None:
    """``live_stations``, ``live_station_status`` and ``system_metrics`` over the functions."""
    for view in ("live_stations", "live_station_status"):
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY VIEW {view} AS
            SELECT s.*, CAST(((2000L * coalesce(s.num_bikes_available, 0) + s.capacity) DIV NULLIF(2L * s.capacity, 0L)) AS DOUBLE) / 10D
                     AS utilization_pct,
                   current_timestamp() AS queried_at
            FROM (SELECT explode(from_json(stations_json, '{STATION_ARRAY}')) AS s
                  FROM {prefix}get_all_stations_summary_json())""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY VIEW system_metrics AS
        SELECT current_timestamp() AS metric_time,
               {prefix}count_total_stations() AS total_stations,
               {prefix}get_total_bikes_available() AS total_bikes,
               {prefix}get_system_utilization() AS utilization_pct""")
