"""Logical tables derived from the star-schema parquet files.

Each function reads only the columns it needs and stays lazy. The SQL side of
the same derivations lives in ``dockline.plans.registry``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockline.schemas import GIVEN_TABLES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def station_information(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part; the key gives position and coordinates by rule."""
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.cast("string").alias("station_id"),
        F.col("p_name").alias("name"),
        (F.lit(45.0) + F.pmod(key * 37, F.lit(1000)) / F.lit(1000.0)).alias("lat"),
        (F.lit(-74.5) + F.pmod(key * 91, F.lit(1500)) / F.lit(1000.0)).alias("lon"),
        F.col("p_size").alias("capacity"),
        F.lit("en").alias("lang"),
        key.alias("position"),
    )


def status_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as one report of a station's state."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("station_id"),
        F.col("l_shipdate").alias("reported_at"),
        F.col("l_orderkey").alias("report_key"),
        F.col("l_linenumber").alias("report_line"),
        (F.floor("l_quantity").cast("int") - 1).alias("num_bikes_available"),
        F.pmod("l_suppkey", F.lit(30)).cast("int").alias("num_docks_available"),
        (F.col("l_returnflag") != "R").alias("is_installed"),
        (F.col("l_linestatus") == "O").alias("is_renting"),
        (F.col("l_returnflag") == "N").alias("is_returning"),
        F.col("l_partkey").alias("position"),
    )


def station_status(spark: SparkSession, folder: str) -> DataFrame:
    """Latest report per station.

    The whole row is the aggregate (``max`` of a struct led by the ordering
    columns), so each map task sends one row per station however many reports
    a hot station has. Grouping is by the integer key, which sorts faster than
    its text form; the text is made once per station afterwards.
    """
    reports = status_reports(spark, folder)
    rest = [c for c in reports.columns if c not in ("station_id", "position")]
    return (
        reports.groupBy("position")
        .agg(F.max(F.struct(*rest)).alias("s"))
        .select(
            F.col("position").cast("string").alias("station_id"),
            "s.num_bikes_available",
            "s.num_docks_available",
            "s.is_installed",
            "s.is_renting",
            "s.is_returning",
            (F.unix_date(F.col("s.reported_at").cast("date")).cast("bigint") * 86400).alias("last_reported"),
            F.lit("en").alias("lang"),
            "position",
        )
    )


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """Trip stations: customers, with their nation as the zone."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").cast("int").alias("Code"), F.col("n_name").alias("Arrondisse"))
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as trips; some codes lie past the last station and stay unmatched."""
    return table(spark, folder, "orders").select(
        (F.col("o_custkey") + F.pmod("o_orderkey", F.lit(10))).cast("int").alias("start_station_code"),
        (F.col("o_custkey") + F.pmod("o_orderkey", F.lit(50))).cast("int").alias("end_station_code"),
        F.col("o_orderdate").alias("start_date"),
    )


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Events as polled snapshots of a station, without its static columns."""
    return table(spark, folder, "events").select(
        F.col("ts").alias("snapshot_time"),
        F.col("user_id").cast("string").alias("station_id"),
        F.pmod(F.floor("value"), F.lit(50)).cast("int").alias("num_bikes_available"),
        F.pmod("event_id", F.lit(20)).cast("int").alias("num_docks_available"),
        (F.col("event_type") != "error").alias("is_renting"),
    )


def usage_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a log of answered questions."""
    return table(spark, folder, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("props").alias("question"),
        F.col("event_type").alias("tool_used"),
        F.floor("value").alias("execution_time_ms"),
        (F.col("event_type") != "error").alias("success"),
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("url", "html")


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """User turns of the conversations."""
    return (
        table(spark, folder, "conversations")
        .filter(F.col("role") == "user")
        .select("conv_id", "turn", F.col("text").alias("question"))
    )


def locations(spark: SparkSession, folder: str) -> DataFrame:
    """Query points: the first two vector entries moved into the stations' box."""
    at = lambda i: F.element_at("embedding", i).cast("double")
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("location_id"),
        (F.lit(45.5) + at(1)).alias("lat"),
        (F.lit(-73.75) + at(2)).alias("lon"),
    )
