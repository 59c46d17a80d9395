"""Snapshot history: rows, recent windows, station-day series, trends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockline.functions import columns as C
from dockline.operators.stations import latest_per_key


def history_rows(stations: DataFrame, snapshot_time: Column | None = None) -> DataFrame:
    """Merged stations in the shape of the history table.

    ``snapshot_date`` is the partition column; it is derived, since a table
    cannot be partitioned by an expression.
    """
    taken = F.current_timestamp() if snapshot_time is None else snapshot_time
    return stations.select(
        taken.alias("snapshot_time"),
        "station_id",
        F.col("name").alias("station_name"),
        "lat", "lon", "capacity", "num_bikes_available", "num_docks_available", "is_renting",
        C.utilization_pct().alias("utilization_pct"),
        taken.cast("date").alias("snapshot_date"),
    )


def snapshot_history(snapshots: DataFrame, info: DataFrame) -> DataFrame:
    """Polled snapshots completed with the static columns of their station.

    A station that the information holds more than once counts with its last row (with any of them where no
    position orders the rows).
    """
    placed = info if "position" in info.columns else info.withColumn("position", F.lit(0))
    static = latest_per_key(placed.select("station_id", "name", "lat", "lon", "capacity", "position")).drop("position")
    return history_rows(snapshots.join(static, "station_id", "left"), F.col("snapshot_time"))


def since(history: DataFrame, anchor: dt.date, days: int = 7, time: str = "snapshot_time") -> DataFrame:
    """Rows of the last ``days`` days before ``anchor``, and later ones.

    Where the table has its partition column the bound is put on that too, so
    older partitions are not listed.
    """
    first = anchor - dt.timedelta(days=days)
    recent = history.filter(F.col(time) >= F.lit(first))
    if "snapshot_date" in history.columns:
        recent = recent.filter(F.col("snapshot_date") >= F.lit(first))
    return recent


def latest_rows(history: DataFrame, k: int = 20) -> DataFrame:
    return (
        history.select("snapshot_time", "station_name", "num_bikes_available", "num_docks_available",
                       "utilization_pct", "station_id")
        .orderBy(F.col("snapshot_time").desc(), F.col("num_bikes_available").desc(), "station_id")
        .limit(k)
        .drop("station_id")
    )


def station_day_series(history: DataFrame) -> DataFrame:
    """Average, largest and smallest bike count and mean utilisation per station and day."""
    return (
        history.groupBy("station_name", F.col("snapshot_time").cast("date").alias("date"))
        .agg(
            F.avg("num_bikes_available").alias("avg_bikes"),
            F.max("num_bikes_available").alias("max_bikes"),
            F.min("num_bikes_available").alias("min_bikes"),
            # Tenths are summed as integers: exact whatever the order of rows.
            (F.avg(F.round(F.col("utilization_pct") * 10).cast("bigint")) / 10).alias("avg_utilization"),
        )
    )


def bikes_per_poll(snapshots: DataFrame) -> DataFrame:
    """Total bikes of each poll."""
    return snapshots.groupBy("snapshot_time").agg(
        F.sum(C.count_of("num_bikes_available")).alias("total_bikes"))


def tool_usage(log: DataFrame, anchor: dt.date | None = None) -> DataFrame:
    """Answers and mean time per tool, busiest first; from ``anchor`` on if given."""
    if anchor is not None:
        log = since(log, anchor, days=0, time="timestamp")
    return (
        log.groupBy("tool_used")
        .agg(F.count("*").alias("usage_count"), F.avg("execution_time_ms").alias("avg_time_ms"))
        .orderBy(F.col("usage_count").desc(), "tool_used")
    )
