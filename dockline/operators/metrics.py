"""System metrics. Every report costs one scan of each feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from dockline.functions import columns as C

# --- fixed values: rungs of the availability ladder and dashboard lines ----
LADDER = [
    ("All stations", "total_stations"),
    ("5+ bikes", "bikes_5"),
    ("10+ bikes", "bikes_10"),
    ("20+ bikes", "bikes_20"),
    ("5+ docks", "docks_5"),
    ("10+ docks", "docks_10"),
]
DASHBOARD = [
    ("System Overview", "Total Stations", "total_stations"),
    ("System Overview", "Operational Stations", "operational_stations"),
    ("Availability", "Total Bikes", "total_bikes"),
    ("Availability", "Total Docks", "total_docks"),
    ("Capacity", "System Capacity", "capacity"),
    ("Utilization", "Utilization %", "utilization_int"),
]
# --------------------------------------------------------------------------


def _total(name: str) -> Column:
    return F.coalesce(F.sum(F.col(name).cast("bigint")), F.lit(0).cast("bigint"))


def total_bikes(status: DataFrame) -> DataFrame:
    return status.agg(_total("num_bikes_available").alias("total_bikes"))


def total_docks(status: DataFrame) -> DataFrame:
    return status.agg(_total("num_docks_available").alias("total_docks"))


def system_capacity(info: DataFrame) -> DataFrame:
    return info.agg(_total("capacity").alias("capacity"))


def count_stations(info: DataFrame) -> DataFrame:
    return info.agg(F.count("*").alias("total_stations"))


def count_operational(status: DataFrame) -> DataFrame:
    return status.agg(F.count_if(C.flag("is_renting")).alias("operational_stations"))


def count_installed(status: DataFrame) -> DataFrame:
    return status.agg(F.count_if(C.flag("is_installed")).alias("installed_stations"))


def count_with_bikes(status: DataFrame, min_bikes: int = 1) -> DataFrame:
    return status.agg(F.count_if(C.has_bikes(min_bikes)).alias("stations"))


def count_with_docks(status: DataFrame, min_docks: int = 1) -> DataFrame:
    return status.agg(F.count_if(C.has_docks(min_docks)).alias("stations"))


def count_empty_and_full(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count_if(C.count_of("num_bikes_available") == 0).alias("empty_stations"),
        F.count_if(C.count_of("num_docks_available") == 0).alias("full_stations"),
    )


def utilization(bikes: str = "total_bikes", capacity: str = "capacity") -> Column:
    """Percent of capacity in use; 0 for a system without capacity."""
    share = F.try_divide(F.col(bikes).cast("double"), F.col(capacity).cast("double"))
    return F.when(F.col(capacity) == 0, F.lit(0.0)).otherwise(share * F.lit(100.0))


def feed_metrics(info: DataFrame, status: DataFrame) -> DataFrame:
    """All system metrics over the two unjoined feeds, as one row.

    Each feed is reduced on its own and the two one-row results are unioned
    and folded, so there is neither a join nor a second scan.
    """
    known = info.agg(
        F.count("*").alias("total_stations"),
        _total("capacity").alias("capacity"),
    )
    rungs = [F.count_if(C.has_bikes(n)).alias(f"bikes_{n}") for n in (1, 5, 10, 20)]
    rungs += [F.count_if(C.has_docks(n)).alias(f"docks_{n}") for n in (1, 5, 10)]
    live = status.agg(
        F.count_if(C.flag("is_renting")).alias("operational_stations"),
        _total("num_bikes_available").alias("total_bikes"),
        _total("num_docks_available").alias("total_docks"),
        *rungs,
    )
    both = known.unionByName(live, allowMissingColumns=True)
    folded = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return folded.withColumn("utilization", utilization())


def system_utilization(info: DataFrame, status: DataFrame) -> DataFrame:
    return feed_metrics(info, status).select("utilization")


def system_report(info: DataFrame, status: DataFrame) -> DataFrame:
    return feed_metrics(info, status).select(
        "total_stations", "operational_stations", "total_bikes", "total_docks", "capacity",
        C.percent(F.col("total_bikes"), F.col("capacity"), 2).alias("utilization_pct"),
    )


def merged_summary(merged: DataFrame) -> DataFrame:
    """The same totals over joined rows only."""
    totals = merged.agg(
        F.count("*").alias("total_stations"),
        _total("num_bikes_available").alias("total_bikes"),
        _total("num_docks_available").alias("total_docks"),
        _total("capacity").alias("capacity"),
    )
    return totals.withColumn("utilization", utilization())


def _as_rows(metrics: DataFrame, lines: list[tuple], names: list[str]) -> DataFrame:
    """Chosen columns of a one-row frame as labelled rows."""
    items = [
        F.struct(*[F.lit(v).alias(n) for v, n in zip(line[:-1], names)],
                 F.col(line[-1]).cast("bigint").alias(names[-1]))
        for line in lines
    ]
    return metrics.select(F.explode(F.array(*items)).alias("line")).select("line.*")


def availability_ladder(info: DataFrame, status: DataFrame) -> DataFrame:
    return _as_rows(feed_metrics(info, status), LADDER, ["category", "count"])


def dashboard(info: DataFrame, status: DataFrame) -> DataFrame:
    whole = feed_metrics(info, status).withColumn("utilization_int", F.col("utilization").cast("bigint"))
    return _as_rows(whole, DASHBOARD, ["metric_group", "metric", "value"])


def _shares(counted: DataFrame) -> DataFrame:
    """Adds each group's share of all rows; the input has one row per label."""
    whole = F.sum("station_count").over(Window.partitionBy())
    return counted.withColumn("percentage", C.percent(F.col("station_count"), whole))


def tier_distribution(stations: DataFrame) -> DataFrame:
    tier = C.availability_tier(C.count_of("num_bikes_available")).alias("availability_tier")
    counted = stations.groupBy(tier).agg(F.count("*").alias("station_count"))
    return _shares(counted).orderBy(C.rank_in(F.col("availability_tier"), C.TIERS))


def use_distribution(stations: DataFrame) -> DataFrame:
    """Needs ``utilization_pct``; stations without capacity are left out."""
    counted = (
        stations.filter(F.col("capacity") > 0)
        .groupBy(C.use_level(F.col("utilization_pct")).alias("status"))
        .agg(F.count("*").alias("station_count"))
    )
    return _shares(counted).orderBy(C.rank_in(F.col("status"), C.USE_LEVELS))
