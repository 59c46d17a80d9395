"""Trips, zone-day counts, reports, features, history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dockline.functions import columns as C
from dockline.operators import forecast as FC
from dockline.operators import history as H
from dockline.operators import profile as PF
from dockline.operators import trips as O
from dockline.plans.registry import HISTORY, INFO, LOG, SNAPSHOTS, TRIPS, ZONE_DAYS, ZONES, query, with_tables
from dockline.sources import tables as T

DAYS = with_tables(ZONES, TRIPS, ZONE_DAYS)
PAST = with_tables(INFO, SNAPSHOTS, HISTORY)
# The tables end in the past, so "today" is given.
TODAY = dt.date(2024, 1, 28)


def _zoned(spark, folder):
    return O.merge_trips_with_stations(T.trips(spark, folder), T.zones(spark, folder))


def _zone_days(spark, folder):
    return O.zone_day_counts_of(T.trips(spark, folder), T.zones(spark, folder))


def _history(spark, folder):
    return H.snapshot_history(T.snapshots(spark, folder), T.station_information(spark, folder))


@query("trips_with_zones", with_tables(ZONES, TRIPS) + """
    SELECT t.*, s.zone AS start_zone, e.zone AS end_zone FROM trips t
    LEFT JOIN zones s ON t.start_station_code = s.code LEFT JOIN zones e ON t.end_station_code = e.code""")
def trips_with_zones(spark, folder):
    return _zoned(spark, folder)


@query("zoned_trips_only", with_tables(ZONES, TRIPS) + """
    SELECT t.*, s.zone AS start_zone, e.zone AS end_zone FROM trips t
    JOIN zones s ON t.start_station_code = s.code LEFT JOIN zones e ON t.end_station_code = e.code""")
def zoned_trips_only(spark, folder):
    return O.drop_unzoned(_zoned(spark, folder))


@query("unzoned_trip_report", with_tables(ZONES, TRIPS) + """
    SELECT count(*) AS trips_total, count(zone) AS trips_kept, count(*) - count(zone) AS trips_removed
    FROM trips LEFT JOIN zones ON start_station_code = code""")
def unzoned_trip_report(spark, folder):
    return O.unzoned_report(O.start_zones(T.trips(spark, folder), T.zones(spark, folder)))


@query("dates_from_text", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def dates_from_text(spark, folder):
    """Dates from texts that hold a date, a date and a time, no date, or nothing."""
    kind = F.pmod("o_orderkey", F.lit(4))
    text = F.when(kind == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(
        kind == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(kind == 2, F.concat(F.lit("on "), "o_orderpriority"))
    return T.table(spark, folder, "orders").select("o_orderkey", C.as_date(text).alias("day"))


@query("zone_day_counts", DAYS + "SELECT * FROM zone_days")
def zone_day_counts(spark, folder):
    return _zone_days(spark, folder)


@query("zone_day_counts_from_zoned_trips", DAYS + "SELECT * FROM zone_days")
def zone_day_counts_from_zoned_trips(spark, folder):
    """The same counts from trips that already carry their zones."""
    return O.zone_day_counts(_zoned(spark, folder))


@query("advanced_trip_features", DAYS + """
    SELECT *, CAST(year(start_date) AS INTEGER) AS year, CAST(quarter(start_date) AS INTEGER) AS quarter,
      CAST(dayofyear(start_date) AS INTEGER) AS day_of_year, CAST(weekofyear(start_date) AS INTEGER) AS week_of_year,
      CAST(0 AS INTEGER) AS hour,
      CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
           WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
      month IN (7, 12) AS is_holiday, day_of_week = 0 AS is_monday, day_of_week = 4 AS is_friday,
      round(sin(2 * pi() * day_of_week / 7), 9) + 0 AS day_sin, round(cos(2 * pi() * day_of_week / 7), 9) + 0 AS day_cos,
      round(sin(2 * pi() * month / 12), 9) + 0 AS month_sin, round(cos(2 * pi() * month / 12), 9) + 0 AS month_cos,
      avg(trip_count) OVER (PARTITION BY start_zone) AS zone_avg_trips
    FROM zone_days""")
def advanced_trip_features(spark, folder):
    features = O.advanced_features(_zone_days(spark, folder))
    # Sines are rounded for the comparison only; adding 0 turns -0.0 into 0.0.
    return features.withColumns({
        n: F.round(n, 9) + F.lit(0.0) for n in ("day_sin", "day_cos", "month_sin", "month_cos")})


@query("zone_means", DAYS + "SELECT start_zone, avg(trip_count) AS zone_avg_trips FROM zone_days GROUP BY 1")
def zone_means(spark, folder):
    return O.zone_means(_zone_days(spark, folder))


@query("daily_trip_summary", with_tables(TRIPS) + """
    , days AS (SELECT CAST(start_date AS DATE) AS d, count(*) AS n FROM trips GROUP BY 1)
    SELECT avg(n) AS mean_trips, (SELECT d FROM days ORDER BY n DESC, d LIMIT 1) AS peak_day, max(n) AS peak_trips FROM days""")
def daily_trip_summary(spark, folder):
    return O.daily_summary(T.trips(spark, folder))


@query("trips_by_weekday", with_tables(TRIPS) + """
    SELECT dayname(start_date) AS weekday, count(*) AS trips FROM trips GROUP BY 1""")
def trips_by_weekday(spark, folder):
    return O.trips_by_weekday(T.trips(spark, folder))


@query("trips_by_month", with_tables(TRIPS) + """
    SELECT monthname(start_date) AS month_name, count(*) AS trips FROM trips GROUP BY 1""")
def trips_by_month(spark, folder):
    return O.trips_by_month(T.trips(spark, folder))


@query("stations_per_zone", with_tables(ZONES) + """
    SELECT zone, count(*) AS stations FROM zones GROUP BY 1 ORDER BY stations DESC, zone LIMIT 10""")
def stations_per_zone(spark, folder):
    return O.stations_per_zone(T.zones(spark, folder), 10)


@query("zone_count", with_tables(ZONES) + "SELECT count(DISTINCT zone) AS zones FROM zones")
def zone_count(spark, folder):
    return O.zone_count(T.zones(spark, folder))


@query("distinct_zones", DAYS + "SELECT DISTINCT start_zone FROM zone_days ORDER BY 1 LIMIT 5")
def distinct_zones(spark, folder):
    return O.distinct_zones(_zone_days(spark, folder), 5)


@query("trip_date_coverage", with_tables(TRIPS) + """
    SELECT *, CAST(trips AS DOUBLE) / days_covered AS trips_per_day FROM (
      SELECT CAST(min(start_date) AS DATE) AS first_date, CAST(max(start_date) AS DATE) AS last_date, count(*) AS trips,
             CAST(date_diff('day', CAST(min(start_date) AS DATE), CAST(max(start_date) AS DATE)) + 1 AS INTEGER) AS days_covered
      FROM trips)""")
def trip_date_coverage(spark, folder):
    return O.date_coverage(T.trips(spark, folder))


@query("trip_count_distribution", DAYS + """
    SELECT count(*) AS count, avg(trip_count) AS mean, round(stddev_samp(trip_count), 6) AS std,
           CAST(min(trip_count) AS DOUBLE) AS min, CAST(quantile_cont(trip_count, 0.25) AS DOUBLE) AS q25,
           CAST(quantile_cont(trip_count, 0.5) AS DOUBLE) AS q50, CAST(quantile_cont(trip_count, 0.75) AS DOUBLE) AS q75,
           CAST(max(trip_count) AS DOUBLE) AS max
    FROM zone_days""")
def trip_count_distribution(spark, folder):
    return PF.describe(_zone_days(spark, folder), "trip_count").withColumn("std", F.round("std", 6))


@query("order_price_distribution", """
    SELECT count(*) AS count, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 3) AS std,
           min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 4) AS q25,
           round(quantile_cont(o_totalprice, 0.5), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75,
           max(o_totalprice) AS max FROM orders""")
def order_price_distribution(spark, folder):
    """The summary over a column of nearly distinct values."""
    described = PF.describe(T.table(spark, folder, "orders"), "o_totalprice")
    return described.withColumns({
        "mean": F.round("mean", 4), "std": F.round("std", 3),
        **{q: F.round(q, 4) for q in ("q25", "q50", "q75")}})


@query("trip_count_histogram", DAYS + """
    , ends AS (SELECT CAST(min(trip_count) AS DOUBLE) AS lo, CAST(max(trip_count) AS DOUBLE) AS hi FROM zone_days)
    , filled AS (SELECT CAST(least(floor((trip_count - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
                 FROM zone_days, ends GROUP BY 1)
    SELECT CAST(b.range AS INTEGER) AS bin, lo + b.range * ((hi - lo) / 50) AS bin_start,
           lo + (b.range + 1) * ((hi - lo) / 50) AS bin_end, coalesce(n, 0) AS rows_in_bin
    FROM range(50) b CROSS JOIN ends LEFT JOIN filled ON filled.bin = b.range""")
def trip_count_histogram(spark, folder):
    return PF.histogram(_zone_days(spark, folder), "trip_count", 50)


# --- snapshot history ------------------------------------------------------

@query("snapshot_history", PAST + "SELECT * FROM history")
def snapshot_history(spark, folder):
    return _history(spark, folder)


SERIES = """SELECT station_name, CAST(snapshot_time AS DATE) AS date, avg(num_bikes_available) AS avg_bikes,
    max(num_bikes_available) AS max_bikes, min(num_bikes_available) AS min_bikes,
    avg(CAST(round(utilization_pct * 10) AS BIGINT)) / 10 AS avg_utilization FROM history"""


@query("station_day_series", PAST + SERIES + " GROUP BY 1, 2")
def station_day_series(spark, folder):
    return H.station_day_series(_history(spark, folder))


@query("station_day_series_last_week", PAST + SERIES
       + f" WHERE snapshot_time >= DATE '{TODAY}' - INTERVAL 7 DAYS GROUP BY 1, 2 ORDER BY station_name, date LIMIT 50")
def station_day_series_last_week(spark, folder):
    recent = H.since(_history(spark, folder), TODAY, 7)
    return H.station_day_series(recent).orderBy("station_name", "date").limit(50)


@query("latest_snapshot_rows", PAST + """
    SELECT snapshot_time, station_name, num_bikes_available, num_docks_available, utilization_pct
    FROM history ORDER BY snapshot_time DESC, num_bikes_available DESC, station_id LIMIT 20""")
def latest_snapshot_rows(spark, folder):
    return H.latest_rows(_history(spark, folder), 20)


@query("bikes_per_poll", with_tables(SNAPSHOTS) + """
    SELECT snapshot_time, CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes FROM snapshots GROUP BY 1""")
def bikes_per_poll(spark, folder):
    return H.bikes_per_poll(T.snapshots(spark, folder))


@query("tool_usage", with_tables(LOG) + """
    SELECT tool_used, count(*) AS usage_count, avg(execution_time_ms) AS avg_time_ms FROM log GROUP BY 1""")
def tool_usage(spark, folder):
    return H.tool_usage(T.usage_log(spark, folder))


@query("tool_usage_since", with_tables(LOG) + f"""
    SELECT tool_used, count(*) AS usage_count, avg(execution_time_ms) AS avg_time_ms FROM log
    WHERE timestamp >= DATE '{TODAY}' GROUP BY 1""")
def tool_usage_since(spark, folder):
    return H.tool_usage(T.usage_log(spark, folder), TODAY)


# --- model input -----------------------------------------------------------

HASH = "CAST(CAST('0x' || substr(md5(start_zone || '|' || CAST(start_date AS VARCHAR) || '|{seed}'), 1, 8) AS UBIGINT) % 2147483648 AS BIGINT)"
BUCKET = HASH.format(seed=42)
TEST_BELOW = 429496730  # a fifth of 2^31
MEANS = f"""
    , parts AS (SELECT *, CASE WHEN {BUCKET} < {TEST_BELOW} THEN 'test' ELSE 'train' END AS part FROM zone_days)
    , means AS (SELECT start_zone, avg(trip_count) AS prediction FROM parts WHERE part = 'train' GROUP BY 1)
    , predicted AS (SELECT part, trip_count, prediction FROM parts JOIN means USING (start_zone))"""


@query("train_test_split", DAYS + f"""
    SELECT start_zone, start_date, trip_count, CASE WHEN {BUCKET} < {TEST_BELOW} THEN 'test' ELSE 'train' END AS part FROM zone_days""")
def train_test_split(spark, folder):
    train, test = FC.train_test(_zone_days(spark, folder))
    labelled = lambda df, name: df.select("start_zone", "start_date", "trip_count", F.lit(name).alias("part"))
    return labelled(train, "train").unionByName(labelled(test, "test"))


@query("one_hot_features", DAYS + "SELECT day_of_week, month, is_weekend, trip_count, start_date, " + ", ".join(
    f"CAST(start_zone = 'NATION_{i}' AS INTEGER) AS zone_NATION_{i}" for i in range(25)) + " FROM zone_days")
def one_hot_features(spark, folder):
    """Wide one-hot form; the columns are the zones that occur."""
    days = _zone_days(spark, folder)
    zones = [r["zone"] for r in T.zones(spark, folder).select(F.col("Arrondisse").alias("zone")).distinct().orderBy("zone").collect()]
    return FC.one_hot(days, {"start_zone": zones})


@query("zone_mean_model_metrics", DAYS + MEANS + """
    SELECT part, round(1 - sum((trip_count - prediction) ** 2) / (var_pop(trip_count) * count(*)), 6) AS r2,
           round(avg(abs(trip_count - prediction)), 6) AS mae,
           round(sqrt(avg((trip_count - prediction) ** 2)), 6) AS rmse
    FROM predicted GROUP BY part""")
def zone_mean_model_metrics(spark, folder):
    """Regression metrics of the zone-mean predictor on both parts."""
    days = _zone_days(spark, folder).withColumn("part", FC.split_column())
    means = days.filter(F.col("part") == "train").groupBy("start_zone").agg(F.avg("trip_count").alias("prediction"))
    scored = FC.metrics(days.join(means, "start_zone"), by="part")
    return scored.select("part", *[F.round(n, 6).alias(n) for n in ("r2", "mae", "rmse")])
