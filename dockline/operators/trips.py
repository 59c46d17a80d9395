"""Trips with zones, zone-day counts, and the reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockline.functions import columns as C


SPREAD = 4096


def spread_key(code: Column, *row: Column) -> Column:
    """A join key that a missing code spreads over SPREAD values, which no real code has.

    One column that depends on the row: a second key part that is constant on the other side would be folded
    into a filter, and all missing codes would meet in one task.
    """
    return F.coalesce(F.concat(F.lit("="), code.cast("string")),
                      F.concat(F.lit("?"), F.pmod(F.xxhash64(*row), F.lit(SPREAD)).cast("string")))


def _look_up_zone(trips: DataFrame, stations: DataFrame, code: str, zone: str) -> DataFrame:
    """Adds the zone of one code column; trips without a code match nothing and are spread by their contents."""
    known = stations.where(F.col("Code").isNotNull()).select(
        F.concat(F.lit("="), F.col("Code").cast("string")).alias("__key"), F.col("Arrondisse").alias(zone))
    return (
        trips.withColumn("__key", spread_key(F.col(code), *(F.col(c) for c in trips.columns)))
        .join(known, "__key", "left").select(*trips.columns, zone)
    )


def start_zones(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Every trip with the zone of its start."""
    return _look_up_zone(trips, stations, "start_station_code", "start_zone")


def merge_trips_with_stations(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Every trip with the zone of its start and of its end; NULL if unknown.

    Only code and zone of the stations travel. A station list small enough is
    broadcast by size; a larger one is shuffled, and a start station with a
    large share of the trips is split by adaptive execution. NULL codes match
    nothing.
    """
    return _look_up_zone(start_zones(trips, stations), stations, "end_station_code", "end_zone")


def drop_unzoned(trips: DataFrame) -> DataFrame:
    return trips.na.drop(subset=["start_zone"])


def unzoned_report(trips: DataFrame) -> DataFrame:
    """Trips before, kept and removed by ``drop_unzoned``, in one pass."""
    return trips.agg(
        F.count("*").alias("trips_total"),
        F.count("start_zone").alias("trips_kept"),
        (F.count("*") - F.count("start_zone")).alias("trips_removed"),
    )


def _with_calendar(counted: DataFrame) -> DataFrame:
    return counted.select("*", *[c.alias(n) for n, c in C.calendar_basics(F.col("start_date")).items()])


def zone_day_counts(trips: DataFrame) -> DataFrame:
    """Trips per start zone and date, with calendar columns; trips without a zone do not count."""
    counted = (
        trips.filter(F.col("start_zone").isNotNull())
        .groupBy("start_zone", F.col("start_date").cast("date").alias("start_date"))
        .agg(F.count("*").alias("trip_count"))
    )
    return _with_calendar(counted)


def zone_day_counts_of(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """``zone_day_counts(merge_trips_with_stations(...))`` without moving single trips.

    Trips are first counted per start code and date. What is joined is one row
    per station and day however busy the station is, and the end zone, which
    the counts do not need, is never looked up.
    """
    per_code = (
        trips.groupBy("start_station_code", F.col("start_date").cast("date").alias("start_date"))
        .agg(F.count("*").alias("n"))
    )
    zone_of = stations.select(F.col("Code").alias("start_station_code"), F.col("Arrondisse").alias("start_zone"))
    counted = (
        per_code.join(zone_of, "start_station_code")
        .filter(F.col("start_zone").isNotNull())
        .groupBy("start_zone", "start_date")
        .agg(F.sum("n").alias("trip_count"))
    )
    return _with_calendar(counted)


def advanced_features(zone_days: DataFrame) -> DataFrame:
    """Adds calendar details, cyclical encodings and the mean count of the zone.

    The zone mean is aggregated and joined back instead of computed in a
    window, which would bring all days of a zone to one task.
    """
    date = F.col("start_date")
    extra = {
        **C.calendar_details(date),
        **C.cyclical(F.col("day_of_week"), 7, "day"),
        **C.cyclical(F.col("month"), 12, "month"),
    }
    means = zone_means(zone_days)
    return (
        zone_days.select("*", *[c.alias(n) for n, c in extra.items()])
        .join(means, "start_zone", "left")
    )


def zone_means(zone_days: DataFrame) -> DataFrame:
    return zone_days.groupBy("start_zone").agg(F.avg("trip_count").alias("zone_avg_trips"))


def _per_day(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy(F.col("start_date").cast("date").alias("trip_date"))
        .agg(F.count("*").alias("trips"))
    )


def daily_summary(trips: DataFrame) -> DataFrame:
    """Mean trips per day, the peak day (the first one on a tie) and its count."""
    return _per_day(trips).agg(
        F.avg("trips").alias("mean_trips"),
        F.min_by("trip_date", F.struct(-F.col("trips"), F.col("trip_date"))).alias("peak_day"),
        F.max("trips").alias("peak_trips"),
    )


def date_coverage(trips: DataFrame) -> DataFrame:
    """First and last date, days covered, trips per covered day."""
    date = F.col("start_date").cast("date")
    spans = trips.agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count("*").alias("trips"),
    )
    return (
        spans.withColumn("days_covered", F.date_diff("last_date", "first_date") + 1)
        .withColumn("trips_per_day", F.try_divide(F.col("trips").cast("double"), F.col("days_covered").cast("double")))
    )


def _in_domain(counted: DataFrame, key: str, labels: list[str], name: str) -> DataFrame:
    """All labels of a fixed list with their counts, NULL where there is none."""
    places = counted.sparkSession.createDataFrame(
        [(i, label) for i, label in enumerate(labels)], f"{key} int, {name} string")
    return places.join(counted, key, "left").orderBy(key)


def trips_by_weekday(trips: DataFrame) -> DataFrame:
    counted = (
        trips.groupBy(F.weekday(F.col("start_date")).alias("place")).agg(F.count("*").alias("trips"))
    )
    return _in_domain(counted, "place", C.WEEKDAYS, "weekday").select("weekday", "trips")


def trips_by_month(trips: DataFrame) -> DataFrame:
    counted = (
        trips.groupBy((F.month("start_date") - 1).alias("place")).agg(F.count("*").alias("trips"))
    )
    return _in_domain(counted, "place", C.MONTHS, "month_name").select("month_name", "trips")


def stations_per_zone(stations: DataFrame, k: int | None = 10) -> DataFrame:
    counted = (
        stations.filter(F.col("Arrondisse").isNotNull())
        .groupBy(F.col("Arrondisse").alias("zone"))
        .agg(F.count("*").alias("stations"))
        .orderBy(F.col("stations").desc(), "zone")
    )
    return counted if k is None else counted.limit(k)


def zone_count(stations: DataFrame) -> DataFrame:
    return stations.agg(F.count_distinct("Arrondisse").alias("zones"))


def distinct_zones(zone_days: DataFrame, k: int | None = None) -> DataFrame:
    zones = zone_days.select("start_zone").distinct().orderBy("start_zone")
    return zones if k is None else zones.limit(k)
