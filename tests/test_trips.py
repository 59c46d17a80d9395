import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from dockline.operators import history as H
from dockline.operators import profile as PF
from dockline.operators import trips as O
from dockline.sources.sample import sample_trips

TRIPS = "start_station_code int, end_station_code int, start_date timestamp_ntz"
ZONES = "Code int, Arrondisse string, Latitude double, Longitude double"


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, "Plateau-Mont-Royal", 45.52, -73.58), (2, "Ville-Marie", 45.5, -73.57), (3, None, 0.0, 0.0)], ZONES)


@pytest.fixture
def trips(spark):
    return spark.createDataFrame([
        (1, 2, at("2016-01-01 08:00:00")), (2, 1, at("2016-01-02")), (1, 2, at("2016-01-01 09:30:00")),
        (9, 1, at("2016-01-03")), (None, 2, at("2016-01-03")), (3, 3, at("2016-01-03"))], TRIPS)


def test_merge_adds_both_zones_and_keeps_unmatched(trips, zones):
    merged = O.merge_trips_with_stations(trips, zones)
    assert merged.columns == ["start_station_code", "end_station_code", "start_date", "start_zone", "end_zone"]
    assert rows(merged, "start_station_code", "start_zone", "end_zone") == sorted([
        (1, "Plateau-Mont-Royal", "Ville-Marie"), (1, "Plateau-Mont-Royal", "Ville-Marie"),
        (2, "Ville-Marie", "Plateau-Mont-Royal"), (9, None, "Plateau-Mont-Royal"),
        (None, None, "Ville-Marie"), (3, None, None)], key=str)
    assert tuple(O.unzoned_report(merged).first()) == (6, 3, 3)
    assert O.drop_unzoned(merged).count() == 3


def test_duplicate_station_code_multiplies_trips(spark, trips, zones):
    twice = zones.union(spark.createDataFrame([(1, "Annexe", 0.0, 0.0)], ZONES))
    assert O.merge_trips_with_stations(trips.filter("start_station_code = 1"), twice).count() == 4
    assert rows(O.zone_day_counts_of(trips, twice)) == rows(
        O.zone_day_counts(O.merge_trips_with_stations(trips.select("start_station_code", F.lit(None).cast("int").alias("end_station_code"), "start_date"), twice)))


def test_zone_day_counts(trips, zones):
    want = [("Plateau-Mont-Royal", dt.date(2016, 1, 1), 2, 4, 1, False), ("Ville-Marie", dt.date(2016, 1, 2), 1, 5, 1, True)]
    assert rows(O.zone_day_counts(O.merge_trips_with_stations(trips, zones))) == want
    assert rows(O.zone_day_counts_of(trips, zones)) == want


def test_advanced_features(trips, zones):
    got = {r.start_zone: r for r in O.advanced_features(O.zone_day_counts_of(trips, zones)).collect()}
    row = got["Ville-Marie"]
    assert (row.year, row.quarter, row.day_of_year, row.week_of_year, row.hour) == (2016, 1, 2, 53, 0)
    assert row.season == "Winter" and row.is_friday is False and got["Plateau-Mont-Royal"].is_friday is True
    assert row.is_holiday is False and row.zone_avg_trips == 1.0
    assert np.isclose(row.day_sin, np.sin(2 * np.pi * 5 / 7)) and np.isclose(row.month_cos, np.cos(2 * np.pi / 12))


def test_daily_reports(trips):
    got = O.daily_summary(trips).first()
    assert (got.mean_trips, got.peak_day, got.peak_trips) == (2.0, dt.date(2016, 1, 3), 3)
    spread = O.date_coverage(trips).first()
    assert (spread.first_date, spread.last_date, spread.days_covered, spread.trips_per_day) == (
        dt.date(2016, 1, 1), dt.date(2016, 1, 3), 3, 2.0)


def test_peak_day_is_the_first_on_a_tie(spark):
    tied = spark.createDataFrame([(1, 2, at("2016-05-02")), (1, 2, at("2016-05-01"))], TRIPS)
    assert O.daily_summary(tied).first().peak_day == dt.date(2016, 5, 1)


def test_weekdays_and_months_keep_empty_places(trips):
    weekdays = [tuple(r) for r in O.trips_by_weekday(trips).collect()]
    assert weekdays == [("Monday", None), ("Tuesday", None), ("Wednesday", None), ("Thursday", None), ("Friday", 2), ("Saturday", 1), ("Sunday", 3)]
    months = [tuple(r) for r in O.trips_by_month(trips).collect()]
    assert months[0] == ("January", 6) and months[11] == ("December", None) and len(months) == 12


def test_zone_reports(zones):
    assert rows(O.stations_per_zone(zones)) == [("Plateau-Mont-Royal", 1), ("Ville-Marie", 1)]
    assert O.zone_count(zones).first().zones == 2


@pytest.mark.parametrize("values", [
    [5], [1, 2], [3, 3, 3, 3], [1] * 400 + list(range(2, 300)), [0.5, -1.25, 7.0, 2.5, 2.5, 100.0], list(range(1000, 0, -1)) + [None, None]])
def test_describe_equals_pandas(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    got = PF.describe(df, "x").first()
    want = pd.Series([v for v in values if v is not None], dtype=float).describe()
    assert got["count"] == want["count"]
    for ours, theirs in (("mean", "mean"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert np.isclose(got[ours], want[theirs]), ours
    assert got["std"] is None if np.isnan(want["std"]) else np.isclose(got["std"], want["std"])


@pytest.mark.parametrize("values", [[1, 2, 2, 3, 10], [4, 4, 4], list(range(101))])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = PF.histogram(df, "x", 10).collect()
    counts, edges = np.histogram(values, bins=10)
    assert [r.rows_in_bin for r in got] == counts.tolist()
    assert np.allclose([r.bin_start for r in got], edges[:-1]) and np.isclose(got[-1].bin_end, edges[-1])


def test_sample_trips(zones):
    made = sample_trips(zones, dt.date(2016, 5, 1), 40)
    per_day = {r.d: r.n for r in made.groupBy(F.to_date("start_date").alias("d")).agg(F.count("*").alias("n")).collect()}
    assert len(per_day) == 40
    assert 30 <= per_day[dt.date(2016, 5, 2)] <= 55 and 50 <= per_day[dt.date(2016, 5, 1)] <= 75
    assert 80 <= per_day[dt.date(2016, 6, 4)] <= 105
    assert made.filter("start_station_code = end_station_code").count() == 0
    assert made.select("start_station_code").distinct().count() == 3


HISTORY = "snapshot_time timestamp, station_id string, station_name string, num_bikes_available int, " \
          "num_docks_available int, utilization_pct double"


@pytest.fixture
def history(spark):
    return spark.createDataFrame([
        (at("2024-01-01 10:00:00"), "a", "A", 4, 6, 40.0), (at("2024-01-01 10:15:00"), "a", "A", 7, 3, 70.0),
        (at("2024-01-08 10:00:00"), "a", "A", 1, 9, 10.0), (at("2024-01-08 10:00:00"), "b", "B", 3, 9, 25.0)], HISTORY)


def test_series_and_recent(history):
    series = {(r.station_name, r.date): r for r in H.station_day_series(history).collect()}
    day = series["A", dt.date(2024, 1, 1)]
    assert (day.avg_bikes, day.max_bikes, day.min_bikes, day.avg_utilization) == (5.5, 7, 4, 55.0)
    assert H.since(history, dt.date(2024, 1, 9), 7).count() == 2
    assert [r.station_name for r in H.latest_rows(history, 3).collect()] == ["B", "A", "A"]
    assert rows(H.bikes_per_poll(history), "total_bikes") == [(4,), (4,), (7,)]


def test_tool_usage(spark):
    log = spark.createDataFrame([
        (at("2024-01-01 10:00:00"), "q", "x", 10, True), (at("2024-01-02 10:00:00"), "q", "x", 30, True),
        (at("2024-01-02 11:00:00"), "q", "y", 5, False)],
        "timestamp timestamp, question string, tool_used string, execution_time_ms long, success boolean")
    assert [tuple(r) for r in H.tool_usage(log).collect()] == [("x", 2, 20.0), ("y", 1, 5.0)]
    assert [tuple(r) for r in H.tool_usage(log, dt.date(2024, 1, 2)).collect()] == [("x", 1, 30.0), ("y", 1, 5.0)]


def test_missing_codes_are_spread_by_the_join_key(spark):
    """With broadcasting off, the trips are shuffled by the key that spreads missing codes."""
    trips = spark.createDataFrame([(None, i, dt.datetime(2016, 1, 1 + i % 28)) for i in range(200)],
                                  "start_station_code int, end_station_code int, start_date timestamp")
    zones = spark.createDataFrame([(1, "A"), (None, "nowhere")], "Code int, Arrondisse string")
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        joined = O.start_zones(trips, zones)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(__key" in plan and joined.where("start_zone IS NULL").count() == 200
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert trips.select(O.spread_key(F.col("start_station_code"), F.col("end_station_code"))).distinct().count() > 150
