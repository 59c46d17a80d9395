import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import rows
from dockline import schemas as S
from dockline.operators import history as H
from dockline.sinks import tables as K
from dockline.sources import feeds as FD
from dockline.sources import files as FL


def land(folder, name, *documents):
    os.makedirs(f"{folder}/{name}", exist_ok=True)
    for i, document in enumerate(documents):
        with open(f"{folder}/{name}/{i}.json", "w", encoding="utf-8") as out:
            json.dump(document, out, indent=1, ensure_ascii=False)
    return f"{folder}/{name}"


def test_status_documents(spark, folder):
    station = {"station_id": "1", "num_bikes_available": 4, "is_renting": True, "unknown_field": [1]}
    path = land(folder, "status",
                {"last_updated": 200, "ttl": 10, "data": {"stations": [station, {"station_id": "2"}]}},
                {"last_updated": 100, "ttl": 10, "data": {"stations": [dict(station, num_bikes_available=9)]}},
                {"last_updated": 300, "data": {"stations": []}})
    got = FD.station_status(spark, path)
    assert rows(got, "station_id", "num_bikes_available", "is_renting", "last_updated") == [
        ("1", 4, True, 200), ("1", 9, True, 100), ("2", None, None, 200)]
    from dockline.operators.stations import latest_per_key
    assert rows(latest_per_key(got), "station_id", "num_bikes_available") == [("1", 4), ("2", None)]


def test_flags_fields_and_positions(spark, folder):
    path = land(folder, "flags",
                {"last_updated": 5, "data": {"stations": [{"station_id": "1", "is_renting": 1, "is_installed": "0", "is_returning": "TRUE", "more": {"x": 1}},
                                                          {"station_id": "2"}]}},
                {"last_updated": 5, "data": {"stations": [{"station_id": "1", "is_renting": 0}]}})
    got = FD.station_status(spark, path, raw=True)
    assert rows(got, "station_id", "is_renting", "is_installed", "is_returning") == [
        ("1", False, None, None), ("1", True, False, True), ("2", None, None, None)]
    assert got.select("position").distinct().count() == 3
    assert [json.loads(r.raw)["more"] for r in got.collect() if "more" in r.raw] == [{"x": 1}]
    assert FD.station_status(spark, path, newest=True).count() in (1, 2)
    broken = land(folder, "broken", {"last_updated": 5, "data": {"stations": [{"station_id": "1", "is_renting": "maybe"}]}})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        FD.station_status(spark, broken).collect()


def test_information_documents(spark, folder):
    path = land(folder, "info", {"last_updated": 1, "ttl": 5, "data": {"stations": [
        {"station_id": "1", "name": "Métro", "lat": 45.5, "lon": -73.5, "capacity": 20}]}})
    assert rows(FD.station_information(spark, path), "station_id", "name", "lat", "capacity") == [("1", "Métro", 45.5, 20)]


def test_alerts_system_and_vehicles(spark, folder):
    alerts = land(folder, "alerts", {"last_updated": 1, "ttl": 1, "data": {"alerts": [{"alert_id": "1", "summary": "Closed"}, {"alert_id": "2"}]}},
                  {"last_updated": 2, "ttl": 1, "data": {"alerts": []}})
    assert rows(FD.system_alerts(spark, alerts), "alert_id", "summary") == [("1", "Closed"), ("2", "No summary")]
    system = land(folder, "system", {"last_updated": 7, "ttl": 1, "data": {"system_id": "s", "name": "City", "language": "en", "timezone": "UTC"}})
    assert tuple(FD.system_information(spark, system).first()) == ("s", "en", "City", "UTC", 7)
    kinds = land(folder, "kinds", {"last_updated": 7, "ttl": 1, "data": {"vehicle_types": [{"vehicle_type_id": "1", "form_factor": "bicycle"}]}})
    assert rows(FD.vehicle_types(spark, kinds), "vehicle_type_id", "form_factor") == [("1", "bicycle")]


@pytest.mark.parametrize("language, expected", [("fr", [("etat", "u2")]), ("en", [("test", "u1")]), ("xyz", [("test", "u1")])])
def test_feed_list_falls_back(spark, folder, language, expected):
    path = land(folder, "feeds", {"data": {"en": {"feeds": [{"name": "test", "url": "u1"}]}, "fr": {"feeds": [{"name": "etat", "url": "u2"}]}}})
    assert rows(FD.feed_list(spark, path, language)) == expected


def test_feed_list_without_fallback_is_empty(spark, folder):
    path = land(folder, "feeds", {"data": {"de": {"feeds": [{"name": "x", "url": "y"}]}}})
    assert FD.feed_list(spark, path, "fr").count() == 0


def test_raw_documents(spark, folder):
    document = {"data": {"name": "é"}}
    got = FD.raw_documents(spark, land(folder, "raw", document)).first().json
    assert json.loads(got) == document


def test_envelopes_round_trip(spark, folder):
    stations = spark.createDataFrame([(str(i), i, i) for i in range(25)], "station_id string, num_bikes_available int, position long")
    FD.as_envelopes(stations, F.lit(5), ["station_id", "num_bikes_available"], per_document=10).write.text(f"{folder}/env")
    assert spark.read.text(f"{folder}/env").count() == 3
    assert rows(FD.station_status(spark, f"{folder}/env", lines=True), "station_id", "num_bikes_available") == rows(
        stations, "station_id", "num_bikes_available")


def test_zone_and_trip_files(spark, folder):
    os.makedirs(f"{folder}/csv")
    with open(f"{folder}/csv/Stations.csv", "w", encoding="utf-8") as out:
        out.write("Code,Arrondisse,Latitude,Longitude\n7,Côte-des-Neiges,45.49,-73.61\n")
    with open(f"{folder}/csv/Trips.csv", "w", encoding="utf-8") as out:
        out.write("start_station_code,end_station_code,start_date\n1,2,2016-05-01\n2,,2016-05-01 10:30:00\n")
    with open(f"{folder}/csv/notes.txt", "w") as out:
        out.write("x")
    assert rows(FL.zone_stations(spark, f"{folder}/csv/Stations.csv")) == [(7, "Côte-des-Neiges", 45.49, -73.61)]
    assert [str(r.start_date) for r in FL.trip_records(spark, f"{folder}/csv/Trips.csv").collect()] == ["2016-05-01 00:00:00", "2016-05-01 10:30:00"]
    listing = {r.name: (r.size_bytes, r.size_mb) for r in FL.file_listing(spark, f"{folder}/csv").collect()}
    assert listing == {n: (os.path.getsize(f"{folder}/csv/{n}"), 0.0) for n in ("Stations.csv", "Trips.csv")}


def test_missing_file(spark, folder):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        FL.zone_stations(spark, f"{folder}/nowhere.csv")


def test_csv_sink_round_trip(spark, folder):
    zones = FL.from_rows(spark, [Row(Code=1, Arrondisse="Montréal, \"Est\"", Latitude=1.5, Longitude=None)], S.ZONES)
    K.write_csv(zones, f"{folder}/out")
    assert rows(FL.zone_stations(spark, f"{folder}/out")) == rows(zones)


def test_catalog_tables(spark, folder):
    frame = spark.createDataFrame([(1, "x")], "a int, b string")
    frame.write.option("path", f"{folder}/t").mode("overwrite").saveAsTable("dockline_test_table")
    try:
        assert rows(FL.catalog_table(spark, "dockline_test_table")) == [(1, "x")]
    finally:
        spark.sql("DROP TABLE dockline_test_table")


def test_history_table_is_partitioned_and_appended(spark, folder):
    name = "dockline_test_history"
    K.create_history(spark, name, f"{folder}/history")
    try:
        stations = spark.createDataFrame([("a", "A", 1.0, 2.0, 10, 3, 7, True)],
                                         "station_id string, name string, lat double, lon double, capacity int, "
                                         "num_bikes_available int, num_docks_available int, is_renting boolean")
        for day in ("2024-01-01", "2024-01-02"):
            K.append_table(H.history_rows(stations, F.lit(f"{day} 08:00:00").cast("timestamp")), name)
        assert rows(spark.table(name).select(F.col("snapshot_date").cast("string"), "station_name", "utilization_pct")) == [
            ("2024-01-01", "A", 30.0), ("2024-01-02", "A", 30.0)]
        assert sorted(n for n in os.listdir(f"{folder}/history") if n.startswith("snapshot")) == [
            "snapshot_date=2024-01-01", "snapshot_date=2024-01-02"]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_recent_filter_prunes_partitions(spark, folder):
    import datetime as dt

    past = spark.createDataFrame([(dt.datetime(2024, 1, d), "a", dt.date(2024, 1, d)) for d in range(1, 15)],
                                 "snapshot_time timestamp, station_id string, snapshot_date date")
    K.append_history(past, f"{folder}/h")
    recent = H.since(spark.read.parquet(f"{folder}/h"), dt.date(2024, 1, 12), 2)
    assert recent.count() == 5
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_usage_log_table(spark, folder):
    K.create_usage_log(spark, "dockline_test_log", f"{folder}/log")
    try:
        row = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS timestamp, 'q' AS question, 't' AS tool_used, 5L AS execution_time_ms, true AS success")
        K.append_table(row, "dockline_test_log")
        assert H.tool_usage(spark.table("dockline_test_log")).first().usage_count == 1
    finally:
        spark.sql("DROP TABLE dockline_test_log")
