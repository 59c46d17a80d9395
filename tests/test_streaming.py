import json
import os

from conftest import rows
from dockline.session import drop_path
from dockline.streaming import polls as P
from dockline.streaming import snapshots as SN


def land(folder, name, *polls):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        out.writelines(json.dumps(p) + "\n" for p in polls)


def poll(time, station, bikes, version):
    return {"snapshot_time": f"2024-01-01 {time}", "station_id": station, "num_bikes_available": bikes, "last_updated": version}


def run(stream, folder, name):
    P.to_parquet(stream, f"{folder}/{name}", f"{folder}/{name}-state").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/{name}")


def test_windows_close_behind_the_watermark(spark, folder):
    land(f"{folder}/in", "1", poll("10:01:00", "a", 3, 1), poll("10:14:59", "b", 4, 1), poll("10:20:00", "a", None, 2), poll("12:00:00", "a", 9, 3))
    out = run(P.windowed_bikes(P.landed_polls(spark, f"{folder}/in")), folder, "windows")
    assert rows(out.selectExpr("date_format(window_start, 'HH:mm') w", "total_bikes", "polls")) == [("10:00", 7, 2), ("10:15", 0, 1)]


def test_repeats_are_dropped_across_runs(spark, folder):
    stream = lambda: P.first_of_repeats(P.landed_polls(spark, f"{folder}/in"))
    land(f"{folder}/in", "1", poll("10:00:00", "a", 3, 1), poll("10:00:00", "b", 3, 1))
    run(stream(), folder, "first")
    land(f"{folder}/in", "2", poll("10:00:10", "a", 3, 1), poll("10:00:20", "a", 4, 2))
    assert rows(run(stream(), folder, "first"), "station_id", "last_updated") == [("a", 1), ("a", 2), ("b", 1)]


def test_history_stream_resumes(spark, folder):
    info = spark.createDataFrame([("a", "A", 1.0, 2.0, 10)], "station_id string, name string, lat double, lon double, capacity int")
    stream = lambda: P.history_stream(P.landed_polls(spark, f"{folder}/in", files_per_batch=1), info)
    land(f"{folder}/in", "1", poll("10:00:00", "a", 3, 1))
    run(stream(), folder, "history")
    land(f"{folder}/in", "2", poll("10:15:00", "a", 5, 2), poll("10:15:00", "new", 1, 2))
    assert rows(run(stream(), folder, "history"), "station_name", "num_bikes_available", "utilization_pct") == [
        ("A", 3, 30.0), ("A", 5, 50.0), (None, 1, None)]


def test_envelope_stream(spark, folder):
    os.makedirs(f"{folder}/docs")
    with open(f"{folder}/docs/1.json", "w") as out:
        json.dump({"last_updated": 1704103200, "ttl": 10, "data": {"stations": [{"station_id": "a", "num_bikes_available": 2}, {"station_id": "b"}]}}, out, indent=2)
    out = run(P.landed_envelopes(spark, f"{folder}/docs"), folder, "rows")
    assert rows(out.selectExpr("date_format(snapshot_time, 'yyyy-MM-dd HH') t", "station_id", "num_bikes_available")) == [
        ("2024-01-01 10", "a", 2), ("2024-01-01 10", "b", None)]


def test_open_windows_complete_the_emitted_ones(spark, folder):
    start = lambda: P.to_parquet(P.windowed_bikes(P.landed_polls(spark, f"{folder}/in")), f"{folder}/w", f"{folder}/w-state").awaitTermination()
    shown = lambda df: rows(df.selectExpr("date_format(window_start, 'HH:mm') w", "total_bikes", "polls"))
    land(f"{folder}/in", "1", poll("10:01:00", "a", 3, 1), poll("12:00:00", "a", 9, 3))
    start()
    assert shown(P.open_windows(spark, f"{folder}/w-state")) == [("12:00", 9, 1)]
    # After a restart: one row late within the watermark of 11:30, one beyond it, one in an open window.
    land(f"{folder}/in", "2", poll("11:31:00", "x", 3, 1), poll("11:20:00", "y", 4, 1), poll("12:01:00", "z", None, 1))
    start()
    land(f"{folder}/in", "3", poll("12:20:00", "a", 9, 3))
    start()
    assert shown(spark.read.parquet(f"{folder}/w")) == [("10:00", 3, 1), ("11:30", 3, 1)]
    assert shown(P.open_windows(spark, f"{folder}/w-state")) == [("12:00", 9, 2), ("12:15", 9, 1)]


def document(folder, name, version, *stations):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        json.dump({"last_updated": version, "ttl": 10, "data": {"stations": list(stations)}}, out, indent=2)


def test_documents_come_once_unless_corrected(spark, folder):
    start = lambda: run(P.document_stations(P.first_documents(P.landed_documents(spark, f"{folder}/docs"))), folder, "docs-out")
    a, b = {"station_id": "a", "num_bikes_available": 2}, {"station_id": "a", "num_bikes_available": 3}
    document(f"{folder}/docs", 1, 1704103200, a, {"station_id": "b"})
    document(f"{folder}/docs", 2, 1704103200, a, {"station_id": "b"})
    assert rows(start(), "station_id", "num_bikes_available") == [("a", 2), ("b", None)]
    document(f"{folder}/docs", 3, 1704103200, a, {"station_id": "b"})
    document(f"{folder}/docs", 4, 1704103200, b)
    document(f"{folder}/docs", 5, 1704103500)
    assert rows(start(), "station_id", "num_bikes_available") == [("a", 2), ("a", 3), ("b", None)]


def test_a_repeated_batch_writes_nothing_twice(spark, folder):
    os.makedirs(f"{folder}/in")
    polls = P.landed_polls(spark, f"{folder}/in")
    start = lambda: SN.keep_snapshots(P.landed_polls(spark, f"{folder}/in"), f"{folder}/snaps", f"{folder}/snaps-state").awaitTermination()
    shown = lambda: rows(SN.snapshots(spark, f"{folder}/snaps", polls).selectExpr("batch", "date_format(taken, 'HH:mm') t", "station_id", "num_bikes_available"))
    land(f"{folder}/in", "1", poll("10:00:00", "a", 3, 1), poll("10:00:00", "b", 1, 1), poll("10:00:00", None, 8, 1))
    start()
    land(f"{folder}/in", "2", poll("10:15:00", "a", 5, 2), poll("09:00:00", "b", 7, 0), poll("10:10:00", "c", None, 2))
    start()
    wanted = [(0, "10:00", "a", 3), (0, "10:00", "b", 1), (1, "10:15", "a", 5), (1, "10:15", "b", 1), (1, "10:15", "c", None)]
    assert shown() == wanted
    drop_path(spark, f"{folder}/snaps-state/commits/1")  # the batch was written, but its commit was lost
    start()
    assert shown() == wanted
    land(f"{folder}/in", "3", poll("10:30:00", "d", 1, 3))
    start()
    assert [r for r in shown() if r[0] == 2] == [(2, "10:30", "a", 5), (2, "10:30", "b", 1), (2, "10:30", "c", None), (2, "10:30", "d", 1)]
    assert sorted(os.listdir(f"{folder}/snaps/latest")) == ["batch=1", "batch=2"]


def test_a_busy_day_lands_as_several_documents(spark):
    from dockline.plans.streams import _documents

    polls = spark.range(900).selectExpr(
        "timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id % 3 AS int)) AS snapshot_time", "if(id < 600, 'same', string(id)) AS station_id",
        "cast(null AS int) AS num_bikes_available", "1 AS num_docks_available", "true AS is_renting")
    made = lambda: rows(_documents(polls, 50).selectExpr("last_updated", "data.stations.station_id"))
    documents = made()
    assert documents == made() and sum(len(ids) for _, ids in documents) == 900 and len({v for v, _ in documents}) == len(documents)
    assert len(documents) > 15 and max(len(ids) for _, ids in documents) < 100
    assert {v // 86400 * 86400 for v, _ in documents} == {1704067200, 1704153600, 1704240000}
    assert [v for v, _ in rows(_documents(polls).select("last_updated", "data"))] == [1704067200, 1704153600, 1704240000]


def test_odd_and_large_documents(spark, folder):
    import time

    os.makedirs(f"{folder}/docs")
    texts = ["﻿" + json.dumps({"last_updated": 60, "data": {"stations": [{"station_id": "é"}]}}), "", "no json", "null",
             json.dumps([{"last_updated": 120, "data": {"stations": [{"station_id": "x"}]}}, {"last_updated": 180, "data": {"stations": []}}]),
             json.dumps({"last_updated": 240, "data": {"stations": [{"station_id": str(i), "num_bikes_available": i} for i in range(40_000)]}}, indent=2)]
    for i, text in enumerate(texts):
        with open(f"{folder}/docs/{i}.json", "w", encoding="utf-8") as out:
            out.write(text)
    began = time.monotonic()
    out = run(P.landed_envelopes(spark, f"{folder}/docs"), folder, "rows")
    assert time.monotonic() - began < 30  # the file source takes far longer: it reads the file again for every item
    assert rows(out.groupBy("last_updated").count()) == [(120, 1), (240, 40_000), (60, 1)]
    assert rows(out.where("last_updated < 200"), "station_id") == [("x",), ("é",)]
    assert out.where("num_bikes_available = station_id").count() == 40_000
