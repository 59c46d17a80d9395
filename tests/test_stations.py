from dockline.operators import neighbourhood as NB
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dockline import schemas as S
from dockline.functions import columns as C
from dockline.operators import metrics as M
from dockline.operators import proximity as P
from dockline.operators import stations as O

STATUS = "station_id string, num_bikes_available int, num_docks_available int, is_installed boolean, " \
         "is_renting boolean, is_returning boolean, position long"
INFO = "station_id string, name string, lat double, lon double, capacity int, position long"


@pytest.fixture
def status(spark):
    return spark.createDataFrame([
        ("a", 5, 3, True, True, True, 0),
        ("b", 12, 0, True, True, False, 1),
        ("c", 7, 9, True, False, True, 2),
        ("d", None, None, None, None, None, 3),
        ("ghost", 9, 9, True, True, True, 4),     # no information
        ("a", 2, 8, True, True, True, 5),         # second report of a
        ("e", 30, 1, False, True, True, 6),       # not installed
    ], STATUS)


@pytest.fixture
def info(spark):
    return spark.createDataFrame([
        ("a", "Berri / de Maisonneuve", 45.50, -73.57, 10, 0),
        ("b", "100% Centre_Nord", 45.51, -73.58, 0, 1),
        ("c", "Métro Laurier", 45.52, -73.59, None, 2),
        ("d", None, None, None, 15, 3),
        ("a", "Berri bis", 45.55, -73.50, 20, 4),  # later duplicate of a
        ("e", "Jean-Talon", 45.53, -73.61, 40, 5),
        ("quiet", "Sans statut", 45.54, -73.62, 8, 6),
    ], INFO)


def test_latest_per_key_takes_last_values_and_first_place(info):
    got = {r.station_id: r for r in O.latest_per_key(info).collect()}
    assert got["a"].name == "Berri bis" and got["a"].capacity == 20 and got["a"].position == 0
    assert len(got) == 6


def test_inner_merge_keeps_every_status_row(status, info):
    merged = O.merge_stations(status, info)
    assert rows(merged, "station_id", "num_bikes_available", "name") == sorted([
        ("a", 2, "Berri bis"), ("a", 5, "Berri bis"), ("b", 12, "100% Centre_Nord"),
        ("c", 7, "Métro Laurier"), ("d", None, None), ("e", 30, "Jean-Talon")], key=str)


def test_left_merge_keeps_every_information_row(status, info):
    merged = O.merge_stations(status, info, how="left")
    assert rows(merged, "station_id", "name", "num_bikes_available") == sorted([
        ("a", "Berri / de Maisonneuve", 2), ("a", "Berri bis", 2), ("b", "100% Centre_Nord", 12),
        ("c", "Métro Laurier", 7), ("d", None, None), ("e", "Jean-Talon", 30), ("quiet", "Sans statut", None)], key=str)


def test_merge_rejects_other_kinds(status, info):
    with pytest.raises(ValueError):
        O.merge_stations(status, info, how="outer")


def test_status_wins_on_shared_columns(spark):
    status = spark.createDataFrame([("a", 1, "live", 0)], "station_id string, num_bikes_available int, name string, position long")
    info = spark.createDataFrame([("a", "old", 5, 0)], "station_id string, name string, capacity int, position long")
    assert rows(O.merge_stations(status, info), "name", "capacity") == [("live", 5)]


def test_find_with_bikes_and_docks(status, info):
    assert rows(O.find_with_bikes(status, info, 5), "station_id", "num_bikes_available") == [("a", 5), ("b", 12)]
    assert rows(O.find_with_docks(status, info, 3), "station_id", "num_docks_available") == [("a", 3), ("a", 8), ("c", 9)]
    assert rows(O.find_with_bikes(status, info, 0), "station_id") == [("a",), ("a",), ("b",)]


@pytest.mark.parametrize("text, expected", [
    ("BERRI", ("a", "Berri bis", 2)),
    ("%", ("b", "100% Centre_Nord", 12)),
    ("_", ("b", "100% Centre_Nord", 12)),
    ("métro", ("c", "Métro Laurier", 7)),
    ("sans", ("quiet", "Sans statut", None)),
    ("", ("a", "Berri bis", 2)),
])
def test_by_name(status, info, text, expected):
    assert rows(O.find_by_name(status, info, text), "station_id", "name", "num_bikes_available") == [expected]


def test_by_name_without_match_gives_no_row(status, info):
    assert O.find_by_name(status, info, "B%i").count() == 0


def test_known_status(status, info):
    assert rows(O.known_status(status, info), "station_id") == [("a",), ("a",), ("b",), ("c",), ("d",), ("e",)]


def test_live_view_guards_capacity(status, info):
    view = {r.station_id: r.utilization_pct for r in O.live_view(O.merge_stations(status, info)).collect() if r.station_id != "a"}
    assert view == {"b": None, "c": None, "d": 0.0, "e": 75.0}


def test_percent_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (49, 400), (5, 0), (None, 5), (2, 3)], "a int, b int")
    got = [r[0] for r in df.select(C.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [12.5, 33.3, 12.3, None, None, 66.7]


def test_json_pages_hold_all_rows_in_order(status, info):
    merged = O.merge_stations(status, info, how="left")
    pages = O.json_pages(merged, ["station_id", "name", "num_bikes_available"], page_size=2)
    got = pages.orderBy("page").collect()
    assert [r.page for r in got] == [0, 1, 2, 3]
    assert got[0].stations_json == '[{"station_id":"a","name":"Berri / de Maisonneuve","num_bikes_available":2},' \
                                   '{"station_id":"b","name":"100% Centre_Nord","num_bikes_available":12}]'
    assert O.parse_pages(pages, S.STATION_ARRAY).count() == 7


def test_display_text_defaults(spark):
    sparse = spark.createDataFrame(
        [("test", "Test Station", None, None, None, None, None, None, None, None)],
        "station_id string, name string, lat double, lon double, capacity int, num_bikes_available int, "
        "num_docks_available int, is_installed boolean, is_renting boolean, is_returning boolean")
    text = O.with_display_text(sparse).first().display_text
    assert text.splitlines() == [
        "Station: Test Station", "Location: (0.000000, 0.000000)", "Capacity: 0", "Available Bikes: 0",
        "Available Docks: 0", "Status: Installed ✗ | Renting ✗ | Returning ✗"]


def test_quality_violations(status, info):
    got = O.quality_violations(O.merge_stations(status, info)).first()
    assert (got.rows_checked, got.lat_violations, got.lon_violations, got.capacity_violations) == (6, 1, 1, 2)


def test_metrics(status, info):
    got = M.feed_metrics(info, status).first()
    assert (got.total_stations, got.capacity, got.total_bikes, got.total_docks) == (7, 93, 65, 30)
    assert got.operational_stations == 5 and got.bikes_5 == 3 and got.docks_5 == 3
    assert math.isclose(got.utilization, 65 / 93 * 100)


def test_metrics_of_an_empty_system(spark):
    empty_status, empty_info = spark.createDataFrame([], STATUS), spark.createDataFrame([], INFO)
    assert M.system_utilization(empty_info, empty_status).first().utilization == 0.0
    assert M.total_bikes(empty_status).first().total_bikes == 0
    assert rows(M.dashboard(empty_info, empty_status), "metric", "value")[0] == ("Operational Stations", 0)


def test_tiers_and_levels(spark):
    df = spark.createDataFrame([(n, 20, float(p)) for n, p in zip((0, 1, 2, 3, 5, 6, 9, 10, 50), (0, 24, 25, 49, 50, 74, 75, 90, 100))],
                               "num_bikes_available int, capacity int, utilization_pct double")
    assert [tuple(r) for r in M.tier_distribution(df).collect()] == [
        ("Empty", 1, 11.1), ("Low (1-2)", 2, 22.2), ("Medium (3-5)", 2, 22.2), ("Good (6-9)", 2, 22.2), ("Excellent (10+)", 2, 22.2)]
    assert [tuple(r)[:2] for r in M.use_distribution(df).collect()] == [
        ("Busy (75%+)", 3), ("Moderate (50-75%)", 2), ("Quiet (25-50%)", 2), ("Very Quiet (<25%)", 2)]


def test_within_radius(info):
    near = P.within_radius(info, 45.504, -73.574, radius=0.01, k=5)
    assert [r.station_id for r in near.collect()] == ["a", "b"]


@pytest.mark.parametrize("side", [1, 3, 4096])
def test_near_locations_against_brute_force(spark, side):
    """A crowded cell, cut into blocks of different sizes, gives the same pairs."""
    random.seed(7)
    crowd = lambda: (45.5 + random.uniform(0, 0.004), -73.5 + random.uniform(0, 0.004))
    spread = lambda: (random.uniform(45, 46), random.uniform(-74.5, -73))
    stations = [(f"s{i}", *(crowd() if i % 3 == 0 else spread())) for i in range(90)] + [("none", None, None)]
    places = [(i, *(crowd() if i % 2 == 0 else spread())) for i in range(30)]
    want = sorted((p[0], s[0]) for p, s in itertools.product(places, stations)
                  if s[1] is not None and math.hypot(p[1] - s[1], p[2] - s[2]) < 0.003)
    sdf = spark.createDataFrame(stations, "station_id string, lat double, lon double")
    pdf = spark.createDataFrame(places, "location_id int, lat double, lon double")
    near = P.near_pairs(pdf, sdf, radius=0.003, pairs_per_task_side=side)
    assert sorted((r.location_id, r.station_id) for r in near.collect()) == want
    assert {r.location_id: r.stations for r in P.near_counts(pdf, sdf, 0.003, side).collect()} == {
        p: sum(q == p for q, _ in want) for p, _ in want}
    top = P.nearest_stations(pdf, sdf, radius=0.003, k=2, pairs_per_task_side=side)
    counts = {}
    for p, _ in want:
        counts[p] = min(counts.get(p, 0) + 1, 2)
    assert {r.location_id: r["count"] for r in top.groupBy("location_id").count().collect()} == counts


@pytest.mark.parametrize("most,radius", [(60, 0.5), (4096, 0.05)])
def test_neighbourhoods_equal_brute_force(spark, most, radius):
    pick = random.Random(most)
    spots = [(45 + pick.random(), -73 + pick.random()) for _ in range(60)] + [(45.5 + pick.random() / 50, -72.5 + pick.random() / 50) for _ in range(80)]
    stations = [(f"s{i:03}", *spot) for i, spot in enumerate(spots + [spots[100]] * 9)] + [("none", None, 1.0), ("nan", float("nan"), 1.0)]
    points = [(i, 45 + pick.random(), -73 + pick.random()) for i in range(40)] + [(40 + i, *spots[60 + i]) for i in range(50)]
    points += [(90, 45.5 + radius, -72.5), (91, *spots[100]), (92, *spots[100]), (93, None, None), (94, 0.0, -0.0)]
    sdf = spark.createDataFrame([(*s, 7) for s in stations], "station_id string, lat double, lon double, capacity int").repartition(3)
    pdf = spark.createDataFrame(points, "location_id int, lat double, lon double").repartition(3)
    far = lambda p, s: math.sqrt((s[1] - p[1]) ** 2 + (s[2] - p[2]) ** 2)
    near = {p[0]: sorted((far(p, s), s[0]) for s in stations[:-2] if far(p, s) < radius) for p in points if p[1] is not None}
    got = {r.location_id: (r.stations, r.distance) for r in NB.near_counts(pdf, sdf, radius, most).collect()}
    assert got == {i: (len(n), pytest.approx(n[0][0], abs=1e-12)) for i, n in near.items() if n}
    top = NB.nearest_stations(pdf, sdf, radius, 4, most)
    assert top.columns == ["location_id", "station_id", "lat", "lon", "capacity", "distance", "place"]
    rows_of = sorted((r.location_id, r.place, r.station_id) for r in top.collect())
    assert rows_of == sorted((i, j + 1, s) for i, n in near.items() for j, (_, s) in enumerate(n[:4]))
    assert NB.near_counts(pdf.limit(0), sdf, radius).count() == 0 == NB.nearest_stations(pdf, sdf.limit(0), radius).count()


def test_crowded_cells_are_not_compared_pair_by_pair(spark):
    """40,000 places each in one cell: all but the border is decided by totals."""
    pick = random.Random(4)
    crowd = lambda n: [(i, 10 + pick.random() / 10, 20 + pick.random() / 10) for i in range(n)]
    sdf = spark.createDataFrame(crowd(2000), "station_id int, lat double, lon double")
    points = NB._folded(NB._places(spark.createDataFrame(crowd(2000), "location_id int, lat double, lon double")))
    folded = NB._folded(NB._places(sdf))
    counted = []

    def decide(pairs):
        inside = F.col("most") < 0.2
        counted.append(pairs.where(inside).agg(F.sum(F.col("na") * F.col("nb"))).first()[0] or 0)
        return pairs.where(~inside & (F.col("least") < 0.2)), None

    finished, _ = NB._walk(points.withColumn("n", F.lit(1)), folded, 0.2, decide, 4096)
    assert sum(counted) > 0.9 * 2000 * 2000  # every pair is within the radius
