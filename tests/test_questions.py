import pytest

from conftest import rows
from dockline.operators import questions as O
from pyspark.sql import functions as F

ASKED = [
    ("How many bikes are available?", "get_total_bikes", None), ("Find Berri", "find_station", "Berri"),
    ("find a STATION near  Laurier ", "find_station", "Laurier"), ("What's the status?", "get_system_status", None),
    ("station status", "find_station", "status"), ("Tell me more", "get_system_status", None), ("", "get_system_status", None),
]


def test_routing(spark):
    df = spark.createDataFrame([(q,) for q, _, _ in ASKED], "question string")
    got = {r.question: (r.tool_used, r.station_param) for r in O.routed(df).collect()}
    assert got == {q: (t, p) for q, t, p in ASKED}


@pytest.mark.parametrize("rules, default, question, tool", [
    (O.STRICT_RULES, O.DEFAULT_TOOL, "find a bike", "get_system_status"), (O.STRICT_RULES, O.DEFAULT_TOOL, "Find a station", "find_station"),
    (O.STRICT_RULES, O.DEFAULT_TOOL, "Berri station", "find_station"), (O.QUERY_RULES, O.QUERY_DEFAULT_TOOL, "Is Berri free", "get_station_by_name"),
    (O.QUERY_RULES, O.QUERY_DEFAULT_TOOL, "utilization and how many stations", "count_total_stations"),
    (O.QUERY_RULES, O.QUERY_DEFAULT_TOOL, "hello", "top_stations")])
def test_other_rules(spark, rules, default, question, tool):
    df = spark.createDataFrame([(question,)], "question string")
    assert df.select(O.route(F.col("question"), rules, default)).first()[0] == tool


def test_first_station_per_text_against_scan(spark):
    names = ["Berri / de Maisonneuve", "Métro Laurier", "Laurier Est", "berri bis", "Maison", "A"]
    stations = [(i, str(i), n, i * 10) for i, n in enumerate(names)]
    words = ["berri", "LAURIER", "maison", "e", "/", "é", "zz", "s", "a"]
    want = {}
    for w in words:
        hits = [s for s in stations if w.lower() in s[2].lower()]
        if hits:
            want[w] = hits[0][2]
    found = O.first_station_per_text(
        spark.createDataFrame([(w,) for w in words], "word string"),
        spark.createDataFrame(stations, "position long, station_id string, name string, num_bikes_available int"))
    assert {r.word: r.name for r in found.collect()} == want


def test_answers(spark):
    asked = spark.createDataFrame([(q,) for q, _, _ in ASKED] + [("Find nowhere",)], "question string")
    metrics = spark.createDataFrame([(1031, 10509, 23100)], "total_stations long, total_bikes long, capacity long")
    stations = spark.createDataFrame([(0, "1", "Berri / Est", 5), (1, "2", "Laurier", None)],
                                     "position long, station_id string, name string, num_bikes_available int")
    got = dict(rows(O.answers(asked, metrics, stations, "City"), "question", "answer"))
    assert got["How many bikes are available?"] == "There are currently 10,509 bikes available."
    assert got["Find Berri"] == "Station 'Berri / Est' has 5 bikes available."
    assert got["find a STATION near  Laurier "] == "Station 'Laurier' has 0 bikes available."
    assert got["Find nowhere"] == "Station 'nowhere' not found."
    assert got["What's the status?"] == "City has 1,031 stations with 10,509 bikes available (45.5% utilization)."
    assert got["Tell me more"] == "City system: 1,031 stations, 10,509 bikes, 45.5% utilization"
    assert len(got) == 8
