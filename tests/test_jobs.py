import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dockline.jobs import LandedFeeds, crawl_site, train_from_trips
from dockline.operators.forecast import TripPredictor
from dockline.sources.sample import sample_trips


@pytest.fixture
def feeds(spark, folder):
    def put(path, document):
        os.makedirs(os.path.dirname(f"{folder}/{path}"), exist_ok=True)
        with open(f"{folder}/{path}", "w", encoding="utf-8") as out:
            json.dump(document, out, indent=2)

    wrap = lambda name, items: {"last_updated": 1700000000, "ttl": 10, "data": {name: items}}
    put("feeds.json", {"data": {"en": {"feeds": [{"name": "station_status", "url": "u"}]}}})
    for language, bikes in (("en", 7), ("fr", 9)):
        put(f"{language}/station_status.json", wrap("stations", [
            {"station_id": "1", "num_bikes_available": bikes, "num_docks_available": 2, "is_installed": True, "is_renting": True, "is_returning": True},
            {"station_id": "2", "num_bikes_available": 0, "is_installed": True, "is_renting": True}]))
        put(f"{language}/station_information.json", wrap("stations", [
            {"station_id": "1", "name": "Berri", "lat": 45.5, "lon": -73.5, "capacity": 20}, {"station_id": "2", "name": "Laurier", "capacity": 0}]))
        put(f"{language}/system_information.json", {"last_updated": 1, "ttl": 1, "data": {"name": f"City {language}"}})
        put(f"{language}/system_alerts.json", wrap("alerts", [{"alert_id": "a"}]))
        put(f"{language}/vehicle_types.json", wrap("vehicle_types", [{"vehicle_type_id": "v", "form_factor": "bicycle"}]))
    return LandedFeeds(spark, folder)


def test_feed_methods(feeds):
    assert rows(feeds.feeds("xx"), "name") == [("station_status",)]
    assert rows(feeds.find_stations_with_bikes(5), "name", "num_bikes_available") == [("Berri", 7)]
    assert rows(feeds.find_stations_with_docks(language="fr"), "name", "num_bikes_available") == [("Berri", 9)]
    assert rows(feeds.station_by_name("laur"), "name", "num_bikes_available") == [("Laurier", 0)]
    assert feeds.all_stations_summary().count() == 2
    assert rows(feeds.system_information("fr"), "name") == [("City fr",)]
    assert rows(feeds.system_alerts(), "summary") == [("No summary",)] and feeds.vehicle_types().count() == 1
    assert feeds.metrics().first().total_bikes == 7


def test_the_newest_document_is_the_live_state(spark, folder):
    os.makedirs(f"{folder}/en/station_status.json")
    os.makedirs(f"{folder}/en/station_information.json")
    for n, (stamp, bikes) in enumerate([(100, 5), (300, 7), (200, 9)]):
        status = [{"station_id": s, "num_bikes_available": bikes, "is_renting": 1, "is_installed": "1", "is_returning": True, "vendor": {"x": n}}
                  for s in ("1", "2")]
        info = [{"station_id": s, "name": f"N{s}", "capacity": 20} for s in ("1", "2")]
        for feed, stations in (("station_status", status), ("station_information", info)):
            with open(f"{folder}/en/{feed}.json/{n}.json", "w", encoding="utf-8") as out:
                json.dump({"last_updated": stamp, "ttl": 1, "data": {"stations": stations}}, out)
    feeds = LandedFeeds(spark, folder)
    figures = feeds.metrics().first()
    assert (figures.total_stations, figures.capacity, figures.total_bikes) == (2, 40, 14)
    assert rows(feeds.find_stations_with_bikes(1), "name", "num_bikes_available") == [("N1", 7), ("N2", 7)]
    feeds.append_snapshot(f"{folder}/history", F.lit(dt.datetime(2024, 1, 1, 8)))
    assert spark.read.parquet(f"{folder}/history").count() == 2


def test_functions_by_language(feeds, spark):
    feeds.register_functions(("en", "fr"), prefix="city_")
    assert tuple(spark.sql("SELECT city_get_total_bikes_available(), city_get_total_bikes_available('fr')").first()) == (7, 9)
    document = spark.sql("SELECT * FROM city_get_system_information_json('fr')").first()[0]
    assert json.loads(document)["data"]["name"] == "City fr"


def test_snapshots_add_up(feeds, spark, folder):
    for hour in (8, 9):
        feeds.append_snapshot(f"{folder}/history", F.lit(dt.datetime(2024, 1, 1, hour)))
    assert rows(spark.read.parquet(f"{folder}/history"), "station_name", "utilization_pct") == [
        ("Berri", 35.0), ("Berri", 35.0), ("Laurier", None), ("Laurier", None)]


def test_crawl_site(spark, folder):
    page = lambda name, *links: (f"https://city.example/{name}", f"<title>{name}</title><p>x</p>" + "".join(f'<a href="{l}">y</a>' for l in links))
    pages = spark.createDataFrame([page("", "/a", "https://other.example/", "/doc.pdf"), page("a", "/b"), page("b", "/")], "url string, html string")
    stats = crawl_site(pages, "https://city.example/", ["city.example"], f"{folder}/site", scraped_at=F.lit(5.0)).first()
    assert tuple(stats) == (3, 3, 0, 3, 3)
    assert rows(spark.read.json(f"{folder}/site/index"), "title", "links_count", "scraped_at") == [("", 1, 5.0), ("a", 1, 5.0), ("b", 1, 5.0)]


def test_train_from_trips(spark, folder):
    stations = spark.createDataFrame([(1, "North"), (2, "South"), (3, "North")], "Code int, Arrondisse string")
    trips = sample_trips(stations, dt.date(2016, 5, 1), 120)
    predictor = train_from_trips(trips, stations, folder, "linear_regression")
    assert predictor.scores["test_r2"] > 0.5
    loaded = TripPredictor.load(f"{folder}/linear_regression", spark)
    zones = stations.select(F.col("Arrondisse").alias("start_zone"))
    got = {r.start_zone: r.predicted_trips for r in loaded.forecast(zones, dt.date(2016, 6, 15)).collect()}
    assert got["North"] > got["South"] > 0
