import pytest

from conftest import rows
from dockline.functions import catalog as FN
from dockline.schemas import STATION_ARRAY

NAMES = {
    "get_total_bikes_available", "get_total_docks_available", "get_system_capacity", "get_system_utilization",
    "count_total_stations", "count_operational_stations", "count_stations_with_bikes", "count_stations_with_docks",
    "get_station_status_json", "get_station_information_json", "get_system_information_json", "get_system_alerts_json",
    "find_stations_with_bikes_json", "find_stations_with_docks_json", "get_station_by_name_json", "get_all_stations_summary_json",
}


@pytest.fixture(scope="module")
def registered(spark):
    status = spark.createDataFrame([
        ("1", 5, 3, True, True, True, 11, "en", 0), ("2", 12, 0, True, False, True, 12, "en", 1),
        ("1", 8, 1, True, True, True, 13, "en", 2), ("1", 99, 9, True, True, True, 14, "fr", 0)],
        "station_id string, num_bikes_available int, num_docks_available int, is_installed boolean, is_renting boolean, "
        "is_returning boolean, last_reported long, lang string, position long")
    info = spark.createDataFrame([
        ("1", "Berri", 45.5, -73.5, 20, "en", 0), ("2", "Laurier", 45.6, -73.6, 30, "en", 1), ("3", "Sans", 45.7, -73.7, 0, "en", 2),
        ("1", "Berri (fr)", 45.5, -73.5, 20, "fr", 0)],
        "station_id string, name string, lat double, lon double, capacity int, lang string, position long")
    documents = spark.createDataFrame([('{"name":"x"}', "en"), ('{"name":"y"}', "fr")], "json string, lang string")
    FN.register_sources(spark, status, info, documents, documents)
    assert set(FN.register_all(spark)) == NAMES
    return spark


def test_catalogue():
    assert set(FN.list_available_functions()) == NAMES
    assert FN.list_available_functions("city_")[0] == "city_get_total_bikes_available"


def test_scalars(registered):
    got = registered.sql("""SELECT get_total_bikes_available(), get_total_docks_available('en'), get_system_capacity(),
        get_system_utilization(), count_total_stations(), count_operational_stations(), count_stations_with_bikes(),
        count_stations_with_bikes(min_bikes => 6), count_stations_with_docks(2, 'en'), get_total_bikes_available('fr')""").first()
    assert tuple(got) == (25, 4, 50, 50.0, 3, 2, 2, 1, 1, 99)


def test_unknown_language_is_an_empty_system(registered):
    assert tuple(registered.sql("SELECT get_total_bikes_available('xx'), get_system_utilization('xx'), count_total_stations('xx')").first()) == (0, 0.0, 0)


def test_paged_json(registered):
    def names(call):
        return rows(registered.sql(
            f"SELECT s.name, s.num_bikes_available FROM (SELECT explode(from_json(stations_json, '{STATION_ARRAY}')) AS s FROM {call})"))

    assert names("find_stations_with_bikes_json(6)") == [("Berri", 8)]
    assert names("find_stations_with_bikes_json(1, 'fr')") == [("Berri (fr)", 99)]
    assert names("find_stations_with_docks_json(0)") == [("Berri", 8), ("Laurier", 12)]
    assert names("get_all_stations_summary_json()") == [("Berri", 8), ("Laurier", 12), ("Sans", None)]
    assert len(names("get_station_status_json()")) == 3 and len(names("get_station_information_json()")) == 3


def test_documents(registered):
    assert rows(registered.sql("SELECT * FROM get_system_information_json()")) == [('{"name":"x"}',)]
    assert rows(registered.sql("SELECT * FROM get_system_alerts_json('fr')")) == [('{"name":"y"}',)]


def test_by_name(registered):
    got = registered.sql("SELECT get_json_object(get_station_by_name_json('ERR'), '$.num_bikes_available')").first()[0]
    assert got == "8"
    assert registered.sql("SELECT 1 FROM (SELECT get_station_by_name_json('%') AS j) WHERE j != 'null'").count() == 0


def test_views(registered):
    FN.create_views(registered)
    assert rows(registered.sql("SELECT station_id, utilization_pct FROM live_stations")) == [("1", 40.0), ("2", 40.0), ("3", None)]
    assert registered.table("live_station_status").columns == registered.table("live_stations").columns
    assert tuple(registered.sql("SELECT total_stations, total_bikes, utilization_pct FROM system_metrics").first()) == (3, 25, 50.0)


def test_subset_with_prefix_and_examples(registered):
    assert FN.register(registered, ["count_total_stations"], "my_") == ["my_count_total_stations"]
    assert registered.sql(FN.example_call("count_total_stations", "my_")).first().result == 3
    for name in NAMES:
        assert registered.sql(FN.example_call(name)).count() >= 0


def test_listing_and_description(registered):
    assert registered.sql("SHOW USER FUNCTIONS LIKE 'count_stations*'").count() == 2
    text = " ".join(r[0] for r in registered.sql("DESCRIBE FUNCTION EXTENDED get_total_bikes_available").collect())
    assert "get_total_bikes_available" in text


def test_permanent_ddl():
    sql = FN.get_function_sql("get_system_capacity", "main", "city", prefix="my_")
    assert sql.startswith("CREATE SCHEMA IF NOT EXISTS main.city;")
    assert "CREATE OR REPLACE FUNCTION main.city.my_get_system_capacity(language STRING DEFAULT 'en') RETURNS BIGINT" in sql
    assert "SCHEMA" not in FN.get_function_sql("my_get_system_capacity", "main", "city", include_schema=False, prefix="my_").split("FUNCTION")[0]


def test_permanent_functions_work_from_any_schema(registered, tmp_path_factory):
    home = "dockline_city"
    registered.sql(f"CREATE SCHEMA IF NOT EXISTS {home} LOCATION '{tmp_path_factory.mktemp('city')}'")
    try:
        for view in (FN.STATUS_VIEW, FN.INFO_VIEW, FN.SYSTEM_VIEW, FN.ALERT_VIEW):
            registered.table(view).write.saveAsTable(f"{home}.{view}")
        created = FN.create_functions(registered, sorted(NAMES), schema=home, prefix="p_")
        assert len(created) == 16
        got = registered.sql(f"SELECT {home}.p_get_total_bikes_available(), {home}.p_count_stations_with_bikes(6)").first()
        assert tuple(got) == (25, 1)
        registered.sql(f"USE {home}")
        assert registered.sql("SELECT * FROM p_get_all_stations_summary_json()").count() == 1
        assert registered.sql(f"SHOW USER FUNCTIONS IN {home} LIKE 'p_*'").count() >= 16
    finally:
        registered.sql("USE default")
        registered.sql(f"DROP SCHEMA {home} CASCADE")


def test_unknown_name_lists_the_known_ones():
    with pytest.raises(ValueError, match="get_system_capacity"):
        FN.get_function_sql("nope")
