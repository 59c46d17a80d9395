"""Every registered query against its SQL, and the shape of the plans."""

import pytest

import __spark_entry__ as entry
from dockline.plans import ORACLES, QUERIES
from tools.check import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == ""
    else:
        assert df.count() > 0


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 10


# Queries whose joins must stay equality joins when nothing may be broadcast.
JOINED = ["top_stations_with_bikes", "all_stations_summary_left", "station_by_name", "stations_near_locations",
          "nearest_stations_per_location", "trips_with_zones", "zone_day_counts", "advanced_trip_features", "answered_questions",
          "snapshot_history", "system_report", "trip_count_distribution"]


@pytest.mark.parametrize("name", JOINED)
def test_no_pairwise_joins_without_broadcast(spark, sf_dir, con, name):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert compare(df, con, ORACLES[name]) == ""
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = QUERIES["daily_trip_summary"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderdate:" in plan and "o_custkey" not in plan
