"""Sources and sinks: data derived from the tables is written, then read back through them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dockline import schemas as S
from dockline.operators import history as H
from dockline.operators import stations as ST
from dockline.plans.registry import HISTORY, INFO, LOG, SNAPSHOTS, STATUS, TRIPS, ZONES, query, with_tables
from dockline.session import shared_path
from dockline.sinks import tables as K
from dockline.sources import feeds as FD
from dockline.sources import files as FL
from dockline.sources import tables as T

STAMP = 1_700_000_000


def _land(spark, documents, label):
    """Writes one document per line and returns the folder."""
    path = shared_path(spark, label)
    documents.write.mode("overwrite").text(path)
    return path


@query("status_feed", with_tables(STATUS) + f"""
    SELECT station_id, num_bikes_available, num_docks_available, is_installed, is_renting, is_returning, last_reported,
           CAST({STAMP} AS BIGINT) AS last_updated FROM status""")
def status_feed(spark, folder):
    fields = [f.name for f in S.STATUS_STATION]
    landed = _land(spark, FD.as_envelopes(T.station_status(spark, folder), F.lit(STAMP), fields), "status")
    return FD.station_status(spark, landed, lines=True).select(*fields, "last_updated")


@query("information_feed", with_tables(INFO) + """
    SELECT station_id, name, lat, lon, capacity, CAST(position % 1000 AS BIGINT) AS position, CAST(10 AS INTEGER) AS ttl
    FROM info""")
def information_feed(spark, folder):
    fields = [f.name for f in S.INFO_STATION]
    landed = _land(spark, FD.as_envelopes(T.station_information(spark, folder), F.lit(STAMP), fields), "information")
    place = F.col("position.place").cast("bigint").alias("position")
    return FD.station_information(spark, landed, lines=True).select(*fields, place, "ttl")


@query("numeric_flag_feed", with_tables(STATUS) + """
    SELECT station_id, is_installed, is_renting, is_returning FROM status""")
def numeric_flag_feed(spark, folder):
    """Flags written as 0 and 1, as numbers and as texts."""
    status = T.station_status(spark, folder).withColumns({
        "is_installed": F.col("is_installed").cast("int"), "is_renting": F.col("is_renting").cast("int").cast("string"),
        "is_returning": F.col("is_returning").cast("string")})
    names = ["station_id", "is_installed", "is_renting", "is_returning"]
    landed = _land(spark, FD.as_envelopes(status, F.lit(STAMP), names), "flags")
    return FD.station_status(spark, landed, lines=True).select(*names)


@query("further_feed_fields", """
    SELECT CAST(p_partkey AS VARCHAR) AS station_id, p_brand AS brand, CAST(p_retailprice AS DOUBLE) AS price FROM part""")
def further_feed_fields(spark, folder):
    """Fields that no schema names come through in the raw item."""
    part = T.table(spark, folder, "part").select(F.col("p_partkey").alias("position"), F.col("p_partkey").cast("string").alias("station_id"),
                                                 F.struct(F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price")).alias("extra"))
    landed = _land(spark, FD.as_envelopes(part, F.lit(STAMP), ["station_id", "extra"]), "further")
    read = FD.station_information(spark, landed, lines=True, raw=True)
    return read.select("station_id", F.get_json_object("raw", "$.extra.brand").alias("brand"),
                       F.get_json_object("raw", "$.extra.price").cast("double").alias("price"))


def _two_polls(spark, folder, label):
    """Information of two polls; the earlier one holds only half the stations, twice as large."""
    info, path = T.station_information(spark, folder), shared_path(spark, label)
    half = info.where("position % 2 = 0").withColumn("capacity", 2 * F.col("capacity"))
    fields = [f.name for f in S.INFO_STATION]
    for frame, stamp in ((half, STAMP), (info, STAMP + 60)):
        FD.as_envelopes(frame, F.lit(stamp), fields).write.mode("append").text(path)
    return path


@query("latest_row_over_polls", with_tables(INFO) + "SELECT station_id, capacity FROM info")
def latest_row_over_polls(spark, folder):
    """All landed polls, reduced to the last row of each station."""
    read = FD.station_information(spark, _two_polls(spark, folder, "all-polls"), lines=True)
    return ST.latest_per_key(read).select("station_id", "capacity")


@query("system_information_feed", """
    SELECT CAST(s_suppkey AS VARCHAR) AS system_id, 'en' AS language, s_name AS name, 'UTC' AS timezone FROM supplier""")
def system_information_feed(spark, folder):
    data = F.struct(F.col("s_suppkey").cast("string").alias("system_id"), F.lit("en").alias("language"),
                    F.col("s_name").alias("name"), F.lit("UTC").alias("timezone"))
    docs = T.table(spark, folder, "supplier").select(F.to_json(F.struct(F.lit(STAMP).alias("last_updated"), data.alias("data"))))
    return FD.system_information(spark, _land(spark, docs, "system"), lines=True).drop("last_updated")


@query("system_alert_feed", """
    SELECT CAST(event_id AS VARCHAR) AS alert_id, event_type AS type,
           CASE WHEN event_type = 'error' THEN props ELSE 'No summary' END AS summary FROM events""")
def system_alert_feed(spark, folder):
    """Events as alerts; only errors bring a summary."""
    alert = F.struct(F.col("event_id").cast("string").alias("alert_id"), F.col("event_type").alias("type"),
                     F.when(F.col("event_type") == "error", F.col("props")).alias("summary"))
    docs = T.table(spark, folder, "events").select(F.to_json(F.struct(
        F.lit(STAMP).alias("last_updated"), F.struct(F.array(alert).alias("alerts")).alias("data"))))
    return FD.system_alerts(spark, _land(spark, docs, "alerts"), lines=True).select("alert_id", "type", "summary")


@query("vehicle_type_feed", """
    SELECT CAST(p_partkey AS VARCHAR) AS vehicle_type_id, p_type AS form_factor, p_brand AS propulsion_type FROM part""")
def vehicle_type_feed(spark, folder):
    kind = F.struct(F.col("p_partkey").cast("string").alias("vehicle_type_id"), F.col("p_type").alias("form_factor"),
                    F.col("p_brand").alias("propulsion_type"))
    docs = T.table(spark, folder, "part").select(F.to_json(F.struct(
        F.lit(STAMP).alias("last_updated"), F.struct(F.array(kind).alias("vehicle_types")).alias("data"))))
    return FD.vehicle_types(spark, _land(spark, docs, "vehicles"), lines=True).select(
        "vehicle_type_id", "form_factor", "propulsion_type")


@query("feed_list", """
    SELECT source AS name, CASE WHEN bool_or(lang = 'fr') THEN 'fr' ELSE 'en' END AS url
    FROM documents WHERE source IS NOT NULL GROUP BY source HAVING bool_or(lang IN ('fr', 'en'))""")
def feed_list(spark, folder):
    """One feed list per document source, French wanted, English otherwise."""
    feed = F.struct(F.array(F.struct(F.col("source").alias("name"), F.col("lang").alias("url"))).alias("feeds"))
    docs = (
        T.table(spark, folder, "documents").filter(F.col("source").isNotNull() & F.col("lang").isNotNull())
        .select("source", "lang").distinct()
        .groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("lang", feed))).alias("data"))
        .select(F.to_json(F.struct("data")))
    )
    return FD.feed_list(spark, _land(spark, docs, "feeds"), "fr", lines=True)


@query("raw_status_documents", with_tables(STATUS) + """
    SELECT CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes, count(*) AS stations FROM status""")
def raw_status_documents(spark, folder):
    """Documents kept as text and only taken apart by the query."""
    fields = ["station_id", "num_bikes_available"]
    landed = _land(spark, FD.as_envelopes(T.station_status(spark, folder), F.lit(STAMP), fields), "raw")
    raw = spark.read.text(landed).select(F.col("value").alias("json"))
    bikes = F.from_json(F.get_json_object("json", "$.data.stations[*].num_bikes_available"), "array<int>")
    return raw.select(F.explode(bikes).alias("bikes")).agg(
        F.sum("bikes").alias("total_bikes"), F.count("*").alias("stations"))


@query("zone_csv", with_tables(ZONES) + """
    SELECT code AS "Code", zone AS "Arrondisse", CAST(45.5 AS DOUBLE) AS "Latitude", CAST(-73.5 AS DOUBLE) AS "Longitude" FROM zones""")
def zone_csv(spark, folder):
    path = shared_path(spark, "zones")
    K.write_csv(T.zones(spark, folder).select("Code", "Arrondisse", F.lit(45.5).alias("Latitude"), F.lit(-73.5).alias("Longitude")), path)
    return FL.zone_stations(spark, path)


@query("trip_csv", with_tables(TRIPS) + "SELECT * FROM trips")
def trip_csv(spark, folder):
    path = shared_path(spark, "trips")
    K.write_csv(T.trips(spark, folder), path)
    return FL.trip_records(spark, path)


@query("csv_file_listing", with_tables(TRIPS) + r"""
    SELECT true AS named_csv, true AS sized, CAST(sum(length(coalesce(CAST(start_station_code AS VARCHAR), '')) + 1
           + length(coalesce(CAST(end_station_code AS VARCHAR), '')) + 1
           + length(strftime(start_date, '%Y-%m-%d %H:%M:%S')) + 1) AS BIGINT) AS row_bytes FROM trips""")
def csv_file_listing(spark, folder):
    """Listing of the files a CSV write produced: their sizes without the header lines are those of the rows."""
    path = shared_path(spark, "listing")
    trips = T.trips(spark, folder).withColumn("start_date", F.date_format("start_date", "yyyy-MM-dd HH:mm:ss"))
    K.write_csv(trips, path)
    header = len(",".join(trips.columns)) + 1
    return FL.file_listing(spark, path).where("size_bytes > 0").agg(
        F.bool_and(F.endswith("name", F.lit(".csv"))).alias("named_csv"),
        F.bool_and(F.col("size_mb") == F.round(F.col("size_bytes") / F.lit(1048576), 2)).alias("sized"),
        F.sum(F.col("size_bytes") - header).alias("row_bytes"))


@query("overwritten_trip_table", with_tables(TRIPS) + "SELECT * FROM trips")
def overwritten_trip_table(spark, folder):
    return K.overwrite(T.trips(spark, folder), shared_path(spark, "trip-table"))


@query("appended_history", with_tables(INFO, SNAPSHOTS, HISTORY) + "SELECT * FROM history")
def appended_history(spark, folder):
    """History appended by date partition and read back."""
    path = shared_path(spark, "history")
    K.append_history(H.snapshot_history(T.snapshots(spark, folder), T.station_information(spark, folder)), path)
    return spark.read.parquet(path)


@query("recent_history_partitions", with_tables(INFO, SNAPSHOTS, HISTORY) + """
    SELECT snapshot_date, count(*) AS snapshots FROM history WHERE snapshot_time >= DATE '2024-01-21' GROUP BY 1""")
def recent_history_partitions(spark, folder):
    """The rolling filter on the partitioned table lists only the recent partitions."""
    import datetime as dt

    path = shared_path(spark, "recent")
    K.append_history(H.snapshot_history(T.snapshots(spark, folder), T.station_information(spark, folder)), path)
    recent = H.since(spark.read.parquet(path), dt.date(2024, 1, 28), 7)
    return recent.groupBy("snapshot_date").agg(F.count("*").alias("snapshots"))


@query("snapshot_insert", with_tables(INFO, STATUS) + """
    SELECT i.station_id, name AS station_name, num_bikes_available, TIMESTAMP '2024-01-01 12:00:00' AS snapshot_time
    FROM info i LEFT JOIN status s ON i.station_id = s.station_id""")
def snapshot_insert(spark, folder):
    """One snapshot of all stations appended to an empty history."""
    path = shared_path(spark, "snapshot")
    merged = ST.merge_stations(T.station_status(spark, folder), T.station_information(spark, folder), how="left")
    K.append_history(H.history_rows(merged, F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")), path)
    return spark.read.parquet(path).select("station_id", "station_name", "num_bikes_available", "snapshot_time")


@query("usage_log_table", with_tables(LOG) + "SELECT * FROM log")
def usage_log_table(spark, folder):
    """Log rows appended to the created table and read back by name."""
    name = f"dockline_log_{uuid.uuid4().hex}"
    K.create_usage_log(spark, name, shared_path(spark, "log"))
    log = T.usage_log(spark, folder)
    K.append_table(log.withColumn("timestamp", F.col("timestamp").cast("timestamp")), name)
    return FL.catalog_table(spark, name).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("created_history_table", with_tables(INFO, SNAPSHOTS, HISTORY) + """
    SELECT station_id, station_name, utilization_pct, snapshot_date FROM history""")
def created_history_table(spark, folder):
    """Snapshots appended to the created, partitioned history table."""
    name = f"dockline_history_{uuid.uuid4().hex}"
    K.create_history(spark, name, shared_path(spark, "history-table"))
    rows = H.snapshot_history(T.snapshots(spark, folder), T.station_information(spark, folder))
    K.append_table(rows.withColumn("snapshot_time", F.col("snapshot_time").cast("timestamp")), name)
    return FL.catalog_table(spark, name).select("station_id", "station_name", "utilization_pct", "snapshot_date")
