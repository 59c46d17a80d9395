"""Structured Streaming runs over landed poll files, to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockline.plans.registry import HISTORY, INFO, SNAPSHOTS, query, with_tables
from dockline.session import drop_path, shared_path
from dockline.sinks import tables as K
from dockline.sources import tables as T
from dockline.streaming import polls as P
from dockline.streaming import snapshots as SN

REPEATS = 2


def _landed(spark, folder, repeats=1, parts=None):
    """Events as poll files, each row landed ``repeats`` times."""
    path = shared_path(spark, "polls")
    polls = T.snapshots(spark, folder).select(
        F.col("snapshot_time").cast("timestamp").alias("snapshot_time"),
        F.unix_micros(F.col("snapshot_time").cast("timestamp")).alias("last_updated"),
        "station_id", "num_bikes_available", "num_docks_available", "is_renting")
    if repeats > 1:
        polls = polls.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).drop("copy")
    if parts:
        polls = polls.repartition(parts)
    polls.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(path)
    return path


def _finished(spark, stream, label, schema=None, **kwargs):
    out = shared_path(spark, label)
    run = P.to_parquet(stream, out, shared_path(spark, label + "-state"), **kwargs)
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _plain(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("streamed_history", with_tables(INFO, SNAPSHOTS, HISTORY) + "SELECT * FROM history")
def streamed_history(spark, folder):
    """Polls streamed into the date-partitioned history, in several micro-batches."""
    landed = _landed(spark, folder, parts=6)
    stream = P.history_stream(P.landed_polls(spark, landed, files_per_batch=2), T.station_information(spark, folder))
    return _plain(_finished(spark, stream, "streamed", partition_by=["snapshot_date"]), "snapshot_time")


@query("streamed_window_totals", with_tables(SNAPSHOTS) + """
    SELECT * FROM (SELECT time_bucket(INTERVAL 15 MINUTES, snapshot_time) AS window_start,
           time_bucket(INTERVAL 15 MINUTES, snapshot_time) + INTERVAL 15 MINUTES AS window_end,
           CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes, count(*) AS polls
    FROM snapshots GROUP BY 1, 2)
    WHERE window_end <= (SELECT max(snapshot_time) FROM snapshots) - INTERVAL 30 MINUTES""")
def streamed_window_totals(spark, folder):
    """Bikes per 15-minute window, for the windows the watermark has closed."""
    stream = P.windowed_bikes(P.landed_polls(spark, _landed(spark, folder)))
    return _plain(_finished(spark, stream, "windows"), "window_start", "window_end")


@query("streamed_first_of_repeats", with_tables(SNAPSHOTS) + """
    SELECT DISTINCT snapshot_time, station_id, num_bikes_available FROM snapshots""")
def streamed_first_of_repeats(spark, folder):
    """Every poll landed twice, kept once."""
    stream = P.first_of_repeats(P.landed_polls(spark, _landed(spark, folder, REPEATS)))
    return _plain(_finished(spark, stream, "repeats"), "snapshot_time").select(
        "snapshot_time", "station_id", "num_bikes_available")


# Polls that arrive in four landings by their time. Some come a landing late, some with the last one.
LANDINGS = 4
ARRIVALS = with_tables(SNAPSHOTS) + f"""
    , span AS (SELECT min(epoch_us(snapshot_time)) AS lo, max(epoch_us(snapshot_time)) - min(epoch_us(snapshot_time)) + 1 AS width FROM snapshots)
    , timed AS (SELECT s.*, CAST((epoch_us(snapshot_time) - lo) * {LANDINGS} // width AS INTEGER) AS slice FROM snapshots s, span)
    , arrivals AS (SELECT *, CASE num_docks_available WHEN 0 THEN least(slice + 1, {LANDINGS - 1}) WHEN 1 THEN {LANDINGS - 1} ELSE slice END AS landing FROM timed)
    , marks AS (SELECT landing, max(date_trunc('millisecond', max(snapshot_time))) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                       - INTERVAL 2 DAYS AS watermark FROM arrivals GROUP BY landing)"""
LATE = "2 days"


def _arrivals(spark, folder):
    """Polls with the number of the landing that brings them."""
    polls = T.snapshots(spark, folder).withColumn("snapshot_time", F.col("snapshot_time").cast("timestamp"))
    us = F.unix_micros("snapshot_time")
    lo, hi = polls.agg(F.min(us), F.max(us)).first()
    docks = F.col("num_docks_available")
    last = F.lit(LANDINGS - 1)
    return polls.withColumn("last_updated", us).withColumn("slice", F.expr(f"cast((last_updated - {lo}) * {LANDINGS} div {hi - lo + 1} AS int)")) \
        .withColumn("landing", F.when(docks == 0, F.least(F.col("slice") + 1, last)).when(docks == 1, last).otherwise(F.col("slice")))


def _land(rows, path):
    """One landing: adds files to a folder that a stream reads."""
    rows.write.mode("append").option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(path)


def _runs(spark, folder, start, column="landing", again=lambda n: []):
    """Lands the polls one landing after the other; after each, a run starts from the checkpoint and ends with the input."""
    path = shared_path(spark, "landings")
    arrivals = K.overwrite(_arrivals(spark, folder), shared_path(spark, "arrivals"))
    for n in range(LANDINGS):
        for k in [n, *again(n)]:
            _land(arrivals.where(F.col(column) == k).drop("slice", "landing"), path)
        start(P.landed_polls(spark, path)).awaitTermination()
    return path


@query("streamed_late_windows", ARRIVALS + """
    , kept AS (SELECT *, time_bucket(INTERVAL 6 HOURS, snapshot_time) AS window_start, time_bucket(INTERVAL 6 HOURS, snapshot_time) + INTERVAL 6 HOURS AS window_end
               FROM arrivals JOIN marks USING (landing))
    SELECT window_start, window_end, CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes, count(*) AS polls,
           window_end <= (SELECT date_trunc('millisecond', max(snapshot_time)) - INTERVAL 2 DAYS FROM snapshots) AS closed
    FROM kept WHERE watermark IS NULL OR window_end > watermark GROUP BY window_start, window_end""")
def streamed_late_windows(spark, folder):
    """Windows over four runs from one checkpoint, rows late within and beyond the watermark; at the end the open windows too."""
    out, state = shared_path(spark, "windows"), shared_path(spark, "windows-state")
    windows = lambda polls: P.windowed_bikes(polls, "6 hours", LATE)
    path = _runs(spark, folder, lambda polls: P.to_parquet(windows(polls), out, state))
    closed = spark.read.schema(windows(P.landed_polls(spark, path)).schema).parquet(out)
    both = closed.withColumn("closed", F.lit(True)).unionByName(P.open_windows(spark, state).withColumn("closed", F.lit(False)))
    return _plain(both, "window_start", "window_end")


@query("streamed_first_seen", ARRIVALS + """
    SELECT DISTINCT snapshot_time, station_id, num_bikes_available FROM arrivals JOIN marks USING (landing)
    WHERE watermark IS NULL OR snapshot_time > watermark""")
def streamed_first_seen(spark, folder):
    """Polls that land again with every later landing, kept once over four runs; those that come too late are dropped."""
    out, state = shared_path(spark, "seen"), shared_path(spark, "seen-state")
    first = lambda polls: P.first_of_repeats(polls, LATE)
    path = _runs(spark, folder, lambda polls: P.to_parquet(first(polls), out, state), again=range)
    rows = spark.read.schema(P.landed_polls(spark, path).schema).parquet(out)
    return _plain(rows, "snapshot_time").select("snapshot_time", "station_id", "num_bikes_available")


@query("interval_snapshots", ARRIVALS + f"""
    , batches AS (SELECT CAST(range AS INTEGER) AS batch FROM range({LANDINGS}))
    , known AS (SELECT batch, a.*, max(snapshot_time) OVER (PARTITION BY batch) AS taken FROM batches JOIN arrivals a ON a.landing <= batch)
    SELECT batch, taken, station_id, snapshot_time, num_bikes_available, num_docks_available, is_renting FROM known
    QUALIFY row_number() OVER (PARTITION BY batch, station_id
                               ORDER BY snapshot_time DESC, num_bikes_available DESC, num_docks_available DESC, is_renting DESC) = 1""")
def interval_snapshots(spark, folder):
    """A snapshot of all stations per landing; the last batch runs twice, as after a failure, and writes nothing twice."""
    out, state = shared_path(spark, "snapshots"), shared_path(spark, "snapshots-state")
    path = _runs(spark, folder, lambda polls: SN.keep_snapshots(polls, out, state))
    drop_path(spark, f"{state}/commits/{LANDINGS - 1}")
    polls = P.landed_polls(spark, path)
    SN.keep_snapshots(polls, out, state).awaitTermination()
    return _plain(SN.snapshots(spark, out, polls), "taken", "snapshot_time").select(
        "batch", "taken", "station_id", "snapshot_time", "num_bikes_available", "num_docks_available", "is_renting")


# Stations of a landed document, about; a day with more of them lands as several documents.
DOCUMENT_STATIONS = 20_000
DAY_DOCUMENTS = 80_000  # their versions are seconds of the day, the shortest of which has 82,800


def _documents(polls, most=DOCUMENT_STATIONS):
    """Whole documents (last_updated, data) of about ``most`` stations; those of a day have versions from its start on.

    Rows are dealt out by a hash of their contents and of their place among equal rows, so that a day's documents are
    the same whenever they are made, and equal rows do not crowd one of them.
    """
    stations = ["station_id", "num_bikes_available", "num_docks_available", "is_renting"]
    day = F.unix_timestamp(F.date_trunc("day", F.col("snapshot_time").cast("timestamp")))
    folded = polls.groupBy(day.alias("day"), *stations).agg(F.count("*").alias("n"))
    sizes = polls.groupBy(day.alias("of")).agg(F.least(F.ceil(F.count("*") / most), F.lit(DAY_DOCUMENTS)).alias("documents"))
    dealt = folded.join(sizes, F.col("day").eqNullSafe(F.col("of"))).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))) \
        .withColumn("document", F.pmod(F.xxhash64(*stations, "copy"), F.col("documents")))
    rows = F.sort_array(F.collect_list(F.struct(*stations)))
    return dealt.groupBy("day", "document").agg(rows.alias("stations")) \
        .select((F.col("day") + F.col("document")).alias("last_updated"), F.struct("stations").alias("data"))


@query("streamed_documents", with_tables(SNAPSHOTS) + """
    SELECT date_trunc('day', snapshot_time) AS snapshot_time, station_id, num_bikes_available, num_docks_available, is_renting FROM snapshots""")
def streamed_documents(spark, folder):
    """Whole documents, one file each, that all land twice: every station row of each document once."""
    documents = _documents(T.snapshots(spark, folder))
    path, out, state = (shared_path(spark, n) for n in ("documents", "stations", "stations-state"))
    for _ in range(2):
        documents.write.mode("append").option("maxRecordsPerFile", 1).json(path)
        rows = P.document_stations(P.first_documents(P.landed_documents(spark, path), "10000 days"))
        P.to_parquet(rows, out, state).awaitTermination()
    got = spark.read.schema(rows.schema).parquet(out).withColumn("snapshot_time", F.date_trunc("day", "snapshot_time"))
    return _plain(got, "snapshot_time").select("snapshot_time", "station_id", "num_bikes_available", "num_docks_available", "is_renting")
