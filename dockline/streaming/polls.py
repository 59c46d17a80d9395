"""Structured Streaming over landed poll files.

The same functions serve a running job (``every="15 minutes"``) and a
catch-up run that ends when all landed files are processed (``every=None``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dockline import schemas as S
from dockline.functions import columns as C
from dockline.sources.feeds import typed

FILES_PER_PARTITION = 4
POLL = T.StructType([
    T.StructField("snapshot_time", T.TimestampType()),
    T.StructField("last_updated", T.LongType()),
    *S.STATUS_STATION.fields,
])


def landed_polls(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Poll rows, one JSON object per line, as a stream."""
    reader = spark.readStream.schema(POLL)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def landed_documents(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Whole status documents as a stream: (snapshot_time, last_updated, data), one row per document of a file.

    A file is read as UTF-8 text and parsed there: a JSON source goes back to the start of its file for every item that
    is kept as text, so that its work is quadratic in the document.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    parsed = F.from_json(F.regexp_replace("value", "^\ufeff", ""), T.ArrayType(S.ITEM_FEED["stations"]))
    documents = reader.text(folder, wholetext=True).select(F.explode_outer(parsed).alias("document")).select("document.*")
    return documents.select(F.timestamp_seconds("last_updated").alias("snapshot_time"), "last_updated", "data")


def first_documents(documents: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """Each document once, before its stations are unfolded: the state holds a digest per document, not per station.

    A document that comes again with the same version but other contents is another document.
    """
    digest = F.sha2(F.to_json("data"), 256)
    return (
        documents.withColumn("digest", digest).withWatermark("snapshot_time", delay)
        .dropDuplicatesWithinWatermark(["last_updated", "digest"]).drop("digest")
    )


def document_stations(documents: DataFrame) -> DataFrame:
    """A row per station of each document."""
    return documents.select("snapshot_time", "last_updated", F.explode("data.stations").alias("item")).select(
        "snapshot_time", "last_updated", *typed(F.col("item"), S.STATUS_STATION))


def landed_envelopes(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Whole status documents as a stream of station rows."""
    return document_stations(landed_documents(spark, folder, files_per_batch))


def first_of_repeats(polls: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """One row per station and feed version; the state is bounded by the watermark."""
    return (
        polls.withWatermark("snapshot_time", delay)
        .dropDuplicatesWithinWatermark(["station_id", "last_updated"])
    )


def windowed_bikes(polls: DataFrame, width: str = "15 minutes", delay: str = "30 minutes") -> DataFrame:
    """Total bikes and polls per tumbling window, emitted once the window has closed.

    A window closes when polls later than its end by ``delay`` have come; the windows of the last ``delay`` are
    therefore not emitted by a run that ends with its input, but by a later run from the same checkpoint.
    """
    return (
        polls.withWatermark("snapshot_time", delay)
        .groupBy(F.window("snapshot_time", width).alias("w"))
        .agg(F.sum(C.count_of("num_bikes_available").cast("bigint")).alias("total_bikes"),
             F.count("*").alias("polls"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total_bikes", "polls")
    )


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a run of ``windowed_bikes`` has not emitted yet, read from its state.

    For an input that has ended: what the run wrote and these rows are all windows. The state is only read, so the
    run may still go on from its checkpoint.
    """
    window, value = F.col("key.window"), F.col("value")
    return spark.read.format("statestore").load(checkpoint).select(
        window["start"].alias("window_start"), window["end"].alias("window_end"), value["sum"].alias("total_bikes"), value["count"].alias("polls"))


def history_stream(polls: DataFrame, info: DataFrame) -> DataFrame:
    """Polls completed with the static station columns, in the history shape."""
    from dockline.operators.history import snapshot_history

    return snapshot_history(polls, info)


def to_parquet(stream: DataFrame, path: str, checkpoint: str, every: str | None = None,
               partition_by: list[str] | None = None) -> StreamingQuery:
    """Appends to a parquet folder, exactly once per checkpoint.

    With ``partition_by`` the rows of a partition are gathered in FILES_PER_PARTITION tasks of a micro-batch, so
    that a date gets a few files a batch, and a date with most of the rows is not written by one task.
    """
    if partition_by:
        share = F.pmod(F.xxhash64(*stream.columns), F.lit(FILES_PER_PARTITION))
        stream = stream.repartition(*partition_by, share)
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
