"""A snapshot of all stations per trigger, from a stream of polls.

Each batch folds its polls into the latest state per station and writes that state as one snapshot. Both are written
below the batch's own number, so a batch that runs again after a failure replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockline.session import drop_path

KEPT_STATES = 2  # the state a repeated batch starts from, and its own


def _folder(path: str, kind: str, batch: int) -> str:
    return f"{path}/{kind}/batch={batch}"


def latest_per_station(rows: DataFrame) -> DataFrame:
    """The newest poll of every station, folded in the map tasks; equal times go to the larger row."""
    order = ["snapshot_time"] + [c for c in rows.columns if c not in ("station_id", "snapshot_time")]
    newest = F.max(F.struct(*order)).alias("newest")
    return rows.groupBy("station_id").agg(newest).select("station_id", "newest.*").select(*rows.columns)


def write_snapshot(polls: DataFrame, batch: int, path: str) -> None:
    """Folds one batch into the state of the batch before and writes state and snapshot of this batch.

    ``taken`` is the newest poll time known by then. A batch without polls repeats the state.
    """
    spark = polls.sparkSession
    rows = polls.where(F.col("station_id").isNotNull())
    if batch > 0:
        rows = spark.read.schema(polls.schema).parquet(_folder(path, "latest", batch - 1)).unionByName(rows)
    latest_per_station(rows).write.mode("overwrite").parquet(_folder(path, "latest", batch))
    state = spark.read.schema(polls.schema).parquet(_folder(path, "latest", batch))
    taken = state.agg(F.max("snapshot_time").cast("string")).first()[0]  # one value
    state.withColumn("taken", F.lit(taken).cast("timestamp")).write.mode("overwrite").parquet(_folder(path, "snapshots", batch))
    if batch >= KEPT_STATES:
        drop_path(spark, _folder(path, "latest", batch - KEPT_STATES))


def keep_snapshots(polls: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Runs the stream; with ``every``, say ``15 minutes``, one snapshot per interval that brought polls."""
    writer = polls.writeStream.option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda rows, batch: write_snapshot(rows, batch, path))
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def snapshots(spark: SparkSession, path: str, polls: DataFrame) -> DataFrame:
    """All snapshots: batch, taken, and the newest poll of every station known by then."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in polls.schema)
    return spark.read.schema(f"{columns}, taken timestamp, batch int").parquet(f"{path}/snapshots")
