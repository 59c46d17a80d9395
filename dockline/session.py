"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: run-time re-planning, skew splitting, and
# UTC so that dates do not depend on the machine.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "dockline", **conf: str) -> SparkSession:
    """A session with the defaults above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share.

    That is the one the cluster names in ``spark.checkpoint.dir``, else the context's checkpoint folder, else one
    below the warehouse, which tables need to be shared as well. No folder is ever made up. On several machines a
    warehouse on a local disk is refused, as each executor would write to its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse:
        raise ValueError("the session names neither spark.checkpoint.dir nor a warehouse folder")
    if not _shared(spark.sparkContext.master, warehouse):
        raise ValueError("spark.checkpoint.dir is not set, and the warehouse is on a local disk: name a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_intermediate"


def _shared(master: str, folder: str) -> bool:
    """Whether all executors see the folder: always on one machine, else unless it is on a local disk."""
    one_machine = master.startswith("local") and not master.startswith("local-cluster")
    return one_machine or not (folder.startswith("file:") or folder.startswith("/"))


_given: list[str] = []


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    _given.append(f"{shared_root(spark)}/dockline/{label}-{uuid.uuid4().hex}")
    return _given[-1]


def cut_lineage(df: DataFrame, label: str = "step") -> DataFrame:
    """Writes the frame to the shared folder and reads it back.

    Survives the loss of any executor, ends the plan, and gives later joins
    the real size of the table.
    """
    path = shared_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder on whatever storage holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_intermediates(spark: SparkSession) -> None:
    """Removes what this process has written below the shared folder; for when no result that reads it is open."""
    while _given:
        drop_path(spark, _given.pop())
