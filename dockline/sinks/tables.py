"""Written tables. Paths are folders on storage that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockline import schemas as S
from dockline.operators import pages as P


def overwrite(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_table(df: DataFrame, name: str) -> DataFrame:
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def create_history(spark: SparkSession, name: str, path: str | None = None) -> None:
    """The history table, partitioned by the derived snapshot date."""
    _create(spark, name, S.HISTORY_TABLE, path, partition="snapshot_date")


def create_usage_log(spark: SparkSession, name: str, path: str | None = None) -> None:
    _create(spark, name, S.USAGE_LOG, path)


def _create(spark: SparkSession, name: str, schema, path: str | None, partition: str | None = None) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        + (f" PARTITIONED BY ({partition})" if partition else "")
        + (f" LOCATION '{path}'" if path else "")
    )


def append_history(rows: DataFrame, path: str) -> None:
    """Appends snapshots below their date.

    Rebalancing gathers each date in files of the advised size: small dates
    are not scattered over many files, and a date with most of the rows is
    split over several tasks.
    """
    (
        rows.hint("rebalance", F.col("snapshot_date"))
        .write.mode("append").partitionBy("snapshot_date").parquet(path)
    )


def append_table(rows: DataFrame, name: str) -> None:
    """Appends by column name to an existing table."""
    target = rows.sparkSession.table(name).columns
    rows.select(*target).write.mode("append").insertInto(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def save_pages(results: DataFrame, path: str) -> dict[str, str]:
    """Content, metadata, index and totals of a crawl, each as its own table.

    ``results`` is read once per table; pass a written table when it is costly.
    """
    paths = {n: f"{path}/{n}" for n in ("content", "metadata", "index", "totals")}
    P.page_files(results).write.mode("overwrite").parquet(paths["content"])
    (
        results.select(P.U.file_name(F.col("url")).alias("filename"), "metadata.*")
        .write.mode("overwrite").json(paths["metadata"])
    )
    P.page_index(results).write.mode("overwrite").json(paths["index"])
    results.agg(F.count("*").alias("total_pages")).write.mode("overwrite").json(paths["totals"])
    return paths
