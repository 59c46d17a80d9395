"""Trip and zone files, catalog tables, rows from memory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockline import schemas as S


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # enforceSchema off: the header is checked, so a reordered file cannot be misread.
    return (
        spark.read.schema(schema)
        .option("header", True).option("encoding", "UTF-8").option("enforceSchema", False)
        .csv(path)
    )


def zone_stations(spark: SparkSession, path: str) -> DataFrame:
    """A missing path raises ``AnalysisException`` (PATH_NOT_FOUND)."""
    return _csv(spark, path, S.ZONES)


def trip_records(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, S.TRIPS)


def file_listing(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Name and size of each file; file contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .load(folder).select("path", "length")
    )
    return listed.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size_bytes"),
        F.round(F.col("length") / F.lit(1024 * 1024), 2).alias("size_mb"),
    )


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
