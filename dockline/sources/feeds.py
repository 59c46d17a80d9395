"""Landed feed documents: one JSON document per file, read with explicit schemas.

``path`` may hold any number of documents (one per poll). A row's ``position`` is (update time of the document,
document, place inside it): unique, the latest poll last. With ``newest`` only the document updated last is
read, as the live state, and ``position`` is the place alone. ``raw`` adds the whole item as JSON text under
that name, for fields beyond the named ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockline import schemas as S

NO_SUMMARY = "No summary"


def documents(spark: SparkSession, path: str, schema: T.StructType, lines: bool = False, newest: bool = False) -> DataFrame:
    """Whole documents; ``lines`` for files with one document per line.

    ``document`` names the file, and the contents too where a file holds several.
    """
    read = spark.read.schema(schema).option("multiLine", not lines).json(path)
    name = F.col("_metadata.file_path")
    docs = read.select("*", (F.concat_ws("#", name, F.xxhash64(F.to_json(F.struct("data")))) if lines else name).alias("document"))
    if not newest:
        return docs
    order = F.struct(F.coalesce("last_updated", F.lit(0)).alias("at"), "document")
    return docs.where(order == docs.agg(F.max(order)).scalar())


def typed(item: Column, kind: T.StructType) -> list[Column]:
    """The named fields of an item; flags and numbers that can't be read raise an error."""
    texts = F.from_json(item, T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType) for f in kind]),
        {"mode": "FAILFAST"})
    out = []
    for f in kind:
        value = texts[f.name]
        if isinstance(f.dataType, T.BooleanType):
            low = F.lower(value)
            value = F.when(low.isin("true", "false"), low == "true").otherwise(value.cast("double") != 0)
        out.append(value.alias(f.name))
    return out


def _items(spark: SparkSession, path: str, name: str, kind: T.StructType, lines: bool, newest: bool, raw: bool) -> DataFrame:
    docs = documents(spark, path, S.ITEM_FEED[name], lines, newest)
    rows = docs.select("last_updated", "ttl", "document", F.posexplode(f"data.{name}").alias("place", "item"))
    position = F.col("place").cast("bigint") if newest else F.struct(
        F.coalesce("last_updated", F.lit(0)).alias("last_updated"), "document", "place")
    return rows.select(*typed(F.col("item"), kind), *([F.col("item").alias("raw")] if raw else []),
                       position.alias("position"), "last_updated", "ttl")


def station_status(spark: SparkSession, path: str, lines: bool = False, newest: bool = False, raw: bool = False) -> DataFrame:
    return _items(spark, path, "stations", S.STATUS_STATION, lines, newest, raw)


def station_information(spark: SparkSession, path: str, lines: bool = False, newest: bool = False, raw: bool = False) -> DataFrame:
    return _items(spark, path, "stations", S.INFO_STATION, lines, newest, raw)


def vehicle_types(spark: SparkSession, path: str, lines: bool = False, newest: bool = False, raw: bool = False) -> DataFrame:
    return _items(spark, path, "vehicle_types", S.VEHICLE_TYPE, lines, newest, raw)


def system_alerts(spark: SparkSession, path: str, lines: bool = False, newest: bool = False, raw: bool = False) -> DataFrame:
    """One row per alert; a document without alerts yields no row."""
    return _items(spark, path, "alerts", S.ALERT, lines, newest, raw).withColumn(
        "summary", F.coalesce("summary", F.lit(NO_SUMMARY)))


def system_information(spark: SparkSession, path: str, lines: bool = False, newest: bool = False, raw: bool = False) -> DataFrame:
    docs = documents(spark, path, S.SYSTEM_FEED, lines, newest)
    return docs.select(*typed(F.col("data"), S.SYSTEM), *([F.col("data").alias("raw")] if raw else []), "last_updated")


def feed_list(spark: SparkSession, path: str, language: str = "en", lines: bool = False) -> DataFrame:
    """Feeds of the language, else of English, else none."""
    return choose_feeds(documents(spark, path, S.FEED_LIST, lines), language)


def choose_feeds(docs: DataFrame, language: str = "en") -> DataFrame:
    listed = F.coalesce(
        F.try_element_at("data", F.lit(language)), F.try_element_at("data", F.lit("en")))
    return docs.select(F.explode(listed["feeds"]).alias("feed")).select("feed.*")


def raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one JSON string."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("json"))


def as_envelopes(rows: DataFrame, last_updated, fields: list[str], per_document: int = 1000, ttl: int = 10) -> DataFrame:
    """Station rows packed into feed documents of bounded size, in position order.

    The inverse of the readers: one JSON string per document.
    """
    entry = F.struct(F.col("position"), F.struct(*fields).alias("item"))
    document = F.call_function("div", F.col("position"), F.lit(per_document)).alias("document")
    return (
        rows.groupBy(document)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(F.to_json(F.struct(
            last_updated.cast("bigint").alias("last_updated"),
            F.lit(ttl).alias("ttl"),
            F.struct(F.transform("entries", lambda e: e["item"]).alias("stations")).alias("data"),
        )).alias("value"))
    )
