"""Stations near a point, and near each of many points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockline.functions import columns as C


def within_radius(stations: DataFrame, lat: float, lon: float, radius: float = 0.01,
                  k: int | None = 5) -> DataFrame:
    """Stations closer than ``radius`` to one point, nearest first.

    The bounding box repeats the condition in a form the scan can use.
    """
    distance = C.planar_distance(F.col("lat"), F.col("lon"), F.lit(lat), F.lit(lon))
    near = (
        stations
        .filter(F.col("lat").between(lat - radius, lat + radius))
        .filter(F.col("lon").between(lon - radius, lon + radius))
        .withColumn("distance", distance)
        .filter(F.col("distance") < radius)
        .orderBy("distance", "station_id")
    )
    return near if k is None else near.limit(k)


def _cell(value: Column, radius: float) -> Column:
    return F.floor(value / F.lit(radius))


SALTS = 16


def near_pairs(locations: DataFrame, stations: DataFrame, radius: float = 0.01, pairs_per_task_side: int = 4096) -> DataFrame:
    """(location, station) pairs closer than ``radius``, to be reduced before they are shuffled.

    Space is cut into square cells of side ``radius``; a station can only be
    near a location of its own cell or of the eight around it, so cell equality
    is the join key. Both sides of a crowded cell are cut into blocks of about
    ``pairs_per_task_side`` rows and the block numbers join the key, so no task
    compares more than one block with another. Nothing is dropped: each
    location meets every block of stations and the other way round. The block
    counts, one row per cell, are joined by cell and salt, so that rows of a
    crowded cell are spread before they have blocks.
    """
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    points = (
        locations
        .filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .select("location_id", F.col("lat").alias("l_lat"), F.col("lon").alias("l_lon"))
        .withColumn("dx", F.explode(steps))
        .withColumn("dy", F.explode(steps))
        .select("location_id", "l_lat", "l_lon",
                (_cell(F.col("l_lat"), radius) + F.col("dx")).alias("cx"),
                (_cell(F.col("l_lon"), radius) + F.col("dy")).alias("cy"))
    )
    placed = (
        stations
        .filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .withColumn("cx", _cell(F.col("lat"), radius))
        .withColumn("cy", _cell(F.col("lon"), radius))
    )

    # How many blocks each occupied cell needs on either side.
    blocks = lambda n: F.ceil(F.col(n) / F.lit(pairs_per_task_side)).cast("int")
    station_cells = placed.groupBy("cx", "cy").agg(F.count("*").alias("ns"))
    location_cells = points.groupBy("cx", "cy").agg(F.count("*").alias("nl"))
    cells = station_cells.join(location_cells, ["cx", "cy"]).select(
        "cx", "cy", blocks("ns").alias("station_blocks"), blocks("nl").alias("location_blocks"))

    salt = lambda key: F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")
    salted = cells.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    all_blocks = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own_block = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = (
        points.withColumn("salt", salt("location_id")).join(salted, ["cx", "cy", "salt"])
        .withColumn("lb", own_block("location_id", "location_blocks"))
        .withColumn("sb", all_blocks("station_blocks"))
        .drop("station_blocks", "location_blocks", "salt")
    )
    right = (
        placed.withColumn("salt", salt("station_id")).join(salted, ["cx", "cy", "salt"])
        .withColumn("sb", own_block("station_id", "station_blocks"))
        .withColumn("lb", all_blocks("location_blocks"))
        .drop("station_blocks", "location_blocks", "salt")
    )
    return (
        left.join(right, ["cx", "cy", "lb", "sb"])
        .withColumn("distance", C.planar_distance(F.col("lat"), F.col("lon"), F.col("l_lat"), F.col("l_lon")))
        .filter(F.col("distance") < radius)
        .drop("cx", "cy", "lb", "sb", "l_lat", "l_lon")
    )


def nearest_stations(locations: DataFrame, stations: DataFrame, radius: float = 0.01, k: int = 5,
                     pairs_per_task_side: int = 4096) -> DataFrame:
    """The nearest ``k`` stations closer than ``radius`` of every location; limited inside each task first."""
    nearest = Window.partitionBy("location_id").orderBy("distance", "station_id")
    near = near_pairs(locations, stations, radius, pairs_per_task_side)
    return near.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k)


def near_counts(locations: DataFrame, stations: DataFrame, radius: float = 0.01, pairs_per_task_side: int = 4096) -> DataFrame:
    """How many stations are closer than ``radius`` to every location that has one, and how near the first is."""
    return near_pairs(locations, stations, radius, pairs_per_task_side).groupBy("location_id").agg(
        F.count("*").alias("stations"), F.min("distance").alias("distance"))
