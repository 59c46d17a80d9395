"""Counts of stations near many locations, and the nearest k, without making all pairs in the radius.

Space is cut into square cells whose side is the radius, and cells are halved where that helps. A pair of cells, one of
locations and one of stations, is decided as a whole where it can be: cells wholly inside the radius are counted by their
totals, cells wholly outside, or farther than k stations are known to be, are dropped. Only undecided pairs of small cells
are compared row by row; undecided pairs of crowded cells are split into the pairs of their quarters and looked at again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockline.functions import columns as C
from dockline.session import cut_lineage

MOST_COMPARED = 1 << 18   # rows x rows that one cell of locations is compared with
DEEPEST = 40           # halvings; by then a cell holds one place
SALTS = 16
CELL, PAIR = ["ax", "ay"], ["ax", "ay", "bx", "by"]


def _places(rows: DataFrame) -> DataFrame:
    """Rows with coordinates, -0.0 taken as 0.0."""
    sound = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c)) < F.lit(float("inf")))
    return rows.where(sound("lat") & sound("lon")).withColumns({c: F.col(c).cast("double") + F.lit(0.0) for c in ("lat", "lon")})


def _index(column: str, radius: float, level: int) -> Column:
    """The number of the cell; halving the side doubles the quotient exactly, so a cell's quarters are its own."""
    return F.floor(F.col(column) / F.lit(radius / 2 ** level)).cast("bigint")


def _totals(places: DataFrame, radius: float, level: int, x: str, y: str, n: str) -> DataFrame:
    return places.groupBy(_index("lat", radius, level).alias(x), _index("lon", radius, level).alias(y)).agg(F.sum("n").alias(n))


def _measured(pairs: DataFrame, radius: float, level: int) -> DataFrame:
    """Adds the least and the largest distance that two points of a pair of cells can have."""
    side = radius / 2 ** level
    least = "sqrt(pow(greatest(abs(ax - bx) - 1, 0), 2) + pow(greatest(abs(ay - by) - 1, 0), 2))"
    most = "sqrt(pow(abs(ax - bx) + 1, 2) + pow(abs(ay - by) + 1, 2))"
    return pairs.withColumn("least", F.expr(least) * side).withColumn("most", F.expr(most) * side)


def _first_pairs(location_cells: DataFrame, station_cells: DataFrame) -> DataFrame:
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    around = location_cells.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps)) \
        .select("ax", "ay", "na", (F.col("ax") + F.col("dx")).alias("bx"), (F.col("ay") + F.col("dy")).alias("by"))
    return around.join(station_cells, ["bx", "by"])


def _quarters(pairs: DataFrame, location_cells: DataFrame, station_cells: DataFrame) -> DataFrame:
    """The pairs of the quarters of both cells that hold anything."""
    halves = F.array(F.lit(0), F.lit(1))
    parts = pairs.select(*PAIR)
    for c in PAIR:
        parts = parts.withColumn("half", F.explode(halves)).withColumn(c, 2 * F.col(c) + F.col("half")).drop("half")
    return parts.join(location_cells, CELL).join(station_cells, ["bx", "by"])


def _walk(points: DataFrame, stations: DataFrame, radius: float, decide, most: int):
    """Goes down the levels. ``decide`` turns the pairs of a level into (pairs to keep, cells counted whole or None)."""
    finished, whole = [], []
    pairs = None
    for level in range(DEEPEST + 1):
        location_cells = _totals(points, radius, level, "ax", "ay", "na")
        station_cells = _totals(stations, radius, level, "bx", "by", "nb")
        found = _first_pairs(location_cells, station_cells) if pairs is None else _quarters(pairs, location_cells, station_cells)
        kept, counted = decide(_measured(found, radius, level))
        work = F.col("na") * F.sum("nb").over(Window.partitionBy(*CELL))
        ready = (work <= most) if level < DEEPEST else F.lit(True)
        kept = cut_lineage(kept.withColumn("ready", ready).select(*PAIR, "na", "nb", "ready"), "cell-pairs")
        finished.append((level, kept.where("ready").select(*PAIR)))
        if counted is not None:
            whole.append((level, counted))
        pairs = kept.where("NOT ready")
        if pairs.isEmpty():
            break
    return finished, whole


def _compared(points: DataFrame, stations: DataFrame, finished: list, radius: float) -> DataFrame:
    """Rows of points and stations in finished pairs of cells that are closer than the radius.

    The cells of a level are joined by salt as well, so that points of a crowded cell, which is finished deeper, do not
    gather in one task.
    """
    salt = lambda rows: F.pmod(F.xxhash64("lat", "lon"), F.lit(SALTS)).cast("int")
    out = []
    for level, pairs in finished:
        spread = pairs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        left = points.select("lat", "lon", _index("lat", radius, level).alias("ax"), _index("lon", radius, level).alias("ay"),
                             salt(points).alias("salt")).join(spread, [*CELL, "salt"]).drop("salt", *CELL)
        right = stations.select(
            *[F.col(c).alias(f"s_{c}") if c in ("lat", "lon") else F.col(c) for c in stations.columns],
            _index("lat", radius, level).alias("bx"), _index("lon", radius, level).alias("by"))
        near = left.join(right, ["bx", "by"]).withColumn("distance", C.planar_distance(
            F.col("s_lat"), F.col("s_lon"), F.col("lat"), F.col("lon")))
        out.append(near.where(F.col("distance") < radius).drop("bx", "by"))
    return reduce(DataFrame.unionByName, out)


def _margin(radius: float) -> float:
    return 1e-9 * radius + 1e-12


def _folded(rows: DataFrame) -> DataFrame:
    """One row per place, with how many rows stand there."""
    return rows.groupBy("lat", "lon").agg(F.count("*").alias("n"))


def nearest_stations(locations: DataFrame, stations: DataFrame, radius: float = 0.01, k: int = 5, most: int = MOST_COMPARED) -> DataFrame:
    """The nearest ``k`` stations closer than ``radius`` of every location, with distance and place; ties by station_id.

    Locations at one place are looked up once, and of stations at one place only the first ``k`` can count. A cell of
    locations drops the cells of stations that begin farther away than its nearest cells with ``k`` stations end.
    """
    given, placed = _places(locations), _places(stations)
    points = cut_lineage(_folded(given), "points")
    here = Window.partitionBy("lat", "lon").orderBy("station_id")
    first = cut_lineage(placed.withColumn("_here", F.row_number().over(here)).where(F.col("_here") <= k).drop("_here"), "first-stations")
    counted = first.groupBy("lat", "lon").agg(F.count("*").alias("n"))
    margin = _margin(radius)

    def decide(pairs: DataFrame):
        by_end = Window.partitionBy(*CELL).orderBy("most", "bx", "by").rowsBetween(Window.unboundedPreceding, 0)
        enough = F.min(F.when(F.col("known") >= k, F.col("most"))).over(Window.partitionBy(*CELL))
        bounded = pairs.withColumn("known", F.sum("nb").over(by_end)).withColumn("reach", F.least(F.coalesce(enough, F.lit(radius)), F.lit(radius)))
        return bounded.where(F.col("least") <= F.col("reach") + margin), None

    finished, _ = _walk(points.withColumn("n", F.lit(1)), counted, radius, decide, most)
    order = Window.partitionBy("lat", "lon").orderBy("distance", "station_id")
    top = _compared(points, first, finished, radius).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    top = top.withColumnsRenamed({"lat": "_lat", "lon": "_lon"})
    own = given.select("location_id", "lat", "lon")
    return own.join(top, (own["lat"] == top["_lat"]) & (own["lon"] == top["_lon"])).select(
        "location_id", *[F.col(f"s_{c}").alias(c) if c in ("lat", "lon") else F.col(c) for c in stations.columns], "distance", "place")


def near_counts(locations: DataFrame, stations: DataFrame, radius: float = 0.01, most: int = MOST_COMPARED) -> DataFrame:
    """How many stations are closer than ``radius`` to every location that has one, and how near the first is."""
    given = _places(locations)
    points = cut_lineage(_folded(given), "points")
    folded = cut_lineage(_folded(_places(stations)), "folded-stations")
    margin = _margin(radius)

    def decide(pairs: DataFrame):
        inside = F.col("most") < radius - margin
        counted = cut_lineage(pairs.where(inside).groupBy(*CELL).agg(F.sum("nb").alias("stations")), "whole-cells")
        return pairs.where(~inside & (F.col("least") < radius + margin)), counted

    finished, whole = _walk(points.withColumn("n", F.lit(1)), folded, radius, decide, most)
    counts = [_compared(points, folded, finished, radius).select("lat", "lon", F.col("n").alias("stations"))]
    for level, cells in whole:
        spread = cells.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        counts.append(points.select("lat", "lon", _index("lat", radius, level).alias("ax"), _index("lon", radius, level).alias("ay"),
                                    F.pmod(F.xxhash64("lat", "lon"), F.lit(SALTS)).cast("int").alias("salt"))
                      .join(spread, [*CELL, "salt"]).select("lat", "lon", "stations"))
    total = reduce(DataFrame.unionByName, counts).groupBy("lat", "lon").agg(F.sum("stations").alias("stations"))
    nearest = nearest_stations(points.select(F.struct("lat", "lon").alias("location_id"), "lat", "lon"),
                               folded.select(F.lit(0).alias("station_id"), "lat", "lon"), radius, 1, most)
    distance = nearest.select(F.col("location_id.lat").alias("lat"), F.col("location_id.lon").alias("lon"), "distance")
    return given.select("location_id", "lat", "lon").join(total, ["lat", "lon"]).join(distance, ["lat", "lon"]) \
        .select("location_id", "stations", "distance")
