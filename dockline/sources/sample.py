"""Sample trips for demonstrations, generated by Spark from a station table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.operators.profile import ranked_values, sliced_values

# --- fixed values: trips per day, summer factor, jitter --------------------
WEEKDAY_TRIPS, WEEKEND_TRIPS = 40, 60
SUMMER_MONTHS, SUMMER_FACTOR = [6, 7, 8], 1.5
JITTER_LOW, JITTER_HIGH = -10, 15
# --------------------------------------------------------------------------


def sample_trips(stations: DataFrame, first_day: dt.date, days: int, seed: int = 42, scale: int = 1) -> DataFrame:
    """Trips between different stations, more at weekends and in summer.

    Stations are numbered once; a trip draws a start number and a step to a
    different end number, and both are looked up by equality. ``scale``
    multiplies the trips of every day. All days come from one range with
    room for the fullest day; what a day does not use of its room is left out.
    """
    spark = stations.sparkSession
    codes = stations.select("Code").distinct()
    numbered = ranked_values(sliced_values(codes.select(F.col("Code").alias("value"), F.lit(1).alias("n"))))
    total = codes.agg(F.count("*")).scalar()
    most = (int(max(WEEKDAY_TRIPS, WEEKEND_TRIPS) * SUMMER_FACTOR) + JITTER_HIGH) * scale
    day = F.date_add(F.lit(first_day), (F.col("id") / most).cast("int"))
    base = F.when(F.weekday("day") >= 5, WEEKEND_TRIPS).otherwise(WEEKDAY_TRIPS)
    seasonal = F.when(F.month("day").isin(SUMMER_MONTHS), F.floor(base * SUMMER_FACTOR)).otherwise(base)
    jitter = F.pmod(F.xxhash64("day", F.lit(seed)), F.lit(JITTER_HIGH - JITTER_LOW + 1)) + JITTER_LOW
    drawn = (
        spark.range(days * most).select("id", day.alias("day"))
        .where(F.col("id") % most < (seasonal + jitter) * scale)
        .withColumn("a", F.floor(F.rand(seed + 1) * total))
        .withColumn("step", F.floor(F.rand(seed + 2) * (total - 1)) + 1)
        .select("day", (F.col("a") + 1).alias("from_no"), (F.pmod(F.col("a") + F.col("step"), total) + 1).alias("to_no"))
    )
    code = lambda name, no: numbered.select(
        F.col("value").alias(name), (F.col("before") + 1).alias(no))
    return (
        drawn.join(code("start_station_code", "from_no"), "from_no")
        .join(code("end_station_code", "to_no"), "to_no")
        .select("start_station_code", "end_station_code", F.col("day").cast("timestamp_ntz").alias("start_date"))
    )

