"""Exact distribution summary and histogram of a numeric column.

Both first fold the column to (value, count), which absorbs any hot value
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockline.session import cut_lineage

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _value_counts(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double").alias("value")
    return df.filter(F.col(column).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))


def sliced_values(counts: DataFrame) -> DataFrame:
    """(value, n, slice): values cut into ranges, one per task of a range shuffle.

    The result is written once and read back, so that the slices are fixed
    and the column is folded only once.
    """
    ranges = counts.repartitionByRange("value").withColumn("slice", F.spark_partition_id())
    return cut_lineage(ranges, "slices")


def ranked_values(sliced: DataFrame) -> DataFrame:
    """Adds ``before``: how many rows have a smaller value.

    Running counts are taken inside each slice and raised by the total of the
    slices before it. Only the slice totals, one row per task of the range
    shuffle, are ever ordered in one task.
    """
    totals = sliced.groupBy("slice").agg(F.sum("n").alias("slice_rows"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("slice", F.coalesce(F.sum("slice_rows").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("slice").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, "slice")
        .select("value", "n", (F.col("offset") + F.col("inner")).alias("before"))
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max."""
    sliced = sliced_values(_value_counts(df, column))
    value, weight = F.col("value"), F.col("n").cast("double")
    known = sliced.agg(F.struct(
        F.sum("n").alias("rows"), (F.sum(value * weight) / F.sum(weight)).alias("mean"))).scalar()
    ranked = ranked_values(sliced).withColumns({"rows": known["rows"], "mean": known["mean"]})

    def at(rank):
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), value))

    parts = []
    for name, share in QUARTILES.items():
        exact = (F.col("rows") - 1) * F.lit(share)
        parts += [at(F.floor(exact)).alias(f"{name}_low"), at(F.ceil(exact)).alias(f"{name}_high"),
                  F.max(exact - F.floor(exact)).alias(f"{name}_part")]
    apart = value - F.col("mean")
    moments = ranked.agg(
        F.sum("n").alias("count"),
        F.max("mean").alias("mean"),
        F.sum(weight * apart * apart).alias("squares"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *parts,
    )
    spread = F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1)))
    between = lambda n: F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * F.col(f"{n}_part")
    return moments.select(
        "count", "mean", spread.alias("std"), "min",
        *[between(n).alias(n) for n in QUARTILES], "max",
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the value range, the last one closed; empty bins kept."""
    counts = _value_counts(df, column)
    ends = counts.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low) / F.lit(float(bins))
    filled = (
        counts
        .withColumn("bin", F.least(F.floor((F.col("value") - start) / width), F.lit(bins - 1)).cast("int"))
        .groupBy("bin").agg(F.sum("n").alias("rows_in_bin"))
    )
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        edges.join(filled, "bin", "left")
        .select(
            "bin",
            (start + F.col("bin") * width).alias("bin_start"),
            (start + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("rows_in_bin", F.lit(0)).alias("rows_in_bin"),
        )
        .orderBy("bin")
    )
