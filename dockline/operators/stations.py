"""Joins, searches and projections over station information and status.

Joins carry no broadcast hint: Spark broadcasts a side only after checking its
size, and otherwise shuffles and lets adaptive execution split hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockline.functions import columns as C

KEY = "station_id"


def latest_per_key(df: DataFrame, key: str = KEY, position: str = "position") -> DataFrame:
    """One row per key: the values of the last position, the place of the first.

    An aggregate rather than a window, so duplicates are folded before the
    shuffle and a hot key never lands whole in one task.
    """
    values = [c for c in df.columns if c not in (key, position)]
    return (
        df.groupBy(key)
        .agg(
            F.max_by(F.struct(*values), F.col(position)).alias("__last"),
            F.min(position).alias(position),
        )
        .select(key, *[F.col(f"__last.{c}").alias(c) for c in values], position)
    )


def _merged_columns(status: DataFrame, info: DataFrame, driver: str) -> list[Column]:
    """Information columns, then status columns; status wins where both have one."""
    shared = set(status.columns) & set(info.columns) - {KEY, "position"}
    out = [F.col(f"{driver}.{KEY}").alias(KEY)]
    for name in info.columns:
        if name in shared:
            out.append(F.coalesce(F.col(f"s.{name}"), F.col(f"i.{name}")).alias(name))
        elif name not in (KEY, "position"):
            out.append(F.col(f"i.{name}"))
    out += [F.col(f"s.{n}") for n in status.columns if n not in shared and n not in (KEY, "position")]
    if "position" in (status.columns if driver == "s" else info.columns):
        out.append(F.col(f"{driver}.position").alias("position"))
    return out


def merge_stations(status: DataFrame, info: DataFrame, how: str = "inner") -> DataFrame:
    """Status and information side by side.

    ``inner``: every status row that has information, in status order.
    ``left``: every information row, with the last status of its station.
    The looked-up side is reduced to one row per station in both cases.
    """
    if how == "inner":
        looked_up = latest_per_key(info)
        joined = status.alias("s").join(looked_up.alias("i"), F.col(f"s.{KEY}") == F.col(f"i.{KEY}"), "inner")
        return joined.select(*_merged_columns(status, looked_up, "s"))
    if how == "left":
        looked_up = latest_per_key(status)
        joined = info.alias("i").join(looked_up.alias("s"), F.col(f"s.{KEY}") == F.col(f"i.{KEY}"), "left")
        return joined.select(*_merged_columns(looked_up, info, "i"))
    raise ValueError(f"how must be 'inner' or 'left', not {how!r}")


def find_with_bikes(status: DataFrame, info: DataFrame, min_bikes: int = 1) -> DataFrame:
    return merge_stations(status.filter(C.has_bikes(min_bikes)), info)


def find_with_docks(status: DataFrame, info: DataFrame, min_docks: int = 1) -> DataFrame:
    return merge_stations(status.filter(C.has_docks(min_docks)), info)


def known_status(status: DataFrame, info: DataFrame) -> DataFrame:
    """Status rows whose station is known, without any information column."""
    return status.join(info.select(KEY), KEY, "left_semi")


def find_by_name(status: DataFrame, info: DataFrame, name: str) -> DataFrame:
    """The first station in feed order whose name contains the text, or no row.

    One information row is chosen first, so that status is only filtered for
    that station and not reduced as a whole.
    """
    chosen = (
        latest_per_key(info)
        .filter(C.contains_text(F.col("name"), name))
        .orderBy("position", KEY)
        .limit(1)
    )
    return merge_stations(status.join(chosen.select(KEY), KEY, "left_semi"), chosen, how="left")


def top_by(df: DataFrame, column: str, k: int) -> DataFrame:
    """Largest values first; the station id settles ties."""
    return df.orderBy(F.col(column).desc(), F.col(KEY)).limit(k)


def live_view(merged: DataFrame, queried_at: Column | None = None) -> DataFrame:
    """The station view: named columns, utilisation, query time."""
    return merged.select(
        KEY, "name", "lat", "lon", "capacity",
        "num_bikes_available", "num_docks_available", "is_renting", "is_returning",
        C.utilization_pct().alias("utilization_pct"),
        (F.current_timestamp() if queried_at is None else queried_at).alias("queried_at"),
    )


def with_display_text(merged: DataFrame) -> DataFrame:
    return merged.select(KEY, C.display_text().alias("display_text"))


def quality_violations(merged: DataFrame) -> DataFrame:
    """Rows checked and rows outside each plausible range, in one pass."""
    def outside(name: str, low: float, high: float) -> Column:
        return ~F.coalesce((F.col(name) > low) & (F.col(name) < high), F.lit(False))

    # --- fixed values: plausible ranges, and the slack of bikes + docks over capacity
    lat_range, lon_range, slack = (45.0, 46.0), (-74.5, -73.0), 5
    held = C.count_of("num_bikes_available") + C.count_of("num_docks_available")
    return merged.agg(
        F.count("*").alias("rows_checked"),
        F.count_if(outside("lat", *lat_range)).alias("lat_violations"),
        F.count_if(outside("lon", *lon_range)).alias("lon_violations"),
        F.count_if(held > C.count_of("capacity") + slack).alias("capacity_violations"),
    )


def json_documents(merged: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One JSON object per station; absent values are left out of it."""
    names = fields or [c for c in merged.columns if c != "position"]
    return merged.select("position", F.to_json(F.struct(*names)).alias("station_json"))


def json_pages(merged: DataFrame, fields: list[str] | None = None, page_size: int = 1000) -> DataFrame:
    """The result as JSON arrays of at most ``page_size`` stations, in feed order.

    A single array over all stations would have to be built by one task. The
    page number comes from the row's own position, so no global numbering is
    needed and every group is bounded.
    """
    names = fields or [c for c in merged.columns if c != "position"]
    page = F.call_function("div", F.col("position"), F.lit(page_size)).alias("page")
    entry = F.struct(F.col("position"), F.struct(*names).alias("station"))
    return (
        merged.groupBy(page)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select("page", F.to_json(F.transform("entries", lambda e: e["station"])).alias("stations_json"))
    )


def parse_pages(pages: DataFrame, schema: str, column: str = "stations_json") -> DataFrame:
    """JSON arrays back to typed rows."""
    return pages.select(F.explode(F.from_json(F.col(column), schema)).alias("s")).select("s.*")
