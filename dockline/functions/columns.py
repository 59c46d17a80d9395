"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
TIERS = ["Empty", "Low (1-2)", "Medium (3-5)", "Good (6-9)", "Excellent (10+)"]
TIER_UPPER_BOUNDS = [1, 3, 6, 10]
USE_LEVELS = ["Busy (75%+)", "Moderate (50-75%)", "Quiet (25-50%)", "Very Quiet (<25%)"]
USE_LEVEL_FLOORS = [75, 50, 25]
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8], "Fall": [9, 10, 11]}
HOLIDAY_MONTHS = [7, 12]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
DISPLAY_FORMAT = (
    "Station: %s\n"
    "Location: (%.6f, %.6f)\n"
    "Capacity: %d\n"
    "Available Bikes: %d\n"
    "Available Docks: %d\n"
    "Status: Installed %s | Renting %s | Returning %s"
)
YES_MARK, NO_MARK = "✓", "✗"
# --------------------------------------------------------------------------


def count_of(name: str) -> Column:
    """An availability count; a missing one is 0."""
    return F.coalesce(F.col(name), F.lit(0))


def flag(name: str) -> Column:
    """A state flag; a missing one is false."""
    return F.coalesce(F.col(name), F.lit(False))


def has_bikes(minimum: int) -> Column:
    return (count_of("num_bikes_available") >= minimum) & flag("is_renting") & flag("is_installed")


def has_docks(minimum: int) -> Column:
    return (count_of("num_docks_available") >= minimum) & flag("is_returning") & flag("is_installed")


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """``100 * part / whole`` of non-negative integers, rounded half up.

    Integer arithmetic makes the rounding exact, so it cannot differ between
    engines the way rounding a binary fraction can. NULL where whole is 0.
    """
    scale = 10 ** places
    part, whole = part.cast("bigint"), whole.cast("bigint")
    steps = F.call_function("div", F.lit(200 * scale) * part + whole, F.nullif(F.lit(2) * whole, F.lit(0)))
    return steps / F.lit(float(scale))


def utilization_pct() -> Column:
    return percent(count_of("num_bikes_available"), F.col("capacity"))


def ladder(value: Column, labels: list, bounds: list, below: bool) -> Column:
    """First label whose bound holds (``value < b`` or ``value >= b``), else the last."""
    column = None
    for label, bound in zip(labels, bounds):
        test = value < bound if below else value >= bound
        column = F.when(test, F.lit(label)) if column is None else column.when(test, F.lit(label))
    return column.otherwise(F.lit(labels[-1]))


def availability_tier(value: Column) -> Column:
    return ladder(value, TIERS, TIER_UPPER_BOUNDS, below=True)


def use_level(pct: Column) -> Column:
    return ladder(pct, USE_LEVELS, USE_LEVEL_FLOORS, below=False)


def rank_in(value: Column, labels: list[str]) -> Column:
    """1-based place of a label in its list, for custom sort orders."""
    return F.array_position(F.array(*[F.lit(v) for v in labels]), value)


def contains_text(haystack: Column, needle: str | Column) -> Column:
    """Case-insensitive substring test; wildcard characters are literal."""
    needle = needle if isinstance(needle, Column) else F.lit(needle)
    return F.contains(F.lower(F.coalesce(haystack, F.lit(""))), F.lower(needle))


def planar_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = lat1 - lat2, lon1 - lon2
    return F.sqrt(dlat * dlat + dlon * dlon)


def display_text() -> Column:
    mark = lambda name: F.when(flag(name), F.lit(YES_MARK)).otherwise(F.lit(NO_MARK))
    real = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    return F.format_string(
        DISPLAY_FORMAT,
        F.coalesce("name", F.lit("Unknown")),
        real("lat"), real("lon"),
        count_of("capacity"), count_of("num_bikes_available"), count_of("num_docks_available"),
        mark("is_installed"), mark("is_renting"), mark("is_returning"),
    )


# --- calendar -------------------------------------------------------------

def season(month: Column) -> Column:
    column = None
    for name, months in SEASONS.items():
        test = month.isin(months)
        column = F.when(test, F.lit(name)) if column is None else column.when(test, F.lit(name))
    return column


def calendar_basics(date: Column) -> dict[str, Column]:
    """Weekday (Monday is 0), month and weekend flag of a date."""
    return {
        "day_of_week": F.weekday(date),
        "month": F.month(date),
        "is_weekend": F.weekday(date).isin(5, 6),
    }


def calendar_details(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "quarter": F.quarter(date),
        "day_of_year": F.dayofyear(date),
        "week_of_year": F.weekofyear(date),
        "hour": F.hour(date.cast("timestamp_ntz")),
        "season": season(F.month(date)),
        "is_holiday": F.month(date).isin(HOLIDAY_MONTHS),
        "is_monday": F.weekday(date) == 0,
        "is_friday": F.weekday(date) == 4,
    }


def cyclical(value: Column, period: int, name: str) -> dict[str, Column]:
    angle = F.lit(2 * math.pi) * value / F.lit(period)
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def as_date(value: Column) -> Column:
    """Date of a timestamp or of ISO text; NULL when the text is no date."""
    return F.try_to_timestamp(value.cast("string")).cast("date")
