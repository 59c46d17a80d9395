"""URL expressions. Patterns work on any text and never raise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
SKIPPED_EXTENSIONS = [".pdf", ".jpg", ".jpeg", ".png", ".gif", ".css", ".js", ".xml"]
SKIPPED_PATTERNS = ["/api/", "/admin/", "/login", "/logout", "/register"]
FILE_NAME_LIMIT = 100
EMPTY_PATH_NAME = "index"
EMPTY_FILE_NAME = "page"
# --------------------------------------------------------------------------

AUTHORITY_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
PATH_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"


def authority(url: Column) -> Column:
    """Host part, with a port if the URL has one; empty when there is none."""
    return F.regexp_extract(url, AUTHORITY_PATTERN, 1)


def path(url: Column) -> Column:
    """Path without query, fragment, or the parameters of its last segment."""
    return F.regexp_replace(F.regexp_extract(url, PATH_PATTERN, 1), r";[^/]*$", "")


def worth_visiting(url: Column) -> Column:
    """Neither a skipped file type nor a skipped address pattern."""
    lowered = F.lower(url)
    skipped = F.lit(False)
    for extension in SKIPPED_EXTENSIONS:
        skipped = skipped | F.endswith(lowered, F.lit(extension))
    for pattern in SKIPPED_PATTERNS:
        skipped = skipped | F.contains(url, F.lit(pattern))
    return F.coalesce(~skipped, F.lit(False))


def admissible(df: DataFrame, url: str, hosts: list[str] | DataFrame) -> DataFrame:
    """Rows whose URL is on an allowed host and worth visiting.

    A fixed list is tested in place. A DataFrame with a ``host`` column may be
    of any size: it is semi-joined, and Spark picks the strategy by its size.
    """
    kept = df.filter(worth_visiting(F.col(url)))
    if isinstance(hosts, DataFrame):
        allowed = hosts.select(F.col("host").alias("__host")).distinct()
        return kept.join(allowed, authority(F.col(url)) == F.col("__host"), "left_semi")
    return kept.filter(authority(F.col(url)).isin(list(hosts)))


def file_name(url: Column) -> Column:
    """A safe file name for a page: letters, digits, ``_ - .``, 100 characters at most."""
    trimmed = F.regexp_replace(path(url), r"^/+|/+$", "")
    named = F.when(trimmed == "", F.lit(EMPTY_PATH_NAME)).otherwise(trimmed)
    safe = F.regexp_replace(named, r"[^\p{L}\p{N}_\-.]", "_")
    safe = F.regexp_replace(safe, r"_+", "_")
    safe = F.regexp_replace(safe, r"^_+|_+$", "")
    short = F.left(safe, F.lit(FILE_NAME_LIMIT))
    return F.when(short == "", F.lit(EMPTY_FILE_NAME)).otherwise(short)
