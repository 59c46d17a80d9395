"""Page tables: parsing, links, crawl, index, statistics."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockline.functions import urls as U
from dockline.operators import markup
from dockline.operators.markup import read_page
from dockline.session import cut_lineage

# The page reader travels with the task, so executors need no copy of the package.
for _module in (markup, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

# --- fixed values ---------------------------------------------------------
CONTENT_HEADER = (
    "# %s\n\n"
    "**URL:** %s  \n"
    "**Description:** %s  \n"
    "**Main Heading:** %s  \n"
    "**Scraped:** %s\n\n"
    "---\n\n"
)
ERROR_TITLE = "Error"
ERROR_CONTENT = "# Error scraping %s\n\nError: %s"
NO_PAGE = "page not found"
PAGES_AT_ONCE = 64  # pages whose texts a Python worker holds side by side
# --------------------------------------------------------------------------

_PARSED = ("url string, title string, description string, main_heading string, "
           "body string, links array<string>, error string")
_PARSED_COLUMNS = ["url", "title", "description", "main_heading", "body", "links", "error"]


def _parse_batches(batches: Iterator[pa.RecordBatch], clean: bool = True) -> Iterator[pa.RecordBatch]:
    """Parsed pages, a few at a time: a batch of Spark's has up to 10,000 pages, which only stay there as Arrow's bytes."""
    schema = pa.schema([(c, pa.list_(pa.string()) if c == "links" else pa.string()) for c in _PARSED_COLUMNS])
    for batch in batches:
        for at in range(0, batch.num_rows, PAGES_AT_ONCE):
            rows = []
            for page in batch.slice(at, PAGES_AT_ONCE).to_pylist():
                row = dict.fromkeys(_PARSED_COLUMNS)
                try:
                    if page["html"] is None:
                        raise ValueError(NO_PAGE)
                    row.update(read_page(page["url"] or "", page["html"], clean))
                except Exception as problem:  # one bad page must not end the job
                    row["error"] = str(problem) or type(problem).__name__
                rows.append({**row, "url": page["url"]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _kept_links(links: Column, hosts: list[str] | None) -> Column:
    def keep(url: Column) -> Column:
        good = U.worth_visiting(url)
        return good if hosts is None else good & U.authority(url).isin(list(hosts))

    return F.array_distinct(F.filter(links, keep))


def parse_pages(pages: DataFrame, hosts: list[str] | None = None, scraped_at: Column | None = None,
                clean: bool = True) -> DataFrame:
    """Cleaned content, metadata and links of each page, from one parse per page.

    Pages that cannot be parsed become rows with status ``error``. With
    ``hosts`` only links to these hosts are kept; without, links to any host.
    ``clean`` drops scripts, styles, navigation, headers and footers first,
    their links included.
    """
    parsed = pages.select("url", "html").mapInArrow(partial(_parse_batches, clean=clean), _PARSED)
    when = F.unix_timestamp().cast("double") if scraped_at is None else scraped_at.cast("double")
    failed = F.col("error").isNotNull()
    stamp = F.date_format(F.timestamp_seconds(F.col("scraped_at")), "yyyy-MM-dd HH:mm:ss")
    header = F.format_string(CONTENT_HEADER, "title", "url", "description", "main_heading", stamp)
    return (
        parsed.withColumn("scraped_at", F.when(~failed, when))
        .select(
            "url",
            F.struct(
                F.when(failed, F.lit(ERROR_TITLE)).otherwise(F.col("title")).alias("title"),
                "description", "main_heading", "url", "scraped_at",
            ).alias("metadata"),
            F.when(failed, F.format_string(ERROR_CONTENT, "url", "error"))
            .otherwise(F.concat(header, "body")).alias("content"),
            F.coalesce(_kept_links(F.col("links"), hosts), F.array().cast("array<string>")).alias("links"),
            F.when(failed, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        )
    )


def link_edges(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.col("url").alias("src"), F.explode("links").alias("dst"))


def unvisited(frontier: DataFrame, visited: DataFrame) -> DataFrame:
    """Frontier URLs that have not been visited."""
    return frontier.join(visited.select("url"), "url", "left_anti")


def reach(edges: DataFrame, starts: DataFrame, max_depth: int = 3) -> DataFrame:
    """URLs reachable in at most ``max_depth`` links, with their smallest depth.

    Breadth first, one join per level. Targets are made distinct before they
    meet the visited set, so a page everybody links to is folded in the map
    tasks. Each level is written to the shared folder; an empty one ends the loop.
    """
    visited = cut_lineage(starts.select("url").distinct().withColumn("depth", F.lit(0)))
    frontier = visited
    for depth in range(1, max_depth + 1):
        targets = (
            edges.join(frontier.select(F.col("url").alias("src")), "src", "left_semi")
            .select(F.col("dst").alias("url")).distinct()
        )
        frontier = cut_lineage(unvisited(targets, visited).withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


def links_to(parsed: DataFrame, hosts: DataFrame) -> DataFrame:
    """(url, links) with only the links to the given hosts, of which there may be many.

    A page's links came from one page, so gathering them again is bounded.
    """
    return (
        U.admissible(link_edges(parsed), "dst", hosts)
        .groupBy(F.col("src").alias("url"))
        .agg(F.collect_set("dst").alias("links"))
    )


def one_per_url(parsed: DataFrame) -> DataFrame:
    """One row per address: a parsed page before an error, then the one with the least hash of its content."""
    rest = [c for c in parsed.columns if c != "url"]
    order = F.struct(F.col("status") != "success", F.xxhash64("content"))
    return parsed.groupBy("url").agg(F.min_by(F.struct(*rest), order).alias("page")).select("url", *(F.col(f"page.{c}") for c in rest))


def crawl(parsed: DataFrame, starts: DataFrame, max_depth: int = 3, links: DataFrame | None = None) -> DataFrame:
    """Parsed pages reached from the start URLs, with depth; unknown pages as errors.

    The links are read once per level, so pass written tables. With ``links``
    (url, links) these are followed and reported instead of the pages' own. An
    address that stands in several rows is visited once.
    """
    parsed = one_per_url(parsed)
    followed = parsed.select("url", "links") if links is None else links
    reached = reach(link_edges(followed), starts, max_depth)
    found = parsed if links is None else parsed.drop("links").join(links, "url", "left")
    missing = F.col("status").isNull()
    none = F.array().cast("array<string>")
    return reached.join(found, "url", "left").select(
        "url", "depth",
        F.when(missing, F.named_struct(
            F.lit("title"), F.lit(ERROR_TITLE),
            F.lit("description"), F.lit(None).cast("string"),
            F.lit("main_heading"), F.lit(None).cast("string"),
            F.lit("url"), F.col("url"),
            F.lit("scraped_at"), F.lit(None).cast("double"),
        )).otherwise(F.col("metadata")).alias("metadata"),
        F.when(missing, F.format_string(ERROR_CONTENT, F.col("url"), F.lit(NO_PAGE)))
        .otherwise(F.col("content")).alias("content"),
        F.coalesce("links", none).alias("links"),
        F.coalesce("status", F.lit("error")).alias("status"),
    )


def page_index(results: DataFrame) -> DataFrame:
    """One index row per page, with defaults for what is missing."""
    return results.select(
        "url",
        F.coalesce("metadata.title", F.lit("Untitled")).alias("title"),
        F.coalesce("status", F.lit("unknown")).alias("status"),
        F.coalesce(F.array_size("links"), F.lit(0)).alias("links_count"),
        F.col("metadata.scraped_at").alias("scraped_at"),
    )


def page_files(results: DataFrame) -> DataFrame:
    return results.select(U.file_name(F.col("url")).alias("filename"), "url", "content")


def crawl_stats(results: DataFrame) -> DataFrame:
    good = F.count_if(F.col("status") == "success")
    return results.agg(
        F.count("*").alias("total_pages"),
        good.alias("successful_pages"),
        (F.count("*") - good).alias("error_pages"),
        F.coalesce(F.sum(F.coalesce(F.array_size("links"), F.lit(0))), F.lit(0)).cast("bigint").alias("total_links_found"),
        F.count("url").alias("visited_urls"),
    )
