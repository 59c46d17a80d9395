"""Whole jobs for users: feeds by language, snapshots, a site crawl, model training."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockline.functions import catalog
from dockline.operators import history as H
from dockline.operators import metrics as M
from dockline.operators import pages as P
from dockline.operators import stations as ST
from dockline.operators import trips as TR
from dockline.operators.forecast import TripPredictor
from dockline.session import cut_lineage
from dockline.sinks import tables as K
from dockline.sources import feeds as FD


@dataclass(frozen=True)
class LandedFeeds:
    """Feed documents landed as ``<root>/<language>/<feed>.json`` and ``<root>/feeds.json``.

    A path may be a file or a folder of documents, of which the one updated last is the live state. Every
    method returns a DataFrame and reads only what its result needs.
    """

    spark: SparkSession
    root: str

    def _path(self, feed: str, language: str) -> str:
        return f"{self.root}/{language}/{feed}.json"

    def feeds(self, language: str = "en") -> DataFrame:
        return FD.feed_list(self.spark, f"{self.root}/feeds.json", language)

    def station_status(self, language: str = "en") -> DataFrame:
        return FD.station_status(self.spark, self._path("station_status", language), newest=True).drop("last_updated", "ttl")

    def station_information(self, language: str = "en") -> DataFrame:
        return FD.station_information(self.spark, self._path("station_information", language), newest=True).drop("last_updated", "ttl")

    def system_information(self, language: str = "en") -> DataFrame:
        return FD.system_information(self.spark, self._path("system_information", language), newest=True)

    def system_alerts(self, language: str = "en") -> DataFrame:
        return FD.system_alerts(self.spark, self._path("system_alerts", language), newest=True)

    def vehicle_types(self, language: str = "en") -> DataFrame:
        return FD.vehicle_types(self.spark, self._path("vehicle_types", language), newest=True)

    def find_stations_with_bikes(self, min_bikes: int = 1, language: str = "en") -> DataFrame:
        return ST.find_with_bikes(self.station_status(language), self.station_information(language), min_bikes)

    def find_stations_with_docks(self, min_docks: int = 1, language: str = "en") -> DataFrame:
        return ST.find_with_docks(self.station_status(language), self.station_information(language), min_docks)

    def station_by_name(self, name: str, language: str = "en") -> DataFrame:
        return ST.find_by_name(self.station_status(language), self.station_information(language), name)

    def all_stations_summary(self, language: str = "en", how: str = "inner") -> DataFrame:
        return ST.merge_stations(self.station_status(language), self.station_information(language), how)

    def metrics(self, language: str = "en") -> DataFrame:
        return M.feed_metrics(self.station_information(language), self.station_status(language))

    def register_functions(self, languages: tuple[str, ...] = ("en",), prefix: str = "") -> list[str]:
        """The SQL functions over these feeds, chosen by their language argument."""
        def spoken(read) -> DataFrame:
            frames = [read(language).withColumn("lang", F.lit(language)) for language in languages]
            union = frames[0]
            for frame in frames[1:]:
                union = union.unionByName(frame)
            return union

        raw = lambda feed: lambda language: FD.raw_documents(self.spark, self._path(feed, language))
        catalog.register_sources(
            self.spark, spoken(self.station_status), spoken(self.station_information),
            spoken(raw("system_information")), spoken(raw("system_alerts")))
        return catalog.register_all(self.spark, prefix)

    def append_snapshot(self, path: str, taken: Column | None = None, language: str = "en") -> None:
        """One snapshot of all stations, appended to the history."""
        K.append_history(H.history_rows(self.all_stations_summary(language, how="left"), taken), path)


def crawl_site(pages: DataFrame, start_url: str, hosts: list[str], path: str, max_depth: int = 3,
               scraped_at: Column | None = None) -> DataFrame:
    """Parse, crawl from the start URL, save content, metadata and index; returns the statistics."""
    spark = pages.sparkSession
    parsed = K.overwrite(P.parse_pages(pages, hosts, scraped_at), f"{path}/parsed")
    starts = spark.createDataFrame([(start_url,)], "url string")
    results = K.overwrite(P.crawl(parsed, starts, max_depth), f"{path}/results")
    K.save_pages(results, path)
    return P.crawl_stats(results)


def train_from_trips(trips: DataFrame, stations: DataFrame, path: str, model_type: str = "random_forest",
                     advanced: bool = False, **kwargs) -> TripPredictor:
    """Trips to zone-day counts to a scored model, saved below ``path``."""
    days = cut_lineage(TR.zone_day_counts_of(trips, stations), "zone-days")
    means = TR.zone_means(days) if advanced else None
    features = cut_lineage(TR.advanced_features(days), "features") if advanced else days
    predictor = TripPredictor(model_type, advanced=advanced, zone_means=means, **kwargs).train(features)
    predictor.save(f"{path}/{model_type}", trips.sparkSession)
    return predictor
