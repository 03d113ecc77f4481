"""All queries over one set of canonical tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from docklens.operators.latest import latest_date
from docklens.operators.series import STRETCH
from docklens.plans import clusters, predictions, profiles, stations, timeseries, transactions
from docklens.sources import adapters
from docklens.sources.tables import read_table


@dataclass(frozen=True)
class BikeShare:
    """The canonical tables; every method returns a lazy DataFrame."""

    station: DataFrame
    readings: DataFrame
    daily: DataFrame
    prediction: DataFrame
    clustering: DataFrame
    centroid: DataFrame

    @classmethod
    def from_lake(cls, spark: SparkSession, lake: str) -> BikeShare:
        """Tables written by ``docklens.sinks.tables``; one not written yet is empty."""
        names = (
            "station", "timeseries", "daily_transaction", "prediction", "clustering", "centroid",
        )
        return cls(*[read_table(spark, lake, name) for name in names])

    @classmethod
    def from_star_schema(cls, spark: SparkSession, folder: str) -> BikeShare:
        """The test tables, seen as stations and readings."""
        makers = (
            adapters.station, adapters.timeseries, adapters.daily_transaction,
            adapters.prediction, adapters.clustering, adapters.centroid,
        )
        return cls(*[make(spark, folder) for make in makers])

    def cities(self) -> DataFrame:
        return stations.cities(self.station)

    def stations(self, city=None, limit=None, geojson=False) -> DataFrame:
        return stations.stations(self.station, city, limit, geojson)

    def specific_stations(self, city, ids) -> DataFrame:
        return stations.specific_stations(self.station, ids, city)

    def station_ids(self, city=None) -> DataFrame:
        return stations.station_ids(self.station, city)

    def daily_transaction(self, city, ids, day, window=0, backward=True) -> DataFrame:
        rows = transactions.daily_rows(
            self.daily, self.station, ids, day, window, backward, city
        )
        return transactions.nest_daily(rows).orderBy("city_key", "id")

    def daily_transaction_list(
        self, city, day, limit=20, order_by="station", window=0, backward=True
    ) -> DataFrame:
        rows = transactions.daily_transaction_list(
            self.daily, self.station, city, day, limit, order_by, window, backward
        )
        return transactions.nest_daily(rows, "rank").orderBy("city_key", "rank")

    def timeseries(self, city, ids, start, stop, stretch=STRETCH) -> DataFrame:
        nested = timeseries.timeseries_nested(
            self.readings, self.station, ids, start, stop, city, stretch
        )
        return nested.orderBy("city_key", "id", "piece")

    def prediction_timeseries(
        self, city, ids, start, stop, values_num=5, with_current=False, freq="1H",
        per_station=False,
    ) -> DataFrame:
        return predictions.prediction_timeseries(
            self.prediction, self.readings, self.station, city, ids, start, stop,
            values_num, with_current, freq, per_station,
        )

    def latest_availability(self, city, as_of, limit=None, geojson=False) -> DataFrame:
        return timeseries.latest_availability(
            self.readings, self.station, as_of, city, limit, geojson
        )

    def latest_predictions(
        self, city, as_of, limit=None, geojson=False, freq="1H"
    ) -> DataFrame:
        return predictions.latest_predictions(
            self.prediction, self.station, as_of, city, limit, geojson, freq
        )

    @staticmethod
    def latest_date(result: DataFrame) -> DataFrame:
        return latest_date(result)

    def hourly_profile(self, city, ids, day, window=7) -> DataFrame:
        profile = profiles.hourly_profile(
            self.readings, self.station, ids, day, window, city
        )
        return profiles.nest_profile(profile, "hour").orderBy("city_key", "id")

    def daily_profile(self, city, ids, day, window=30) -> DataFrame:
        profile = profiles.daily_profile(self.daily, self.station, ids, day, window, city)
        return profiles.nest_profile(profile, "day").orderBy("city_key", "id")

    def station_clusters(self, city=None, ids=None, geojson=False) -> DataFrame:
        return clusters.station_clusters(self.clustering, self.station, city, ids, geojson)

    def cluster_profiles(self, city=None, start=None, stop=None) -> DataFrame:
        return clusters.cluster_profiles(self.centroid, city, start, stop)

    def latest_station_timewindow(self, city, start, stop) -> DataFrame:
        return timeseries.latest_station_timewindow(self.readings, start, stop, city)

    def aggregate_transactions(self, city, day) -> DataFrame:
        return transactions.aggregate_transactions(self.readings, day, city)
