"""The dashboard's five views as one object over a warehouse.

Each method returns the DataFrames one view shows, for the chosen filter
values (widgets become arguments). Nothing is collected here; the caller
decides what to show.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..functions import expressions as X
from ..operators import demand as D
from ..operators import options as OP
from ..operators import routes as R
from ..operators import stations as ST
from ..session import scratch_path
from ..sinks.tables import Warehouse
from .pipeline import data_health, overview


@dataclass
class StationView:
    ranking: DataFrame
    regions: DataFrame
    options: DataFrame
    top: DataFrame
    map: DataFrame
    selected: Optional[DataFrame] = None
    daily: Optional[DataFrame] = None
    hourly: Optional[DataFrame] = None
    destinations: Optional[DataFrame] = None


class Dashboard:
    """Overview, Historical Demand, Station Activity, Routes, Data Health."""

    def __init__(self, spark: SparkSession, warehouse: Warehouse, manifest_path: str):
        self.spark = spark
        self.wh = warehouse
        self.manifest_path = manifest_path

    @classmethod
    def open(cls, spark: SparkSession, serving_root: str, warehouse_root: str,
             serving_manifest: str, warehouse_manifest: str) -> "Dashboard":
        """The serving copy and its manifest when present, else the full
        warehouse and the ingestion manifest."""
        wh = Warehouse.open(spark, serving_root, warehouse_root)
        from ..session import exists
        manifest = serving_manifest if exists(spark, serving_manifest) else warehouse_manifest
        return cls(spark, wh, manifest)

    @property
    def trips(self) -> DataFrame:
        return self.wh.table(S.STAGING_TRIPS)

    @property
    def stations(self) -> DataFrame:
        return self.wh.table(S.DIM_STATIONS)

    def quarter_choices(self) -> DataFrame:
        """E5 + H4: 'All Quarters' then the quarter labels in order."""
        return OP.with_all_option(D.quarters(self.trips).select("quarter_label"), "quarter_label",
                                  X.ALL_QUARTERS)

    def overview(self, quarter: str = X.ALL_QUARTERS):
        """M7: metrics, manifest summary, demand by quarter or by day."""
        return overview(self.spark, self.wh, self.manifest_path, quarter)

    def filter_options(self) -> DataFrame:
        """Region, passholder and bike type choices."""
        return OP.demand_filter_options(self.trips, self.stations)

    def historical_demand(self, filters: D.DemandFilters = D.DemandFilters()) -> dict[str, DataFrame]:
        """E8 and its rollups E9-E12 (by quarter only for All Quarters).

        The trips are read once: E8 is written to the shared folder, and all
        rollups come from one grouping-sets pass over it."""
        root = scratch_path(self.spark, "historical-demand")
        hourly = self._written(D.historical_demand(self.trips, self.stations, filters), f"{root}/hourly")
        rollups = self._written(D.demand_rollups(hourly), f"{root}/rollups")
        views = {"hourly": D.in_hourly_order(hourly)}
        for name in D.ROLLUPS:
            if name != "by_quarter" or filters.quarter == X.ALL_QUARTERS:
                views[name] = D.one_rollup(rollups, name)
        return views

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def station_activity(self, quarter: str = X.ALL_QUARTERS, region: str = X.ALL_REGIONS,
                         station_label: str = X.ALL_STATIONS, top_n: int = 20,
                         include_special: bool = False) -> StationView:
        """E13 with region choice, options, top-N and map; with a station
        chosen also its row, daily and hourly starts and top destinations."""
        ranking = ST.station_ranking(self.trips, self.stations, quarter)
        view = StationView(
            ranking=ST.in_region(ranking, region),
            regions=ST.station_regions(ranking),
            options=ST.station_options(ranking, region),
            top=ST.top_stations(ranking, top_n, region),
            map=ST.station_map(ranking, region),
        )
        station_id = ST.selected_station_id(station_label)
        if station_id is not None:
            view.selected = ST.station_lookup(ranking, station_label, region)
            view.daily = ST.station_daily(self.trips, quarter, station_id)
            view.hourly = ST.station_hourly(self.trips, quarter, station_id)
            view.destinations = ST.top_destinations(self.trips, self.stations, quarter, station_id,
                                                    include_special)
        return view

    def routes(self, quarter: str = X.ALL_QUARTERS, category: str = X.ALL_TRIPS,
               top_n: int = 20) -> dict[str, DataFrame]:
        """E18, E17 and G5."""
        return {
            "categories": R.route_categories(self.trips),
            "routes": R.top_routes(self.trips, self.stations, quarter, category),
            "top": R.top_route_labels(self.trips, self.stations, quarter, category, top_n),
        }

    def data_health(self, quarter: str = X.ALL_QUARTERS):
        """M6: table counts, manifest rows, updated_at."""
        return data_health(self.spark, self.wh, self.manifest_path, quarter)
