"""Warehouse build (M3): lake -> staging -> dimension -> three marts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..operators import models as M
from ..operators.joins import estimated_size
from ..session import short_lived_shuffles
from ..sources.local import rows_frame
from ..sinks.tables import Warehouse


#: Compressed staging bytes up to which the marts are built side by side. The jobs of a larger one fill
#: the cluster one by one, and side by side would only need the disk for all their shuffles at once.
SIDE_BY_SIDE_BYTES = 64 * 1024 * 1024


def build_warehouse(spark: SparkSession, trips_dir: str, stations_file: str, root: str,
                    catalog: bool = False) -> tuple[Warehouse, DataFrame]:
    """B4 -> A7/A8 -> staging -> dim -> hourly -> station -> route -> B12.

    Staging is written (partitioned by quarter) and read back by the marts,
    so the dedup shuffle runs once; independent writes run concurrently, the
    marts of a large staging table one after the other. A
    failure midway leaves earlier tables
    replaced and later ones as they were, as in the reference. The written
    tables' row counts (B12) are observed in the final stage of their writes;
    the two raw tables are counted from Parquet footers."""
    wh = Warehouse(spark, root, trips_lake=trips_dir, stations_file=stations_file, catalog=catalog)
    raw_trips = wh.table(S.RAW_TRIPS)
    raw_stations = wh.table(S.RAW_STATIONS)
    wh.create_schemas()
    counts: dict[str, int] = {}
    # Independent jobs run side by side (Spark schedules concurrent jobs
    # from driver threads): staging and the dimension first, then the marts,
    # which read both. A failure in any of them fails the build.
    with short_lived_shuffles(spark):
        with ThreadPoolExecutor(max_workers=3) as pool:
            first = {
                S.STAGING_TRIPS: pool.submit(wh.save, M.build_staging_trips(raw_trips), S.STAGING_TRIPS),
                S.DIM_STATIONS: pool.submit(wh.save, M.build_dim_stations(raw_stations), S.DIM_STATIONS),
                S.RAW_TRIPS: pool.submit(raw_trips.count),
                S.RAW_STATIONS: pool.submit(raw_stations.count),
            }
            counts.update({name: f.result() for name, f in first.items()})
        stg, dim = wh.table(S.STAGING_TRIPS), wh.table(S.DIM_STATIONS)
        with ThreadPoolExecutor(max_workers=3 if estimated_size(stg) <= SIDE_BY_SIDE_BYTES else 1) as pool:
            marts = {
                S.RPT_HOURLY_DEMAND: pool.submit(wh.save, M.build_hourly_demand(stg), S.RPT_HOURLY_DEMAND),
                S.RPT_STATION_ACTIVITY: pool.submit(wh.save, M.build_station_activity(stg, dim), S.RPT_STATION_ACTIVITY),
                S.RPT_ROUTE_POPULARITY: pool.submit(wh.save, M.build_route_popularity(stg, dim), S.RPT_ROUTE_POPULARITY),
            }
            counts.update({name: f.result() for name, f in marts.items()})
    rows = [(name, counts[name]) for name in S.WAREHOUSE_TABLES]
    return wh, rows_frame(spark, rows, "table_name string, row_count bigint").orderBy("table_name")
