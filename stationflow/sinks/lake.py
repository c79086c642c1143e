"""Lake sinks (B1, B2)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schemas as S
from .files import write_then_replace


def write_trip_lake(df: DataFrame, trips_dir: str) -> None:
    """B1: replace the year/quarter partitions present in ``df`` and leave
    the others (dynamic partition overwrite). Each task writes the quarters
    of the rows it holds, one file each: the whole rows are not shuffled once
    more to deal them by quarter, and no task holds a whole quarter."""
    (
        df.sortWithinPartitions(*S.LAKE_PARTITIONS)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*S.LAKE_PARTITIONS)
        .parquet(trips_dir)
    )


def write_station_lake(df: DataFrame, stations_path: str) -> None:
    """B2: replace the station Parquet (written beside it, then swapped in)."""
    write_then_replace(df.sparkSession, df.write, stations_path)
