"""Lake and warehouse table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import glob_exists


def read_trip_lake(spark: SparkSession, trips_dir: str) -> DataFrame:
    """The Hive-partitioned trip lake (year=/quarter= folders) with
    partition discovery, so filters on year/quarter prune folders. Error
    when it holds no Parquet files (A12)."""
    root = trips_dir.rstrip("/")
    if not glob_exists(spark, f"{root}/*/*/*.parquet"):
        raise FileNotFoundError(f"the trip lake {trips_dir} holds no Parquet file")
    df = spark.read.option("basePath", root).parquet(root)
    return df.select(*[c for c in df.columns if c not in S.LAKE_PARTITIONS],
                     F.col("year").cast("int"), F.col("quarter").cast("int"))


def read_station_lake(spark: SparkSession, stations_path: str) -> DataFrame:
    """The station Parquet; error when absent."""
    if not glob_exists(spark, stations_path):
        raise FileNotFoundError(f"there is no station list at {stations_path}")
    return spark.read.parquet(stations_path)
