"""The warehouse: named tables ``schema.table`` stored as Parquet folders
under one root (B3, B4, A10, A11), optionally registered in the catalog.

Every table is a versioned folder (``sinks.versions``), and so may be the root:
a reader resolves the pointers each time it opens a table.

``raw.trips`` is the trip lake itself (read in place, not copied);
``staging.trips`` is partitioned by (source_year, source_quarter), so quarter
filters prune folders.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import exists
from . import versions
from ..sources.lake import read_station_lake, read_trip_lake

PARTITIONING = {S.STAGING_TRIPS: S.STAGING_PARTITIONS}
CLUSTERING = {S.STAGING_TRIPS: ["trip_date", "start_station_id"]}


class Warehouse:
    """Table access by name under ``root``; ``trips_lake`` and
    ``stations_file`` back the two raw tables."""

    def __init__(self, spark: SparkSession, root: str, trips_lake: str | None = None,
                 stations_file: str | None = None, catalog: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.trips_lake = trips_lake
        self.stations_file = stations_file
        self.catalog = catalog

    @classmethod
    def open(cls, spark: SparkSession, primary: str, fallback: str, **kw) -> "Warehouse":
        """The serving copy when present, else the full warehouse."""
        root = primary if exists(spark, primary) else fallback
        return cls(spark, root, **kw)

    def path(self, name: str) -> str:
        """The folder of a table, which holds its versions."""
        schema, table = name.split(".")
        return f"{versions.current(self.spark, self.root) or self.root}/{schema}/{table}"

    def exists(self, name: str) -> bool:
        if name == S.RAW_TRIPS and self.trips_lake:
            return exists(self.spark, self.trips_lake)
        if name == S.RAW_STATIONS and self.stations_file:
            return exists(self.spark, self.stations_file)
        return versions.current(self.spark, self.path(name)) is not None

    def table(self, name: str) -> DataFrame:
        """A10: a table by name, read-only."""
        if name == S.RAW_TRIPS and self.trips_lake:
            return read_trip_lake(self.spark, self.trips_lake)
        if name == S.RAW_STATIONS and self.stations_file:
            return read_station_lake(self.spark, self.stations_file)
        data = versions.current(self.spark, self.path(name))
        if data is None:
            raise FileNotFoundError(f"Warehouse table not found: {name} ({self.path(name)})")
        df = self.spark.read.parquet(data)
        if name == S.STAGING_TRIPS:
            return df.select(*[c for c in S.STAGING_COLUMNS if c in df.columns])
        return df

    def tables(self, names: Sequence[str] = tuple(S.WAREHOUSE_TABLES)) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in names}

    def create_schemas(self) -> None:
        """Schemas exist as folders (and catalog databases if enabled)."""
        if self.catalog:
            for schema in ("raw", "staging", "marts"):
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{self.root}/{schema}'")

    def save(self, df: DataFrame, name: str) -> int:
        """Replace the table with ``df``, written as a new version: one
        atomic step makes it the table, and a failed save leaves the old one.
        Returns the number of rows written, counted in the write's final
        stage (a task's count is applied once, also when it is retried).
        Partitions are written from the tasks that hold their rows, which are
        not shuffled again for it."""
        parts = PARTITIONING.get(name, [])
        cluster = CLUSTERING.get(name, [])
        obs = Observation(f"rows_{name}")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        out = df.sortWithinPartitions(*parts, *cluster) if (parts or cluster) else df
        writer = out.write.option("compression", "zstd")
        if parts:
            writer = writer.partitionBy(*parts)
        version = versions.write(self.spark, writer, self.path(name))
        if self.catalog:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.spark.catalog.createTable(name, path=version, source="parquet")
            if parts:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return int(obs.get.get("rows", 0) or 0)
