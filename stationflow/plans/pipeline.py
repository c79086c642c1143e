"""The full run (M5) and the two composite dashboard views (M6, M7)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..functions import expressions as X
from ..operators import demand as D
from ..operators import manifest as MF
from ..operators.quality import assert_checks, run_checks, table_counts
from ..session import short_lived_shuffles
from ..sinks.exports import export_csv, export_serving
from ..sinks.manifest import copy_manifest
from ..sinks.tables import Warehouse
from ..sources.manifest import manifest_updated_at, read_manifest
from .ingest import ingest_stations, ingest_trips
from .warehouse import build_warehouse


@dataclass
class PipelineConfig:
    raw_dir: str
    stations_csv: str
    lake_trips: str
    lake_stations: str
    manifest: str
    warehouse: str
    csv_exports: str | None = None
    csv_single_file: bool = False
    serving: str | None = None
    serving_manifest: str | None = None
    archives: list[str] = field(default_factory=list)
    catalog: bool = False


@dataclass
class PipelineResult:
    ingest: object
    stations: int
    counts: list
    checks: list
    csv_files: list[str]
    serving: str | None


def run_pipeline(spark: SparkSession, cfg: PipelineConfig,
                 ingested_at: dt.datetime | None = None) -> PipelineResult:
    """M5, failing fast: [archives] -> trips -> stations -> warehouse ->
    checks -> CSV extracts -> serving copy + manifest copy. The union of the
    reference's local script and its scheduled flow."""
    if cfg.archives:
        from ..sources.archives import expand_archives
        expand_archives(spark, cfg.archives, cfg.raw_dir).collect()
    ingest = ingest_trips(spark, cfg.raw_dir, cfg.lake_trips, cfg.manifest, ingested_at)
    stations = ingest_stations(spark, cfg.stations_csv, cfg.lake_stations)
    wh, counts = build_warehouse(spark, cfg.lake_trips, cfg.lake_stations, cfg.warehouse, cfg.catalog)
    count_rows = [(r["table_name"], r["row_count"]) for r in counts.collect()]
    with short_lived_shuffles(spark):
        checks = assert_checks(run_checks(wh.tables()))
        csv_files = export_csv(spark, wh, cfg.csv_exports, cfg.csv_single_file) if cfg.csv_exports else []
    if cfg.serving:
        export_serving(spark, wh, cfg.serving)
        if cfg.serving_manifest:
            copy_manifest(spark, cfg.manifest, cfg.serving_manifest)
    return PipelineResult(ingest, stations, count_rows, checks, csv_files, cfg.serving)


DASHBOARD_TABLES = [S.STAGING_TRIPS, S.RPT_HOURLY_DEMAND, S.RPT_STATION_ACTIVITY, S.RPT_ROUTE_POPULARITY]


def data_health(spark: SparkSession, wh: Warehouse, manifest_path: str,
                quarter: str = X.ALL_QUARTERS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M6: table counts, the manifest rows of the quarter, ``updated_at``."""
    counts = table_counts({n: wh.table(n) for n in DASHBOARD_TABLES})
    rows = MF.for_quarter(read_manifest(spark, manifest_path), quarter)
    return counts, rows, manifest_updated_at(spark, manifest_path)


def overview(spark: SparkSession, wh: Warehouse, manifest_path: str,
             quarter: str = X.ALL_QUARTERS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M7: headline metrics, manifest summary with its ``updated_at``, and
    demand by quarter (All Quarters) or by day (one quarter). Without a
    manifest the latest quarter's label is 'Unknown' and no file is counted."""
    trips = wh.table(S.STAGING_TRIPS)
    metrics = D.overview_metrics(trips, quarter)
    updated = manifest_updated_at(spark, manifest_path).first()["updated_at"]
    summary = MF.summary(read_manifest(spark, manifest_path), updated).withColumn(
        "latest_quarter_label", X.with_default("latest_quarter_label", X.UNKNOWN))
    demand = D.demand_by_quarter(trips) if quarter == X.ALL_QUARTERS else D.daily_demand(trips, quarter)
    return metrics, summary, demand
