"""Ingestion plans: trip CSVs -> partitioned lake + manifest (M1), station
CSV -> station Parquet (M2).

All files are read as one DataFrame; the rows are shuffled once, for the
per-file dedup, and its tasks write the quarters they hold. The cleaned row
counts come from the written quarters' Parquet footers; only a file that a
later one of its quarter replaces is counted by ``observe``, in the stage that
writes.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import glob_exists, short_lived_shuffles
from ..operators import manifest as MF
from ..sinks import journal
from ..sinks.lake import write_station_lake, write_trip_lake
from ..sinks.manifest import write_manifest
from ..sources import trips as TR
from ..sources.local import rows_frame
from ..sources.manifest import read_manifest
from ..sources.stations import read_station_csv


@dataclass
class IngestResult:
    files: list[str]
    cleaned_rows: dict[str, int]
    total_rows: int
    ingested_at: str
    manifest_updated_at: str
    records: DataFrame


def ingest_trips(spark: SparkSession, input_dir: str, lake_dir: str, manifest_path: str,
                 ingested_at: dt.datetime | None = None, multi_line: bool = False) -> IngestResult:
    """M1: A2 -> A3 -> A1/A5 -> F3 -> C2 -> C1 -> B1 -> B11 -> B9.
    ``multi_line``: quoted fields may span lines (files are then not split)."""
    files = TR.list_trip_files(spark, input_dir)
    return ingest_trip_files(spark, files, input_dir, lake_dir, manifest_path, ingested_at, multi_line)


def ingest_trip_files(spark: SparkSession, files: list[str], input_dir: str, lake_dir: str,
                      manifest_path: str, ingested_at: dt.datetime | None = None,
                      multi_line: bool = False) -> IngestResult:
    """M1 over an explicit list of trip CSVs (used by the batch run and by
    the incremental stream). Re-running it with the same files gives the
    same lake partitions and manifest records. Quarters and manifest are
    staged and committed together (``sinks.journal``); a run that stopped
    before is completed or undone first."""
    journal.recover(spark, lake_dir)
    names = [p.rsplit("/", 1)[-1] for p in files]
    quarters = {n: TR.trip_file_quarter(n) for n in names}
    stamp = ingested_at or dt.datetime.now(dt.timezone.utc)

    rows = TR.cleaned_trips(spark, files, stamp, keep_file_index=True, multi_line=multi_line)
    index = {n: i for i, n in enumerate(sorted(set(names)))}
    winners = TR.last_file_per_quarter(files)
    replaced = [n for n in names if n not in set(winners)]
    # Rows of a file that a later file of the same quarter replaces are
    # counted while the lake is written (rare: one metric per such file).
    obs = Observation("stationflow_ingest_counts")
    counted = rows.observe(obs, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col(TR.FILE_INDEX) == F.lit(index[n])).alias(f"file_{index[n]}") for n in replaced
    ])
    run = journal.staging(lake_dir)
    staged = journal.rows_dir(run)
    with short_lived_shuffles(spark):
        write_trip_lake(counted.filter(F.col(TR.FILE_INDEX).isin([index[n] for n in winners]))
                        .drop(TR.FILE_INDEX), staged)
    metrics = obs.get
    counts = {n: int(metrics.get(f"file_{index[n]}", 0) or 0) for n in replaced}
    # Each staged quarter holds exactly its winning file's rows. A winning
    # file without a valid row stages no partition, so its quarter's old
    # folder is removed, as replacing it with an empty file would.
    any_rows = glob_exists(spark, f"{staged}/year=*/quarter=*/*.parquet")
    by_quarter = {(r["year"], r["quarter"]): r["rows"]
                  for r in lake_partitions(spark, staged).collect()} if any_rows else {}
    for n in winners:
        counts[n] = int(by_quarter.get(quarters[n], 0))
    written = [quarters[n] for n in winners if counts[n]]
    emptied = [quarters[n] for n in winners if not counts[n]]
    count_rows = [(n, quarters[n][0], quarters[n][1], counts[n]) for n in names]
    count_df = rows_frame(
        spark, count_rows, "source_file string, source_year bigint, source_quarter bigint, cleaned_rows bigint")
    stamp_iso = stamp.astimezone(dt.timezone.utc).isoformat()
    new = MF.records_from_counts(count_df, input_dir, lake_dir, stamp_iso)
    records = MF.upsert(read_manifest(spark, manifest_path), new)
    updated = write_manifest(spark, records, journal.manifest_file(run))
    journal.finish(spark, run, lake_dir, manifest_path, written, emptied)
    return IngestResult(files, counts, sum(counts.values()), stamp_iso, updated,
                        read_manifest(spark, manifest_path))


def ingest_stations(spark: SparkSession, input_file: str, output_file: str) -> int:
    """M2: A12 -> A4 -> A5 -> A6 -> F4 -> B2; returns the station count."""
    obs = Observation("stationflow_station_count")
    stations = read_station_csv(spark, input_file)
    write_station_lake(stations.observe(obs, F.count(F.lit(1)).alias("n")), output_file)
    return int(obs.get.get("n", 0) or 0)


def lake_partitions(spark: SparkSession, lake_dir: str) -> DataFrame:
    """(year, quarter, rows) of a lake, counted from Parquet footers."""
    from ..sources.lake import read_trip_lake
    lake = read_trip_lake(spark, lake_dir)
    return lake.groupBy(*S.LAKE_PARTITIONS).agg(F.count(F.lit(1)).alias("rows"))
