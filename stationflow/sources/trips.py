"""Trip CSV source (A1-A3, A5) and the ingest cleaning."""

from __future__ import annotations

import re

import datetime as dt
from pathlib import PurePosixPath
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.dedup import FILE_POSITION, keep_first_in_file
from . import csvfiles as C
from .local import rows_frame

# The trip file naming of the published data.
TRIP_FILE_PREFIX = "metro-trips-"
TRIP_CSV_GLOB = "metro-trips-*.csv"


def list_trip_files(spark: SparkSession, input_dir: str) -> list[str]:
    """A2: the trip CSVs of a folder, sorted; error when there are none."""
    files = C.list_files(spark, f"{input_dir.rstrip('/')}/{TRIP_CSV_GLOB}")
    if not files:
        raise FileNotFoundError(f"No trip CSV files found in {input_dir}")
    return files


# A quarter's file name without its ending; archives may add further parts.
_FILE_NAME = r"metro-trips-(\d+)-q?(\d+)"
_LOOSE_NAME = _FILE_NAME + r"(?:-.*)?"


def trip_file_quarter(file_name: str, strict: bool = True) -> tuple[int, int]:
    """(year, quarter) from 'metro-trips-YYYY-qN.<ext>'.

    ``strict`` (CSV files) needs exactly four '-' parts; the looser form
    (archive names) accepts more, so suffixed names pass."""
    found = re.fullmatch(_FILE_NAME if strict else _LOOSE_NAME, PurePosixPath(file_name).stem)
    if not found:
        raise ValueError(f"the file name {file_name!r} does not name a quarter of trips")
    return int(found[1]), int(found[2])


def quarter_columns(name: Column, strict: bool = True) -> tuple[Column, Column]:
    """A3 as Spark expressions over a file-name column; a name that does not
    fit raises an error in the job."""
    pattern = f"^{_FILE_NAME if strict else _LOOSE_NAME}$"
    stem = F.regexp_replace(name, r"\.[^./]*$", "")
    err = F.raise_error(F.concat(F.lit("not the name of a quarter's trip file: "), name)).cast("bigint")
    year, quarter = (F.when(stem.rlike(pattern), F.regexp_extract(stem, pattern, i).cast("bigint")).otherwise(err)
                     for i in (1, 2))
    return year, quarter


def normalize_trip_header(name: str) -> str:
    """A5: strip and lower-case (trips)."""
    return name.strip().lower()


def read_trip_csv(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """A1 + A5: typed trip rows of the given CSV files with the file's path,
    name and each row's position in its file. Extra columns are kept as text."""
    text = C.read_text_columns(spark, paths, normalize_trip_header, multi_line)
    C.require_columns(text, S.TRIP_CSV_COLUMNS, "trip CSV")
    what = "trip CSV"
    typed = []
    for name, dtype in S.TRIP_CSV_TYPES.items():
        kind = dtype.typeName()
        if kind == "long":
            typed.append(C.parse_long(name, what).alias(name))
        elif kind == "double":
            typed.append(C.parse_double(name, what).alias(name))
        elif kind == "timestamp_ntz":
            typed.append(C.parse_timestamp(name).alias(name))
        else:
            typed.append(C.parse_string(name).alias(name))
    extras = [c for c in text.columns if c not in S.TRIP_CSV_TYPES and not c.startswith("__")]
    return text.select(*typed, *extras, C.FILE_PATH, C.FILE_NAME, *FILE_POSITION)


def ingest_filter(df: DataFrame) -> DataFrame:
    """Times present, end not before start, duration > 0 (null duration
    or time fails the test and is dropped)."""
    return df.filter(
        F.col("start_time").isNotNull()
        & F.col("end_time").isNotNull()
        & (F.col("end_time") >= F.col("start_time"))
        & (F.col("duration") > 0)
    )


FILE_INDEX = "__file_index"


def file_quarters(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(file name, file index, source_year, source_quarter) of the listed
    files (A3 on the driver, raising for a bad name before any job runs).
    One row per file."""
    rows = [(n, i, *trip_file_quarter(n)) for i, n in enumerate(sorted(set(names)))]
    return rows_frame(
        spark, rows, f"{C.FILE_NAME} string, {FILE_INDEX} int, source_year bigint, source_quarter bigint")


def listed_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file_quarters`` of the files at these paths, with the lake's partition columns."""
    lookup = file_quarters(spark, [p.rsplit("/", 1)[-1] for p in paths])
    return lookup.withColumn("year", F.col("source_year").cast("int")).withColumn(
        "quarter", F.col("source_quarter").cast("int"))


def with_file_index(rows: DataFrame, lookup: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """The rows of ``read_trip_csv`` with their file's index (and other columns
    of the lookup, one row per listed file) in place of its path and name. To be
    applied right after the scan: a shuffle then moves a number and no names."""
    index_of = F.broadcast(lookup.select(C.FILE_NAME, FILE_INDEX, *columns))
    return rows.drop(C.FILE_PATH).join(index_of, C.FILE_NAME, "inner").drop(C.FILE_NAME)


def with_file_name(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """The file's name again in place of its index."""
    return rows.join(F.broadcast(lookup.select(FILE_INDEX, C.FILE_NAME)), FILE_INDEX, "inner").drop(FILE_INDEX)


def with_source_metadata(df: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    """C1 from the file name by expressions: source_file, source_year,
    source_quarter, ingested_at, and the lake partition columns."""
    year, quarter = quarter_columns(F.col(C.FILE_NAME))
    return _stamp(df.withColumn("source_year", year).withColumn("source_quarter", quarter), ingested_at)


def stamp_literal(ingested_at: dt.datetime) -> Column:
    """The run's ingestion instant as a timestamp literal, in any session time zone."""
    micros = (ingested_at.astimezone(dt.timezone.utc) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def _source(df: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    return df.withColumn("source_file", F.col(C.FILE_NAME)).withColumn("ingested_at", stamp_literal(ingested_at))


def _stamp(df: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    return (
        _source(df, ingested_at)
        .withColumn("year", F.col("source_year").cast("int"))
        .withColumn("quarter", F.col("source_quarter").cast("int"))
    )


def cleaned_trips(spark: SparkSession, paths: Sequence[str], ingested_at: dt.datetime,
                  keep_file_index: bool = False, multi_line: bool = False) -> DataFrame:
    """The rows the lake receives from the given files, before choosing one
    file per quarter: A1, A5, F3, C2, C1.

    The dedup shuffle is keyed on (file index, trip_id) and carries no names;
    name, year and quarter are looked up by the index behind it. The lake's
    partition columns travel with the index and lead the dedup's sort, which
    is then the only one: the lake is written in that order."""
    lookup = listed_files(spark, paths)
    rows = with_file_index(read_trip_csv(spark, paths, multi_line), lookup, S.LAKE_PARTITIONS)
    first = ingest_filter(keep_first_in_file(rows, FILE_INDEX, ["trip_id"], grouped=S.LAKE_PARTITIONS))
    named = first.join(F.broadcast(lookup.drop(*S.LAKE_PARTITIONS)), FILE_INDEX, "inner")
    out = _source(named, ingested_at)
    extras = [c for c in out.columns if c not in S.RAW_TRIP_COLUMNS + S.LAKE_PARTITIONS and not c.startswith("__")]
    index = [FILE_INDEX] if keep_file_index else []
    return out.select(*S.TRIP_CSV_COLUMNS, *extras, *S.SOURCE_COLUMNS, *S.LAKE_PARTITIONS, *index)


def last_file_per_quarter(paths: Sequence[str]) -> list[str]:
    """With two files for one quarter (e.g. '-q1' and '-1') the one later in
    sorted order replaces the other in the lake."""
    winners: dict[tuple[int, int], str] = {}
    for p in sorted(paths, key=lambda p: p.rsplit("/", 1)[-1]):
        winners[trip_file_quarter(p.rsplit("/", 1)[-1])] = p.rsplit("/", 1)[-1]
    return sorted(winners.values())
