"""Station CSV source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.dedup import FILE_POSITION, keep_first_in_file
from . import csvfiles as C

# Header renames of the station list.
STATION_RENAMES = {"kiosk_id": "station_id", "kiosk_name": "station_name"}


def normalize_station_header(name: str) -> str:
    """A5: strip, lower-case, blanks to '_' ('Region ' -> 'region')."""
    return name.strip().lower().replace(" ", "_")


def read_station_csv(spark: SparkSession, path: str) -> DataFrame:
    """A4 + A5 + A6 + F4: typed stations, first row per station_id in file
    order. Missing file -> FileNotFoundError (A12)."""
    files = C.list_files(spark, path)
    if not files:
        raise FileNotFoundError(f"Input file not found: {path}")
    text = C.read_text_columns(spark, files, normalize_station_header)
    text = text.withColumnsRenamed({k: v for k, v in STATION_RENAMES.items() if k in text.columns})
    C.require_columns(text, S.STATION_COLUMNS, "station CSV")
    what = "station CSV"
    typed = [
        C.parse_long("station_id", what).alias("station_id"),
        C.parse_string("station_name").alias("station_name"),
        C.parse_timestamp("go_live_date").alias("go_live_date"),
        C.parse_string("region").alias("region"),
        C.parse_string("status").alias("status"),
        C.parse_double("latitude", what).alias("latitude"),
        C.parse_double("longitude", what).alias("longitude"),
    ]
    extras = [c for c in text.columns if c not in S.STATION_COLUMNS and not c.startswith("__")]
    rows = text.select(*typed, *extras, C.FILE_PATH, *FILE_POSITION)
    first = keep_first_in_file(rows, C.FILE_PATH, ["station_id"])
    return first.drop(C.FILE_PATH, *FILE_POSITION)
