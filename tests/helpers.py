"""Hand-written rows for the unit tests (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from stationflow import schemas as S

RAW_SCHEMA = (
    "trip_id bigint, duration bigint, start_time timestamp_ntz, end_time timestamp_ntz, "
    "start_station bigint, start_lat double, start_lon double, end_station bigint, end_lat double, "
    "end_lon double, bike_id string, plan_duration bigint, trip_route_category string, "
    "passholder_type string, bike_type string, source_file string, source_year bigint, "
    "source_quarter bigint, ingested_at timestamp"
)
STATION_SCHEMA = (
    "station_id bigint, station_name string, go_live_date timestamp_ntz, region string, "
    "status string, latitude double, longitude double"
)


def ts(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M")


SAME = object()


def trip(trip_id, start="2026-01-05 10:00", minutes=8, duration=SAME, start_station=1, end_station=2,
         bike="b1", route="One Way", passholder="Monthly", bike_type="standard",
         quarter=(2026, 1), end=SAME, start_lat=34.05, start_lon=-118.25):
    """One raw trip; ``duration`` defaults to ``minutes``, ``end`` to start +
    minutes (pass None for a missing value)."""
    st = ts(start) if start else None
    if end is SAME:
        en = st + dt.timedelta(minutes=minutes) if st else None
    else:
        en = ts(end) if end else None
    return (trip_id, minutes if duration is SAME else duration, st, en, start_station, start_lat, start_lon,
            end_station, 34.06, -118.24, bike, 30, route, passholder, bike_type,
            f"metro-trips-{quarter[0]}-q{quarter[1]}.csv", quarter[0], quarter[1],
            dt.datetime(2026, 6, 14))


def raw_trips(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def station(sid, name, region="DTLA", status="Active", lat=34.05, lon=-118.25, live="2016-07-07 00:00"):
    return (sid, name, ts(live), region, status, lat, lon)


def raw_stations(spark, rows):
    return spark.createDataFrame(rows, STATION_SCHEMA)


def sorted_rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).orderBy(*[F.col(c).asc_nulls_last() for c in cols]).collect()]


TRIP_HEADER = ",".join(S.TRIP_CSV_COLUMNS)


def csv_line(values):
    return ",".join("" if v is None else str(v) for v in values)


def write_text(folder, name, text):
    path = folder.replace("file://", "") + "/" + name
    with open(path, "w") as f:
        f.write(text)
    return folder + "/" + name
