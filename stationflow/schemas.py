"""Column lists and StructTypes of every layer (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Trip CSV columns after header normalisation, with the declared types.
TRIP_CSV_TYPES = {
    "trip_id": T.LongType(),
    "duration": T.LongType(),
    "start_time": T.TimestampNTZType(),
    "end_time": T.TimestampNTZType(),
    "start_station": T.LongType(),
    "start_lat": T.DoubleType(),
    "start_lon": T.DoubleType(),
    "end_station": T.LongType(),
    "end_lat": T.DoubleType(),
    "end_lon": T.DoubleType(),
    "bike_id": T.StringType(),
    "plan_duration": T.LongType(),
    "trip_route_category": T.StringType(),
    "passholder_type": T.StringType(),
    "bike_type": T.StringType(),
}
TRIP_CSV_COLUMNS = list(TRIP_CSV_TYPES)

# Station CSV columns after normalisation and renaming.
STATION_TYPES = {
    "station_id": T.LongType(),
    "station_name": T.StringType(),
    "go_live_date": T.TimestampNTZType(),
    "region": T.StringType(),
    "status": T.StringType(),
    "latitude": T.DoubleType(),
    "longitude": T.DoubleType(),
}
STATION_COLUMNS = list(STATION_TYPES)

SOURCE_COLUMNS = ["source_file", "source_year", "source_quarter", "ingested_at"]
RAW_TRIP_COLUMNS = TRIP_CSV_COLUMNS + SOURCE_COLUMNS
LAKE_PARTITIONS = ["year", "quarter"]

STAGING_TYPES = {
    "trip_id": T.StringType(), "duration_minutes": T.IntegerType(),
    "start_time": T.TimestampNTZType(), "end_time": T.TimestampNTZType(),
    "trip_date": T.DateType(), "start_hour": T.LongType(), "day_of_week": T.LongType(),
    "start_station_id": T.StringType(), "start_lat": T.DoubleType(), "start_lon": T.DoubleType(),
    "end_station_id": T.StringType(), "end_lat": T.DoubleType(), "end_lon": T.DoubleType(),
    "bike_id": T.StringType(), "plan_duration_days": T.IntegerType(),
    "trip_route_category": T.StringType(), "passholder_type": T.StringType(), "bike_type": T.StringType(),
    "source_file": T.StringType(), "source_year": T.IntegerType(), "source_quarter": T.IntegerType(),
    "ingested_at": T.TimestampType(),
}
STAGING_COLUMNS = list(STAGING_TYPES)
STAGING_PARTITIONS = ["source_year", "source_quarter"]

# The serving copy keeps 17 of the 22 staging columns.
SLIM_COLUMNS = [
    "trip_id", "duration_minutes", "trip_date", "start_hour", "day_of_week",
    "start_station_id", "start_lat", "start_lon", "end_station_id", "bike_id",
    "trip_route_category", "passholder_type", "bike_type", "source_file",
    "source_year", "source_quarter", "ingested_at",
]

DIM_STATION_TYPES = STATION_TYPES | {"station_id": T.StringType(), "go_live_date": T.DateType()}
DIM_STATION_COLUMNS = list(DIM_STATION_TYPES)

HOURLY_DEMAND_COLUMNS = [
    "source_year", "source_quarter", "trip_date", "start_hour",
    "start_hour_label", "trip_count", "active_station_count",
    "distinct_bikes_used", "avg_duration_minutes",
]
STATION_ACTIVITY_COLUMNS = [
    "source_year", "source_quarter", "station_id", "station_name", "region",
    "station_status", "station_lat", "station_lon", "trip_starts",
    "distinct_bikes_used", "avg_duration_minutes",
]
ROUTE_POPULARITY_COLUMNS = [
    "source_year", "source_quarter", "start_station_id", "start_station_name",
    "start_region", "end_station_id", "end_station_name", "end_region",
    "trip_count", "distinct_bikes_used", "avg_duration_minutes",
]

MANIFEST_RECORD = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("source_year", T.LongType()),
    T.StructField("source_quarter", T.LongType()),
    T.StructField("cleaned_rows", T.LongType()),
    T.StructField("output_path", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
])
MANIFEST_COLUMNS = [f.name for f in MANIFEST_RECORD.fields]
MANIFEST_DOCUMENT = T.StructType([
    T.StructField("files", T.ArrayType(MANIFEST_RECORD)),
    T.StructField("updated_at", T.StringType()),
])

# Warehouse table names: schema.table, in build order.
RAW_TRIPS = "raw.trips"
RAW_STATIONS = "raw.stations"
STAGING_TRIPS = "staging.trips"
DIM_STATIONS = "marts.dim_stations"
RPT_HOURLY_DEMAND = "marts.rpt_hourly_demand"
RPT_STATION_ACTIVITY = "marts.rpt_station_activity"
RPT_ROUTE_POPULARITY = "marts.rpt_route_popularity"
WAREHOUSE_TABLES = [
    RAW_TRIPS, RAW_STATIONS, STAGING_TRIPS, DIM_STATIONS,
    RPT_HOURLY_DEMAND, RPT_STATION_ACTIVITY, RPT_ROUTE_POPULARITY,
]
