"""The warehouse models: staging trips, station dimension and three marts.

Aggregation before joining: the marts group trips by station ids first (map-side
partial aggregation shrinks every shuffle to one row per group per task) and
only then attach the station attributes. The dimension has one row per
station_id (``build_dim_stations`` guarantees it), so its attributes are
functions of the id and grouping by them as well, as the SQL models do, gives
the same groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import expressions as X
from .dedup import keep_first
from .joins import broadcast_if_small, is_small, station_role

# Order used to pick the surviving row of a duplicated trip_id; completed with
# every other raw column (see dedup.total_order) so the choice is total.
STAGING_DEDUP_KEY = "trip_id"
STAGING_DEDUP_ORDER = ["start_time"]


def staging_dedup_order_columns() -> list[str]:
    """The full ordering of the raw columns used by the staging dedup."""
    rest = [c for c in S.RAW_TRIP_COLUMNS if c not in (STAGING_DEDUP_KEY, *STAGING_DEDUP_ORDER)]
    return STAGING_DEDUP_ORDER + rest


def raw_schema() -> T.StructType:
    """The raw trip columns with their types."""
    source = {"source_file": T.StringType(), "source_year": T.LongType(), "source_quarter": T.LongType(),
              "ingested_at": T.TimestampType()}
    return T.StructType([T.StructField(c, S.TRIP_CSV_TYPES.get(c) or source[c]) for c in S.RAW_TRIP_COLUMNS])


def valid_trips(raw: DataFrame) -> DataFrame:
    """C4: rows with both times and a positive duration."""
    return raw.select(*S.RAW_TRIP_COLUMNS).filter(
        F.col("start_time").isNotNull()
        & F.col("end_time").isNotNull()
        & (F.col("duration") > 0)
    )


def first_per_trip(valid: DataFrame) -> DataFrame:
    """the first row per trip_id by start time."""
    return keep_first(
        valid,
        [STAGING_DEDUP_KEY],
        [F.col(c).asc_nulls_last() for c in STAGING_DEDUP_ORDER],
        STAGING_DEDUP_ORDER,
    )


def build_staging_trips(raw: DataFrame) -> DataFrame:
    """staging.trips: valid rows (C4), first row per trip_id by start time
    (F1, after the filter), then the typed projection (C3)."""
    return project_staging(first_per_trip(valid_trips(raw)))


def project_staging(df: DataFrame) -> DataFrame:
    st = F.col("start_time")
    return df.select(
        F.col("trip_id").cast("string").alias("trip_id"),
        F.col("duration").cast("int").alias("duration_minutes"),
        st.cast("timestamp_ntz").alias("start_time"),
        F.col("end_time").cast("timestamp_ntz").alias("end_time"),
        F.to_date(st).alias("trip_date"),
        F.hour(st).cast("bigint").alias("start_hour"),
        X.dow0(st).alias("day_of_week"),
        F.col("start_station").cast("string").alias("start_station_id"),
        F.col("start_lat").cast("double").alias("start_lat"),
        F.col("start_lon").cast("double").alias("start_lon"),
        F.col("end_station").cast("string").alias("end_station_id"),
        F.col("end_lat").cast("double").alias("end_lat"),
        F.col("end_lon").cast("double").alias("end_lon"),
        F.col("bike_id").cast("string").alias("bike_id"),
        F.col("plan_duration").cast("int").alias("plan_duration_days"),
        F.trim("trip_route_category").alias("trip_route_category"),
        F.trim("passholder_type").alias("passholder_type"),
        F.trim("bike_type").alias("bike_type"),
        F.col("source_file").cast("string").alias("source_file"),
        F.col("source_year").cast("int").alias("source_year"),
        F.col("source_quarter").cast("int").alias("source_quarter"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
    )


def build_dim_stations(raw_stations: DataFrame) -> DataFrame:
    """marts.dim_stations: one row per station_id, the latest go-live (F2)."""
    valid = raw_stations.select(*S.STATION_COLUMNS).filter(F.col("station_id").isNotNull())
    latest = keep_first(
        valid, ["station_id"], [F.col("go_live_date").desc_nulls_last()], ["go_live_date"]
    )
    return latest.select(
        F.col("station_id").cast("string").alias("station_id"),
        F.col("station_name"),
        F.to_date("go_live_date").alias("go_live_date"),
        F.col("region"),
        F.col("status"),
        F.col("latitude"),
        F.col("longitude"),
    )


def trip_measures(station: bool = True, bikes: bool = True, duration: bool = True,
                  count_name: str = "trip_count") -> list:
    measures = [F.count(F.lit(1)).alias(count_name)]
    if station:
        measures.append(F.count_distinct("start_station_id").alias("active_station_count"))
    if bikes:
        measures.append(F.count_distinct("bike_id").alias("distinct_bikes_used"))
    if duration:
        measures.append(X.round_binary(F.avg("duration_minutes"), 2).alias("avg_duration_minutes"))
    return measures


def build_hourly_demand(trips: DataFrame) -> DataFrame:
    """marts.rpt_hourly_demand."""
    agg = trips.groupBy("source_year", "source_quarter", "trip_date", "start_hour").agg(
        *trip_measures()
    )
    return agg.select(
        "source_year", "source_quarter", "trip_date", "start_hour",
        X.hour_label("start_hour").alias("start_hour_label"),
        "trip_count", "active_station_count", "distinct_bikes_used",
        "avg_duration_minutes",
    )


def station_activity(trips: DataFrame, dim: DataFrame, group_keys: list[str]) -> DataFrame:
    """Trip starts per start station (+ ``group_keys``) with dim attributes;
    coordinates fall back to the rounded mean start position."""
    agg = trips.groupBy(*group_keys, "start_station_id").agg(
        F.count(F.lit(1)).alias("trip_starts"),
        F.count_distinct("bike_id").alias("distinct_bikes_used"),
        X.round_binary(F.avg("duration_minutes"), 2).alias("avg_duration_minutes"),
        X.round_binary(F.avg("start_lat"), 6).alias("_avg_lat"),
        X.round_binary(F.avg("start_lon"), 6).alias("_avg_lon"),
    )
    side = broadcast_if_small(
        station_role(dim, "s_", ["station_id", "station_name", "region", "status", "latitude", "longitude"])
    )
    joined = agg.join(side, agg["start_station_id"] == side["s_station_id"], "left")
    return joined.select(
        *group_keys,
        F.col("start_station_id").alias("station_id"),
        X.with_default("s_station_name", X.UNKNOWN_STATION).alias("station_name"),
        X.with_default("s_region", X.UNKNOWN_REGION).alias("region"),
        X.with_default("s_status", X.UNKNOWN_STATUS).alias("station_status"),
        F.coalesce("s_latitude", "_avg_lat").alias("station_lat"),
        F.coalesce("s_longitude", "_avg_lon").alias("station_lon"),
        "trip_starts", "distinct_bikes_used", "avg_duration_minutes",
    )


def build_station_activity(trips: DataFrame, dim: DataFrame) -> DataFrame:
    """marts.rpt_station_activity (E2): null start stations dropped."""
    valid = trips.filter(F.col("start_station_id").isNotNull())
    return station_activity(valid, dim, ["source_year", "source_quarter"])


def route_end(agg: DataFrame, dim: DataFrame, key: str, prefix: str,
              cols=("station_id", "station_name", "region")) -> DataFrame:
    """Attach one end's station attributes (``prefix`` + name) to per-route aggregates."""
    side = broadcast_if_small(station_role(dim, prefix, list(cols)), is_small(dim))
    return agg.join(side, agg[key] == side[f"{prefix}station_id"], "left")


def route_names(agg: DataFrame, dim: DataFrame) -> DataFrame:
    """Attach start/end station attributes (``ss_*``, ``es_*``) to per-route aggregates."""
    return route_end(route_end(agg, dim, "start_station_id", "ss_"), dim, "end_station_id", "es_")


def most_trips(routes: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` routes by trip count, ties by the ids (TakeOrderedAndProject)."""
    return routes.orderBy(*route_order()).limit(limit)


def route_order() -> list:
    return [F.col("trip_count").desc_nulls_last(),
            F.col("start_station_id").asc_nulls_last(), F.col("end_station_id").asc_nulls_last()]


def build_route_popularity(trips: DataFrame, dim: DataFrame) -> DataFrame:
    """marts.rpt_route_popularity."""
    valid = trips.filter(
        F.col("start_station_id").isNotNull() & F.col("end_station_id").isNotNull()
    )
    agg = valid.groupBy("source_year", "source_quarter", "start_station_id", "end_station_id").agg(
        *trip_measures(station=False)
    )
    named = route_names(agg, dim)
    return named.select(
        "source_year", "source_quarter", "start_station_id",
        X.with_default("ss_station_name", X.UNKNOWN_START_STATION).alias("start_station_name"),
        X.with_default("ss_region", X.UNKNOWN_REGION).alias("start_region"),
        "end_station_id",
        X.with_default("es_station_name", X.UNKNOWN_END_STATION).alias("end_station_name"),
        X.with_default("es_region", X.UNKNOWN_REGION).alias("end_region"),
        "trip_count", "distinct_bikes_used", "avg_duration_minutes",
    )


def slim_trips(staging: DataFrame) -> DataFrame:
    """The serving copy of staging.trips (B6): 17 of 22 columns."""
    return staging.select(*S.SLIM_COLUMNS)


# (column, descending) pairs of each mart's ORDER BY.
MART_ORDER = {
    S.RPT_HOURLY_DEMAND: [("source_year", False), ("source_quarter", False),
                          ("trip_date", False), ("start_hour", False)],
    S.RPT_STATION_ACTIVITY: [("source_year", False), ("source_quarter", False), ("trip_starts", True)],
    S.RPT_ROUTE_POPULARITY: [("source_year", False), ("source_quarter", False), ("trip_count", True)],
}


def mart_order(df: DataFrame, table: str, within: bool = False) -> DataFrame:
    """The ORDER BY of a mart's model (G1), nulls last, for exports and
    display; Spark tables keep no row order, so it is applied at read time.
    ``within`` sorts each partition only (for a single-partition frame)."""
    spec = MART_ORDER.get(table)
    if not spec:
        return df
    keys = [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in spec]
    return df.sortWithinPartitions(*keys) if within else df.orderBy(*keys)
