"""Station Activity queries."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from .models import most_trips, route_end, route_order, station_activity


def station_ranking(trips: DataFrame, dim: DataFrame, quarter: str = X.ALL_QUARTERS) -> DataFrame:
    """Per start station over the chosen quarter(s); trips without a
    start station form their own 'Unknown Station' row (no null filter).
    Ordered by trip starts, descending (ties by station id)."""
    return station_activity(X.where(trips, [X.quarter_filter(quarter)]), dim, []).orderBy(
        F.col("trip_starts").desc_nulls_last(), F.col("station_id").asc_nulls_last())


def in_region(ranking: DataFrame, region: str = X.ALL_REGIONS) -> DataFrame:
    """C17: the ranking restricted to one region."""
    if region == X.ALL_REGIONS:
        return ranking
    return ranking.filter(F.col("region") == F.lit(region))


def station_regions(ranking: DataFrame) -> DataFrame:
    """Regions of the ranked stations, special ones left out, sorted."""
    return (
        ranking.select("region").filter(
            F.col("region").isNotNull() & ~F.col("region").isin(*X.SPECIAL_REGIONS)
        )
        .distinct()
        .orderBy(F.col("region").asc_nulls_last())
    )


def station_options(ranking: DataFrame, region: str = X.ALL_REGIONS) -> DataFrame:
    """Distinct (id, name) pairs of a region with 'Name (id)' labels."""
    return (
        in_region(ranking, region).select("station_id", "station_name").dropDuplicates()
        .withColumn("station_label", X.station_label())
        .orderBy(F.col("station_name").asc_nulls_last(), F.col("station_id").asc_nulls_last())
    )


def station_lookup(ranking: DataFrame, station_label: str, region: str = X.ALL_REGIONS) -> DataFrame:
    """The chosen station's row (id taken after the label's last '(')."""
    station_id = X.station_id_from_label(station_label)
    return in_region(ranking, region).filter(F.col("station_id") == F.lit(station_id))


def top_stations(ranking: DataFrame, n: int = 20, region: str = X.ALL_REGIONS) -> DataFrame:
    """The n stations with most trip starts (ties by station id)."""
    return (
        in_region(ranking, region)
        .orderBy(F.col("trip_starts").desc_nulls_last(), F.col("station_id").asc_nulls_last())
        .limit(n)
    )


def bar_order(df: DataFrame, measure: str) -> DataFrame:
    """Ascending by the measure, for horizontal bar charts."""
    return df.orderBy(F.col(measure).asc_nulls_last())


def mappable(ranking: DataFrame) -> DataFrame:
    """Stations in a known, regular region with usable coordinates."""
    return ranking.filter(
        F.col("region").isNotNull()
        & ~F.col("region").isin(*X.SPECIAL_REGIONS)
        & F.col("station_lat").isNotNull()
        & F.col("station_lon").isNotNull()
        & (F.col("station_lat") != 0)
        & (F.col("station_lon") != 0)
    )


def station_map(ranking: DataFrame, region: str = X.ALL_REGIONS) -> DataFrame:
    """Mappable stations with marker size max(sqrt(starts), 6) and colour."""
    return mappable(in_region(ranking, region)).select(
        "station_id", "station_name", "region", "station_lat", "station_lon", "trip_starts",
        X.marker_size().alias("marker_size"),
        X.region_color("region").alias("region_color"),
    )


def _station_trips(trips: DataFrame, quarter: str, station_id: str) -> DataFrame:
    return X.where(trips, [X.quarter_filter(quarter), F.col("start_station_id") == F.lit(station_id)])


def station_daily(trips: DataFrame, quarter: str, station_id: str) -> DataFrame:
    """Trip starts per day at one station."""
    return _station_trips(trips, quarter, station_id).groupBy("trip_date").agg(
        F.count(F.lit(1)).alias("trip_starts")
    ).orderBy(F.col("trip_date").asc_nulls_last())


def station_hourly(trips: DataFrame, quarter: str, station_id: str) -> DataFrame:
    """Trip starts per hour at one station, with labels."""
    agg = _station_trips(trips, quarter, station_id).groupBy("start_hour").agg(
        F.count(F.lit(1)).alias("trip_starts")
    )
    return agg.select("start_hour", X.hour_label("start_hour").alias("start_hour_label"), "trip_starts").orderBy(
        F.col("start_hour").asc_nulls_last())


def physical_destination(prefix: str = "es_") -> Column:
    """Not a Virtual Station, in a known region, with real coordinates."""
    return (
        (X.with_default(f"{prefix}station_name", X.UNKNOWN_END_STATION) != F.lit(X.VIRTUAL_STATION))
        & (X.with_default(f"{prefix}region", X.UNKNOWN_REGION) != F.lit(X.UNKNOWN_REGION))
        & F.col(f"{prefix}latitude").isNotNull()
        & F.col(f"{prefix}longitude").isNotNull()
        & (F.col(f"{prefix}latitude") != 0)
        & (F.col(f"{prefix}longitude") != 0)
    )


def route_columns(extra: tuple[str, ...] = ()) -> list:
    return [
        X.with_default("ss_station_name", X.UNKNOWN_START_STATION).alias("start_station_name"),
        X.with_default("ss_region", X.UNKNOWN_REGION).alias("start_region"),
        X.with_default("es_station_name", X.UNKNOWN_END_STATION).alias("end_station_name"),
        X.with_default("es_region", X.UNKNOWN_REGION).alias("end_region"),
        "trip_count", *extra, "avg_duration_minutes",
    ]


def top_destinations(trips: DataFrame, dim: DataFrame, quarter: str, station_id: str,
                     include_special: bool = False, limit: int = 15,
                     keep_ids: bool = False) -> DataFrame:
    """The most frequent destinations from one station.

    Trips are aggregated per (start, end) id first; the end's attributes and
    the C15 test are functions of its id and are applied to the aggregates, the
    start's are attached to the rows that remain. Ties on the count are broken
    by the ids, which are grouped but not shown."""
    base = _station_trips(trips, quarter, station_id).filter(F.col("end_station_id").isNotNull())
    agg = base.groupBy("start_station_id", "end_station_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        X.round_binary(F.avg("duration_minutes"), 2).alias("avg_duration_minutes"),
    )
    named = route_end(agg, dim, "end_station_id", "es_",
                      ("station_id", "station_name", "region", "latitude", "longitude"))
    if not include_special:
        named = named.filter(physical_destination("es_"))
    named = route_end(most_trips(named, limit), dim, "start_station_id", "ss_")
    ids = ["start_station_id", "end_station_id"] if keep_ids else []
    return named.orderBy(*route_order()).select(*ids, *route_columns())


def selected_station_id(label: Optional[str]) -> Optional[str]:
    """'All Stations' -> None, else the id from 'Name (id)'."""
    if label is None or label == X.ALL_STATIONS:
        return None
    return X.station_id_from_label(label)
