"""Overview and demand queries over staged trips.

Each function takes DataFrames and filter values and returns a DataFrame;
nothing is collected. Filters are bound literals (never SQL text).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from .joins import broadcast_if_small, is_small
from .models import trip_measures


def _asc(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def overview_metrics(trips: DataFrame, quarter: str = X.ALL_QUARTERS) -> DataFrame:
    """One row of headline figures, optionally for one quarter."""
    return X.where(trips, [X.quarter_filter(quarter)]).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.min("trip_date").alias("first_trip_date"),
        F.max("trip_date").alias("last_trip_date"),
        F.count_distinct("start_station_id").alias("start_station_count"),
        F.count_distinct("bike_id").alias("distinct_bikes"),
        X.round_binary(F.avg("duration_minutes"), 2).alias("avg_duration_minutes"),
    )


def overview_display(metrics: DataFrame) -> DataFrame:
    """E4 as display text: '1,234' counts, 'Jan 5, 2026' dates, 'x.xx min'."""
    return metrics.select(
        X.format_count("total_trips").alias("trips"),
        X.format_count("start_station_count").alias("start_stations"),
        X.format_count("distinct_bikes").alias("distinct_bikes"),
        X.format_minutes("avg_duration_minutes").alias("avg_duration"),
        X.format_day("first_trip_date").alias("first_trip"),
        X.format_day("last_trip_date").alias("latest_trip"),
    )


def quarters(trips: DataFrame) -> DataFrame:
    """E5: the quarters present, with their 'YYYY QN' labels, in order."""
    return (
        trips.select("source_year", "source_quarter").distinct()
        .select("source_year", "source_quarter", X.quarter_label().alias("quarter_label"))
        .orderBy(F.col("source_year").asc_nulls_last(), F.col("source_quarter").asc_nulls_last())
    )


def demand_by_quarter(trips: DataFrame) -> DataFrame:
    """Trips per quarter."""
    return (
        trips.groupBy("source_year", "source_quarter").agg(F.count(F.lit(1)).alias("trip_count"))
        .select("source_year", "source_quarter", X.quarter_label().alias("quarter_label"), "trip_count")
        .orderBy(*_asc("source_year", "source_quarter"))
    )


def daily_demand(trips: DataFrame, quarter: str) -> DataFrame:
    """Trips per day inside one quarter."""
    return (
        X.where(trips, [X.quarter_filter(quarter)])
        .groupBy("trip_date").agg(F.count(F.lit(1)).alias("trip_count"))
        .orderBy(*_asc("trip_date"))
    )


@dataclass(frozen=True)
class DemandFilters:
    """The Historical Demand filter values; 'All ...' means no filter."""

    quarter: str = X.ALL_QUARTERS
    region: str = X.ALL_REGIONS
    passholder_type: str = X.ALL_PASSHOLDER_TYPES
    bike_type: str = X.ALL_BIKE_TYPES
    day_type: str = X.ALL_DAYS
    start_hour: int = 0
    end_hour: int = 23

    def conditions(self) -> list[Column | None]:
        conds: list[Column | None] = [X.quarter_filter(self.quarter)]
        if self.passholder_type != X.ALL_PASSHOLDER_TYPES:
            conds.append(X.equals_with_default("passholder_type", X.UNKNOWN, self.passholder_type))
        if self.bike_type != X.ALL_BIKE_TYPES:
            conds.append(X.equals_with_default("bike_type", X.UNKNOWN, self.bike_type))
        conds.append(X.weekday_filter(self.day_type))
        conds.append(F.col("start_hour").between(F.lit(self.start_hour), F.lit(self.end_hour)))
        return conds


def in_start_region(trips: DataFrame, dim: DataFrame, region: str) -> DataFrame:
    """Trips whose start station lies in ``region``: a semi join to the ids of
    that region alone. 'Unknown Region' also holds trips without a known
    station, so it is an anti join to the ids of all other regions."""
    if region == X.ALL_REGIONS:
        return trips
    unknown = region == X.UNKNOWN_REGION
    here = X.with_default("region", X.UNKNOWN_REGION) == F.lit(region)
    ids = broadcast_if_small(dim.filter(~here if unknown else here).select(F.col("station_id").alias("__region_id")),
                             is_small(dim))
    return trips.join(ids, trips["start_station_id"] == ids["__region_id"], "left_anti" if unknown else "left_semi")


def historical_demand(trips: DataFrame, dim: DataFrame, filters: DemandFilters = DemandFilters()) -> DataFrame:
    """Filtered demand per (quarter, date, hour) with labels and day type.

    A chosen region keeps the trips that start in it (``in_start_region``).
    The labels and the day type are functions of the group keys and are
    added after the aggregation, keeping the shuffle keys narrow."""
    return in_hourly_order(_hourly_demand(trips, dim, filters))


def in_hourly_order(hourly: DataFrame) -> DataFrame:
    return hourly.orderBy(*_asc("trip_date", "start_hour", "source_year", "source_quarter"))


def _hourly_demand(trips: DataFrame, dim: DataFrame, filters: DemandFilters) -> DataFrame:
    agg = (
        in_start_region(X.where(trips, filters.conditions()), dim, filters.region)
        .groupBy("source_year", "source_quarter", "trip_date", "start_hour")
        .agg(*trip_measures())
    )
    return agg.select(
        "source_year", "source_quarter",
        X.quarter_label().alias("quarter_label"),
        "trip_date", "start_hour",
        X.hour_label("start_hour").alias("start_hour_label"),
        X.day_type(X.dow0("trip_date")).alias("day_type"),
        "trip_count", "active_station_count", "distinct_bikes_used", "avg_duration_minutes",
    )


def has_rows(df: DataFrame) -> bool:
    """False when nothing matched (the caller shows a message)."""
    return not df.isEmpty()


def mean_of_rounded(c: str) -> Column:
    """Unweighted mean of values already rounded to hundredths, computed as
    whole hundredths summed exactly, so it does not depend on row order."""
    hundredths = F.round(F.col(c) * F.lit(100.0), 0).cast("bigint")
    return (F.sum(hundredths).cast("double") / F.lit(100.0)) / F.count(F.col(c)).cast("double")


def demand_daily(hourly: DataFrame) -> DataFrame:
    """Per-day rollup of E8 (sum of trips, busiest hour's station count,
    sum of the hourly distinct bike counts, as the dashboard shows them)."""
    return hourly.groupBy("trip_date").agg(
        F.sum("trip_count").alias("trip_count"),
        F.max("active_station_count").alias("active_station_count"),
        F.sum("distinct_bikes_used").alias("distinct_bikes_used"),
    ).orderBy(*_asc("trip_date"))


def demand_by_hour(hourly: DataFrame) -> DataFrame:
    """Per-hour rollup of E8: trips and the mean of the hourly averages."""
    return hourly.groupBy("start_hour", "start_hour_label").agg(
        F.sum("trip_count").alias("trip_count"),
        mean_of_rounded("avg_duration_minutes").alias("avg_duration_minutes"),
    ).orderBy(*_asc("start_hour"))


def demand_by_day_type(hourly: DataFrame) -> DataFrame:
    """Weekday / Weekend rollup of E8."""
    return hourly.groupBy("day_type").agg(
        F.sum("trip_count").alias("trip_count"),
        mean_of_rounded("avg_duration_minutes").alias("avg_duration_minutes"),
    ).orderBy(*_asc("day_type"))


def demand_by_quarter_filtered(hourly: DataFrame) -> DataFrame:
    """Per-quarter rollup of E8 (shown for All Quarters)."""
    return hourly.groupBy("source_year", "source_quarter", "quarter_label").agg(
        F.sum("trip_count").alias("trip_count")
    ).orderBy(*_asc("source_year", "source_quarter"))


# The rollups of one historical-demand view: name -> group keys.
ROLLUPS = {
    "daily": ["trip_date"],
    "by_hour": ["start_hour", "start_hour_label"],
    "by_day_type": ["day_type"],
    "by_quarter": ["source_year", "source_quarter", "quarter_label"],
}
_ROLLUP_MEASURES = {
    "daily": ["trip_count", "active_station_count", "distinct_bikes_used"],
    "by_hour": ["trip_count", "avg_duration_minutes"],
    "by_day_type": ["trip_count", "avg_duration_minutes"],
    "by_quarter": ["trip_count"],
}


def demand_rollups(hourly: DataFrame) -> DataFrame:
    """E9-E12 in one pass over E8: a row per group of every rollup, named by
    ``rollup``; the keys of the other rollups are null."""
    keys = [c for columns in ROLLUPS.values() for c in columns]
    name = F.lit(None).cast("string")
    for rollup, columns in ROLLUPS.items():
        name = F.when(F.grouping(columns[0]) == 0, rollup).otherwise(name)
    return hourly.groupingSets([[F.col(c) for c in columns] for columns in ROLLUPS.values()], *keys).agg(
        name.alias("rollup"),
        F.sum("trip_count").alias("trip_count"),
        F.max("active_station_count").alias("active_station_count"),
        F.sum("distinct_bikes_used").alias("distinct_bikes_used"),
        mean_of_rounded("avg_duration_minutes").alias("avg_duration_minutes"),
    ).select("rollup", *keys, "trip_count", "active_station_count", "distinct_bikes_used", "avg_duration_minutes")


def one_rollup(rollups: DataFrame, name: str) -> DataFrame:
    """One of E9-E12 out of ``demand_rollups``, in its order."""
    order = [c for c in ROLLUPS[name] if not c.endswith("_label")]
    return (rollups.where(F.col("rollup") == F.lit(name)).select(*ROLLUPS[name], *_ROLLUP_MEASURES[name])
            .orderBy(*_asc(*order)))
