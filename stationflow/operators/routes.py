"""Routes queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from .models import most_trips, route_names, route_order
from .stations import route_columns


def route_categories(trips: DataFrame) -> DataFrame:
    """Route categories, null shown as 'Unknown'. Grouped on the raw
    column, so a literal 'Unknown' and a null give two rows."""
    return (
        trips.select("trip_route_category").distinct()
        .select(X.with_default("trip_route_category", X.UNKNOWN).alias("route_category"))
        .orderBy(F.col("route_category").asc_nulls_last())
    )


def top_routes(trips: DataFrame, dim: DataFrame, quarter: str = X.ALL_QUARTERS,
               category: str = X.ALL_TRIPS, limit: int = 500, keep_ids: bool = False) -> DataFrame:
    """The most frequent station-to-station routes.

    Aggregated per (start, end) id pair first (map-side partial aggregation),
    then the top ``limit`` by trip count with the ids as tie-break (a
    TakeOrderedAndProject), and only those rows get their names."""
    conds = [
        X.quarter_filter(quarter),
        F.col("start_station_id").isNotNull(),
        F.col("end_station_id").isNotNull(),
    ]
    if category != X.ALL_TRIPS:
        conds.append(X.equals_with_default("trip_route_category", X.UNKNOWN, category))
    agg = X.where(trips, conds).groupBy("start_station_id", "end_station_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.count_distinct("bike_id").alias("distinct_bikes_used"),
        X.round_binary(F.avg("duration_minutes"), 2).alias("avg_duration_minutes"),
    )
    named = route_names(most_trips(agg, limit), dim)
    ids = ["start_station_id", "end_station_id"] if keep_ids else []
    return named.orderBy(*route_order()).select(*ids, *route_columns(("distinct_bikes_used",)))


def top_route_labels(trips: DataFrame, dim: DataFrame, quarter: str = X.ALL_QUARTERS,
                     category: str = X.ALL_TRIPS, n: int = 20) -> DataFrame:
    """The first n of the top routes with a 'Start to End' label. The
    first n of the top 500 under one total order are the top n."""
    top = top_routes(trips, dim, quarter, category, limit=min(n, 500))
    return top.withColumn(
        "route", F.concat(F.col("start_station_name"), F.lit(" to "), F.col("end_station_name"))
    )
