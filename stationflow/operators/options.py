"""Filter option lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from .joins import broadcast_if_small, station_role


def demand_filter_options(trips: DataFrame, dim: DataFrame) -> DataFrame:
    """(filter_name, filter_value) for regions, passholder types and
    bike types, special values left out, as one UNION ALL.

    Regions come from the distinct start stations joined to the dimension,
    so only one row per station reaches the join."""
    stations = trips.select("start_station_id").distinct()
    side = broadcast_if_small(station_role(dim, "s_", ["station_id", "region"]))
    regions = (
        stations.join(side, stations["start_station_id"] == side["s_station_id"], "left")
        .filter(~X.with_default("s_region", X.UNKNOWN_REGION).isin(*X.SPECIAL_REGIONS))
        .select("s_region").distinct()
        .select(F.lit("region").alias("filter_name"),
                X.with_default("s_region", X.UNKNOWN_REGION).alias("filter_value"))
    )
    passholders = (
        trips.filter(~X.with_default("passholder_type", X.UNKNOWN).isin(*X.SPECIAL_PASSHOLDER_TYPES))
        .select("passholder_type").distinct()
        .select(F.lit("passholder_type").alias("filter_name"),
                X.with_default("passholder_type", X.UNKNOWN).alias("filter_value"))
    )
    bikes = (
        trips.select("bike_type").distinct()
        .select(F.lit("bike_type").alias("filter_name"),
                X.with_default("bike_type", X.UNKNOWN).alias("filter_value"))
    )
    return (
        regions.unionByName(passholders).unionByName(bikes)
        .orderBy(F.col("filter_name").asc_nulls_last(), F.col("filter_value").asc_nulls_last())
    )


def filter_option_lists(options: DataFrame) -> DataFrame:
    """One row per filter name with its sorted values. The values are
    distinct categories of one column, so each list is small."""
    return options.groupBy("filter_name").agg(
        F.sort_array(F.collect_list("filter_value")).alias("filter_values")
    )


def with_all_option(options: DataFrame, value_col: str, all_label: str) -> DataFrame:
    """H4: the 'All ...' choice in front of a list (``option_rank`` 0), the
    list's own rows after it in their order (``option_rank`` 1)."""
    spark = options.sparkSession
    head = spark.range(1).select(F.lit(all_label).alias(value_col), F.lit(0).alias("option_rank"))
    rest = options.select(F.col(value_col).cast("string").alias(value_col), F.lit(1).alias("option_rank"))
    return head.unionByName(rest).orderBy("option_rank", F.col(value_col).asc_nulls_last())
