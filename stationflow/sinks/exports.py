"""Exports (B5-B8): headed CSV extracts of the marts and a slim serving copy."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import schemas as S
from ..operators.models import mart_order, slim_trips
from . import files, versions
from .tables import Warehouse

# Extract file name -> warehouse table, in export order.
CSV_EXPORTS = {
    "hourly_demand": S.RPT_HOURLY_DEMAND,
    "station_activity": S.RPT_STATION_ACTIVITY,
    "route_popularity": S.RPT_ROUTE_POPULARITY,
    "stations": S.DIM_STATIONS,
}


def export_csv(spark: SparkSession, wh: Warehouse, out_dir: str, single_file: bool = False) -> list[str]:
    """One headed, comma-separated extract per mart, rows in the mart's
    order. Each extract is a folder of headed part files written in parallel,
    whose name order is the row order. With ``single_file=True`` it is one
    file: the rows are sorted and written in parallel without headers, and the
    parts are then joined behind one header line."""
    written = []
    for file_name, table in CSV_EXPORTS.items():
        df = mart_order(wh.table(table), table)
        target = f"{out_dir.rstrip('/')}/{file_name}.csv"
        staged = files.staging_for(target)
        (
            df.write
            .mode("overwrite")
            .option("header", not single_file)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("dateFormat", "yyyy-MM-dd")
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(staged)
        )
        if single_file:
            files.concatenate_parts(spark, staged, target, ",".join(df.columns) + "\n")
        else:
            files.replace_dir(spark, staged, target)
        written.append(target)
    return written


SERVING_TABLES = [S.DIM_STATIONS, S.RPT_HOURLY_DEMAND, S.RPT_STATION_ACTIVITY, S.RPT_ROUTE_POPULARITY]


def export_serving(spark: SparkSession, wh: Warehouse, out_root: str) -> Warehouse:
    """The serving copy, replaced as a whole in one atomic step: the
    17-column staging projection (same partitioning) plus the dimension and
    marts unchanged, as a new version of the copy's root."""
    version = versions.fresh(out_root)
    out = Warehouse(spark, version)
    out.save(slim_trips(wh.table(S.STAGING_TRIPS)), S.STAGING_TRIPS)
    for name in SERVING_TABLES:
        out.save(wh.table(name), name)
    versions.commit(spark, version)
    return Warehouse(spark, out_root)
