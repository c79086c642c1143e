"""Registered queries: Spark callables and their DuckDB oracle statements.

Every callable takes ``(spark, sf_dir)``, derives trip and station tables from
the test tables there (``sources.adapter``) and runs one operator of the
library over them. ``ORACLE[name]`` is the same computation in DuckDB SQL.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from .. import session
from ..functions import expressions as X
from ..operators import demand as D
from ..operators import manifest as MF
from ..operators import models as M
from ..operators import options as OP
from ..operators import quality as Q
from ..operators import routes as R
from ..operators import stations as ST
from ..plans.ingest import ingest_stations, ingest_trips
from ..plans.warehouse import build_warehouse
from ..session import scratch_path
from ..sinks.exports import export_csv, export_serving
from ..sinks.lake import write_station_lake, write_trip_lake
from ..sinks.tables import Warehouse
from ..sources import adapter as A
from ..sources import archives as AR
from ..sources.adapter import FILE_ORDER
from ..sources.lake import read_trip_lake
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return run
    return deco


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.build_staging_trips(A.raw_trips(spark, sf_dir))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.build_dim_stations(A.raw_stations(spark, sf_dir))


# ---------------------------------------------------------------- models ---

@register("stg_trips", O.sql("select * from stg"))
def q_stg_trips(spark, sf_dir):
    """staging.trips: C3-C4, F1, I1-I5."""
    return staging(spark, sf_dir)


@register("dim_stations", O.sql("select * from dim"))
def q_dim_stations(spark, sf_dir):
    """marts.dim_stations: C5, F2."""
    return dim(spark, sf_dir)


# grouped step, labels and station attributes are attached to its rows afterwards.

TRIPS = "count(*)"
STATIONS = "count(distinct start_station_id)"
BIKES = "count(distinct bike_id)"
MINUTES = "round(avg(duration_minutes), 2) as avg_duration_minutes"


def hour_label_sql(h: str) -> str:
    """12-hour clock text of an hour number, from a time of that hour."""
    return f"ltrim(strftime(timestamp '2000-01-01' + to_hours(cast({h} as integer)), '%I %p'), '0')"


def grouped_sql(keys: str, measures: str, where: str = "true", source: str = "stg") -> str:
    return f"(select {keys}, {measures} from {source} where {where} group by {keys})"


_HOUR_MEASURES = f"{TRIPS} as trip_count, {STATIONS} as active_station_count, {BIKES} as distinct_bikes_used, {MINUTES}"

HOURLY_MART_SQL = f"""
select h.*, {hour_label_sql('h.start_hour')} as start_hour_label
from {grouped_sql('source_year, source_quarter, trip_date, start_hour', _HOUR_MEASURES)} h
"""


@register("rpt_hourly_demand", O.sql(HOURLY_MART_SQL))
def q_rpt_hourly_demand(spark, sf_dir):
    """marts.rpt_hourly_demand: E1, I6, I10."""
    return M.build_hourly_demand(staging(spark, sf_dir))


def per_station_sql(keys: str = "", where: str = "true") -> str:
    """Starts per station id (and ``keys``), then the station's attributes."""
    measures = (f"{TRIPS} as trip_starts, {BIKES} as distinct_bikes_used, {MINUTES}, "
                "round(avg(start_lat), 6) as mean_lat, round(avg(start_lon), 6) as mean_lon")
    return f"""
select g.* exclude (start_station_id, mean_lat, mean_lon), g.start_station_id as station_id,
       ifnull(d.station_name, 'Unknown Station') as station_name,
       ifnull(d.region, 'Unknown Region') as region,
       ifnull(d.status, 'Unknown Status') as station_status,
       ifnull(d.latitude, mean_lat) as station_lat, ifnull(d.longitude, mean_lon) as station_lon
from {grouped_sql(keys + 'start_station_id', measures, where)} g
left join dim d on d.station_id = g.start_station_id
"""


STATION_MART_SQL = per_station_sql("source_year, source_quarter, ", "start_station_id is not null")


@register("rpt_station_activity", O.sql(STATION_MART_SQL))
def q_rpt_station_activity(spark, sf_dir):
    """marts.rpt_station_activity: E2, D1, C6, I8, I9."""
    return M.build_station_activity(staging(spark, sf_dir), dim(spark, sf_dir))


_ROUTE_MEASURES = f"{TRIPS} as trip_count, {BIKES} as distinct_bikes_used, {MINUTES}"


def named_pairs_sql(pairs: str) -> str:
    """Rows with start_station_id and end_station_id, their names and regions attached."""
    return f"""
select p.*, ifnull(a.station_name, 'Unknown Start Station') as start_station_name,
       ifnull(a.region, 'Unknown Region') as start_region,
       ifnull(b.station_name, 'Unknown End Station') as end_station_name,
       ifnull(b.region, 'Unknown Region') as end_region
from {pairs} p
left join dim a on a.station_id = p.start_station_id
left join dim b on b.station_id = p.end_station_id
"""


BOTH_ENDS = "start_station_id is not null and end_station_id is not null"
ROUTE_MART_SQL = named_pairs_sql(grouped_sql(
    "source_year, source_quarter, start_station_id, end_station_id", _ROUTE_MEASURES, BOTH_ENDS))


@register("rpt_route_popularity", O.sql(ROUTE_MART_SQL))
def q_rpt_route_popularity(spark, sf_dir):
    """marts.rpt_route_popularity: E3, D2."""
    return M.build_route_popularity(staging(spark, sf_dir), dim(spark, sf_dir))


# ------------------------------------------------------- dashboard queries ---


# Fixed parameters of the registered dashboard queries (filter choices).
QUARTER = "1998 Q2"
QUARTER_SQL = "source_year = 1998 and source_quarter = 2"
REGION = "AMERICA"
STATION_ID = "7"
STATION_LABEL = "Supplier#000000007 (7)"
FILTERS_REGION = D.DemandFilters(quarter=QUARTER, region=REGION, day_type=X.WEEKDAY, start_hour=6, end_hour=20)
FILTERS_TYPES = D.DemandFilters(passholder_type="2-HIGH", bike_type="standard", day_type=X.WEEKEND)


def qlabel_sql(prefix: str = "") -> str:
    return f"format('{{}} Q{{}}', {prefix}source_year, {prefix}source_quarter)"


@register("quarters", O.sql(f"""
select source_year, source_quarter, {qlabel_sql()} as quarter_label
from stg group by source_year, source_quarter
"""))
def q_quarters(spark, sf_dir):
    """E5."""
    return D.quarters(staging(spark, sf_dir))


def overview_sql(where: str = "true") -> str:
    """Headline figures: each count taken from its own list of distinct values."""
    return f"""
with chosen as (select * from stg where {where}),
     days as (select min(trip_date) as first_trip_date, max(trip_date) as last_trip_date from chosen)
select days.*, (select count(*) from chosen) as total_trips,
       (select count(*) from (select distinct start_station_id as id from chosen) where id is not null) as start_station_count,
       (select count(*) from (select distinct bike_id as id from chosen) where id is not null) as distinct_bikes,
       (select round(avg(duration_minutes), 2) from chosen) as avg_duration_minutes
from days
"""


@register("overview_all", O.sql("select * from (" + overview_sql() + ")"))
def q_overview_all(spark, sf_dir):
    """E4, all quarters."""
    return D.overview_metrics(staging(spark, sf_dir))


@register("overview_quarter", O.sql("select * from (" + overview_sql(QUARTER_SQL) + ")"))
def q_overview_quarter(spark, sf_dir):
    """E4 with C7."""
    return D.overview_metrics(staging(spark, sf_dir), QUARTER)


@register("demand_by_quarter", O.sql(f"""
select source_year, source_quarter, {qlabel_sql()} as quarter_label, count(*) as trip_count
from stg group by source_year, source_quarter
"""))
def q_demand_by_quarter(spark, sf_dir):
    """E6, I11."""
    return D.demand_by_quarter(staging(spark, sf_dir))


@register("daily_demand", O.sql(f"""
select trip_date, count(*) as trip_count from stg where {QUARTER_SQL} group by trip_date
"""))
def q_daily_demand(spark, sf_dir):
    """E7."""
    return D.daily_demand(staging(spark, sf_dir), QUARTER)


def hourly_sql(where: str) -> str:
    keys = "source_year, source_quarter, trip_date, start_hour"
    return f"""
select h.*, {qlabel_sql('h.')} as quarter_label, {hour_label_sql('h.start_hour')} as start_hour_label,
       if(isodow(h.trip_date) > 5, 'Weekend', 'Weekday') as day_type
from {grouped_sql(keys, _HOUR_MEASURES, where)} h
"""


HOURLY_REGION_WHERE = (
    f"{QUARTER_SQL} and start_station_id in (select station_id from dim where region = '{REGION}')"
    " and isodow(trip_date) < 6 and start_hour >= 6 and start_hour <= 20"
)
HOURLY_TYPES_WHERE = (
    "passholder_type = '2-HIGH' and bike_type = 'standard' and isodow(trip_date) > 5"
)


@register("demand_hourly_filtered", O.sql(hourly_sql(HOURLY_REGION_WHERE)))
def q_demand_hourly_filtered(spark, sf_dir):
    """E8 with quarter, region, weekday and hour range."""
    return D.historical_demand(staging(spark, sf_dir), dim(spark, sf_dir), FILTERS_REGION)


@register("demand_hourly_types", O.sql(hourly_sql(HOURLY_TYPES_WHERE)))
def q_demand_hourly_types(spark, sf_dir):
    """E8 with passholder type, bike type and weekend, all quarters."""
    return D.historical_demand(staging(spark, sf_dir), dim(spark, sf_dir), FILTERS_TYPES)


def _mean_rounded_sql(c: str) -> str:
    return (f"(cast(sum(cast(round({c} * 100.0, 0) as bigint)) as double) / 100.0::double)"
            f" / cast(count({c}) as double)")


@register("demand_daily", O.sql(f"""
select trip_date,
       cast(sum(trip_count) as bigint) as trip_count,
       max(active_station_count) as active_station_count,
       cast(sum(distinct_bikes_used) as bigint) as distinct_bikes_used
from hourly group by trip_date
""", "hourly as (" + hourly_sql(HOURLY_REGION_WHERE) + ")"))
def q_demand_daily(spark, sf_dir):
    """E9."""
    return D.demand_daily(q_demand_hourly_filtered(spark, sf_dir))


@register("demand_by_hour", O.sql(f"""
select start_hour, start_hour_label,
       cast(sum(trip_count) as bigint) as trip_count,
       {_mean_rounded_sql('avg_duration_minutes')} as avg_duration_minutes
from hourly group by start_hour, start_hour_label
""", "hourly as (" + hourly_sql(HOURLY_TYPES_WHERE) + ")"))
def q_demand_by_hour(spark, sf_dir):
    """E10."""
    return D.demand_by_hour(q_demand_hourly_types(spark, sf_dir))


@register("demand_by_day_type", O.sql(f"""
select day_type,
       cast(sum(trip_count) as bigint) as trip_count,
       {_mean_rounded_sql('avg_duration_minutes')} as avg_duration_minutes
from hourly group by day_type
""", "hourly as (" + hourly_sql("start_hour is not null") + ")"))
def q_demand_by_day_type(spark, sf_dir):
    """E11 (no filters but the full hour range)."""
    return D.demand_by_day_type(D.historical_demand(staging(spark, sf_dir), dim(spark, sf_dir)))


@register("demand_rollups", O.sql(f"""
select case when grouping(trip_date) = 0 then 'daily' when grouping(start_hour) = 0 then 'by_hour'
            when grouping(day_type) = 0 then 'by_day_type' else 'by_quarter' end as rollup,
       coalesce(cast(trip_date as varchar), start_hour_label, day_type, quarter_label) as label,
       cast(sum(trip_count) as bigint) as trip_count,
       max(active_station_count) as active_station_count,
       cast(sum(distinct_bikes_used) as bigint) as distinct_bikes_used,
       {_mean_rounded_sql('avg_duration_minutes')} as avg_duration_minutes
from hourly
group by grouping sets ((trip_date), (start_hour, start_hour_label), (day_type), (source_year, source_quarter, quarter_label))
""", "hourly as (" + hourly_sql(HOURLY_TYPES_WHERE) + ")"))
def q_demand_rollups(spark, sf_dir):
    """E9-E12 of one view in one pass over E8; each group by its label."""
    label = F.coalesce(F.col("trip_date").cast("string"), "start_hour_label", "day_type", "quarter_label")
    return D.demand_rollups(q_demand_hourly_types(spark, sf_dir)).select(
        "rollup", label.alias("label"), "trip_count", "active_station_count", "distinct_bikes_used", "avg_duration_minutes")


@register("demand_by_quarter_filtered", O.sql("""
select source_year, source_quarter, quarter_label, cast(sum(trip_count) as bigint) as trip_count
from hourly group by source_year, source_quarter, quarter_label
""", "hourly as (" + hourly_sql(HOURLY_TYPES_WHERE) + ")"))
def q_demand_by_quarter_filtered(spark, sf_dir):
    """E12."""
    return D.demand_by_quarter_filtered(q_demand_hourly_types(spark, sf_dir))


RANKING_Q = "ranking as (" + per_station_sql(where=QUARTER_SQL) + ")"
RANKING_ALL = "ranking as (" + per_station_sql() + ")"


def ranking(spark, sf_dir, quarter=QUARTER):
    return ST.station_ranking(staging(spark, sf_dir), dim(spark, sf_dir), quarter)


@register("station_ranking", O.sql("select * from ranking", RANKING_Q))
def q_station_ranking(spark, sf_dir):
    """E13 for one quarter (null start stations kept)."""
    return ranking(spark, sf_dir)


@register("station_ranking_all", O.sql("select * from ranking", RANKING_ALL))
def q_station_ranking_all(spark, sf_dir):
    """E13 over all quarters."""
    return ranking(spark, sf_dir, X.ALL_QUARTERS)


@register("station_top_n", O.sql(
    "select * from ranking order by trip_starts desc, station_id asc nulls last limit 20", RANKING_ALL))
def q_station_top_n(spark, sf_dir):
    """G4 (n = 20)."""
    return ST.top_stations(ranking(spark, sf_dir, X.ALL_QUARTERS), 20)


@register("station_top_n_region", O.sql(
    f"select * from ranking where region = '{REGION}' "
    "order by trip_starts desc, station_id asc nulls last limit 10", RANKING_Q))
def q_station_top_n_region(spark, sf_dir):
    """G4 (n = 10) inside one region (C17)."""
    return ST.top_stations(ranking(spark, sf_dir), 10, REGION)


@register("station_map", O.sql("""
select station_id, station_name, region, station_lat, station_lon, trip_starts,
       greatest(sqrt(cast(trip_starts as double)), 6.0::double) as marker_size,
       case region when 'DTLA' then '#0057B8' when 'Westside' then '#E4572E'
                   when 'North Hollywood' then '#2CA02C' when 'Pasadena' then '#8E44AD'
                   when 'Port of LA' then '#D81B60' end as region_color
from ranking
where region is not null and region not in ('Free Bikes', 'Unknown Region')
  and station_lat is not null and station_lon is not null
  and station_lat != 0 and station_lon != 0
""", RANKING_ALL))
def q_station_map(spark, sf_dir):
    """C18, I19, I20."""
    return ST.station_map(ranking(spark, sf_dir, X.ALL_QUARTERS))


@register("station_options", O.sql(f"""
select distinct station_id, station_name, station_name || ' (' || station_id || ')' as station_label
from ranking where region = '{REGION}'
""", RANKING_Q))
def q_station_options(spark, sf_dir):
    """E21, I14 (labels)."""
    return ST.station_options(ranking(spark, sf_dir), REGION)


@register("station_regions", O.sql("""
select distinct region from ranking
where region is not null and region not in ('Free Bikes', 'Unknown Region')
""", RANKING_ALL))
def q_station_regions(spark, sf_dir):
    """E22."""
    return ST.station_regions(ranking(spark, sf_dir, X.ALL_QUARTERS))


@register("station_lookup", O.sql(f"select * from ranking where station_id = '{STATION_ID}'", RANKING_Q))
def q_station_lookup(spark, sf_dir):
    """C19 with the id taken from a 'Name (id)' label."""
    return ST.station_lookup(ranking(spark, sf_dir), STATION_LABEL)


@register("station_daily", O.sql(f"""
select trip_date, count(*) as trip_starts from stg
where {QUARTER_SQL} and start_station_id = '{STATION_ID}' group by trip_date
"""))
def q_station_daily(spark, sf_dir):
    """E14, C14."""
    return ST.station_daily(staging(spark, sf_dir), QUARTER, STATION_ID)


@register("station_hourly", O.sql(f"""
select start_hour, {hour_label_sql('start_hour')} as start_hour_label, count(*) as trip_starts from stg
where {QUARTER_SQL} and start_station_id = '{STATION_ID}' group by start_hour
"""))
def q_station_hourly(spark, sf_dir):
    """E15."""
    return ST.station_hourly(staging(spark, sf_dir), QUARTER, STATION_ID)


def first_by_trips(rows: str, n: int) -> str:
    """The n rows with most trips, ties by the station ids."""
    return (f"(select * from {rows} qualify row_number() over (order by trip_count desc, "
            f"start_station_id nulls last, end_station_id nulls last) <= {n})")


_SHOWN = "start_station_name, start_region, end_station_name, end_region, trip_count"


def destinations_sql(special: bool) -> str:
    """Destinations of one station; physical ones come from a list of usable stations."""
    usable = ("(select station_id from dim where ifnull(station_name, '') <> 'Virtual Station'"
              " and ifnull(region, 'Unknown Region') <> 'Unknown Region' and latitude <> 0 and longitude <> 0)")
    where = f"{QUARTER_SQL} and start_station_id = '{STATION_ID}' and end_station_id is not null"
    if not special:
        where += f" and end_station_id in {usable}"
    pairs = grouped_sql("start_station_id, end_station_id", f"{TRIPS} as trip_count, {MINUTES}", where)
    return f"select {_SHOWN}, avg_duration_minutes from ({named_pairs_sql(first_by_trips(pairs, 15))})"


@register("top_destinations", O.sql(destinations_sql(False)))
def q_top_destinations(spark, sf_dir):
    """Physical destinations only."""
    return ST.top_destinations(staging(spark, sf_dir), dim(spark, sf_dir), QUARTER, STATION_ID)


@register("top_destinations_all", O.sql(destinations_sql(True)))
def q_top_destinations_all(spark, sf_dir):
    """E16 with virtual / unknown destinations included."""
    return ST.top_destinations(staging(spark, sf_dir), dim(spark, sf_dir), QUARTER, STATION_ID,
                               include_special=True)


def routes_sql(where: str, limit: int, label: bool = False) -> str:
    pairs = grouped_sql("start_station_id, end_station_id", _ROUTE_MEASURES, f"{BOTH_ENDS} and {where}")
    route = ", concat_ws(' to ', start_station_name, end_station_name) as route" if label else ""
    return (f"select {_SHOWN}, distinct_bikes_used, avg_duration_minutes{route} "
            f"from ({named_pairs_sql(first_by_trips(pairs, limit))})")


@register("top_routes", O.sql(routes_sql("true", 500)))
def q_top_routes(spark, sf_dir):
    """E17, G3 over all quarters and categories."""
    return R.top_routes(staging(spark, sf_dir), dim(spark, sf_dir))


@register("top_routes_one_way", O.sql(routes_sql(f"{QUARTER_SQL} and trip_route_category = 'One Way'", 500)))
def q_top_routes_one_way(spark, sf_dir):
    """E17 with C7 and C16."""
    return R.top_routes(staging(spark, sf_dir), dim(spark, sf_dir), QUARTER, "One Way")


@register("top_route_labels", O.sql(routes_sql("true", 20, label=True)))
def q_top_route_labels(spark, sf_dir):
    """The first 20 routes with 'Start to End' labels."""
    return R.top_route_labels(staging(spark, sf_dir), dim(spark, sf_dir), n=20)


@register("route_categories", O.sql(
    "select ifnull(category, 'Unknown') as route_category from (select distinct trip_route_category as category from stg)"))
def q_route_categories(spark, sf_dir):
    """E18."""
    return R.route_categories(staging(spark, sf_dir))


FILTER_OPTIONS_SQL = """
with used as (select distinct start_station_id as id from stg),
     found as (
    select distinct 'region' as filter_name, d.region as raw, 'Unknown Region' as fallback
    from used left join dim d on d.station_id = used.id
    union select distinct 'passholder_type', passholder_type, 'Unknown' from stg
    union select distinct 'bike_type', bike_type, 'Unknown' from stg)
select filter_name, ifnull(raw, fallback) as filter_value from found
where not (filter_name = 'region' and ifnull(raw, fallback) in ('Free Bikes', 'Unknown Region'))
  and not (filter_name = 'passholder_type' and ifnull(raw, fallback) in ('Testing', 'Unknown'))
"""


@register("demand_filter_options", O.sql("select * from (" + FILTER_OPTIONS_SQL + ")"))
def q_demand_filter_options(spark, sf_dir):
    """E19, H2, C13."""
    return OP.demand_filter_options(staging(spark, sf_dir), dim(spark, sf_dir))


@register("region_choices", O.sql("""
select 'All Regions' as filter_value, 0 as option_rank
union all
select filter_value, 1 from options where filter_name = 'region'
""", "options as (" + FILTER_OPTIONS_SQL + ")"))
def q_region_choices(spark, sf_dir):
    """H4: 'All Regions' in front of the region options."""
    opts = OP.demand_filter_options(staging(spark, sf_dir), dim(spark, sf_dir))
    return OP.with_all_option(opts.filter("filter_name = 'region'"), "filter_value", X.ALL_REGIONS)


# ------------------------------------------------ checks, counts, serving ---


MART_CTES = ",".join([
    "hourly_mart as (" + HOURLY_MART_SQL + ")",
    "station_mart as (" + STATION_MART_SQL + ")",
    "route_mart as (" + ROUTE_MART_SQL + ")",
])


def warehouse_tables(spark, sf_dir) -> dict:
    stg = staging(spark, sf_dir)
    dm = dim(spark, sf_dir)
    return {
        S.RAW_TRIPS: A.raw_trips(spark, sf_dir),
        S.RAW_STATIONS: A.raw_stations(spark, sf_dir),
        S.STAGING_TRIPS: stg,
        S.DIM_STATIONS: dm,
        S.RPT_HOURLY_DEMAND: M.build_hourly_demand(stg),
        S.RPT_STATION_ACTIVITY: M.build_station_activity(stg, dm),
        S.RPT_ROUTE_POPULARITY: M.build_route_popularity(stg, dm),
    }


def _size_sql(name: str, cte: str) -> str:
    return f"select '{Q.HAS_ROWS}' as check_name, '{name}' as table_name, (select count(*) from {cte}) as observed"


_BAD_TIMES = "not coalesce(start_time <= end_time and {minutes} > 0, start_time is not null and end_time is not null and start_time <= end_time)"


def _bad_times_sql(rows: str, minutes: str) -> str:
    return f"(select count(*) from {rows} where {_BAD_TIMES.format(minutes=minutes)})"


DQ_SQL = f"""
with sizes as ({" union all ".join(_size_sql(n, c) for n, c in [
        ("raw.trips", "raw_trips"), ("raw.stations", "raw_stations"), ("staging.trips", "stg"),
        ("marts.dim_stations", "dim"), ("marts.rpt_hourly_demand", "hourly_mart"),
        ("marts.rpt_station_activity", "station_mart"), ("marts.rpt_route_popularity", "route_mart")])}),
faults as (
    select '{Q.ONE_ROW_PER_TRIP}' as check_name, 'staging.trips' as table_name,
           (select count(*) from (select trip_id, count(*) as n from stg group by trip_id) where n > 1) as observed
    union all select '{Q.USABLE_TIMES}', 'staging.trips', {_bad_times_sql('stg', 'duration_minutes')}
    union all select '{Q.HOURLY_KEYS}', 'marts.rpt_hourly_demand',
           (select count(*) from hourly_mart where trip_date is null or start_hour is null or trip_count < 1))
select *, observed > 0 as passed from sizes
union all
select *, observed = 0 as passed from faults
"""


@register("dq_checks", O.sql("select * from (" + DQ_SQL + ")", MART_CTES))
def q_dq_checks(spark, sf_dir):
    """L1-L5 over the seven tables (all pass on the adapter data)."""
    return Q.run_checks(warehouse_tables(spark, sf_dir))


@register("dq_duplicates_raw", O.sql("""
select trip_id, count(*) as row_count from raw_trips group by trip_id having count(*) > 1
"""))
def q_dq_duplicates_raw(spark, sf_dir):
    """E23 on raw.trips, which does hold duplicated trip ids."""
    return Q.duplicate_keys(A.raw_trips(spark, sf_dir), ["trip_id"])


@register("dq_timing_raw", O.sql(f"""
select '{Q.USABLE_TIMES}' as check_name, 'staging.trips' as table_name, n as observed, n = 0 as passed
from (select {_bad_times_sql('trip_source', 'duration')} as n)
"""))
def q_dq_timing_raw(spark, sf_dir):
    """L4 applied to uncleaned source rows: it must fail (observed > 0)."""
    src = A.trip_source(spark, sf_dir).withColumnRenamed("duration", "duration_minutes")
    return Q.timing_check(src)


@register("table_counts", O.sql("""
select table_name, count(id) as row_count
from (select unnest(['staging.trips', 'marts.rpt_hourly_demand', 'marts.rpt_station_activity',
                     'marts.rpt_route_popularity']) as table_name)
left join (select 'staging.trips' as t, 1 as id from stg
           union all select 'marts.rpt_hourly_demand', 1 from hourly_mart
           union all select 'marts.rpt_station_activity', 1 from station_mart
           union all select 'marts.rpt_route_popularity', 1 from route_mart) on t = table_name
group by table_name
""", MART_CTES))
def q_table_counts(spark, sf_dir):
    """H1 (the Data Health counts), B12."""
    t = warehouse_tables(spark, sf_dir)
    names = [S.STAGING_TRIPS, S.RPT_HOURLY_DEMAND, S.RPT_STATION_ACTIVITY, S.RPT_ROUTE_POPULARITY]
    return Q.table_counts({n: t[n] for n in names})


@register("slim_trips", O.sql(f"select {', '.join(S.SLIM_COLUMNS)} from stg"))
def q_slim_trips(spark, sf_dir):
    """The 17-column serving copy of staging.trips."""
    return M.slim_trips(staging(spark, sf_dir))


# -------------------------------------------------------------- manifest ---

RAW_DIR = "data/raw"
LAKE_DIR = "data/lake/trips"
EARLIER_RUN = "2026-03-01T00:00:00.000000+00:00"
LATER_RUN = "2026-06-14T00:30:52.000000+00:00"
FIRST_YEAR_OF_LATER_RUN = 1999
ARCHIVE_URL = "https://example.org/about/data"


def _manifest_records_sql(where: str, stamp: str) -> str:
    return f"""
select source_file, '{RAW_DIR}/' || source_file as source_path, source_year, source_quarter,
       count(*) as cleaned_rows,
       '{LAKE_DIR}/year=' || cast(source_year as varchar) || '/quarter=' || cast(source_quarter as varchar) as output_path,
       '{stamp}' as ingested_at
from raw_trips {where}
group by source_file, source_year, source_quarter
"""


def manifest_records(spark, sf_dir, stamp=LATER_RUN, min_year=None, max_year=None):
    raw = A.raw_trips(spark, sf_dir)
    if min_year is not None:
        raw = raw.filter(F.col("source_year") >= min_year)
    if max_year is not None:
        raw = raw.filter(F.col("source_year") <= max_year)
    counts = raw.groupBy("source_file", "source_year", "source_quarter").agg(
        F.count(F.lit(1)).alias("cleaned_rows"))
    return MF.records_from_counts(counts, RAW_DIR, LAKE_DIR, stamp)


OLD_MANIFEST = "old_manifest as (" + _manifest_records_sql(
    f"where source_year <= {FIRST_YEAR_OF_LATER_RUN}", EARLIER_RUN) + ")"
NEW_MANIFEST = "new_manifest as (" + _manifest_records_sql(
    f"where source_year >= {FIRST_YEAR_OF_LATER_RUN}", LATER_RUN) + ")"


@register("manifest_records", O.sql(_manifest_records_sql("", LATER_RUN)))
def q_manifest_records(spark, sf_dir):
    """One manifest record per source file with its cleaned row count."""
    return manifest_records(spark, sf_dir)


@register("manifest_upsert", O.sql("""
select * from old_manifest where source_file not in (select source_file from new_manifest)
union all
select * from new_manifest
""", OLD_MANIFEST + "," + NEW_MANIFEST))
def q_manifest_upsert(spark, sf_dir):
    """An earlier run's manifest updated with a later run's files."""
    old = manifest_records(spark, sf_dir, EARLIER_RUN, max_year=FIRST_YEAR_OF_LATER_RUN)
    new = manifest_records(spark, sf_dir, LATER_RUN, min_year=FIRST_YEAR_OF_LATER_RUN)
    return MF.upsert(old, new)


@register("manifest_summary", O.sql("""
select l.source_year as latest_year, l.source_quarter as latest_quarter,
       cast(l.source_year as varchar) || ' Q' || cast(l.source_quarter as varchar) as latest_quarter_label,
       c.files_processed
from (select source_year, source_quarter from m order by source_year desc, source_quarter desc limit 1) l,
     (select count(*) as files_processed from m) c
""", "m as (" + _manifest_records_sql("", LATER_RUN) + ")"))
def q_manifest_summary(spark, sf_dir):
    """Latest quarter and number of files."""
    return MF.summary(manifest_records(spark, sf_dir))


@register("manifest_quarter", O.sql(
    f"select * from m where {QUARTER_SQL}", "m as (" + _manifest_records_sql("", LATER_RUN) + ")"))
def q_manifest_quarter(spark, sf_dir):
    """Manifest rows of one quarter."""
    return MF.for_quarter(manifest_records(spark, sf_dir), QUARTER)


_CATALOG_SQL = f"""
catalog as (
    select '{ARCHIVE_URL}/metro-trips-' || cast(y as varchar) || '-q' || cast(q as varchar) || '.zip' as url,
           'metro-trips-' || cast(y as varchar) || '-q' || cast(q as varchar) || '.zip' as file_name,
           'metro-trips-' || cast(y as varchar) || '-q' || cast(q as varchar) || '.csv' as csv_file_name,
           y as year, q as quarter
    from (select distinct source_year as y, source_quarter as q from raw_trips)
)"""


def archive_catalog(spark, sf_dir):
    quarters = A.raw_trips(spark, sf_dir).select(
        F.col("source_year").alias("year"), F.col("source_quarter").alias("quarter")).distinct()
    return MF.archive_catalog_from_quarters(quarters, ARCHIVE_URL)


def existing_csvs(spark, sf_dir):
    old = manifest_records(spark, sf_dir, EARLIER_RUN, max_year=FIRST_YEAR_OF_LATER_RUN)
    return old.select(F.col("source_file").alias("csv_file_name"))


@register("new_archives", O.sql(
    "select * from catalog where csv_file_name not in (select source_file from old_manifest)",
    _CATALOG_SQL + "," + OLD_MANIFEST))
def q_new_archives(spark, sf_dir):
    """Archives whose CSV the earlier run does not have."""
    return MF.select_new(archive_catalog(spark, sf_dir), existing_csvs(spark, sf_dir))


@register("archive_counts", O.sql("""
select count(*) as found,
       count(*) filter (where csv_file_name not in (select source_file from old_manifest)) as new,
       count(*) filter (where csv_file_name in (select source_file from old_manifest)) as skipped
from catalog
""", _CATALOG_SQL + "," + OLD_MANIFEST))
def q_archive_counts(spark, sf_dir):
    """Found / new / skipped."""
    return MF.selection_counts(archive_catalog(spark, sf_dir), existing_csvs(spark, sf_dir))


# ------------------------------------------------------- files round trip ---


INGEST_STAMP = _dt.datetime(2026, 6, 14, 0, 30, 52, tzinfo=_dt.timezone.utc)
_LAKE_COLUMNS = S.TRIP_CSV_COLUMNS + S.SOURCE_COLUMNS + S.LAKE_PARTITIONS

F3_SQL = f"""
select {', '.join(_LAKE_COLUMNS[:-2])},
       cast(source_year as integer) as year, cast(source_quarter as integer) as quarter
from trip_source
qualify row_number() over (partition by source_file, trip_id order by {', '.join(FILE_ORDER)}) = 1
"""


def ingest_to_lake(spark, sf_dir):
    """Adapter trips written as quarterly CSVs, then the full trip ingest."""
    raw_dir = scratch_path(spark, "raw-trips")
    lake = scratch_path(spark, "lake-trips")
    manifest = scratch_path(spark, "manifest") + "/trip_ingestion_manifest.json"
    A.write_trip_csvs(spark, sf_dir, raw_dir)
    result = ingest_trips(spark, raw_dir, lake, manifest, INGEST_STAMP)
    return lake, result


@register("dedup_first_in_file", O.sql(F3_SQL))
def q_dedup_first_in_file(spark, sf_dir):
    """F3 (+A1, A2, A3, A5, C1) on CSVs written in a known row order: the
    first row per trip_id in each file, before any filter."""
    from ..sources import trips as TR
    raw_dir = scratch_path(spark, "raw-trips")
    files = A.write_trip_csvs(spark, sf_dir, raw_dir)
    lookup = TR.listed_files(spark, files)
    rows = TR.with_file_index(TR.read_trip_csv(spark, files), lookup)
    first = TR.keep_first_in_file(rows, TR.FILE_INDEX, ["trip_id"])
    return TR.with_source_metadata(TR.with_file_name(first, lookup), INGEST_STAMP).select(*_LAKE_COLUMNS)


@register("clean_trips_filter", O.sql(f"""
select * from ({F3_SQL})
where start_time is not null and end_time is not null and end_time >= start_time and duration > 0
"""))
def q_clean_trips_filter(spark, sf_dir):
    """M1 through the lake: CSV -> F3 -> C2 -> C1 -> B1 (dynamic partition
    overwrite) -> A7 read back."""
    lake, _ = ingest_to_lake(spark, sf_dir)
    return read_trip_lake(spark, lake).select(*_LAKE_COLUMNS)


@register("ingest_manifest", O.sql(f"""
select source_file, source_year, source_quarter, count(*) as cleaned_rows,
       '2026-06-14T00:30:52+00:00' as ingested_at
from ({F3_SQL})
where start_time is not null and end_time is not null and end_time >= start_time and duration > 0
group by source_file, source_year, source_quarter
"""))
def q_ingest_manifest(spark, sf_dir):
    """The manifest written by the ingest, read back."""
    _, result = ingest_to_lake(spark, sf_dir)
    return result.records.select("source_file", "source_year", "source_quarter", "cleaned_rows", "ingested_at")


# -------------------------------------------------------- pages, archives ---


@register("page_links", O.sql("""
select page_id, link_pos, href,
       regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href as url,
       regexp_extract(href, '([^/]*)$', 1) as file_name
from (
    select page_id, url, unnest(hrefs) as href, generate_subscripts(hrefs, 1) as link_pos
    from (select page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) as hrefs from pages)
)
"""))
def q_page_links(spark, sf_dir):
    """A13 link step (I15, I16): every <a href> of every page, resolved
    against the page URL, with the file name of its path."""
    return AR.page_links(A.table(spark, sf_dir, "pages"))


@register("archive_round_trip", O.sql(f"""
select {', '.join(S.TRIP_CSV_COLUMNS)}, source_file from trip_source
"""))
def q_archive_round_trip(spark, sf_dir):
    """A15 (+A1): quarterly CSVs zipped as archives, unpacked in parallel
    (one task per archive) and read back: every source row returns."""
    from ..sources import trips as TR
    csv_dir = scratch_path(spark, "archive-src")
    zip_dir = scratch_path(spark, "archives")
    out_dir = scratch_path(spark, "unpacked")
    zips = A.pack_archives(spark, A.write_trip_csvs(spark, sf_dir, csv_dir), zip_dir)
    unpacked = [r["csv_path"] for r in AR.expand_archives(spark, zips, out_dir).collect()]
    rows = TR.read_trip_csv(spark, sorted(unpacked))
    return rows.select(*S.TRIP_CSV_COLUMNS, F.col("__file_name").alias("source_file"))


# ------------------------------------------------------------- streaming ---

@register("incremental_ingest", ORACLE["clean_trips_filter"])
def q_incremental_ingest(spark, sf_dir):
    """M1 run incrementally: the quarterly CSVs arrive through a file stream
    (micro-batches of 8 files, availableNow) and each batch is ingested; the
    lake ends up as the batch ingest leaves it."""
    from ..streaming import ingest_new_trip_files
    raw_dir = scratch_path(spark, "raw-trips")
    lake = scratch_path(spark, "lake-trips")
    manifest = scratch_path(spark, "manifest") + "/trip_ingestion_manifest.json"
    A.write_trip_csvs(spark, sf_dir, raw_dir)
    query = ingest_new_trip_files(spark, raw_dir, lake, manifest, scratch_path(spark, "stream-ckpt"),
                                  max_files_per_trigger=8, clock=lambda: INGEST_STAMP)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return read_trip_lake(spark, lake).select(*_LAKE_COLUMNS)


@register("overview_display", O.sql(f"""
select format('{{:,}}', total_trips) as trips,
       format('{{:,}}', start_station_count) as start_stations,
       format('{{:,}}', distinct_bikes) as distinct_bikes,
       printf('%.2f min', avg_duration_minutes) as avg_duration,
       strftime(first_trip_date, '%b %-d, %Y') as first_trip,
       strftime(last_trip_date, '%b %-d, %Y') as latest_trip
from ({overview_sql()})
"""))
def q_overview_display(spark, sf_dir):
    """E4 shown as text (I18): '1,234' counts, 'x.xx min', 'Jan 5, 2026'."""
    return D.overview_display(D.overview_metrics(staging(spark, sf_dir)))


# ---------------------------------------------- warehouse and its outputs ---


def built_warehouse(spark, sf_dir) -> Warehouse:
    """The adapter's raw tables written as the lake and station Parquet,
    then the full warehouse build (M3) in the shared folder."""
    lake = scratch_path(spark, "wh-lake")
    stations = scratch_path(spark, "wh-stations")
    write_trip_lake(A.raw_trips(spark, sf_dir), lake)
    write_station_lake(A.raw_stations(spark, sf_dir), stations)
    wh, _ = build_warehouse(spark, lake, stations, scratch_path(spark, "warehouse"))
    return wh


@register("station_ingest", O.sql("select * from station_current"))
def q_station_ingest(spark, sf_dir):
    """M2 (A4-A6, F4, B2): the station list as a CSV with the published
    header, ingested; the first row per station in file order is kept."""
    csv = A.write_station_csv(spark, sf_dir, scratch_path(spark, "stations-csv") + "/stations.csv")
    out = scratch_path(spark, "stations-parquet")
    ingest_stations(spark, csv, out)
    return spark.read.parquet(out)


@register("warehouse_staging", O.sql("select * from stg"))
def q_warehouse_staging(spark, sf_dir):
    """M3 (B3, B4, A7, A8): staging.trips as written by the warehouse build
    (partitioned by quarter) and read back."""
    return built_warehouse(spark, sf_dir).table(S.STAGING_TRIPS)


@register("warehouse_route_mart", O.sql(ROUTE_MART_SQL))
def q_warehouse_route_mart(spark, sf_dir):
    """M3: the route mart as written by the build (from written staging)."""
    return built_warehouse(spark, sf_dir).table(S.RPT_ROUTE_POPULARITY)


@register("csv_export_hourly", O.sql(HOURLY_MART_SQL))
def q_csv_export_hourly(spark, sf_dir):
    """The hourly-demand extract (one headed CSV in mart order) read
    back with the mart's schema."""
    wh = built_warehouse(spark, sf_dir)
    out = scratch_path(spark, "exports")
    export_csv(spark, wh, out)
    schema = wh.table(S.RPT_HOURLY_DEMAND).schema
    return spark.read.schema(schema).option("header", True).csv(out + "/hourly_demand.csv")


@register("serving_trips", O.sql(f"select {', '.join(S.SLIM_COLUMNS)} from stg"))
def q_serving_trips(spark, sf_dir):
    """Staging.trips of the serving copy (17 columns)."""
    wh = built_warehouse(spark, sf_dir)
    return export_serving(spark, wh, scratch_path(spark, "serving")).table(S.STAGING_TRIPS)
