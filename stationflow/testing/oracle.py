"""DuckDB SQL twins of the adapter tables and the models, for the oracle check.

The driver registers the test tables as views; every oracle statement starts
with ``BASE_CTES`` (adapter + staging + dimension) and selects from them.
Orders and tie-breaks are generated from the same Python lists as the Spark
code so both engines keep the same duplicate rows.
"""

from __future__ import annotations

from ..operators.models import STAGING_DEDUP_KEY, staging_dedup_order_columns
from ..sources.adapter import GO_LIVE_BASE, INGESTED_AT
from .. import schemas as S


def _order(cols, first_desc: bool = False) -> str:
    parts = []
    for i, c in enumerate(cols):
        direction = "desc" if (first_desc and i == 0) else "asc"
        parts.append(f"{c} {direction} nulls last")
    return ", ".join(parts)


def _lat(k: str) -> str:
    return f"(34.0::double + cast(({k} * 7) % 100 as double) / 1000.0::double)"


def _lon(k: str) -> str:
    return f"(-118.0::double - cast(({k} * 3) % 100 as double) / 1000.0::double)"


TRIP_SOURCE_SQL = f"""
trip_base as (
    select
        l.*, o.o_custkey, o.o_orderpriority,
        cast(cast(l.l_quantity as integer) - 2 as bigint) as duration,
        cast(l.l_shipdate as timestamp)
            + to_hours(cast(l.l_partkey % 24 as bigint))
            + to_minutes(cast(l.l_suppkey % 60 as bigint)) as start_time,
        case when l.l_partkey % 40 = 13 then null else l.l_partkey % 100 end as end_station
    from lineitem l
    join orders o on l.l_orderkey = o.o_orderkey
),
trip_source as (
    select
        cast(l_orderkey * 10 + l_linenumber as bigint) as trip_id,
        duration,
        start_time,
        start_time + to_minutes(duration) as end_time,
        cast(case when l_suppkey % 25 = 13 then null else l_suppkey end as bigint) as start_station,
        {_lat('l_suppkey')} as start_lat,
        {_lon('l_suppkey')} as start_lon,
        cast(end_station as bigint) as end_station,
        {_lat('end_station')} as end_lat,
        {_lon('end_station')} as end_lon,
        cast(o_custkey as varchar) as bike_id,
        cast(case when starts_with(o_orderpriority, '1') then 1
                  when starts_with(o_orderpriority, '2') then 30
                  else 365 end as bigint) as plan_duration,
        case when l_suppkey = l_partkey % 100 then ' Round Trip' else 'One Way ' end as trip_route_category,
        ' ' || o_orderpriority || ' ' as passholder_type,
        case when l_linestatus = 'F' then 'standard' else 'electric' end as bike_type,
        'metro-trips-' || cast(year(l_shipdate) as varchar) || '-q' || cast(quarter(l_shipdate) as varchar) || '.csv' as source_file,
        cast(year(l_shipdate) as bigint) as source_year,
        cast(quarter(l_shipdate) as bigint) as source_quarter,
        timestamp '{INGESTED_AT}' as ingested_at,
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
        l_shipdate, l_linestatus
    from trip_base
),
raw_trips as (
    select * exclude (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                      l_shipdate, l_linestatus),
        cast(source_year as integer) as year,
        cast(source_quarter as integer) as quarter
    from trip_source
    where start_time is not null
      and end_time is not null
      and end_time >= start_time
      and duration > 0
)"""

# What a staged or dimension column is made of, where that is not the raw column of the same name.
_MADE_FROM = {
    "duration_minutes": "duration", "start_station_id": "start_station", "end_station_id": "end_station",
    "plan_duration_days": "plan_duration", "trip_date": "start_time", "start_hour": "start_time", "day_of_week": "start_time",
}
_MADE_BY = {
    "start_hour": "date_part('hour', {0})", "day_of_week": "date_part('dow', {0})",
    "trip_route_category": "trim({0})", "passholder_type": "trim({0})", "bike_type": "trim({0})",
}
_DUCKDB_TYPES = {"string": "VARCHAR", "integer": "INTEGER", "long": "BIGINT", "double": "DOUBLE", "date": "DATE",
                 "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def survivors(table: str, key: str, order: str) -> str:
    """One whole row ``r`` per key of a table: the first one in the order."""
    return f"SELECT first(t ORDER BY {order}) AS r FROM {table} t GROUP BY {key}"


def projection(types: dict) -> str:
    """The columns of a model, from its types in ``schemas`` and what they are made of, over rows ``r``."""
    return ", ".join(
        f"CAST({_MADE_BY.get(name, '{0}').format('r.' + _MADE_FROM.get(name, name))} "
        f"AS {_DUCKDB_TYPES[dtype.typeName()]}) AS {name}" for name, dtype in types.items())


# The raw rows of the adapter are all valid (FIXTURES.md section 4), so staging chooses among them only.
STAGING_SQL = f"""
stg as (
    SELECT {projection(S.STAGING_TYPES)}
    FROM ({survivors("raw_trips", STAGING_DEDUP_KEY, _order(staging_dedup_order_columns()))})
)"""

_STATION_REST = [c for c in S.STATION_COLUMNS if c not in ("station_id", "go_live_date")]

STATIONS_SQL = f"""
station_current as (
    select
        cast(s.s_suppkey as bigint) as station_id,
        case when s.s_suppkey = 0 then 'Virtual Station'
             when s.s_suppkey % 11 = 4 then s.s_name || ' (Plaza)'
             when s.s_suppkey % 13 = 2 then 'O''' || s.s_name
             else s.s_name end as station_name,
        timestamp '{GO_LIVE_BASE}' + to_days(cast(s.s_suppkey as integer)) as go_live_date,
        case when n.n_name = 'NATION_9' then 'Free Bikes' else r.r_name end as region,
        case when s.s_acctbal < 0 then 'Inactive' else 'Active' end as status,
        cast(case when s.s_suppkey % 17 = 5 then null when s.s_suppkey % 17 = 6 then 0.0
             else 34.0::double + cast(s.s_suppkey as double) / 1000.0::double end as double) as latitude,
        cast(case when s.s_suppkey % 17 = 5 then null when s.s_suppkey % 17 = 6 then 0.0
             else -118.0::double - cast(s.s_suppkey as double) / 1000.0::double end as double) as longitude
    from supplier s
    join nation n on s.s_nationkey = n.n_nationkey
    join region r on n.n_regionkey = r.r_regionkey
    where s.s_suppkey % 10 <> 9
),
raw_stations as (
    select * from station_current
    union all
    select station_id, station_name || ' (old)', go_live_date - to_days(400), region, 'Planned', latitude, longitude
    from station_current
    where station_id % 7 = 3
),
dim as (
    SELECT {projection(S.DIM_STATION_TYPES)}
    FROM ({survivors("raw_stations", "station_id", _order(["go_live_date", *_STATION_REST], first_desc=True))})
)"""

BASE_CTES = "with " + ",".join([TRIP_SOURCE_SQL, STAGING_SQL, STATIONS_SQL])


def sql(body: str, extra_ctes: str = "") -> str:
    """A full oracle statement: the base CTEs, optional more, then ``body``."""
    ctes = BASE_CTES + ("," + extra_ctes if extra_ctes else "")
    return f"{ctes}\n{body}"

