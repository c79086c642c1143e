"""Registered queries over whole runs and their outputs: ingest variants, full runs, extracts, serving copy, row order.

A run is made once per session and table folder and shared by the queries that read its outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import expressions as X
from ..operators import demand as D
from ..operators import manifest as MF
from ..operators import models as M
from ..operators import options as OP
from ..operators import quality as Q
from ..operators import stations as ST
from ..plans.ingest import ingest_trips
from ..plans import refresh
from ..plans.pipeline import PipelineConfig, data_health, overview, run_pipeline
from ..plans.warehouse import build_warehouse
from ..session import scratch_path
from ..sinks.exports import export_csv, export_serving
from ..sinks.lake import write_station_lake, write_trip_lake
from ..sinks.tables import Warehouse
from ..sources import adapter as A
from ..sources import archives as AR
from ..sources.lake import read_trip_lake
from ..sources.local import rows_frame
from ..sources.manifest import read_manifest
from . import oracle as O
from . import registered as R

_RUNS: dict[tuple, object] = {}


def once(label: str, make):
    """``make(spark, sf_dir)``, run once per session and table folder."""
    def get(spark: SparkSession, sf_dir: str):
        key = (label, spark.sparkContext.applicationId, sf_dir)
        if key not in _RUNS:
            _RUNS[key] = make(spark, sf_dir)
        return _RUNS[key]
    return get


def positioned(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` with ``position``, each row's place in the frame's order (from 1).

    The rows are written in their order with a place per partition; only the
    rows per partition are summed in one window."""
    path = scratch_path(spark, "ordered")
    df.withColumn("_m", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_p", F.shiftright("_m", 33))
    sizes = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_p", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(starts, "_p").withColumn("position", place.cast("bigint")).drop("_m", "_p", "_before")


# ---------------------------------------------------------------- ingest ---

TIME_FORMS = {1: "M/d/yyyy h:mm a", 2: "yyyy-MM-dd'T'HH:mm:ss.SSS", 3: "yyyy-MM-dd HH:mm:ss'+00:00'"}


@R.register("ingest_time_forms", R.ORACLE["clean_trips_filter"])
def q_ingest_time_forms(spark, sf_dir):
    """Quarters written with AM/PM, ISO fractions and UTC offsets."""
    raw_dir, lake = scratch_path(spark, "raw-trips"), scratch_path(spark, "lake-trips")
    A.write_trip_csvs(spark, sf_dir, raw_dir, TIME_FORMS)
    ingest_trips(spark, raw_dir, lake, scratch_path(spark, "manifest") + "/m.json", R.INGEST_STAMP)
    return read_trip_lake(spark, lake).select(*R._LAKE_COLUMNS)


REPUBLISHED = (1996, 3)
_REPUBLISHED_SQL = f"(source_year = {REPUBLISHED[0]} and source_quarter = {REPUBLISHED[1]} and trip_id % 3 <> 0)"


@R.register("staging_refresh", O.sql(
    f"select {O.projection(S.STAGING_TYPES)} from ("
    + O.survivors("published", M.STAGING_DEDUP_KEY, O._order(M.staging_dedup_order_columns())) + ")",
    f"published as (select * from raw_trips where not {_REPUBLISHED_SQL})"))
def q_staging_refresh(spark, sf_dir):
    """M3, F1: staging after one quarter was published again with a third of its trips, merged into the kept rows."""
    lake = scratch_path(spark, "lake-trips")
    raw = A.raw_trips(spark, sf_dir)
    write_trip_lake(raw, lake)
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    refresh.refresh_staging(wh, lake, bucket_bytes=1 << 20)
    again = raw.where(f"source_year = {REPUBLISHED[0]} and source_quarter = {REPUBLISHED[1]} and not {_REPUBLISHED_SQL}")
    write_trip_lake(again, lake)
    refresh.refresh_staging(wh, lake, [REPUBLISHED])
    return wh.table(S.STAGING_TRIPS)


@R.register("missing_inputs", O.sql("""
select 'stations' as input, 'FileNotFoundError' as when_missing, (select count(*) from raw_stations) as rows_when_there
union all select 'trip files', 'FileNotFoundError', (select count(distinct (source_year, source_quarter)) from trip_source)
union all select 'trip lake', 'FileNotFoundError', (select count(*) from raw_trips)
union all select 'warehouse table', 'FileNotFoundError', (select count(*) from dim)
"""))
def q_missing_inputs(spark, sf_dir):
    """Every input raises where it is missing and is read where it is there."""
    from ..sources.lake import read_station_lake
    from ..sources.trips import list_trip_files
    root = scratch_path(spark, "inputs")
    write_trip_lake(A.raw_trips(spark, sf_dir), f"{root}/lake")
    write_station_lake(A.raw_stations(spark, sf_dir), f"{root}/stations")
    A.write_trip_csvs(spark, sf_dir, f"{root}/raw")
    Warehouse(spark, f"{root}/warehouse").save(R.dim(spark, sf_dir), S.DIM_STATIONS)
    reads = {
        "trip lake": lambda at: read_trip_lake(spark, f"{at}/lake").count(),
        "stations": lambda at: read_station_lake(spark, f"{at}/stations").count(),
        "trip files": lambda at: len(list_trip_files(spark, f"{at}/raw")),
        "warehouse table": lambda at: Warehouse(spark, f"{at}/warehouse").table(S.DIM_STATIONS).count(),
    }

    def error(read):
        try:
            read(f"{root}/nowhere")
        except Exception as missing:
            return type(missing).__name__
        return "none"

    return rows_frame(spark, [(name, error(read), read(root)) for name, read in reads.items()],
                      "input string, when_missing string, rows_when_there bigint")


CATALOG_TABLES = {S.STAGING_TRIPS: "stg_trips", S.DIM_STATIONS: "dim_stations", S.RPT_HOURLY_DEMAND: "rpt_hourly_demand",
                  S.RPT_STATION_ACTIVITY: "rpt_station_activity", S.RPT_ROUTE_POPULARITY: "rpt_route_popularity"}


@R.register("warehouse_catalog", " union all ".join(
    f"select '{name.split('.')[0]}' as schema_name, '{name.split('.')[1]}' as table_name, count(*) as row_count "
    f"from ({R.ORACLE[query]})" for name, query in CATALOG_TABLES.items()))
def q_warehouse_catalog(spark, sf_dir):
    """The schemas are created and every table is read through the catalog."""
    root = scratch_path(spark, "catalog")
    write_trip_lake(A.raw_trips(spark, sf_dir), f"{root}/lake")
    write_station_lake(A.raw_stations(spark, sf_dir), f"{root}/stations")
    build_warehouse(spark, f"{root}/lake", f"{root}/stations", f"{root}/warehouse", catalog=True)
    schemas = {row[0] for row in spark.sql("SHOW DATABASES").collect()}
    rows = [(schema, table, spark.table(f"{schema}.{table}").count())
            for schema, table in (name.split(".") for name in CATALOG_TABLES) if schema in schemas]
    return rows_frame(spark, rows, "schema_name string, table_name string, row_count bigint")


EMPTY_FILE = "metro-trips-2050-q1.csv"


@R.register("ingest_empty_quarter", f"""
select source_file, source_year, source_quarter, cleaned_rows from ({R.ORACLE["ingest_manifest"]})
union all select '{EMPTY_FILE}', 2050, 1, 0
""")
def q_ingest_empty_quarter(spark, sf_dir):
    """A file of which no row is valid gets a manifest record with 0 rows."""
    from ..sinks import files
    raw_dir = scratch_path(spark, "raw-trips")
    A.write_trip_csvs(spark, sf_dir, raw_dir)
    staged = scratch_path(spark, "empty-quarter")
    (A.trip_source(spark, sf_dir).where(R.QUARTER_SQL).withColumn("duration", F.lit(0))
     .select(*S.TRIP_CSV_COLUMNS).repartition(1).write.option("header", True)
     .option("timestampNTZFormat", A.CSV_TIME_FORMAT).csv(staged))
    files.single_part_to_file(spark, staged, f"{raw_dir}/{EMPTY_FILE}")
    result = ingest_trips(spark, raw_dir, scratch_path(spark, "lake-trips"),
                          scratch_path(spark, "manifest") + "/m.json", R.INGEST_STAMP)
    return result.records.select("source_file", "source_year", "source_quarter", "cleaned_rows")


# -------------------------------------------------------------- archives ---

_FIRST_YEAR, _YEARS = 2016, 9


def archive_pages(spark, sf_dir):
    """The pages with one archive link each, derived from the page id, behind a link in a comment and a data-href."""
    page = F.col("page_id")
    name = F.concat(F.lit("metro-trips-"), (F.lit(_FIRST_YEAR) + page % _YEARS).cast("string"),
                    F.when(page % 2 == 0, "-q").otherwise("-"), (page % 4 + 1).cast("string"),
                    F.when(page % 5 == 0, "-final").otherwise(""), F.lit(".zip"))
    head = F.concat(F.lit('<!-- <a href="/old/metro-trips-1999-q1.zip">old</a> --><a data-href="/none.zip" href="/files/'),
                    name, F.lit('?a=1&amp;b=2">data</a>'))
    return A.table(spark, sf_dir, "pages").withColumn("html", F.concat(head, F.coalesce("html", F.lit(""))))


_FOUND_SQL = f"""
select regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || '/files/' || name || '?a=1&b=2' as url,
       name as file_name, 'metro-trips-' || y || '-q' || q || '.csv' as csv_file_name, y as year, q as quarter
from (select *, 'metro-trips-' || y || case when page_id % 2 = 0 then '-q' else '-' end || q
                || case when page_id % 5 = 0 then '-final' else '' end || '.zip' as name
      from (select page_id, url, {_FIRST_YEAR} + page_id % {_YEARS} as y, page_id % 4 + 1 as q from pages))
qualify row_number() over (partition by y, q order by page_id) = 1
"""


@R.register("archive_discovery", f"""
select *, row_number() over (order by year, quarter) as position from ({_FOUND_SQL})
""")
def q_archive_discovery(spark, sf_dir):
    """The first archive link per quarter, in order."""
    found = AR.discover_archives(archive_pages(spark, sf_dir))
    return positioned(spark, AR.require_archives(found))


@R.register("archive_no_links", """
select 'the pages hold no link to a trip archive' as problem, count(*) as pages from pages
""")
def q_archive_no_links(spark, sf_dir):
    """The error over the pages as they are, which link to no archive."""
    pages, problem = A.table(spark, sf_dir, "pages"), None
    try:
        AR.require_archives(AR.discover_archives(pages))
    except ValueError as e:
        problem = str(e)
    return pages.agg(F.count(F.lit(1)).alias("pages")).withColumn("problem", F.lit(problem))


# ------------------------------------------------- extracts, serving copy ---

_AROUND = (" ", ' "a, b" \\ ')


def _quoted_warehouse(spark, sf_dir) -> tuple[Warehouse, str]:
    """A warehouse whose station names hold quotes, commas, backslashes and outer blanks, and its extracts."""
    lake, stations = scratch_path(spark, "wh-lake"), scratch_path(spark, "wh-stations")
    write_trip_lake(A.raw_trips(spark, sf_dir), lake)
    names = F.concat(F.lit(_AROUND[0]), "station_name", F.lit(_AROUND[1]))
    write_station_lake(A.raw_stations(spark, sf_dir).withColumn("station_name", names), stations)
    wh, _ = build_warehouse(spark, lake, stations, scratch_path(spark, "warehouse"))
    out = scratch_path(spark, "exports")
    export_csv(spark, wh, out)
    return wh, out


quoted_warehouse = once("quoted", _quoted_warehouse)


def extract(spark, sf_dir, name: str, table: str) -> DataFrame:
    wh, out = quoted_warehouse(spark, sf_dir)
    return (spark.read.schema(wh.table(table).schema).option("header", True).option("escape", '"')
            .csv(f"{out}/{name}.csv"))


def _named(column: str, unknown: str) -> str:
    return (f"case when {column} = '{unknown}' then {column} "
            f"else '{_AROUND[0]}' || {column} || '{_AROUND[1]}' end as {column}")


_QUOTED_ACTIVITY = f"select * replace ({_named('station_name', 'Unknown Station')}) from ({R.STATION_MART_SQL})"
_QUOTED_ROUTES = f"""select * replace ({_named('start_station_name', 'Unknown Start Station')},
       {_named('end_station_name', 'Unknown End Station')}) from ({R.ROUTE_MART_SQL})"""


@R.register("csv_export_station_activity", O.sql(_QUOTED_ACTIVITY))
def q_csv_export_station_activity(spark, sf_dir):
    """The station-activity extract, names with quotes, commas, backslashes and blanks."""
    return extract(spark, sf_dir, "station_activity", S.RPT_STATION_ACTIVITY)


@R.register("csv_export_routes", O.sql(_QUOTED_ROUTES))
def q_csv_export_routes(spark, sf_dir):
    """The route extract."""
    return extract(spark, sf_dir, "route_popularity", S.RPT_ROUTE_POPULARITY)


@R.register("csv_export_stations", O.sql(f"select * replace ({_named('station_name', '')}) from dim"))
def q_csv_export_stations(spark, sf_dir):
    """The station extract."""
    return extract(spark, sf_dir, "stations", S.DIM_STATIONS)


@R.register("mart_order", O.sql("""
select 'activity' as mart, source_year, source_quarter, cast(trip_starts as bigint) as sort_value,
       row_number() over (order by source_year nulls last, source_quarter nulls last, trip_starts desc nulls last) as position
from station_mart
union all
select 'routes', source_year, source_quarter, cast(trip_count as bigint),
       row_number() over (order by source_year nulls last, source_quarter nulls last, trip_count desc nulls last)
from route_mart
union all
select 'hourly', source_year, source_quarter, cast(start_hour as bigint),
       row_number() over (order by source_year nulls last, source_quarter nulls last, trip_date nulls last, start_hour nulls last)
from hourly_mart
""", R.MART_CTES))
def q_mart_order(spark, sf_dir):
    """G1: the sort values of the three marts by their place in the mart's order."""
    wh, _ = quoted_warehouse(spark, sf_dir)
    parts = []
    for mart, table, value in [("activity", S.RPT_STATION_ACTIVITY, "trip_starts"),
                               ("routes", S.RPT_ROUTE_POPULARITY, "trip_count"),
                               ("hourly", S.RPT_HOURLY_DEMAND, "start_hour")]:
        ordered = M.mart_order(wh.table(table), table).select(
            F.lit(mart).alias("mart"), "source_year", "source_quarter", F.col(value).cast("bigint").alias("sort_value"))
        parts.append(positioned(spark, ordered))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _serving(spark, sf_dir) -> Warehouse:
    wh, _ = quoted_warehouse(spark, sf_dir)
    root = scratch_path(spark, "serving")
    export_serving(spark, wh, root)
    return Warehouse.open(spark, root, wh.root)


serving = once("serving", _serving)


@R.register("serving_stations", O.sql(f"select * replace ({_named('station_name', '')}) from dim"))
def q_serving_stations(spark, sf_dir):
    """The dimension of the serving copy, which is opened before the warehouse."""
    return serving(spark, sf_dir).table(S.DIM_STATIONS)


@R.register("serving_hourly", O.sql(R.HOURLY_MART_SQL))
def q_serving_hourly(spark, sf_dir):
    """The hourly mart of the serving copy."""
    return serving(spark, sf_dir).table(S.RPT_HOURLY_DEMAND)


@R.register("serving_station_activity", O.sql(_QUOTED_ACTIVITY))
def q_serving_station_activity(spark, sf_dir):
    """The activity mart of the serving copy."""
    return serving(spark, sf_dir).table(S.RPT_STATION_ACTIVITY)


@R.register("serving_routes", O.sql(_QUOTED_ROUTES))
def q_serving_routes(spark, sf_dir):
    """The route mart of the serving copy."""
    return serving(spark, sf_dir).table(S.RPT_ROUTE_POPULARITY)


# -------------------------------------------------------------- full run ---


def _full_run(spark, sf_dir):
    root = scratch_path(spark, "full-run")
    A.write_trip_csvs(spark, sf_dir, f"{root}/raw")
    cfg = PipelineConfig(
        raw_dir=f"{root}/raw", stations_csv=A.write_station_csv(spark, sf_dir, f"{root}/stations.csv"),
        lake_trips=f"{root}/lake", lake_stations=f"{root}/stations.parquet", manifest=f"{root}/manifest.json",
        warehouse=f"{root}/warehouse", serving=f"{root}/serving", serving_manifest=f"{root}/serving-manifest.json")
    return cfg, run_pipeline(spark, cfg, R.INGEST_STAMP)


full_run = once("full-run", _full_run)

_VALID = "start_time is not null and end_time is not null and end_time >= start_time and duration > 0"
_CLEANED = f"cleaned as (select * from ({R.F3_SQL}) where {_VALID})"


@R.register("full_run_counts", O.sql("""
select 'raw.trips' as table_name, count(*) as row_count from cleaned
union all select 'staging.trips', count(distinct trip_id) from cleaned
union all select 'raw.stations', count(*) from station_current
union all select 'marts.dim_stations', count(*) from station_current
""", _CLEANED))
def q_full_run_counts(spark, sf_dir):
    """M5: the counts that a full run reports for the ingested and staged tables."""
    _, result = full_run(spark, sf_dir)
    counts = rows_frame(spark, [tuple(r) for r in result.counts], "table_name string, row_count bigint")
    return counts.where(F.col("table_name").isin(S.RAW_TRIPS, S.STAGING_TRIPS, S.RAW_STATIONS, S.DIM_STATIONS))


_RUN_MANIFEST = "select source_file, source_year, source_quarter, count(*) as cleaned_rows from cleaned group by all"


@R.register("serving_manifest", O.sql(_RUN_MANIFEST, _CLEANED))
def q_serving_manifest(spark, sf_dir):
    """The manifest copied beside the serving copy, read back."""
    cfg, _ = full_run(spark, sf_dir)
    return read_manifest(spark, cfg.serving_manifest).select(
        "source_file", "source_year", "source_quarter", "cleaned_rows")


@R.register("data_health", O.sql(f"""
select m.*, (select count(distinct trip_id) from cleaned) as staged_trips
from ({_RUN_MANIFEST}) m where {R.QUARTER_SQL}
""", _CLEANED))
def q_data_health(spark, sf_dir):
    """M6: the manifest rows of one quarter beside the count of staged trips."""
    cfg, _ = full_run(spark, sf_dir)
    counts, rows, _ = data_health(spark, Warehouse(spark, cfg.warehouse), cfg.manifest, R.QUARTER)
    staged = counts.where(F.col("table_name") == S.STAGING_TRIPS).first()["row_count"]
    return rows.select("source_file", "source_year", "source_quarter", "cleaned_rows",
                       F.lit(staged).cast("bigint").alias("staged_trips"))


@R.register("overview_view", O.sql("""
select l.source_year as latest_year, l.source_quarter as latest_quarter,
       l.source_year || ' Q' || l.source_quarter as latest_quarter_label,
       (select count(distinct source_file) from cleaned) as files_processed, true as has_stamp,
       (select count(distinct trip_id) from cleaned) as total_trips
from (select source_year, source_quarter from cleaned order by source_year desc, source_quarter desc limit 1) l
""", _CLEANED))
def q_overview_view(spark, sf_dir):
    """M7: the manifest summary with its stamp and the trips of the headline figures."""
    cfg, _ = full_run(spark, sf_dir)
    metrics, summary, _ = overview(spark, Warehouse(spark, cfg.warehouse), cfg.manifest)
    return summary.select("latest_year", "latest_quarter", "latest_quarter_label", "files_processed",
                          F.col("updated_at").isNotNull().alias("has_stamp"),
                          F.lit(metrics.first()["total_trips"]).cast("bigint").alias("total_trips"))


# ---------------------------------------------------- failing checks, order ---


@R.register("dq_failures", O.sql(f"""
select '{Q.HAS_ROWS}' as check_name, 'raw.stations' as table_name, cast(0 as bigint) as observed, false as passed
union all
select '{Q.ONE_ROW_PER_TRIP}', 'staging.trips', count(*), count(*) = 0
from (select trip_id from raw_trips group by trip_id having count(*) > 1)
union all
select '{Q.HOURLY_KEYS}', 'marts.rpt_hourly_demand', count(*), count(*) = 0 from hourly_mart where start_hour = 8
""", R.MART_CTES))
def q_dq_failures(spark, sf_dir):
    """L1, L3, L5 on tables that break them: no stations, repeated trips, hours set to null."""
    hourly = M.build_hourly_demand(R.staging(spark, sf_dir))
    broken = hourly.withColumn("start_hour", F.when(F.col("start_hour") != 8, F.col("start_hour")))
    return (Q.nonempty(S.RAW_STATIONS, A.raw_stations(spark, sf_dir).where("station_id is null"))
            .unionByName(Q.duplicate_trip_check(A.raw_trips(spark, sf_dir)))
            .unionByName(Q.hourly_grain_check(broken)))


@R.register("dq_raise", O.sql(f"""
select 'staging.trips: {Q.ONE_ROW_PER_TRIP}: not met (' || format('{{:,}}', count(*)) || ' counted)' as problem
from (select trip_id from raw_trips group by trip_id having count(*) > 1)
"""))
def q_dq_raise(spark, sf_dir):
    """L2: the error that a failed check raises, with its number."""
    problem = None
    try:
        Q.assert_checks(Q.duplicate_trip_check(A.raw_trips(spark, sf_dir)))
    except Q.CheckFailed as e:
        problem = str(e)
    return rows_frame(spark, [(problem,)], "problem string")


@R.register("demand_option_lists", O.sql("""
select filter_name, string_agg(filter_value, '|' order by filter_value) as filter_values from options group by filter_name
""", "options as (" + R.FILTER_OPTIONS_SQL + ")"))
def q_demand_option_lists(spark, sf_dir):
    """One sorted list per filter, shown joined by '|'."""
    lists = OP.filter_option_lists(OP.demand_filter_options(R.staging(spark, sf_dir), R.dim(spark, sf_dir)))
    return lists.select("filter_name", F.array_join("filter_values", "|").alias("filter_values"))


@R.register("option_order", O.sql("""
select *, row_number() over (order by filter_name, filter_value) as position from options
""", "options as (" + R.FILTER_OPTIONS_SQL + ")"))
def q_option_order(spark, sf_dir):
    """The filter options by their place in the list."""
    return positioned(spark, OP.demand_filter_options(R.staging(spark, sf_dir), R.dim(spark, sf_dir)))


@R.register("bar_order", O.sql("""
select trip_starts, row_number() over (order by trip_starts) as position
from (select trip_starts from ranking order by trip_starts desc limit 20)
""", R.RANKING_ALL))
def q_bar_order(spark, sf_dir):
    """The top 20 stations' starts by their place in the bar chart, smallest first."""
    top = ST.top_stations(R.ranking(spark, sf_dir, X.ALL_QUARTERS))
    return positioned(spark, ST.bar_order(top, "trip_starts").select("trip_starts"))


@R.register("manifest_order", O.sql("""
select source_file, row_number() over (order by source_year, source_quarter, source_file) as position
from (select * from old_manifest where source_file not in (select source_file from new_manifest)
      union all select * from new_manifest)
""", R.OLD_MANIFEST + "," + R.NEW_MANIFEST))
def q_manifest_order(spark, sf_dir):
    """The files of an updated manifest by their place in it."""
    old = R.manifest_records(spark, sf_dir, R.EARLIER_RUN, max_year=R.FIRST_YEAR_OF_LATER_RUN)
    new = R.manifest_records(spark, sf_dir, R.LATER_RUN, min_year=R.FIRST_YEAR_OF_LATER_RUN)
    return positioned(spark, MF.upsert(old, new).select("source_file"))


REGIONS = {"AMERICA": "DTLA", "ASIA": "Westside", "EUROPE": "North Hollywood", "AFRICA": "Pasadena"}
_REGION_CASE = "case region " + " ".join(f"when '{a}' then '{b}'" for a, b in REGIONS.items()) + " else region end"


@R.register("station_map_colors", O.sql(f"""
select station_id, region,
       case region when 'DTLA' then '#0057B8' when 'Westside' then '#E4572E'
                   when 'North Hollywood' then '#2CA02C' when 'Pasadena' then '#8E44AD' end as region_color
from (select * replace ({_REGION_CASE} as region) from ranking)
where region not in ('Free Bikes', 'Unknown Region') and station_lat != 0 and station_lon != 0
""", R.RANKING_ALL))
def q_station_map_colors(spark, sf_dir):
    """The colours of the map, with regions named as in the lookup."""
    ranked = R.ranking(spark, sf_dir, X.ALL_QUARTERS).withColumn("region", F.expr(_REGION_CASE))
    return ST.station_map(ranked).select("station_id", "region", "region_color")


@R.register("stations_quoted_region", O.sql("""
select station_id, trip_starts from ranking where region = 'AMERICA' order by trip_starts desc, station_id limit 5
""", R.RANKING_ALL))
def q_stations_quoted_region(spark, sf_dir):
    """A filter value that holds a quote."""
    named = R.ranking(spark, sf_dir, X.ALL_QUARTERS).withColumn("region", F.concat(F.lit("O'"), "region"))
    return ST.top_stations(named, 5, "O'AMERICA").select("station_id", "trip_starts")


@R.register("demand_has_rows", O.sql("""
select (select count(*) from stg join dim on dim.station_id = stg.start_station_id where region = 'Nowhere') > 0 as nowhere,
       (select count(*) from stg join dim on dim.station_id = stg.start_station_id where region = 'AMERICA') > 0 as america
"""))
def q_demand_has_rows(spark, sf_dir):
    """Whether the filtered demand has rows, for a region without trips and one with trips."""
    stg, dim = R.staging(spark, sf_dir), R.dim(spark, sf_dir)
    found = [D.has_rows(D.historical_demand(stg, dim, D.DemandFilters(region=r))) for r in ("Nowhere", "AMERICA")]
    return rows_frame(spark, [tuple(found)], "nowhere boolean, america boolean")
