"""Trip- and station-shaped tables derived from the driver's test tables.

The reference ships no data; its inputs are bike-trip CSVs and a station list.
The registered queries run on tables that Spark derives from ``lineitem``,
``orders``, ``supplier``, ``nation`` and ``region`` (see FIXTURES.md §4), so
their work grows with the test data. ``stationflow.testing.oracle`` holds the
same definitions in DuckDB SQL.

``raw_trips`` has the columns of ``raw.trips`` (cleaned CSV rows plus source
metadata and the lake's year/quarter partition columns).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import expressions as X
from ..operators.joins import estimated_size
from ..session import short_lived_shuffles

# Fixed values of the adapter (shared with the DuckDB twin).
INGESTED_AT = "2026-06-14 00:30:52"
GO_LIVE_BASE = "2016-01-01"
# Row order of the adapter's quarterly CSV files.
FILE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_shipdate", "l_linestatus"]
CSV_TIME_FORMAT = "M/d/yyyy H:mm"
# Bytes of lineitem up to which quarter files are written by one plan.
ONE_PLAN_BYTES = 128 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lat(key: Column) -> Column:
    return F.lit(34.0) + (key * 7 % 100).cast("double") / F.lit(1000.0)


def _lon(key: Column) -> Column:
    return F.lit(-118.0) - (key * 3 % 100).cast("double") / F.lit(1000.0)


def trip_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table columns that a trip is derived from, one row per trip."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner").drop("o_orderkey")


def _source_columns() -> dict[str, Column]:
    """Source metadata of a row of ``trip_base``."""
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    year = F.year(ship).cast("bigint")
    quarter = F.quarter(ship).cast("bigint")
    return {"source_file": F.format_string("metro-trips-%d-q%d.csv", year, quarter),
            "source_year": year, "source_quarter": quarter}


def _trip_columns() -> list[Column]:
    """The columns of a trip CSV, of a row of ``trip_base``."""
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    duration = F.col("l_quantity").cast("int") - F.lit(2)
    start = ship + F.make_dt_interval(
        F.lit(0), (F.col("l_partkey") % 24).cast("int"), (F.col("l_suppkey") % 60).cast("int"), F.lit(0)
    )
    end_station = F.when(F.col("l_partkey") % 40 == 13, F.lit(None)).otherwise(F.col("l_partkey") % 100)
    prio = F.col("o_orderpriority")
    return [
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("trip_id"),
        duration.cast("bigint").alias("duration"),
        start.alias("start_time"),
        F.timestamp_add("MINUTE", duration, start).alias("end_time"),
        F.when(F.col("l_suppkey") % 25 == 13, F.lit(None)).otherwise(F.col("l_suppkey")).cast("bigint").alias("start_station"),
        _lat(F.col("l_suppkey")).alias("start_lat"),
        _lon(F.col("l_suppkey")).alias("start_lon"),
        end_station.cast("bigint").alias("end_station"),
        _lat(end_station).alias("end_lat"),
        _lon(end_station).alias("end_lon"),
        F.col("o_custkey").cast("string").alias("bike_id"),
        F.when(prio.startswith("1"), F.lit(1)).when(prio.startswith("2"), F.lit(30))
        .otherwise(F.lit(365)).cast("bigint").alias("plan_duration"),
        F.when(F.col("l_suppkey") == F.col("l_partkey") % 100, F.lit(" Round Trip"))
        .otherwise(F.lit("One Way ")).alias("trip_route_category"),
        F.concat(F.lit(" "), prio, F.lit(" ")).alias("passholder_type"),
        F.when(F.col("l_linestatus") == "F", F.lit("standard")).otherwise(F.lit("electric")).alias("bike_type"),
    ]


def trip_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-CSV-shaped rows before any cleaning, with source metadata."""
    return trip_base(spark, sf_dir).select(
        *_trip_columns(), *[c.alias(name) for name, c in _source_columns().items()],
        F.to_timestamp(F.lit(INGESTED_AT)).alias("ingested_at"))


def ingest_filter(df: DataFrame) -> DataFrame:
    """The ingest filter (C2): times present, end not before start, duration > 0."""
    return df.filter(
        F.col("start_time").isNotNull()
        & F.col("end_time").isNotNull()
        & (F.col("end_time") >= F.col("start_time"))
        & (F.col("duration") > 0)
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.trips`` as the lake would hold it after ingestion."""
    src = ingest_filter(trip_source(spark, sf_dir))
    return src.withColumn("year", F.col("source_year").cast("int")).withColumn(
        "quarter", F.col("source_quarter").cast("int")
    )


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.stations``: suppliers as stations, one in ten missing, with an
    older snapshot row for some stations (dropped by the latest-row dedup)."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == r["r_regionkey"])
    j = j.filter(F.col("s_suppkey") % 10 != 9)
    key = F.col("s_suppkey")
    name = (
        F.when(key == 0, F.lit(X.VIRTUAL_STATION))
        .when(key % 11 == 4, F.concat(F.col("s_name"), F.lit(" (Plaza)")))
        .when(key % 13 == 2, F.concat(F.lit("O'"), F.col("s_name")))
        .otherwise(F.col("s_name"))
    )
    k17 = key % 17
    lat = F.when(k17 == 5, F.lit(None)).when(k17 == 6, F.lit(0.0)).otherwise(
        F.lit(34.0) + key.cast("double") / F.lit(1000.0))
    lon = F.when(k17 == 5, F.lit(None)).when(k17 == 6, F.lit(0.0)).otherwise(
        F.lit(-118.0) - key.cast("double") / F.lit(1000.0))
    go_live = F.to_timestamp_ntz(F.lit(GO_LIVE_BASE)) + F.make_dt_interval(key.cast("int"))
    current = j.select(
        key.cast("bigint").alias("station_id"),
        name.alias("station_name"),
        go_live.alias("go_live_date"),
        F.when(F.col("n_name") == "NATION_9", F.lit(X.FREE_BIKES)).otherwise(F.col("r_name")).alias("region"),
        F.when(F.col("s_acctbal") < 0, F.lit("Inactive")).otherwise(F.lit("Active")).alias("status"),
        lat.cast("double").alias("latitude"),
        lon.cast("double").alias("longitude"),
    )
    older = current.filter(F.col("station_id") % 7 == 3).select(
        "station_id",
        F.concat(F.col("station_name"), F.lit(" (old)")).alias("station_name"),
        (F.col("go_live_date") - F.make_dt_interval(F.lit(400))).alias("go_live_date"),
        "region",
        F.lit("Planned").alias("status"),
        "latitude",
        "longitude",
    )
    return current.unionByName(older)


def _quarter_number() -> Column:
    source = _source_columns()
    return (source["source_year"] * 4 + source["source_quarter"]).cast("int")


def _csv_rows(base: DataFrame, time_forms: dict[int, str] | None) -> DataFrame:
    """Rows of ``trip_base``, of which one task holds a quarter whole, as CSV rows ordered by ``FILE_ORDER``."""
    source = _source_columns()
    rows = (base.withColumn("source_file", source["source_file"])
            .sortWithinPartitions("source_file", *FILE_ORDER)
            .select("source_file", source["source_quarter"].alias("source_quarter"), *_trip_columns()))
    for name in ("start_time", "end_time") if time_forms else ():
        text = F.date_format(name, CSV_TIME_FORMAT)
        for quarter, form in time_forms.items():
            text = F.when(F.col("source_quarter") == quarter, F.date_format(name, form)).otherwise(text)
        rows = rows.withColumn(name, text)
    return rows.select("source_file", *S.TRIP_CSV_COLUMNS)


def trip_csv_rows(spark: SparkSession, sf_dir: str, time_forms: dict[int, str] | None = None) -> DataFrame:
    """The uncleaned trip rows by quarter, in one task each, ordered by ``FILE_ORDER``.

    What is shuffled and sorted are the table columns; the wider trip rows are
    derived from them as they are written. Quarters are dealt by their number,
    so that two do not meet in one task while there are tasks left."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _csv_rows(trip_base(spark, sf_dir).repartitionById(tasks, _quarter_number()), time_forms)


def _write_csv_rows(rows: DataFrame, folder: str) -> None:
    (
        rows.write.mode("overwrite")
        .partitionBy("source_file")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", CSV_TIME_FORMAT)
        .csv(folder)
    )


def _write_dealt_rows(spark: SparkSession, sf_dir: str, folder: str, time_forms: dict[int, str] | None) -> None:
    """``trip_csv_rows`` of tables of any size. The quarters are dealt as sorted
    Parquet, one folder each, which takes less than half the bytes of a shuffle;
    a task then reads a folder whole, and its rows go as soon as they are a CSV."""
    from ..sinks import files
    from . import csvfiles as C

    dealt = f"{folder}/dealt"
    (
        trip_base(spark, sf_dir).withColumn("__quarter", _quarter_number())
        .sortWithinPartitions("__quarter", *FILE_ORDER)
        .write.option("compression", "zstd").partitionBy("__quarter").parquet(dealt)
    )
    quarters = C.list_dirs(spark, f"{dealt}/__quarter=*")

    def write(quarter: str) -> None:
        name = quarter.rsplit("=", 1)[-1]
        _write_csv_rows(_csv_rows(spark.read.parquet(quarter).coalesce(1), time_forms), f"{folder}/csv-{name}")
        files.delete(spark, quarter)

    with ThreadPoolExecutor(max_workers=max(1, min(len(quarters), spark.sparkContext.defaultParallelism))) as pool:
        list(pool.map(write, quarters))


def write_trip_csvs(spark: SparkSession, sf_dir: str, out_dir: str,
                    time_forms: dict[int, str] | None = None,
                    one_plan_bytes: int = ONE_PLAN_BYTES) -> list[str]:
    """Write the uncleaned trip rows as one headed CSV per quarter named
    'metro-trips-YYYY-qN.csv', rows ordered by ``FILE_ORDER``, times as
    'M/d/yyyy H:mm' or in the form that ``time_forms`` gives for the quarter's
    number.

    A quarter file is one file, so each is written by one task (rows are
    streamed, not gathered); the quarters are written in parallel. Up to
    ``one_plan_bytes`` of lineitem they are dealt by a shuffle."""
    from ..sinks import files
    from . import csvfiles as C

    staged = files.staging_for(out_dir)
    with short_lived_shuffles(spark):
        if estimated_size(table(spark, sf_dir, "lineitem")) <= one_plan_bytes:
            _write_csv_rows(trip_csv_rows(spark, sf_dir, time_forms), f"{staged}/csv-all")
        else:
            _write_dealt_rows(spark, sf_dir, staged, time_forms)
    written = []
    for part_dir in C.list_dirs(spark, f"{staged}/csv-*/source_file=*"):
        name = part_dir.rsplit("source_file=", 1)[-1]
        target = f"{out_dir.rstrip('/')}/{name}"
        files.single_part_to_file(spark, part_dir, target)
        written.append(target)
    files.delete(spark, staged)
    return sorted(written)


def pack_archives(spark: SparkSession, csv_paths: list[str], out_dir: str) -> list[str]:
    """Zip each CSV as 'metro-trips-YYYY-qN.zip' holding 'data/<csv name>'
    (one task per file, streamed), as the published archives are shaped."""
    rows = [(p, f"{out_dir.rstrip('/')}/{p.rsplit('/', 1)[-1][:-4]}.zip") for p in csv_paths]

    def pack(batches):
        import shutil
        import zipfile

        import pandas as pd
        import pyarrow.fs as pafs

        for pdf in batches:
            done = []
            for src, dst in zip(pdf["src"], pdf["dst"]):
                sfs, spath = pafs.FileSystem.from_uri(src)
                dfs, dpath = pafs.FileSystem.from_uri(dst)
                dfs.create_dir(dpath.rsplit("/", 1)[0], recursive=True)
                with dfs.open_output_stream(dpath) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
                    zf.writestr("data/readme.txt", "trip data")
                    with sfs.open_input_stream(spath) as f, zf.open("data/" + src.rsplit("/", 1)[-1], "w") as m:
                        shutil.copyfileobj(f, m, 1 << 20)
                done.append(dst)
            yield pd.DataFrame({"path": done})

    df = spark.createDataFrame(rows, "src string, dst string").repartition(max(1, len(rows)))
    return sorted(r["path"] for r in df.mapInPandas(pack, "path string").collect())


STATION_CSV_HEADER = ["Kiosk ID", "Kiosk Name", "Go Live Date", "Region ", "Status", "Latitude", "Longitude"]


def write_station_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write ``raw_stations`` as a station-list CSV with the published header
    ('Region ' with its blank), each station's current row before its older
    snapshot, dates as 'M/d/yyyy'."""
    from ..sinks import files

    rows = raw_stations(spark, sf_dir).withColumn(
        "_older", (F.col("station_name").endswith(" (old)")).cast("int"))
    staged = files.staging_for(path)
    (
        rows.orderBy("station_id", "_older").drop("_older")
        .select([F.col(c).alias(h) for c, h in zip(S.STATION_COLUMNS, STATION_CSV_HEADER)])
        .coalesce(1).write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", "M/d/yyyy")
        .csv(staged)
    )
    files.single_part_to_file(spark, staged, path)
    return path
