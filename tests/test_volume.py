"""What the ingest and the warehouse build move: whole rows are shuffled once, and as narrow as they come."""

import datetime as dt
import os

from helpers import TRIP_HEADER, raw_trips, trip
from pyspark.sql import functions as F
from test_ingest import row
from test_skew import _children

from stationflow import schemas as S
from stationflow.operators import models as M
from stationflow.plans.ingest import ingest_trips
from stationflow.sinks.lake import write_trip_lake
from stationflow.sinks.tables import Warehouse
from stationflow.sources import adapter as A
from stationflow.sources import trips as TR


def shuffled_columns(df) -> list[list[str]]:
    """The columns of each shuffle exchange of a plan."""
    found, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.nodeName() == "Exchange":
            out = node.output()
            found.append([out.apply(i).name() for i in range(out.size())])
        stack.extend(_children(node))
    return found


def data_files(folder: str) -> list[str]:
    root = folder.replace("file://", "")
    return [f for _, _, names in os.walk(root) for f in names if f.endswith(".parquet")]


def trips_in_two_tasks(spark):
    """Four trips of one quarter, held by two tasks."""
    return raw_trips(spark, [trip(i) for i in range(4)]).coalesce(1).withColumn(
        "task", F.col("trip_id").cast("int") % 2).repartitionById(2, "task").drop("task")


def test_the_lake_is_written_from_the_tasks_that_hold_the_rows(spark, folder):
    rows = trips_in_two_tasks(spark).withColumn("year", F.lit(2026)).withColumn("quarter", F.lit(1))
    write_trip_lake(rows, folder + "/lake")
    assert len(data_files(folder + "/lake")) == 2
    back = spark.read.parquet(folder + "/lake")
    assert sorted(r[0] for r in back.select("trip_id").collect()) == [0, 1, 2, 3]


def test_staging_is_written_from_the_tasks_that_hold_the_rows(spark, folder):
    wh = Warehouse(spark, folder + "/wh")
    assert wh.save(M.project_staging(trips_in_two_tasks(spark)), S.STAGING_TRIPS) == 4
    assert len(data_files(folder + "/wh/staging/trips")) == 2
    assert sorted(r["trip_id"] for r in wh.table(S.STAGING_TRIPS).collect()) == ["0", "1", "2", "3"]


def test_the_file_dedup_shuffles_no_file_names_and_no_quarters(spark, tmp_path):
    paths = []
    for quarter in (1, 2):
        path = tmp_path / f"metro-trips-2026-q{quarter}.csv"
        path.write_text("\n".join([TRIP_HEADER, row("1", "5"), row("1", "6"), row("", "7"), row("", "8")]) + "\n")
        paths.append("file://" + str(path))
    stamp = dt.datetime(2026, 6, 14, tzinfo=dt.timezone.utc)
    df = TR.cleaned_trips(spark, paths, stamp)
    (columns,) = shuffled_columns(df)
    assert not {"__file_name", "source_file", "source_year", "source_quarter"} & set(columns)
    rows = df.select("source_file", "source_year", "source_quarter", "year", "quarter", "trip_id", "duration").collect()
    assert sorted(tuple(r) for r in rows if r["trip_id"] is not None) == [
        ("metro-trips-2026-q1.csv", 2026, 1, 2026, 1, 1, 5), ("metro-trips-2026-q2.csv", 2026, 2, 2026, 2, 1, 5)]
    assert [r["duration"] for r in rows if r["trip_id"] is None] == [7, 7]
    result = ingest_trips(spark, "file://" + str(tmp_path), f"file://{tmp_path}/lake", f"file://{tmp_path}/m.json", stamp)
    assert result.cleaned_rows == {"metro-trips-2026-q1.csv": 2, "metro-trips-2026-q2.csv": 2}


def test_quarter_files_are_made_from_the_table_columns(spark, folder):
    day = [dt.datetime(2026, 1, 5), dt.datetime(2026, 4, 6), None]
    lines = [(k, 7 - k % 7, k % 3, 2 - k % 2, 5.0 + k, 1.5, "F" if k % 2 else "O", day[k % 3]) for k in range(12)]
    (spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                           "l_extendedprice double, l_linestatus string, l_shipdate timestamp_ntz")
     .write.parquet(folder + "/lineitem.parquet"))
    (spark.createDataFrame([(k, k, "1-URGENT") for k in range(12)], "o_orderkey bigint, o_custkey bigint, o_orderpriority string")
     .write.parquet(folder + "/orders.parquet"))
    df = A.trip_csv_rows(spark, folder)
    (columns,) = [c for c in shuffled_columns(df) if "o_custkey" in c and "l_shipdate" in c]
    assert set(columns) <= {*A.FILE_ORDER, "o_custkey", "o_orderpriority"}
    written = A.write_trip_csvs(spark, folder, folder + "/csv")
    names = [p.rsplit("/", 1)[-1] for p in written]
    assert "metro-trips-2026-q1.csv" in names and "metro-trips-2026-q2.csv" in names
    first = spark.read.option("header", True).csv(folder + "/csv/metro-trips-2026-q1.csv")
    assert [r["trip_id"] for r in first.collect()] == [str(k * 10 + 2 - k % 2) for k in range(0, 12, 3)]


def line_items(spark, folder, days):
    """lineitem and orders of 24 rows over these ship dates, some rows twice."""
    lines = [(k // 2, 7 - k % 7, k % 3, 1 + k % 2, 5.0 + k, 1.5, "F" if k % 2 else "O", days[k % len(days)]) for k in range(24)]
    (spark.createDataFrame(lines + lines[:5], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                           "l_quantity double, l_extendedprice double, l_linestatus string, l_shipdate timestamp_ntz")
     .repartition(3).write.parquet(folder + "/lineitem.parquet"))
    (spark.createDataFrame([(k, k, f"{1 + k % 3}-P") for k in range(12)], "o_orderkey bigint, o_custkey bigint, o_orderpriority string")
     .write.parquet(folder + "/orders.parquet"))


def shuffle_files() -> int:
    """Shuffle data files that the session's local folders hold."""
    from pyspark.sql import SparkSession
    jvm = SparkSession.active().sparkContext._jvm
    folders = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(n.startswith("shuffle_") and n.endswith(".data")
               for folder in folders for _, _, names in os.walk(folder) for n in names)


def wait_for(condition) -> bool:
    import time
    for _ in range(50):
        if condition():
            return True
        time.sleep(0.1)
    return False


def test_quarters_dealt_as_parquet_give_the_same_files(spark, folder):
    line_items(spark, folder, [dt.datetime(2026, 1, 5), dt.datetime(2026, 4, 6), None, dt.datetime(2025, 4, 6)])
    forms = {1: "M/d/yyyy h:mm a", 2: "yyyy-MM-dd'T'HH:mm:ss.SSS"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    one = A.write_trip_csvs(spark, folder, folder + "/one", forms)
    dealt = A.write_trip_csvs(spark, folder, folder + "/dealt", forms, one_plan_bytes=0)
    assert [p.rsplit("/", 1)[-1] for p in one] == [p.rsplit("/", 1)[-1] for p in dealt] and len(one) == 4
    for a, b in zip(one, dealt):
        with open(a.replace("file://", "")) as f, open(b.replace("file://", "")) as g:
            assert f.read() == g.read()
    assert not [n for n in os.listdir(folder.replace("file://", "")) if "__staging" in n]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_the_lake_is_written_in_the_order_of_the_dedup(spark, tmp_path):
    for quarter in (1, 2):
        lines = [TRIP_HEADER] + [row(str(i % 20)) for i in range(60)]
        (tmp_path / f"metro-trips-2026-q{quarter}.csv").write_text("\n".join(lines) + "\n")
    paths = [f"file://{tmp_path}/metro-trips-2026-q{q}.csv" for q in (1, 2)]
    df = TR.cleaned_trips(spark, paths, dt.datetime(2026, 6, 14, tzinfo=dt.timezone.utc)).sortWithinPartitions(*S.LAKE_PARTITIONS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Final Plan")[-1]
    assert final.count("Sort [") == 2, final  # before and behind the dedup's exchange, none for the write
    assert df.count() == 40


def test_first_in_file_shuffles_no_file_names(spark, folder):
    import __spark_entry__
    line_items(spark, folder, [dt.datetime(2026, 1, 5), dt.datetime(2026, 4, 6)])
    df = __spark_entry__.queries()["dedup_first_in_file"](spark, folder)
    (columns,) = shuffled_columns(df)
    assert not {"__file_name", "__file_path", "source_file"} & set(columns)
    rows = df.select("source_file", "trip_id", "year", "quarter").collect()
    assert len(rows) == 24 and {r[0]: (r[2], r[3]) for r in rows} == {
        "metro-trips-2026-q1.csv": (2026, 1), "metro-trips-2026-q2.csv": (2026, 2)}


def lake_of(spark, folder):
    """A small lake and a station list without rows, of the pipeline's shape."""
    line_items(spark, folder, [dt.datetime(2026, 1, 5), dt.datetime(2026, 4, 6)])
    A.write_trip_csvs(spark, folder, folder + "/raw")
    result = ingest_trips(spark, folder + "/raw", folder + "/lake", folder + "/m.json")
    spark.createDataFrame([], "station_id bigint, station_name string, go_live_date timestamp_ntz, region string, status string, "
                          "latitude double, longitude double").write.parquet(folder + "/stations.parquet")
    return result


def test_a_step_leaves_no_shuffle_files(spark, folder):
    import gc
    from stationflow.plans.warehouse import build_warehouse
    from stationflow.session import SHUFFLE_CLEANUP
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    wait_for(lambda: shuffle_files() == 0)
    held, setting = shuffle_files(), spark.conf.get(SHUFFLE_CLEANUP, "false")
    assert lake_of(spark, folder).total_rows == 24
    build_warehouse(spark, folder + "/lake", folder + "/stations.parquet", folder + "/wh")
    assert wait_for(lambda: shuffle_files() <= held), (shuffle_files(), held)
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == setting


def test_marts_of_a_large_staging_table_are_built_one_by_one(spark, folder, monkeypatch):
    import threading
    from stationflow.plans import warehouse as W
    lake_of(spark, folder)
    at_once, most, lock, save = set(), {}, threading.Lock(), Warehouse.save

    def watched(self, df, name):
        with lock:
            at_once.add(name)
            most[name] = len(at_once)
        try:
            return save(self, df, name)
        finally:
            with lock:
                at_once.discard(name)

    monkeypatch.setattr(Warehouse, "save", watched)
    monkeypatch.setattr(W, "SIDE_BY_SIDE_BYTES", 0)
    wh, _ = W.build_warehouse(spark, folder + "/lake", folder + "/stations.parquet", folder + "/wh")
    marts = [S.RPT_HOURLY_DEMAND, S.RPT_STATION_ACTIVITY, S.RPT_ROUTE_POPULARITY]
    assert [most[name] for name in marts] == [1, 1, 1]
    assert wh.table(S.STAGING_TRIPS).count() == 24


def test_the_checks_of_a_run_keep_no_shuffle_files(spark, folder, monkeypatch):
    from stationflow.plans import pipeline as P
    from stationflow.session import SHUFFLE_CLEANUP
    lake_of(spark, folder)
    with open(folder.replace("file://", "") + "/stations.csv", "w") as f:
        f.write(",".join(A.STATION_CSV_HEADER) + "\n1,One,1/5/2026,DTLA,Active,34.0,-118.0\n")
    seen, checks = [], P.assert_checks
    monkeypatch.setattr(P, "assert_checks", lambda df: seen.append(spark.conf.get(SHUFFLE_CLEANUP, "false")) or checks(df))
    cfg = P.PipelineConfig(folder + "/raw", folder + "/stations.csv", folder + "/lake2", folder + "/stations2.parquet",
                           folder + "/m2.json", folder + "/wh2")
    result = P.run_pipeline(spark, cfg)
    assert seen == ["true"] and dict(result.counts)[S.STAGING_TRIPS] == 24
