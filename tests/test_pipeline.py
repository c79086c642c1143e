import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import TRIP_HEADER, write_text
from test_ingest import row
from stationflow import schemas as S
from stationflow.functions import expressions as X
from stationflow.operators import demand as D
from stationflow.plans.pipeline import PipelineConfig, data_health, overview, run_pipeline
from stationflow.sinks.tables import Warehouse

STAMP = dt.datetime(2026, 6, 14, tzinfo=dt.timezone.utc)


def setup_inputs(folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    write_text(raw, "metro-trips-2026-q1.csv", "\n".join([
        TRIP_HEADER, row("1"), row("2", start_station="3005"), row("3", start="2/1/2026 7:15", end="2/1/2026 7:30"),
    ]) + "\n")
    write_text(raw, "metro-trips-2025-q4.csv", "\n".join([
        TRIP_HEADER, row("9", start="12/1/2025 10:00", end="12/1/2025 10:08", start_station="3005", end_station="4285"),
    ]) + "\n")
    stations = write_text(folder, "stations.csv", "\n".join([
        "Kiosk ID,Kiosk Name,Go Live Date,Region ,Status,Latitude,Longitude",
        "3005,7th & Flower,7/7/2016,DTLA,Active,34.0485,-118.2585",
        "1,One,7/7/2016,Westside,Active,34.0,-118.4",
        "4285,Virtual Station,7/7/2016,,Active,,",
    ]) + "\n")
    return PipelineConfig(
        raw_dir=raw, stations_csv=stations, lake_trips=folder + "/lake/trips",
        lake_stations=folder + "/lake/stations.parquet", manifest=folder + "/manifest/m.json",
        warehouse=folder + "/warehouse", csv_exports=folder + "/exports", csv_single_file=True,
        serving=folder + "/serving", serving_manifest=folder + "/serving/m.json",
    )


def test_full_run_and_rerun(spark, folder):
    cfg = setup_inputs(folder)
    first = run_pipeline(spark, cfg, STAMP)
    counts = dict(first.counts)
    assert counts[S.STAGING_TRIPS] == 4 and counts[S.RAW_TRIPS] == 4 and counts[S.DIM_STATIONS] == 3
    assert len(first.checks) == 10
    exported = sorted(os.listdir(cfg.csv_exports.replace("file://", "")))
    assert exported == ["hourly_demand.csv", "route_popularity.csv", "station_activity.csv", "stations.csv"]
    with open(cfg.csv_exports.replace("file://", "") + "/hourly_demand.csv") as f:
        lines = f.read().splitlines()
    assert lines[0] == ",".join(S.HOURLY_DEMAND_COLUMNS)
    assert lines[1].startswith("2025,4,2025-12-01,10,10 AM,1,1,1,8.0")
    serving = Warehouse(spark, cfg.serving)
    assert serving.table(S.STAGING_TRIPS).columns == S.SLIM_COLUMNS
    assert serving.table(S.RPT_ROUTE_POPULARITY).count() == 3
    assert os.path.exists(cfg.serving_manifest.replace("file://", ""))

    wh_first = Warehouse(spark, cfg.warehouse)
    before = sorted(tuple(r) for r in wh_first.table(S.STAGING_TRIPS).drop("ingested_at").collect())
    marts_before = {n: sorted(tuple(r) for r in wh_first.table(n).collect())
                    for n in (S.RPT_HOURLY_DEMAND, S.RPT_STATION_ACTIVITY, S.RPT_ROUTE_POPULARITY)}
    second = run_pipeline(spark, cfg, STAMP + dt.timedelta(hours=1))
    assert second.counts == first.counts
    wh_second = Warehouse(spark, cfg.warehouse)
    assert sorted(tuple(r) for r in wh_second.table(S.STAGING_TRIPS).drop("ingested_at").collect()) == before
    for n, rows in marts_before.items():
        assert sorted(tuple(r) for r in wh_second.table(n).collect()) == rows

    wh = Warehouse(spark, cfg.warehouse, trips_lake=cfg.lake_trips, stations_file=cfg.lake_stations)
    counts_df, files_df, updated = data_health(spark, wh, cfg.manifest, "2026 Q1")
    assert [r["source_file"] for r in files_df.collect()] == ["metro-trips-2026-q1.csv"]
    assert counts_df.count() == 4 and updated.first()["updated_at"] != "unknown"
    metrics, summary, demand = overview(spark, wh, cfg.manifest, X.ALL_QUARTERS)
    assert metrics.first()["total_trips"] == 4
    assert summary.first()["latest_quarter_label"] == "2026 Q1" and summary.first()["files_processed"] == 2
    assert sorted(r["quarter_label"] for r in demand.collect()) == ["2025 Q4", "2026 Q1"]
    _, _, daily = overview(spark, wh, cfg.manifest, "2026 Q1")
    assert daily.count() == 2


def test_quarter_filter_prunes_staging_partitions(spark, folder):
    cfg = setup_inputs(folder)
    run_pipeline(spark, cfg, STAMP)
    wh = Warehouse(spark, cfg.warehouse)
    df = X.where(wh.table(S.STAGING_TRIPS), [X.quarter_filter("2026 Q1")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_year" in plan
    assert df.count() == 3


def test_open_prefers_serving_copy(spark, folder):
    primary, fallback = folder + "/serving", folder + "/warehouse"
    assert Warehouse.open(spark, primary, fallback).root == fallback
    os.makedirs(primary.replace("file://", ""))
    assert Warehouse.open(spark, primary, fallback).root == primary


def test_catalog_mode_registers_tables(spark, folder):
    from stationflow.plans.warehouse import build_warehouse
    from stationflow.plans.ingest import ingest_stations, ingest_trips
    cfg = setup_inputs(folder)
    ingest_trips(spark, cfg.raw_dir, cfg.lake_trips, cfg.manifest, STAMP)
    ingest_stations(spark, cfg.stations_csv, cfg.lake_stations)
    build_warehouse(spark, cfg.lake_trips, cfg.lake_stations, cfg.warehouse, catalog=True)
    assert spark.table("staging.trips").count() == 4
    assert spark.sql("select count(*) from marts.rpt_hourly_demand").first()[0] == 3
    assert spark.table("staging.trips").filter("source_year = 2026").count() == 3


def test_csv_export_as_ordered_parts(spark, folder):
    from stationflow.sinks.exports import export_csv
    cfg = setup_inputs(folder)
    run_pipeline(spark, cfg, STAMP)
    wh = Warehouse(spark, cfg.warehouse)
    export_csv(spark, wh, folder + "/parts", single_file=False)
    back = spark.read.option("header", True).csv(folder + "/parts/route_popularity.csv")
    assert back.count() == 3


def test_dashboard_views(spark, folder):
    from stationflow.operators.demand import DemandFilters
    from stationflow.plans.dashboard import Dashboard
    cfg = setup_inputs(folder)
    run_pipeline(spark, cfg, STAMP)
    dash = Dashboard.open(spark, cfg.serving, cfg.warehouse, cfg.serving_manifest, cfg.manifest)
    assert dash.wh.root == cfg.serving and dash.manifest_path == cfg.serving_manifest
    assert [r[0] for r in dash.quarter_choices().collect()] == ["All Quarters", "2025 Q4", "2026 Q1"]
    views = dash.historical_demand(DemandFilters(region="DTLA"))
    assert set(views) == {"hourly", "daily", "by_hour", "by_day_type", "by_quarter"}
    assert sum(r["trip_count"] for r in views["daily"].collect()) == 2
    hourly = D.historical_demand(dash.trips, dash.stations, DemandFilters(region="DTLA"))
    separate = {"hourly": hourly, "daily": D.demand_daily(hourly), "by_hour": D.demand_by_hour(hourly),
                "by_day_type": D.demand_by_day_type(hourly), "by_quarter": D.demand_by_quarter_filtered(hourly)}
    for name, frame in separate.items():
        assert views[name].columns == frame.columns and views[name].collect() == frame.collect()
        plan = views[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "bike_id" not in plan  # the trips are not read again
    st = dash.station_activity(station_label="7th & Flower (3005)")
    assert st.selected.first()["trip_starts"] == 2 and st.daily.count() == 2
    assert [r["region"] for r in st.regions.collect()] == ["DTLA", "Westside"]
    r = dash.routes(top_n=1)
    assert r["top"].count() == 1 and r["categories"].count() == 1
    counts, files, _ = dash.data_health("2025 Q4")
    assert files.count() == 1 and counts.count() == 4


def test_failed_save_keeps_the_old_table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.save(spark.range(5), "marts.numbers")
    wh.save(spark.range(7), "marts.numbers")
    broken = spark.range(9).withColumn("id", F.expr("if(id = 8, cast(raise_error('broken') as bigint), id)"))
    with pytest.raises(Exception, match="broken"):
        wh.save(broken, "marts.numbers")
    assert wh.table("marts.numbers").count() == 7
    assert [p.name for p in (tmp_path / "wh" / "marts").iterdir()] == ["numbers"]


def test_single_extract_is_sorted_in_parallel(spark, folder):
    from stationflow.sinks.exports import export_csv
    wh = Warehouse(spark, folder + "/wh")
    rows = spark.range(5000).selectExpr(
        "cast(2020 + id % 3 as int) as source_year", "cast(id % 4 + 1 as int) as source_quarter",
        "cast(id % 700 as string) as station_id", "concat('Stop \"', id, '\", x') as station_name", "'r' as region",
        "'Active' as station_status", "34.5D as station_lat", "-118.0D as station_lon", "id * 7919 % 5003 as trip_starts",
        "id as distinct_bikes_used", "1.5D as avg_duration_minutes")
    for name in (S.RPT_HOURLY_DEMAND, S.RPT_ROUTE_POPULARITY, S.DIM_STATIONS):
        empty = rows.limit(0).selectExpr("source_year", "source_quarter", "trip_starts as trip_date", "trip_starts as start_hour",
                                         "trip_starts as trip_count")
        wh.save(empty, name)
    wh.save(rows.repartition(7), S.RPT_STATION_ACTIVITY)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_csv(spark, wh, folder + "/out", single_file=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    out = folder.replace("file://", "") + "/out"
    assert sorted(os.listdir(out)) == ["hourly_demand.csv", "route_popularity.csv", "station_activity.csv", "stations.csv"]
    lines = open(out + "/station_activity.csv").read().splitlines()
    assert lines[0] == ",".join(S.STATION_ACTIVITY_COLUMNS) and len(lines) == 5001
    back = spark.read.option("header", True).option("escape", '"').csv(folder + "/out/station_activity.csv").collect()
    keys = [(int(r["source_year"]), int(r["source_quarter"]), -int(r["trip_starts"])) for r in back]
    assert keys == sorted(keys) and {r["station_name"] for r in back} == {f'Stop "{i}", x' for i in range(5000)}
    assert open(out + "/hourly_demand.csv").read() == "source_year,source_quarter,trip_date,start_hour,trip_count\n"
