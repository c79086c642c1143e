from pyspark.sql import functions as F

from helpers import raw_stations, raw_trips, sorted_rows, station, trip
from stationflow.operators import models as M
from stationflow.operators.joins import estimated_size
from stationflow.operators import quality as Q
from stationflow.operators import stations as ST


def test_staging_dedup_after_filter_and_across_quarters(spark):
    rows = [
        trip(2, duration=0), trip(2, duration=5, minutes=5),            # invalid first kept out
        trip(3, start="2026-03-31 23:50", quarter=(2026, 1)),
        trip(3, start="2026-03-31 23:40", quarter=(2026, 2)),             # earlier start wins
        trip(None, bike="x"), trip(None, bike="y"),                       # nulls are one key
        trip(4, start="2026-01-05 10:00", end="2026-01-05 09:59"),        # reversed, kept here
        trip(5, duration=None), trip(6, start=None), trip(7, end=None),
    ]
    stg = M.build_staging_trips(raw_trips(spark, rows))
    got = {r["trip_id"]: r for r in stg.collect()}
    assert set(got) == {"2", "3", None, "4"}
    assert got["2"]["duration_minutes"] == 5
    assert got["3"]["start_time"].minute == 40 and got["3"]["source_quarter"] == 2
    assert got[None]["bike_id"] == "x"
    assert stg.schema["start_hour"].dataType.typeName() == "long"
    assert stg.schema["source_year"].dataType.typeName() == "integer"


def test_staging_trims_text_and_reversed_time_fails_check(spark):
    rows = [trip(1, route=" Round Trip", passholder="Monthly ", bike_type=" electric "),
            trip(4, start="2026-01-05 10:00", end="2026-01-05 09:59")]
    stg = M.build_staging_trips(raw_trips(spark, rows))
    r = stg.filter("trip_id = '1'").first()
    assert (r["trip_route_category"], r["passholder_type"], r["bike_type"]) == ("Round Trip", "Monthly", "electric")
    check = Q.timing_check(stg).first()
    assert check["observed"] == 1 and not check["passed"]


def test_dim_keeps_latest_go_live_and_drops_null_ids(spark):
    rows = [
        station(1, "Old", live="2016-01-01 00:00"), station(1, "New", live="2020-01-01 00:00"),
        (2, "No date", None, "DTLA", "Active", 1.0, 1.0), station(2, "Dated", live="2019-01-01 00:00"),
        (None, "No id", None, "DTLA", "Active", 1.0, 1.0),
    ]
    dim = M.build_dim_stations(raw_stations(spark, rows))
    assert sorted_rows(dim, "station_id", "station_name") == [("1", "New"), ("2", "Dated")]
    assert dim.schema["go_live_date"].dataType.typeName() == "date"


def test_hourly_mart_counts_and_rounding(spark):
    rows = [trip(i, duration=d, minutes=d, bike=b, start_station=s) for i, d, b, s in
            [(1, 1, "b1", 1), (2, 2, "b1", 2), (3, 2, None, 2)]]
    hourly = M.build_hourly_demand(M.build_staging_trips(raw_trips(spark, rows)))
    r = hourly.first()
    assert (r["trip_count"], r["active_station_count"], r["distinct_bikes_used"]) == (3, 2, 1)
    assert r["avg_duration_minutes"] == 1.67 and r["start_hour_label"] == "10 AM"


def test_station_activity_unknown_station_and_null_start(spark):
    rows = [trip(1, start_station=999, start_lat=34.1234564, start_lon=-118.1),
            trip(2, start_station=999, start_lat=34.1234566, start_lon=-118.3),
            trip(3, start_station=None), trip(4, start_station=1)]
    stg = M.build_staging_trips(raw_trips(spark, rows))
    dim = M.build_dim_stations(raw_stations(spark, [station(1, "Main")]))
    mart = {r["station_id"]: r for r in M.build_station_activity(stg, dim).collect()}
    assert set(mart) == {"999", "1"}
    u = mart["999"]
    assert (u["station_name"], u["region"], u["station_status"]) == ("Unknown Station", "Unknown Region", "Unknown Status")
    assert u["station_lat"] == 34.123457 and u["station_lon"] == -118.2
    ranking = {r["station_id"] for r in ST.station_ranking(stg, dim).collect()}
    assert ranking == {"999", "1", None}
    routes = M.build_route_popularity(stg, dim)
    assert {r["start_station_id"] for r in routes.collect()} == {"999", "1"}


def stored_dimension(spark, folder):
    """A station dimension with statistics, as the marts read it."""
    dim = M.build_dim_stations(raw_stations(spark, [station(1, "Main"), station(2, "Second")]))
    dim.write.parquet(folder + "/dim")
    return spark.read.parquet(folder + "/dim")


def test_aggregate_then_join_plan_broadcasts_dimension(spark, folder):
    stg = M.build_staging_trips(raw_trips(spark, [trip(1), trip(2, start_station=3)]))
    dim = stored_dimension(spark, folder)
    size = estimated_size(dim)
    assert isinstance(size, int) and 0 < size < 100_000
    plan = M.build_route_popularity(stg, dim)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_no_job_runs_while_a_plan_is_built(spark, folder):
    stg = M.build_staging_trips(raw_trips(spark, [trip(1), trip(2, start_station=3)]))
    dim = stored_dimension(spark, folder)
    spark.sparkContext.setJobGroup("plan-only", "plan")
    try:
        M.build_route_popularity(stg, dim)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_window_group_limit_before_shuffle(spark):
    stg = M.build_staging_trips(raw_trips(spark, [trip(1), trip(1, start="2026-01-05 09:00")]))
    plan = stg._jdf.queryExecution().executedPlan().toString()
    # AdaptiveSparkPlan shows the initial plan before execution
    assert "WindowGroupLimit" in plan
    assert stg.count() == 1 and stg.first()["start_hour"] == 9


def test_mart_order_desc_nulls_last(spark):
    df = spark.createDataFrame([(2026, 1, 5), (2026, 1, 9), (2025, 4, 1)],
                               "source_year int, source_quarter int, trip_starts long")
    got = [tuple(r) for r in M.mart_order(df, "marts.rpt_station_activity").collect()]
    assert got == [(2025, 4, 1), (2026, 1, 9), (2026, 1, 5)]
    assert F is not None


def test_no_broadcast_beyond_the_bound(spark, folder):
    stg = M.build_staging_trips(raw_trips(spark, [trip(1), trip(2, start_station=3)]))
    dim = stored_dimension(spark, folder)
    spark.conf.set("stationflow.dimBroadcastMaxBytes", "1")
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.build_route_popularity(stg, dim)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("stationflow.dimBroadcastMaxBytes")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
