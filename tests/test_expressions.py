import datetime as dt

from pyspark.sql import functions as F

from stationflow.functions import expressions as X


def test_round_binary_matches_reference_rounding(spark):
    df = spark.createDataFrame([(201, 200), (203, 200), (29, 200), (107, 40)], "n long, d long")
    got = [r[0] for r in df.select(X.round_binary(F.col("n") / F.col("d"), 2)).collect()]
    assert got == [1.0, 1.01, 0.14, 2.68]


def test_hour_labels(spark):
    df = spark.createDataFrame([(h,) for h in [0, 1, 11, 12, 13, 23]], "h long")
    got = [r[0] for r in df.select(X.hour_label("h")).collect()]
    assert got == ["12 AM", "1 AM", "11 AM", "12 PM", "1 PM", "11 PM"]


def test_day_of_week_and_day_type(spark):
    days = [dt.datetime(2026, 11, 29, 8), dt.datetime(2026, 11, 30, 8), dt.datetime(2026, 12, 5, 8)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    got = df.select(X.dow0("t").alias("d")).select("d", X.day_type("d")).collect()
    assert [tuple(r) for r in got] == [(0, "Weekend"), (1, "Weekday"), (6, "Weekend")]


def test_quarter_filter_and_labels():
    assert X.quarter_filter("All Quarters") is None
    assert X.parse_quarter_label("2026 Q1") == (2026, 1)
    assert X.all_of([None, None]) is None


def test_station_label_round_trip(spark):
    assert X.station_id_from_label("O'Hara (Plaza) (4301)") == "4301"
    df = spark.createDataFrame([("O'Hara (Plaza)", "4301")], "station_name string, station_id string")
    label = df.select(X.station_label().alias("l")).first()["l"]
    assert label == "O'Hara (Plaza) (4301)"


def test_marker_size_and_formats(spark):
    df = spark.createDataFrame([(4, dt.date(2026, 1, 5), 1234567, 8.456)], "n long, d date, c long, m double")
    r = df.select(X.marker_size("n"), X.format_day("d"), X.format_count("c"), X.format_minutes("m")).first()
    assert tuple(r) == (6.0, "Jan 5, 2026", "1,234,567", "8.46 min")


def test_rows_frame_quotes_values(spark):
    from stationflow.sources.local import rows_frame
    rows = [("O'Hara \\ (1)", 1, None, 2.5), ("plain", None, True, None)]
    df = rows_frame(spark, rows, "name string, n bigint, flag boolean, x double")
    assert [tuple(r) for r in df.collect()] == rows
    assert df.schema.simpleString() == "struct<name:string,n:bigint,flag:boolean,x:double>"
    empty = rows_frame(spark, [], "name string, n bigint")
    assert empty.count() == 0 and empty.columns == ["name", "n"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan
