import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from helpers import TRIP_HEADER, csv_line, write_text
from stationflow.plans.ingest import ingest_stations, ingest_trips
from stationflow.sources import trips as TR
from stationflow.sources.lake import read_trip_lake
from stationflow.sources.manifest import read_manifest

STAMP = dt.datetime(2026, 6, 14, 0, 30, 52, tzinfo=dt.timezone.utc)


def row(trip_id, duration="8", start="1/5/2026 10:00", end="1/5/2026 10:08", bike="b1", **kw):
    values = {
        "trip_id": trip_id, "duration": duration, "start_time": start, "end_time": end,
        "start_station": "1", "start_lat": "34.05", "start_lon": "-118.25", "end_station": "2",
        "end_lat": "34.06", "end_lon": "-118.24", "bike_id": bike, "plan_duration": "30",
        "trip_route_category": "One Way", "passholder_type": "Monthly", "bike_type": "standard",
    }
    values.update(kw)
    return csv_line(values[c] for c in TRIP_HEADER.split(","))


def lake_rows(spark, lake):
    return {(r["trip_id"], r["duration"]): r for r in read_trip_lake(spark, lake).collect()}


def test_ingest_dedup_filter_and_na_tokens(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    lines = [
        TRIP_HEADER,
        row("1", "8"), row("1", "9"),                              # first valid kept
        row("2", "0"), row("2", "5"),                              # first invalid: none
        row("", "3"), row("", "4"),                                # null ids: first only
        row("4", "1", start="1/5/2026 10:00", end="1/5/2026 9:59"),  # reversed: dropped
        row("5", "1", start="1/5/2026 10:00", end="1/5/2026 10:00"),  # equal: kept
        row("6", "8.0", bike="N/A"), row("7", "8", bike="None"), row("8", "8", bike="NULL"),
        row("9", "8", bike="NA"), row("10", "8", bike="nan"), row("11", "8", bike=""),
        row("12", "8", bike=" "), row("13", "", bike="b"), row("14", "8", start=""),
        row("15", "8", start="2026-01-05 10:00:00", end="2026-01-05 10:08:00",
            trip_route_category=" Round Trip", passholder_type="Monthly "),
    ]
    write_text(raw, "metro-trips-2026-q1.csv", "\n".join(lines) + "\n")
    lake, manifest = folder + "/lake", folder + "/manifest/m.json"
    result = ingest_trips(spark, raw, lake, manifest, STAMP)
    got = lake_rows(spark, lake)
    ids = sorted((k[0] if k[0] is not None else -1) for k in got)
    assert ids == [-1, 1, 5, 6, 7, 8, 9, 10, 11, 12, 15]
    assert (1, 8) in got and (None, 3) in got
    assert got[(6, 8)]["bike_id"] is None and got[(11, 8)]["bike_id"] is None
    assert got[(12, 8)]["bike_id"] == " "
    assert got[(15, 8)]["trip_route_category"] == " Round Trip"
    assert result.cleaned_rows == {"metro-trips-2026-q1.csv": 11}
    r = got[(1, 8)]
    assert (r["source_year"], r["source_quarter"], r["year"], r["quarter"]) == (2026, 1, 2026, 1)
    m = read_manifest(spark, manifest).collect()
    assert len(m) == 1 and m[0]["cleaned_rows"] == 11 and m[0]["ingested_at"] == "2026-06-14T00:30:52+00:00"


@pytest.mark.parametrize("bad", ["8.5", "abc"])
def test_ingest_rejects_non_integer_duration(spark, folder, bad):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("1", bad) + "\n")
    with pytest.raises(Exception, match="cannot read 'duration'"):
        ingest_trips(spark, raw, folder + "/lake", folder + "/m.json", STAMP)


def test_file_names(spark):
    assert TR.trip_file_quarter("metro-trips-2026-q1.csv") == (2026, 1)
    assert TR.trip_file_quarter("metro-trips-2026-1.csv") == (2026, 1)
    assert TR.trip_file_quarter("metro-trips-2024-q2-final.zip", strict=False) == (2024, 2)
    for bad in ["trips-2026-q1.csv", "metro-trips-2026-q1-final.csv", "metro-trips-x-q1.csv"]:
        with pytest.raises(ValueError):
            TR.trip_file_quarter(bad)
    df = spark.createDataFrame([("metro-trips-2026-q3.csv",)], "n string")
    y, q = TR.quarter_columns(F.col("n"))
    assert tuple(df.select(y, q).first()) == (2026, 3)
    with pytest.raises(Exception, match="not the name of a quarter.s trip file"):
        bad = spark.createDataFrame([("metro-trips-2026.csv",)], "n string")
        bad.select(TR.quarter_columns(F.col("n"))[0]).collect()


def test_no_input_and_no_manifest(spark, folder):
    with pytest.raises(FileNotFoundError):
        ingest_trips(spark, folder + "/nothing", folder + "/lake", folder + "/m.json", STAMP)
    assert read_manifest(spark, folder + "/absent.json").count() == 0


def test_reingest_replaces_only_its_quarter(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("1") + "\n" + row("2") + "\n")
    write_text(raw, "metro-trips-2025-q4.csv", TRIP_HEADER + "\n" + row("3", start="12/1/2025 10:00", end="12/1/2025 10:08") + "\n")
    lake, manifest = folder + "/lake", folder + "/m.json"
    ingest_trips(spark, raw, lake, manifest, STAMP)
    # the 2026 Q1 file is re-published with one trip; a second name for the
    # same quarter sorts before it and is replaced by it in the lake
    os.remove(raw.replace("file://", "") + "/metro-trips-2025-q4.csv")
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("7") + "\n")
    write_text(raw, "metro-trips-2026-1.csv", TRIP_HEADER + "\n" + row("8") + "\n" + row("9") + "\n")
    later = STAMP + dt.timedelta(days=1)
    result = ingest_trips(spark, raw, lake, manifest, later)
    ids = sorted(r["trip_id"] for r in read_trip_lake(spark, lake).collect())
    assert ids == [3, 7]
    m = {r["source_file"]: r for r in read_manifest(spark, manifest).collect()}
    assert set(m) == {"metro-trips-2025-q4.csv", "metro-trips-2026-q1.csv", "metro-trips-2026-1.csv"}
    assert m["metro-trips-2026-q1.csv"]["cleaned_rows"] == 1
    assert m["metro-trips-2026-1.csv"]["cleaned_rows"] == 2
    assert m["metro-trips-2025-q4.csv"]["ingested_at"] == STAMP.isoformat()
    assert result.total_rows == 3


def test_header_normalisation_and_column_order(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    cols = TRIP_HEADER.split(",")
    shuffled = list(reversed(cols))
    header = ",".join(f" {c.upper()} " for c in shuffled)
    values = dict(zip(cols, row("21").split(",")))
    write_text(raw, "metro-trips-2026-q2.csv", header + ",extra\n" + ",".join(values[c] for c in shuffled) + ",x\n")
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("20") + "\n")
    lake = folder + "/lake"
    ingest_trips(spark, raw, lake, folder + "/m.json", STAMP)
    got = {r["trip_id"]: r for r in read_trip_lake(spark, lake).collect()}
    assert set(got) == {20, 21}
    assert got[21]["start_lat"] == 34.05 and got[21]["source_quarter"] == 2
    assert got[21]["extra"] == "x" and got[20]["extra"] is None


def test_station_ingest(spark, folder):
    header = "Kiosk ID,Kiosk Name,Go Live Date,Region ,Status,Latitude,Longitude"
    lines = [header, "3005,7th & Flower,7/7/2016,DTLA,Active,34.0485,-118.2585",
             "3005,Duplicate,7/7/2017,DTLA,Active,1,1", "4285,Virtual Station,,,Active,,"]
    path = write_text(folder, "stations.csv", "\n".join(lines) + "\n")
    out = folder + "/stations.parquet"
    assert ingest_stations(spark, path, out) == 2
    got = {r["station_id"]: r for r in spark.read.parquet(out).collect()}
    assert got[3005]["station_name"] == "7th & Flower" and got[3005]["region"] == "DTLA"
    assert got[3005]["go_live_date"] == dt.datetime(2016, 7, 7)
    assert got[4285]["latitude"] is None and got[4285]["region"] is None
    with pytest.raises(FileNotFoundError):
        ingest_stations(spark, folder + "/missing.csv", out)


def test_republished_quarter_without_valid_rows_empties_it(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("1") + "\n")
    write_text(raw, "metro-trips-2025-q4.csv", TRIP_HEADER + "\n" + row("3", start="12/1/2025 10:00", end="12/1/2025 10:08") + "\n")
    lake, manifest = folder + "/lake", folder + "/m.json"
    ingest_trips(spark, raw, lake, manifest, STAMP)
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("2", "0") + "\n")
    result = ingest_trips(spark, raw, lake, manifest, STAMP + dt.timedelta(days=1))
    assert result.cleaned_rows == {"metro-trips-2025-q4.csv": 1, "metro-trips-2026-q1.csv": 0}
    assert sorted(r["trip_id"] for r in read_trip_lake(spark, lake).collect()) == [3]


def test_multi_line_quoted_fields(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    quoted = row("1", passholder_type='"Monthly\nPass"')
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + quoted + "\n" + row("2") + "\n")
    lake = folder + "/lake"
    ingest_trips(spark, raw, lake, folder + "/m.json", STAMP, multi_line=True)
    got = {r["trip_id"]: r for r in read_trip_lake(spark, lake).collect()}
    assert set(got) == {1, 2} and got[1]["passholder_type"] == "Monthly\nPass"


def test_too_many_fields_raise_too_few_read_as_null(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    short = ",".join(row("1").split(",")[:-1])
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + short + "\n")
    lake = folder + "/lake"
    ingest_trips(spark, raw, lake, folder + "/m.json", STAMP)
    assert read_trip_lake(spark, lake).first()["bike_type"] is None
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("1") + ",extra\n")
    with pytest.raises(Exception, match="more than 15 fields"):
        ingest_trips(spark, raw, lake, folder + "/m.json", STAMP)
    # an empty extra field reads as null and is not noticed
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("1") + ",\n")
    ingest_trips(spark, raw, lake, folder + "/m.json", STAMP)
    assert read_trip_lake(spark, lake).count() == 1


def test_times_in_every_accepted_form_are_read_and_others_raise(spark, folder):
    raw, lake = folder + "/raw", folder + "/lake"
    os.makedirs(raw.replace("file://", ""))
    forms = [("1/5/2026 8:00 AM", "2026-01-05 08:00:00"), ("1/5/2026 1:02:03 pm", "2026-01-05 13:02:03"),
             ("2026-01-05 08:00:00.250", "2026-01-05 08:00:00.25"), ("2026-01-05T08:00:00.5", "2026-01-05 08:00:00.5"),
             ("1/5/26 8:00", "2026-01-05 08:00:00"), ("2026-01-05 08:00:00+00:00", "2026-01-05 08:00:00"),
             ("2026-01-05T10:00:00+02:00", "2026-01-05 08:00:00"), ("2026-01-05", "2026-01-05 00:00:00")]
    write_text(raw, "metro-trips-2026-q1.csv", "\n".join(
        [TRIP_HEADER] + [row(str(i), start=text, end="2/5/2026 10:00") for i, (text, _) in enumerate(forms)]) + "\n")
    ingest_trips(spark, raw, lake, folder + "/m.json", STAMP)
    got = {r["trip_id"]: r["start_time"] for r in read_trip_lake(spark, lake).collect()}
    assert got == {i: dt.datetime.fromisoformat(want) for i, (_, want) in enumerate(forms)}
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("1", start="soon") + "\n")
    with pytest.raises(Exception, match="as time: soon"):
        ingest_trips(spark, raw, lake, folder + "/m.json", STAMP)
    assert read_trip_lake(spark, lake).count() == len(forms)


def test_first_ingest_without_a_valid_row_writes_its_manifest(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("1", duration="0") + "\n")
    result = ingest_trips(spark, raw, folder + "/lake", folder + "/m.json", STAMP)
    assert result.total_rows == 0
    assert [r["cleaned_rows"] for r in read_manifest(spark, folder + "/m.json").collect()] == [0]


def test_quoted_fields_read_as_other_csv_readers_do(spark, folder):
    raw, lake = folder + "/raw", folder + "/lake"
    os.makedirs(raw.replace("file://", ""))
    plain = row("1").split(",")
    at = TRIP_HEADER.split(",").index("passholder_type")
    lines = []
    for i, field in enumerate(['"One ""Way"" pass"', '"x\\"', '"a, b"']):
        fields = list(plain)
        fields[0], fields[at] = str(i), field
        lines.append(",".join(fields))
    write_text(raw, "metro-trips-2026-q1.csv", "\n".join([TRIP_HEADER, *lines]) + "\n")
    ingest_trips(spark, raw, lake, folder + "/m.json", STAMP)
    got = {r["trip_id"]: (r["passholder_type"], r["bike_type"]) for r in read_trip_lake(spark, lake).collect()}
    assert got == {0: ('One "Way" pass', "standard"), 1: ("x\\", "standard"), 2: ("a, b", "standard")}


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_times_keep_their_wall_clock_in_any_session_zone(spark, folder, zone):
    """3/8/2026 2:30 does not exist in Los Angeles and 11/1/2026 1:30 occurs twice."""
    written = {"1": ("3/8/2026 2:30", "3/8/2026 2:45"), "2": ("2026-11-01 1:30", "2026-11-01T01:59:59.25"),
               "3": ("3/8/26 2:05 AM", "2026-03-08 02:06:00+00:00"), "4": ("1/5/2026 12:00 AM", "1/5/2026 12:30 PM")}
    os.makedirs((folder + "/raw").replace("file://", ""))
    write_text(folder + "/raw", "metro-trips-2026-q1.csv",
               "\n".join([TRIP_HEADER, *(row(i, start=a, end=b) for i, (a, b) in written.items())]) + "\n")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ingest_trips(spark, folder + "/raw", folder + "/lake", folder + "/m.json", STAMP)
        found = {r["trip_id"]: r for r in read_trip_lake(spark, folder + "/lake").select(
            "trip_id", "start_time", "end_time", F.unix_micros("ingested_at").alias("stamp")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found[1]["start_time"] == dt.datetime(2026, 3, 8, 2, 30) and found[1]["end_time"] == dt.datetime(2026, 3, 8, 2, 45)
    assert found[2]["start_time"] == dt.datetime(2026, 11, 1, 1, 30)
    assert found[2]["end_time"] == dt.datetime(2026, 11, 1, 1, 59, 59, 250000)
    assert found[3]["start_time"] == dt.datetime(2026, 3, 8, 2, 5) and found[3]["end_time"] == dt.datetime(2026, 3, 8, 2, 6)
    assert found[4]["start_time"] == dt.datetime(2026, 1, 5) and found[4]["end_time"] == dt.datetime(2026, 1, 5, 12, 30)
    assert {r["stamp"] for r in found.values()} == {int(STAMP.timestamp()) * 1_000_000}


def test_typed_scan_stays_below_the_size_the_jvm_compiles(spark, folder):
    os.makedirs((folder + "/raw").replace("file://", ""))
    write_text(folder + "/raw", "metro-trips-2026-q1.csv", "\n".join([TRIP_HEADER, row("1")]) + "\n")
    plan = TR.read_trip_csv(spark, [folder + "/raw/metro-trips-2026-q1.csv"])._jdf.queryExecution().executedPlan()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) < 8000
