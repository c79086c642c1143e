"""Incremental staging against the full build."""

import datetime as dt
import os
import random

import pytest

from helpers import TRIP_HEADER, write_text
from test_ingest import STAMP, row
from stationflow import schemas as S
from stationflow.operators import models as M
from stationflow.plans import refresh
from stationflow.plans.ingest import ingest_trip_files, ingest_trips
from stationflow.sinks.tables import Warehouse
from stationflow.sources.lake import read_trip_lake


def publish(raw, quarter, ids, seed):
    rng = random.Random(seed)
    lines = [row(i, duration=str(rng.choice([0, 5, 9])), start=f"1/{rng.randint(1, 9)}/2026 10:00", end="2/1/2026 10:08",
                 bike=f"b{rng.randint(1, 5)}") for i in ids]
    write_text(raw, f"metro-trips-{quarter[0]}-q{quarter[1]}.csv", "\n".join([TRIP_HEADER, *lines]) + "\n")


def ingest_again(spark, raw, lake, manifest, quarters, days):
    """Only the files of these quarters: the others keep their stamp."""
    paths = [f"{raw}/metro-trips-{y}-q{q}.csv" for y, q in quarters]
    ingest_trip_files(spark, paths, raw, lake, manifest, STAMP + dt.timedelta(days=days))


def rows_of(df):
    return sorted(tuple(str(x) for x in r) for r in df.select(*S.STAGING_COLUMNS).collect())


@pytest.fixture()
def places(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    quarters = [(2025, 3), (2025, 4), (2026, 1)]
    for n, q in enumerate(quarters):
        publish(raw, q, ["", *[str(i) for i in range(n, 40 + n, 1 + n % 2)]], n)
    lake = folder + "/lake"
    ingest_trips(spark, raw, lake, folder + "/m.json", STAMP)
    return raw, lake, folder + "/m.json", Warehouse(spark, folder + "/wh"), quarters


def full(spark, lake):
    return rows_of(M.build_staging_trips(read_trip_lake(spark, lake)))


def test_refresh_equals_the_full_build(spark, places):
    raw, lake, manifest, wh, quarters = places
    n = refresh.refresh_staging(wh, lake, bucket_bytes=2000)
    assert rows_of(wh.table(S.STAGING_TRIPS)) == full(spark, lake) and n == len(full(spark, lake))
    assert refresh.bucket_count(wh, lake) > 1
    # published again without most trips: other quarters' rows of them come back
    publish(raw, quarters[0], ["", "1", "2", "77"], 9)
    publish(raw, (2026, 2), ["1", "500"], 10)
    ingest_again(spark, raw, lake, manifest, [quarters[0], (2026, 2)], 1)
    untouched = os.listdir(refresh._folder(wh, quarters[1]).replace("file://", ""))
    refresh.refresh_staging(wh, lake, [quarters[0]])
    assert rows_of(wh.table(S.STAGING_TRIPS)) == full(spark, lake)
    assert os.listdir(refresh._folder(wh, quarters[1]).replace("file://", "")) == untouched
    assert refresh.held_quarters(wh) == [*quarters, (2026, 2)]
    # a quarter without a valid row leaves the lake and the table
    publish(raw, quarters[2], [], 0)
    ingest_again(spark, raw, lake, manifest, [quarters[2]], 2)
    refresh.refresh_staging(wh, lake, [quarters[2]])
    assert rows_of(wh.table(S.STAGING_TRIPS)) == full(spark, lake)
    assert quarters[2] not in refresh.held_quarters(wh)
    refresh.rebuild(wh, lake)
    assert rows_of(wh.table(S.STAGING_TRIPS)) == full(spark, lake) and refresh.bucket_count(wh, lake) == 1


def test_held_rows_are_not_shuffled(spark, places):
    _, lake, _, wh, quarters = places
    refresh.refresh_staging(wh, lake, bucket_bytes=2000)
    buckets = refresh.bucket_count(wh, lake)
    with refresh.bucketed_rows(wh, buckets) as rows:
        first = refresh.first_rows(rows)
        plan = first._jdf.queryExecution().executedPlan().toString()
        assert first.count()
    assert "Exchange" not in plan and "Bucketed: true" in plan and "Window" in plan
