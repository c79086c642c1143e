"""Versioned tables and the ingest journal, stopped before and after every file system step."""

import datetime as dt
import os

import pytest

from helpers import TRIP_HEADER, write_text
from test_ingest import STAMP, row
from stationflow import schemas as S
from stationflow.plans.ingest import ingest_trips
from stationflow.sinks import files, journal, versions
from stationflow.sinks.exports import export_serving
from stationflow.sinks.tables import Warehouse
from stationflow.sources.lake import read_trip_lake
from stationflow.sources.manifest import read_manifest

STEPS = ("write_text", "rename_new", "delete", "move_over", "copy_file")


class Killed(BaseException):
    pass


class Stop:
    """Stops the process, as it were, at the n-th file system step: before it is done, or right after."""

    def __init__(self, monkeypatch, at, before):
        self.at, self.before, self.seen = at, before, 0
        for name in STEPS:
            monkeypatch.setattr(files, name, self.wrap(getattr(files, name)))

    def wrap(self, step):
        def run(*args):
            self.seen += 1
            if self.seen == self.at and self.before:
                raise Killed
            out = step(*args)
            if self.seen == self.at and not self.before:
                raise Killed
            return out
        return run


def until_it_passes(monkeypatch, work, check):
    """``work`` stopped at step 1, 2, ... until it gets through; ``check`` after each."""
    stopped = 0
    for before in (True, False):
        at = 0
        while True:
            at += 1
            with monkeypatch.context() as patch:
                Stop(patch, at, before)
                try:
                    work()
                    passed = True
                except Killed:
                    passed, stopped = False, stopped + 1
            check(passed)
            if passed:
                break
    return stopped


def test_a_save_stopped_at_any_step_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    sizes = iter(range(5, 500))
    state = {"old": next(sizes)}
    Warehouse(spark, root).save(spark.range(state["old"]), "marts.numbers")
    Warehouse(spark, root).save(spark.range(state["old"]), "marts.numbers")

    def work():
        state["new"] = next(sizes)
        Warehouse(spark, root).save(spark.range(state["new"]), "marts.numbers")

    def check(passed):
        now = Warehouse(spark, root).table("marts.numbers").count()
        assert now == state["new"] if passed else now in (state["old"], state["new"])
        state["old"] = now

    assert until_it_passes(monkeypatch, work, check) >= 6
    kept = [n for n in os.listdir(tmp_path / "wh" / "marts" / "numbers") if n.startswith(versions.POINTER)]
    assert len(kept) <= 3


def test_a_first_save_that_was_stopped_is_no_table(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path))
    with monkeypatch.context() as patch:
        Stop(patch, 1, True)
        with pytest.raises(Killed):
            wh.save(spark.range(3), "marts.numbers")
    assert not wh.exists("marts.numbers")
    with pytest.raises(FileNotFoundError):
        wh.table("marts.numbers")
    wh.save(spark.range(4), "marts.numbers")
    assert wh.exists("marts.numbers") and wh.table("marts.numbers").count() == 4


def test_a_query_goes_on_reading_the_version_it_opened(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.save(spark.range(3), "marts.numbers")
    opened = wh.table("marts.numbers")
    wh.save(spark.range(4), "marts.numbers")
    assert opened.count() == 3 and wh.table("marts.numbers").count() == 4


def test_unversioned_tables_are_read_and_replaced(spark, tmp_path):
    spark.range(6).write.parquet(str(tmp_path / "marts" / "numbers"))
    wh = Warehouse(spark, str(tmp_path))
    assert wh.table("marts.numbers").count() == 6
    wh.save(spark.range(2), "marts.numbers")
    assert wh.table("marts.numbers").count() == 2


def test_the_serving_copy_changes_as_a_whole(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))

    def fill(n):
        wh.save(spark.range(n).selectExpr(*[f"id as {c}" for c in S.STAGING_COLUMNS]), S.STAGING_TRIPS)
        for name in (S.DIM_STATIONS, S.RPT_HOURLY_DEMAND, S.RPT_STATION_ACTIVITY, S.RPT_ROUTE_POPULARITY):
            wh.save(spark.range(n), name)

    out = str(tmp_path / "serving")
    fill(2)
    export_serving(spark, wh, out)
    fill(3)
    for before in (True, False):
        for at in (1, 3, 9, 12):
            with monkeypatch.context() as patch:
                Stop(patch, at, before)
                try:
                    export_serving(spark, wh, out)
                except Killed:
                    pass
            served = Warehouse(spark, out)
            sizes = {served.table(n).count() for n in (S.STAGING_TRIPS, S.DIM_STATIONS, S.RPT_ROUTE_POPULARITY)}
            assert sizes in ({2}, {3})


def test_an_ingest_stopped_at_any_step_is_completed_or_undone(spark, folder, monkeypatch):
    raw, lake, manifest = folder + "/raw", folder + "/lake", folder + "/m/manifest.json"
    os.makedirs(raw.replace("file://", ""))
    write_text(raw, "metro-trips-2026-q1.csv", "\n".join([TRIP_HEADER, row("1"), row("2")]) + "\n")
    write_text(raw, "metro-trips-2025-q4.csv", "\n".join([TRIP_HEADER, row("9")]) + "\n")
    ingest_trips(spark, raw, lake, manifest, STAMP)
    runs = {"n": 0}

    def state():
        rows = sorted((r["source_quarter"], r["trip_id"]) for r in read_trip_lake(spark, lake).collect())
        records = sorted((r["source_quarter"], r["cleaned_rows"]) for r in read_manifest(spark, manifest).collect())
        return rows, records

    def work():
        runs["n"] += 1
        ids = [str(100 + 10 * runs["n"] + k) for k in range(3 + runs["n"] % 2)]
        write_text(raw, "metro-trips-2026-q1.csv", "\n".join([TRIP_HEADER, *(row(i) for i in ids)]) + "\n")
        quarter = [row("9", duration="0" if runs["n"] % 2 else "8")]  # empties its quarter, or fills it again
        write_text(raw, "metro-trips-2025-q4.csv", "\n".join([TRIP_HEADER, *quarter]) + "\n")
        ingest_trips(spark, raw, lake, manifest, STAMP + dt.timedelta(minutes=runs["n"]))

    outcomes = {"completed": 0, "undone": 0}

    def check(passed):
        for kind, found in journal.recover(spark, lake).items():
            outcomes[kind] += len(found)
        rows, records = state()
        held = {q: sum(1 for quarter, _ in rows if quarter == q) for q, _ in records}
        assert held == dict(records)
        assert not [n for n in os.listdir(folder.replace("file://", "")) if "ingest-" in n]

    assert until_it_passes(monkeypatch, work, check) >= 8
    assert outcomes["completed"] and outcomes["undone"]
