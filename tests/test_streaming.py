import os

from helpers import TRIP_HEADER, write_text
from test_ingest import row
from stationflow.sources.lake import read_trip_lake
from stationflow.sources.manifest import read_manifest
from stationflow.streaming import ingest_new_trip_files


def test_incremental_ingest_takes_only_new_files(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    lake, manifest, ckpt = folder + "/lake", folder + "/m.json", folder + "/ckpt"
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("1") + "\n" + row("1", "9") + "\n")
    seen = []
    q = ingest_new_trip_files(spark, raw, lake, manifest, ckpt, on_batch=lambda i, r: seen.append(r.cleaned_rows))
    q.awaitTermination(120)
    assert seen == [{"metro-trips-2026-q1.csv": 1}]
    write_text(raw, "metro-trips-2026-q2.csv", TRIP_HEADER + "\n" + row("2", start="4/2/2026 8:00", end="4/2/2026 8:08") + "\n")
    q = ingest_new_trip_files(spark, raw, lake, manifest, ckpt, on_batch=lambda i, r: seen.append(r.cleaned_rows))
    q.awaitTermination(120)
    assert seen[1:] == [{"metro-trips-2026-q2.csv": 1}]
    assert sorted((r["trip_id"], r["quarter"]) for r in read_trip_lake(spark, lake).collect()) == [(1, 1), (2, 2)]
    assert sorted(r["source_file"] for r in read_manifest(spark, manifest).collect()) == [
        "metro-trips-2026-q1.csv", "metro-trips-2026-q2.csv"]


def test_watching_stream_processes_new_files_until_stopped(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    lake, manifest, ckpt = folder + "/lake", folder + "/m.json", folder + "/ckpt"
    write_text(raw, "metro-trips-2026-q1.csv", TRIP_HEADER + "\n" + row("5") + "\n")
    q = ingest_new_trip_files(spark, raw, lake, manifest, ckpt, available_now=False)
    try:
        q.processAllAvailable()
        assert [r["trip_id"] for r in read_trip_lake(spark, lake).collect()] == [5]
    finally:
        q.stop()
    assert not q.isActive


def test_a_late_file_with_an_old_date_is_ingested(spark, folder):
    raw = folder + "/raw"
    os.makedirs(raw.replace("file://", ""))
    lake, manifest, ckpt = folder + "/lake", folder + "/m.json", folder + "/ckpt"
    for n, name in ((1, "metro-trips-2026-q1.csv"), (2, "metro-trips-2025-q4.csv")):
        write_text(raw, name, TRIP_HEADER + "\n" + row(str(n)) + "\n")
        if n == 2:
            path = raw.replace("file://", "") + "/" + name
            month_ago = os.path.getmtime(path) - 30 * 86400
            os.utime(path, (month_ago, month_ago))
        ingest_new_trip_files(spark, raw, lake, manifest, ckpt).awaitTermination(120)
    assert {r["trip_id"] for r in read_trip_lake(spark, lake).collect()} == {1, 2}
