"""Hot keys: the dedup shuffle carries at most one row per key per map task."""

from helpers import raw_trips, trip
from stationflow.operators import models as M


def _children(node):
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def shuffle_records(df) -> list[int]:
    """Records written by each shuffle exchange of an executed plan."""
    plan = df._jdf.queryExecution().executedPlan()
    found, stack = [], [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            stack.append(node.plan())
            continue
        if "Exchange" in name and node.metrics().contains("shuffleRecordsWritten"):
            found.append(int(node.metrics().apply("shuffleRecordsWritten").value()))
        stack.extend(_children(node))
    return found


def test_hot_keys_are_cut_before_the_shuffle(spark):
    rows = ([trip(None, minutes=5 + i % 50) for i in range(1000)]
            + [trip(7, minutes=5 + i % 50) for i in range(1000)]
            + [trip(100 + i) for i in range(1000)])
    raw = raw_trips(spark, rows)
    tasks = raw.rdd.getNumPartitions()
    stg = M.build_staging_trips(raw)
    out = stg.collect()
    assert len(out) == 1002
    kept = {r["trip_id"]: r for r in out if r["trip_id"] in (None, "7")}
    assert kept[None]["duration_minutes"] == 5 and kept["7"]["duration_minutes"] == 5
    written = shuffle_records(stg)
    # the only exchange (by trip_id, after the partial limit) carries the
    # 1000 distinct ids plus at most one null and one '7' row per input task
    assert written and max(written) <= 1000 + 2 * tasks, (written, tasks)


def test_file_dedup_is_limited_before_its_shuffle(spark, tmp_path):
    import datetime as dt
    from helpers import TRIP_HEADER
    from test_ingest import row
    from stationflow.sources import trips as TR
    lines = [TRIP_HEADER] + [row("", str(5 + i % 40)) for i in range(300)] + [row(str(i)) for i in range(1, 50)]
    path = tmp_path / "metro-trips-2026-q1.csv"
    path.write_text("\n".join(lines) + "\n")
    df = TR.cleaned_trips(spark, ["file://" + str(path)], dt.datetime(2026, 6, 14, tzinfo=dt.timezone.utc))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    rows = df.collect()
    assert len(rows) == 50
    assert [r["duration"] for r in rows if r["trip_id"] is None] == [5]
