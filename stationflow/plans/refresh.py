"""Incremental staging (M3, F1): quarters are replaced one by one, and the rows
already there are never shuffled again.

``staging/trip_rows`` under the warehouse root holds every valid raw row (C4),
one versioned folder per quarter, each bucketed by trip_id into the same number
of buckets. A refresh shuffles the rows of the named quarters only, into their
buckets; choosing the first row per trip_id (F1) then reads bucket by bucket
over all quarters, without an exchange, and writes ``staging.trips`` from the
same tasks. Rows that lost against a quarter are kept, so a quarter that is
published again without some trips brings back other quarters' rows of them.

A lake quarter holds a trip_id at most once (F3), so no bucket has a hot key.
The number of buckets follows the largest quarter at the first refresh and then
stays, for the buckets of all quarters must match; ``rebuild`` chooses anew.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce
from typing import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import models as M
from ..sinks import files, versions
from ..sinks.tables import Warehouse
from ..sources.lake import read_trip_lake

#: Compressed lake bytes of one quarter that go into one bucket.
BUCKET_BYTES = 128 * 1024 * 1024
_QUARTER = ["source_year", "source_quarter"]
Quarter = tuple[int, int]


def rows_root(wh: Warehouse) -> str:
    return f"{wh.root}/staging/trip_rows"


def _folder(wh: Warehouse, quarter: Quarter) -> str:
    return f"{rows_root(wh)}/{quarter[0]}-{quarter[1]}"


def bucket_count(wh: Warehouse, lake_dir: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The buckets of the table, fixed at its first refresh."""
    known = f"{rows_root(wh)}/_buckets"
    if files.found(wh.spark, known):
        return int(files.read_text(wh.spark, known))
    sizes = [files.size(wh.spark, q) for q in files.folders(wh.spark, f"{lake_dir.rstrip('/')}/year=*/quarter=*")]
    count = max(1, -(-max(sizes, default=0) // bucket_bytes))
    files.write_text(wh.spark, known, str(count))
    return count


def lake_quarters(spark: SparkSession, lake_dir: str) -> list[Quarter]:
    """The quarters of the lake, from its folder names."""
    found = files.folders(spark, f"{lake_dir.rstrip('/')}/year=*/quarter=*")
    return sorted(tuple(int(part.split("=")[1]) for part in path.split("/")[-2:]) for path in found)


def held_quarters(wh: Warehouse) -> list[Quarter]:
    """The quarters that have a committed version."""
    found = files.folders(wh.spark, f"{rows_root(wh)}/*-*")
    held = [tuple(int(n) for n in path.rsplit("/", 1)[-1].split("-")) for path in found]
    return sorted(q for q in held if versions.current(wh.spark, _folder(wh, q)))


def replace_quarters(wh: Warehouse, lake_dir: str, quarters: Sequence[Quarter], buckets: int) -> None:
    """Write the valid rows of these lake quarters into their buckets; a
    quarter without rows becomes an empty version."""
    spark = wh.spark
    lake = read_trip_lake(spark, lake_dir)
    wanted = reduce(lambda a, b: a | b, [(F.col("year") == y) & (F.col("quarter") == q) for y, q in quarters])
    rows = M.valid_trips(lake.where(wanted)).repartition(buckets, M.STAGING_DEDUP_KEY)
    staged = files.staging_for(rows_root(wh))
    name = f"stationflow_rows_{uuid.uuid4().hex[:12]}"
    try:
        (rows.write.format("parquet").option("path", staged).partitionBy(*_QUARTER)
         .bucketBy(buckets, M.STAGING_DEDUP_KEY).sortBy(M.STAGING_DEDUP_KEY).saveAsTable(name))
        for quarter in quarters:
            version = versions.fresh(_folder(wh, quarter))
            written = f"{staged}/source_year={quarter[0]}/source_quarter={quarter[1]}"
            if files.found(spark, written):
                files.move_over(spark, written, version)
            else:
                files.write_text(spark, f"{version}/_empty", "")
            versions.commit(spark, version)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        files.delete(spark, staged)


@contextmanager
def bucketed_rows(wh: Warehouse, buckets: int) -> Iterator[DataFrame]:
    """All held rows as a bucketed table, for plans made inside the ``with``."""
    spark = wh.spark
    name = f"stationflow_rows_{uuid.uuid4().hex[:12]}"
    types = {f.name: f.dataType.simpleString() for f in M.raw_schema().fields}
    columns = ", ".join(f"`{c}` {types[c]}" for c in [*[c for c in types if c not in _QUARTER], *_QUARTER])
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(_QUARTER)}) "
              f"CLUSTERED BY ({M.STAGING_DEDUP_KEY}) SORTED BY ({M.STAGING_DEDUP_KEY}) INTO {buckets} BUCKETS "
              f"LOCATION '{rows_root(wh)}/_table'")
    try:
        for year, quarter in held_quarters(wh):
            spark.sql(f"ALTER TABLE {name} ADD PARTITION (source_year={year}, source_quarter={quarter}) "
                      f"LOCATION '{versions.current(spark, _folder(wh, (year, quarter)))}'")
        yield spark.table(name).select(*S.RAW_TRIP_COLUMNS)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def first_rows(rows: DataFrame) -> DataFrame:
    """staging.trips of the bucketed rows: no exchange, each bucket on its own."""
    return M.project_staging(M.first_per_trip(rows))


def refresh_staging(wh: Warehouse, lake_dir: str, quarters: Sequence[Quarter] | None = None,
                    bucket_bytes: int = BUCKET_BYTES) -> int:
    """Bring ``staging.trips`` up to date after these quarters of the lake were
    published (again); quarters that are not held yet, or are no longer in the
    lake, are brought in line too. None: all of them. Returns the rows written."""
    buckets = bucket_count(wh, lake_dir, bucket_bytes)
    there, held = lake_quarters(wh.spark, lake_dir), held_quarters(wh)
    named = there if quarters is None else [q for q in quarters if q in there]
    changed = sorted({*named, *(q for q in there if q not in held)})
    if changed:
        replace_quarters(wh, lake_dir, changed, buckets)
    for quarter in held:
        if quarter not in there:
            files.delete(wh.spark, _folder(wh, quarter))
    with bucketed_rows(wh, buckets) as rows:
        return wh.save(first_rows(rows), S.STAGING_TRIPS)


def rebuild(wh: Warehouse, lake_dir: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Start anew, with a number of buckets for today's quarters."""
    files.delete(wh.spark, rows_root(wh))
    return refresh_staging(wh, lake_dir, None, bucket_bytes)
