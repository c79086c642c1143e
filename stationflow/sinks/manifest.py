"""Manifest sink (B9, B10): one JSON document written next to the data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import glob_exists
from . import files


def utc_now_iso() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def write_manifest(spark: SparkSession, records: DataFrame, path: str,
                   updated_at: str | None = None) -> str:
    """Write the records as the manifest document, ordered by (year,
    quarter), stamped ``updated_at`` (UTC now by default). The records are
    one per source file, so the document is gathered in one task. Written to
    a staging folder first and then moved into place."""
    stamp = updated_at or utc_now_iso()
    keyed = records.select(
        F.struct("source_year", "source_quarter", "source_file").alias("k"),
        F.struct(*S.MANIFEST_COLUMNS).alias("r"),
    )
    doc = keyed.agg(F.sort_array(F.collect_list(F.struct("k", "r"))).alias("files")).select(
        F.to_json(F.struct(
            F.transform(F.coalesce("files", F.array()), lambda x: x["r"]).alias("files"),
            F.lit(stamp).alias("updated_at"),
        )).alias("value")
    )
    staged = files.staging_for(path)
    doc.coalesce(1).write.mode("overwrite").text(staged)
    files.single_part_to_file(spark, staged, path)
    return stamp


def copy_manifest(spark: SparkSession, source: str, target: str) -> bool:
    """Copy the manifest, byte for byte, beside the serving copy; no-op
    when absent."""
    if not glob_exists(spark, source):
        return False
    files.copy_file(spark, source, target)
    return True
