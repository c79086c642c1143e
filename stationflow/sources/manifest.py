"""Manifest source (A9): the JSON document {"files": [...], "updated_at": ...}."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import glob_exists
from .local import rows_frame


def read_manifest_document(spark: SparkSession, path: str) -> DataFrame | None:
    """The document as one row (files, updated_at); None when absent."""
    if not glob_exists(spark, path):
        return None
    return spark.read.schema(S.MANIFEST_DOCUMENT).option("multiLine", True).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The file records; an empty typed frame when there is no manifest."""
    doc = read_manifest_document(spark, path)
    if doc is None:
        return rows_frame(spark, [], S.MANIFEST_RECORD)
    return doc.select(F.explode("files").alias("f")).select("f.*")


def manifest_updated_at(spark: SparkSession, path: str) -> DataFrame:
    """``updated_at`` as a one-row frame ('unknown' when absent)."""
    doc = read_manifest_document(spark, path)
    if doc is None:
        return spark.range(1).select(F.lit("unknown").alias("updated_at"))
    return doc.select(F.coalesce("updated_at", F.lit("unknown")).alias("updated_at"))
