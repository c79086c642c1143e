"""Ingestion manifest operators.

The manifest holds one record per ingested source file, so it grows with the
number of files, not with the data. It is a DataFrame of records here; the
JSON document form is read and written by ``sources.manifest`` and
``sinks.manifest``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import expressions as X


def records_from_counts(counts: DataFrame, source_dir: str, lake_dir: str, ingested_at: str) -> DataFrame:
    """Manifest records from per-file cleaned row counts
    (columns source_file, source_year, source_quarter, cleaned_rows)."""
    return counts.select(
        F.col("source_file").cast("string"),
        F.concat(F.lit(source_dir.rstrip("/") + "/"), F.col("source_file")).alias("source_path"),
        F.col("source_year").cast("bigint"),
        F.col("source_quarter").cast("bigint"),
        F.col("cleaned_rows").cast("bigint"),
        F.format_string(lake_dir.rstrip("/") + "/year=%d/quarter=%d",
                        F.col("source_year"), F.col("source_quarter")).alias("output_path"),
        F.lit(ingested_at).alias("ingested_at"),
    )


def manifest_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("source_year").asc_nulls_last(), F.col("source_quarter").asc_nulls_last(),
                      F.col("source_file").asc_nulls_last())


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Drop old records of the same source_file, add the new ones,
    order by (year, quarter)."""
    kept = old.select(*S.MANIFEST_COLUMNS).join(new.select("source_file"), "source_file", "left_anti")
    return manifest_order(kept.unionByName(new.select(*S.MANIFEST_COLUMNS)))


def summary(records: DataFrame, updated_at: str | None = None) -> DataFrame:
    """The latest file's quarter (max by (year, quarter)), the number of
    files and the update stamp, as one row."""
    latest = F.max_by(F.struct("source_year", "source_quarter"),
                      F.struct("source_year", "source_quarter"))
    out = records.agg(latest.alias("_latest"), F.count(F.lit(1)).alias("files_processed")).select(
        F.col("_latest.source_year").alias("latest_year"),
        F.col("_latest.source_quarter").alias("latest_quarter"),
        F.concat(F.col("_latest.source_year").cast("string"), F.lit(" Q"),
                 F.col("_latest.source_quarter").cast("string")).alias("latest_quarter_label"),
        "files_processed",
    )
    if updated_at is not None:
        out = out.withColumn("updated_at", F.lit(updated_at))
    return out


def for_quarter(records: DataFrame, quarter: str = X.ALL_QUARTERS) -> DataFrame:
    """Manifest rows of one quarter (all rows for 'All Quarters')."""
    return X.where(records, [X.quarter_filter(quarter)])


def archive_catalog_from_quarters(quarters: DataFrame, base_url: str) -> DataFrame:
    """Archive links (url, file_name, csv_file_name, year, quarter) for the
    given (year, quarter) rows, named like the published archives."""
    name = F.format_string("metro-trips-%d-q%d", F.col("year"), F.col("quarter"))
    return quarters.select(
        F.concat(F.lit(base_url.rstrip("/") + "/"), name, F.lit(".zip")).alias("url"),
        F.concat(name, F.lit(".zip")).alias("file_name"),
        F.concat(name, F.lit(".csv")).alias("csv_file_name"),
        F.col("year").cast("bigint").alias("year"),
        F.col("quarter").cast("bigint").alias("quarter"),
    )


def select_new(links: DataFrame, existing_csv_names: DataFrame) -> DataFrame:
    """Links whose CSV is not there yet (anti join on the CSV name)."""
    have = existing_csv_names.select(F.col("csv_file_name").alias("_have"))
    return links.join(have, links["csv_file_name"] == have["_have"], "left_anti")


def selection_counts(links: DataFrame, existing_csv_names: DataFrame) -> DataFrame:
    """Found / new / skipped counts as one row."""
    have = existing_csv_names.select(F.col("csv_file_name").alias("_have")).distinct()
    marked = links.join(have, links["csv_file_name"] == have["_have"], "left")
    return marked.agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.col("_have").isNull()).alias("new"),
        F.count_if(F.col("_have").isNotNull()).alias("skipped"),
    )
