"""Keep-first deduplication (row_number() = 1 per key).

``row_number() over (partition by k order by o) = 1`` is planned by Spark as
a partial ``WindowGroupLimit`` before the shuffle and a final one after it, so
each map task forwards at most one row per key: a hot key (even null, which is
one group) costs one row per map task in the shuffle, not all its rows.

Orders are completed with every remaining column, so the row kept is the same
on any retry: a task recomputed after an executor loss sees its shuffle input
in another order, and a tie broken by arrival order would change the result.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__stationflow_rn"


def total_order(df: DataFrame, order: Sequence[Column], used: Sequence[str]) -> list[Column]:
    """``order`` followed by every other column ascending, nulls last."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in set(used)]
    return list(order) + rest


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               order_columns: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (made total)."""
    full = total_order(df, order, list(keys) + list(order_columns))
    w = Window.partitionBy(*keys).orderBy(*full)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


FILE_BLOCK = "__file_block"
FILE_ROW = "__file_row"
FILE_POSITION = [FILE_BLOCK, FILE_ROW]


def with_file_position(df: DataFrame) -> DataFrame:
    """Row position within its source file, taken right after a file scan.

    Files are split into blocks; ``_metadata.file_block_start`` orders the
    blocks of one file and ``monotonically_increasing_id`` the rows inside a
    block (a block is read front to back by one task, and a re-run task reads
    it the same way). Two plain long columns, so sorts use prefix keys. Must
    be applied to the scan output, before any shuffle or filter."""
    return df.withColumn(FILE_BLOCK, F.col("_metadata.file_block_start")).withColumn(
        FILE_ROW, F.monotonically_increasing_id()
    )


def keep_first_in_file(df: DataFrame, file_col: str, keys: Sequence[str],
                       position: Sequence[str] = tuple(FILE_POSITION), grouped: Sequence[str] = ()) -> DataFrame:
    """One row per (file, keys): the first in file order (pandas
    ``drop_duplicates(keep='first')`` semantics, nulls equal). ``grouped`` are
    columns with one value per file; each task's rows leave sorted by them, so
    that a write partitioned by them needs no sort of its own."""
    w = Window.partitionBy(*grouped, file_col, *keys).orderBy(*[F.col(c).asc() for c in position])
    return (
        df.withColumn(_RN, F.row_number().over(w))
        .filter(F.col(_RN) == 1)
        .drop(_RN)
    )
