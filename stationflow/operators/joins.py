"""Fact-to-dimension joins (trips -> stations), start and end roles.

The station dimension has one row per station, so it is small, but its size
is checked rather than assumed before the broadcast hint is given: the
optimizer's size estimate (from the Parquet file sizes it scans; no job runs)
must be within ``stationflow.dimBroadcastMaxBytes`` (16 MiB; Parquet sizes are
compressed, rows in memory are several times larger).

Otherwise the join stays a shuffle join, which AQE may still turn into a
broadcast from runtime sizes and whose skewed partitions (one station holding
many trips) AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_MAX_BYTES = 16 * 1024 * 1024


def estimated_size(df: DataFrame) -> int:
    """Optimizer size estimate in bytes; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    value = df.sparkSession.conf.get(key, None)
    return int(value) if value else default


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when the estimate of ``df`` is within the broadcast bound."""
    limit = max_bytes if max_bytes is not None else _conf_int(
        df, "stationflow.dimBroadcastMaxBytes", DEFAULT_BROADCAST_MAX_BYTES)
    return estimated_size(df) <= limit


def broadcast_if_small(df: DataFrame, small: bool | None = None) -> DataFrame:
    """Broadcast hint only when the side is proven small (see module doc)."""
    if small is None:
        small = is_small(df)
    return F.broadcast(df) if small else df


def station_role(dim: DataFrame, prefix: str, columns=None) -> DataFrame:
    """The dimension with every column renamed ``prefix + name``."""
    cols = columns or dim.columns
    if "station_id" not in cols:
        cols = ["station_id"] + list(cols)
    return dim.select([F.col(c).alias(f"{prefix}{c}") for c in cols])
