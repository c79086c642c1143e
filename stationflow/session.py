"""Session helpers: the settings the library relies on, and the shared scratch folder.

The library assumes a UTC session time zone (naive trip times are
``timestamp_ntz`` and never shift; ``ingested_at`` is an instant shown in UTC).
Everything else is left to the cluster's own configuration.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import SparkSession

# Runtime SQL settings applied by ``prepare``; AQE re-plans joins and
# coalesces shuffle partitions from runtime statistics, and splits skewed
# join partitions when one key holds a large share of the rows.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str = "local[*]", app_name: str = "stationflow",
              shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    shared_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library's semantics depend on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each action inside the ``with`` are deleted as it
    ends. Otherwise they stay until the driver happens to collect garbage, and
    a run of many steps needs the disk for the shuffles of all of them."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS, object store or a shared mount);
    only a local-mode session without one gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="stationflow-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder for one job's files."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/stationflow/{label}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    """Path existence through Hadoop's file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def glob_exists(spark: SparkSession, pattern: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath)
    return found is not None and len(found) > 0

