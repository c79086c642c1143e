"""Shared Spark helpers of the operators: written intermediate tables, bounded collection, connected components.

Intermediate tables are Parquet in the shared folder (``spark.checkpoint.dir``), so they outlive an executor and cut
the lineage. A table that no later step reads is deleted by the operator itself; the ones behind a lazy result stay
as long as the folder does, which belongs to the session's owner.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of one Arrow batch between Spark and a Python worker; Spark's own bound of 64 MB counts several times per task.
ARROW_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session's Python functions by bytes: a row of theirs holds a whole text."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, whose worker returns its free memory when a task ends: Spark keeps idle workers for later tasks."""
    @wraps(run)
    def within(batches: Batches) -> Batches:
        yield from run(batches)
        give_back()
    return within


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


class Scratch:
    """Written tables of one operator call, under one fresh shared folder."""

    def __init__(self, spark: SparkSession, label: str):
        bounded_batches(spark)
        self.spark = spark
        self.root = scratch_path(spark, label)
        self._count = 0
        self._paths: dict[int, str] = {}

    def path(self, label: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{label}"

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` written once and read back; later uses neither recompute it nor depend on its executors."""
        path, schema = self.path(label), df.schema
        df.write.parquet(path)
        release(self.spark)
        out = self.spark.read.schema(schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that nothing reads any more."""
        for df in tables:
            path = self._paths.pop(id(df), None)
            if path:
                jvm = self.spark.sparkContext._jvm
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished jobs (it acts on the driver's garbage collection)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def empty(df: DataFrame) -> bool:
    return not df.take(1)


def signature(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free checksum of a table."""
    total = F.sum(F.xxhash64(*df.columns).cast(T.DecimalType(38, 0)))
    row = df.agg(F.count(F.lit(1)), total).first()
    return int(row[0]), int(row[1] or 0)


def components(edges: DataFrame, scratch: Scratch, label: str = "components", most_rounds: int = 60) -> DataFrame:
    """Connected components of the pairs (a, b): rows (id, component), the smallest id reachable.

    Large-star and small-star steps alternate until the pairs no longer change. Each step is a partial minimum and a
    join on the same key, so a hub is pre-aggregated before its shuffle, and the join side can be split by AQE. Only
    ids that occur in a pair with a different id get a row.
    """
    now = (edges.where(F.col("a") != F.col("b"))
           .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now = scratch.keep(now, label)
    seen = signature(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        step = (small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        step = scratch.keep(step, label)
        scratch.drop(now)
        now, before = step, seen
        seen = signature(now)
        if seen == before:
            roots = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
    raise RuntimeError("components did not settle")


def uniform(seed: int, *columns: Column) -> Column:
    """A repeatable value in [0, 1) from a seed and some columns."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


#: Bits of an id filter: 2 MB, whatever the number of ids.
FILTER_BITS = 1 << 24


class IdFilter:
    """A fixed-size bitmap over hashed ids: lets through every id of a table, and few others while it is sparse.

    It thins out what a task emits before a shuffle; an exact join always follows, so a full bitmap costs time only.
    """

    def __init__(self, ids: DataFrame):
        slot = F.col("id").bitwiseXOR(F.shiftrightunsigned("id", 23)).bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
        parts = (ids.where("id is not null").select(slot.alias("s"))
                 .groupBy(F.bitmap_bucket_number("s").alias("bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")))
        self.bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for bucket, bits in parts.collect():
            at = (int(bucket) - 1) * len(bits)
            self.bits[at: at + len(bits)] = np.frombuffer(bits, np.uint8)

    def passes(self, ids: np.ndarray) -> np.ndarray:
        """Which of the ids may be in the table."""
        u = ids.view(np.uint64)
        slot = ((u ^ (u >> np.uint64(23))) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
