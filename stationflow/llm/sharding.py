"""Sharding by sampled splitters (law ``bytes``).

Rows are ordered by (text hash, size, checksum, id), so equal texts lie side by side. Size-weighted key samples give
quantile boundaries, overfull ranges are subdivided (``ranges``), and exact range totals turn the order into byte
offsets: shard s holds the rows that begin in [s, s + 1) * total / shards. A group of equal texts that straddles a
boundary goes whole to the lower shard if it is at most ``1 / group_share`` of a shard; a larger group is cut at the
boundary, so no group can overfill a shard. Sizes therefore differ by at most one row plus that share.

Defined results: a null text has no bytes (size 1, checksum 0) and forms one group with the empty texts; a null id is
kept and sorts first; repeated rows each get a slot; an empty table gives an empty result; further columns are
ignored unless ``carry`` names them, and none of them can clash with the computed names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.ranges import global_order
from stationflow.llm.tables import Scratch

SHARDS = 8
#: Equal texts up to this part of a shard (1 / 100) stay in one shard; of more of them no shard could stay even.
GROUP_SHARE = 100


def slim(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """Sort key, size and checksum of every row; carried columns go into one struct, so names cannot clash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = text.cast("binary")
    return docs.select(
        F.struct(F.xxhash64(text).alias("h"), F.octet_length(text).alias("n"), F.crc32(raw).alias("c"),
                 F.col(id_col).cast("bigint").alias("i")).alias("k"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(None).alias("carried"))


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           carry: list[str] | None = None, group_share: int = GROUP_SHARE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law), carried columns last."""
    carry = carry or []
    scratch = Scratch(docs.sparkSession, "shards")
    rows = scratch.keep(slim(docs, id_col, text_col, carry), "keys")
    total = int(rows.agg(F.sum("size")).first()[0] or 0)
    placed = global_order(rows, scratch)
    first = F.least(F.floor(F.col("byte_offset") * F.lit(shards).cast("decimal(20,0)") / F.lit(max(total, 1))),
                    F.lit(shards - 1)).cast("int")
    placed = scratch.keep(placed.withColumn("shard", first), "placed")
    group = [F.col("k.h").alias("h"), F.col("k.n").alias("n"), F.col("k.c").alias("c")]
    # at most one group per inner boundary straddles it: shards - 1 rows
    astride = (placed.groupBy(*group).agg(F.min("shard").alias("low"), F.max("shard").alias("high"),
                                          F.sum("size").alias("bytes"))
               .where(F.col("low") < F.col("high"))
               .where(F.col("bytes") <= F.lit(max(1, total // (shards * group_share))))).collect()
    shard = F.col("shard")
    for g in astride:
        same = (F.col("k.h") == g["h"]) & (F.col("k.n") == g["n"]) & (F.col("k.c") == g["c"])
        shard = F.when(same, F.lit(g["low"])).otherwise(shard)
    placed = placed.withColumn("shard", shard)
    starts = {r[0]: r[1] for r in placed.groupBy("shard").agg(F.min("row_index")).collect()} or {0: 0}
    begin = F.expr("map(" + ", ".join(f"{s}, {i}L" for s, i in starts.items()) + ")")
    out = [F.col("k.i").alias("doc_id"), F.col("size"), F.col("k.c").alias("text_crc32"), F.lit("bytes").alias("law"),
           F.col("shard"), (F.col("row_index") - F.element_at(begin, F.col("shard"))).alias("slot"),
           F.lit(None).cast("int").alias("grown_shard")]
    return placed.select(*out, *[F.col(f"carried.`{c}`") for c in carry])


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """The rows themselves as Parquet, one folder per shard, each file sorted by slot."""
    names = {"size", "text_crc32", "law", "shard", "slot", "grown_shard", id_col}
    others = [c for c in docs.columns if c not in names]
    out = assign(docs, shards, id_col, text_col, carry=others)
    (out.withColumn("part", F.floor(F.col("slot") / F.lit(1_000_000)))
     .repartition("shard", "part").sortWithinPartitions("shard", "slot").drop("part")
     .write.partitionBy("shard").parquet(path))
