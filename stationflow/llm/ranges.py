"""Sampled splitters: a global order over rows without a global sort.

Size-weighted samples of the sort key give quantile boundaries, rows are put into the ranges between them, and ranges
that turn out overfull are sampled again and subdivided. Exact totals per range then give every row its position and
its byte offset in the whole order, with one window per range. A key held by many rows is split between ranges as
long as the key columns tell the rows apart. Only the boundaries (at most a few hundred rows) come to the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.tables import Scratch, uniform

RANGES = 96
SAMPLES_PER_RANGE = 48
#: A range is overfull above this many times the mean.
OVERFULL = 2
ROUNDS = 3


def _range_of(key: Column, bounds: Column) -> Column:
    """The number of boundaries at or below the key: 0 .. len(bounds)."""
    return F.size(F.filter(bounds, lambda b: b <= key))


def _constant(bounds: list, key_type) -> Column:
    """Boundaries as one constant array (folded once by the optimizer)."""
    rows = json.dumps([dict(zip(key_type.names, b)) for b in bounds])
    return F.from_json(F.lit(rows), f"array<{key_type.simpleString()}>")


def _lookup(values: dict, kind: str) -> Column:
    """A constant map from range to value."""
    pairs = ", ".join(f"{r}, cast({v} as {kind})" for r, v in values.items())
    return F.expr(f"map({pairs})")


def _weighted_quantiles(sample: DataFrame, pieces: Column) -> DataFrame:
    """Per range, the sampled keys where the cumulative weight passes a multiple of total / pieces."""
    order = Window.partitionBy("r").orderBy("k")
    whole = Window.partitionBy("r")
    upto = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    step = F.sum("w").over(whole) / pieces
    cut = sample.select("r", "k", F.floor((upto - F.col("w")) / step).alias("lo"), F.floor(upto / step).alias("hi"),
                        pieces.alias("p"))
    return cut.where("hi > lo and hi >= 1 and hi < p").select("k").distinct()


def splitters(rows: DataFrame, ranges: int = RANGES, seed: int = 7) -> tuple[list, dict]:
    """Boundaries of ``rows`` (columns k: struct key, size: long) and the exact totals per range.

    A row is drawn with probability min(1, rate * size / total) from a hash of its key, so the draw repeats exactly
    after a lost executor; its weight is its size divided by that probability.
    """
    total = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    size, count = int(total[0] or 0), int(total[1])
    if not count:
        return [], {}
    limit = OVERFULL * size / ranges
    bounds: list = []
    key_type = rows.schema["k"].dataType

    totals = {0: (size, count)}
    for turn in range(ROUNDS + 1):
        if turn:
            totals = {r: (int(s), int(n)) for r, s, n in rows.select(_range_of(F.col("k"), _constant(bounds, key_type)).alias("r"), "size")
                      .groupBy("r").agg(F.sum("size"), F.count(F.lit(1))).collect()}
        over = {r: s for r, (s, n) in totals.items() if s > limit and n > 1}
        if not over or turn == ROUNDS:
            break
        parts = {r: max(2, min(ranges, round(s * ranges / size))) for r, s in over.items()}
        table, pieces = _lookup(over, "double"), _lookup(parts, "int")
        placed = rows.select(_range_of(F.col("k"), _constant(bounds, key_type)).alias("r"), "k", "size").where(F.col("r").isin(list(over)))
        rate = F.least(F.lit(1.0), SAMPLES_PER_RANGE * F.element_at(pieces, F.col("r")) * F.col("size")
                       / F.element_at(table, F.col("r")))
        drawn = (placed.withColumn("rate", rate).where(uniform(seed + turn, F.col("k")) < F.col("rate"))
                 .select("r", "k", (F.col("size") / F.col("rate")).alias("w")))
        new = [tuple(row[0]) for row in _weighted_quantiles(drawn, F.element_at(pieces, F.col("r"))).collect()]
        before = len(bounds)
        bounds = _sorted(bounds + new)
        if len(bounds) == before:
            break
    return bounds, totals


def _sorted(bounds: list) -> list:
    """Distinct boundaries in Spark's order of the key (nulls first; strings by UTF-8 bytes)."""
    return sorted(set(bounds), key=lambda b: tuple((v is not None, v) for v in b))


def global_order(rows: DataFrame, scratch: Scratch, ranges: int = RANGES, seed: int = 7) -> DataFrame:
    """``rows`` (k: struct key, size: long, others) with ``row_index`` and ``byte_offset`` in the order of k.

    Rows with equal keys follow each other in no fixed order. The totals per range are at most a few hundred rows and
    come back as a literal map.
    """
    bounds, totals = splitters(rows, ranges, seed)
    key_type = rows.schema["k"].dataType
    starts, bytes_before, rows_before = {}, 0, 0
    for r in sorted(totals):
        starts[r] = (bytes_before, rows_before)
        bytes_before += totals[r][0]
        rows_before += totals[r][1]
    starts = starts or {0: (0, 0)}
    byte_map = _lookup({r: b for r, (b, _) in starts.items()}, "bigint")
    row_map = _lookup({r: n for r, (_, n) in starts.items()}, "bigint")
    placed = rows.withColumn("r", _range_of(F.col("k"), _constant(bounds, key_type)))
    order = Window.partitionBy("r").orderBy("k")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (placed.withColumn("row_index", F.element_at(row_map, F.col("r")) + F.row_number().over(order) - 1)
            .withColumn("byte_offset", F.element_at(byte_map, F.col("r")) + upto - F.col("size"))
            .drop("r"))
