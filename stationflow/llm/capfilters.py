"""Embedding near-duplicates by spherical-cap filters: random product codes, list decoding, a join on filters, checks.

A filter is a direction on the unit sphere; a vector passes it if its inner product with the direction is at least
``alpha``. The directions are the products of ``blocks`` short random codes after a random rotation: a code word per
block of coordinates, so ``words ** blocks`` directions need only ``words * blocks`` short vectors. List decoding finds
all directions that a vector passes block by block and drops a partial product as soon as the best words of the
remaining blocks cannot lift it to ``alpha``. Vectors that pass a common filter are compared exactly.

``plan`` chooses the codes from the number of vectors and their dimension: ``alpha`` so that a filter holds about
``COMPANIONS`` unrelated vectors, then words so that a vector passes about ``PER_CODE`` filters of a code, then codes
until the share of pairs at exactly the threshold that meet in a filter, measured on random pairs, reaches ``RECALL``;
closer pairs meet more often. Every vector is indexed.

Equal vectors of one label are one point with a weight, so copies cost nothing. A pair is counted in the smallest filter
that both pass, hence once; a task returns one row per vector (links counted, smallest id met), never pairs. A filter
with many vectors is cut into tiles of ``TILE`` vectors, and every pair of tiles is a task of its own.

Defined results: vectors that are null, empty, all zero or hold a null or non-finite component, and rows without a label,
link with nothing; vectors of different lengths are not compared; equal vectors are equal by two 64-bit hashes; rows
that share an id are vectors of their own; a row without an id takes part, counts as a link, and gets the smallest id
reachable, if any (kept: false); an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.tables import Scratch, components

COSINE = 0.93
#: Least share of pairs at exactly the threshold that must meet; unrelated vectors in a filter; filters per vector and code.
RECALL = 0.98
COMPANIONS = 32
PER_CODE = 2
MOST_WORDS = 4096
MOST_CODES = 64
PAIRS = 2000
#: Vectors in a tile; salts over which the rows of one vector are spread; vectors that are decoded together.
TILE = 2048
SALTS = 16
TOGETHER = 2000
_SEED = 20_11


@dataclass
class Code:
    """One product code: a rotation and, per block of coordinates, its words; a direction's length is 1."""

    alpha: float
    rotation: np.ndarray
    blocks: list[np.ndarray]
    cuts: list[int]

    @classmethod
    def make(cls, dim: int, blocks: int, words: int, alpha: float, number: int = 0) -> Code:
        rng = np.random.default_rng([_SEED, dim, number])
        rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        cuts = [dim * k // blocks for k in range(blocks + 1)]
        codes = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            word = rng.standard_normal((words, b - a))
            word /= np.sqrt((word ** 2).sum(axis=1, keepdims=True))
            codes.append(word * np.sqrt((b - a) / dim))
        return cls(alpha, rotation, codes, cuts)

    @property
    def span(self) -> int:
        return len(self.blocks[0]) ** len(self.blocks)

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of every direction that a row passes: list decoding with pruned partial products."""
        turned = unit @ self.rotation
        scores = [turned[:, a:b] @ word.T for a, b, word in zip(self.cuts[:-1], self.cuts[1:], self.blocks)]
        best = np.cumsum([s.max(axis=1) for s in scores[::-1]], axis=0)[::-1]  # of this block and the later ones
        rest = np.vstack([best[1:], np.zeros((1, len(unit)))])
        row = np.flatnonzero(best[0] >= self.alpha)
        total, name = np.zeros(len(row)), np.zeros(len(row), np.int64)
        for k, score in enumerate(scores):
            step = max(1, (1 << 22) // score.shape[1])
            rows, names, totals = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
            for at in range(0, len(row), step):
                r, t, n = row[at: at + step], total[at: at + step], name[at: at + step]
                here, word = np.nonzero(score[r] >= (self.alpha - t - rest[k][r])[:, None])
                rows.append(r[here])
                names.append(n[here] * score.shape[1] + word)
                totals.append(t[here] + score[r[here], word])
            row, name, total = np.concatenate(rows), np.concatenate(names), np.concatenate(totals)
        return row, name


def decode(codes: list[Code], unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) over all codes, sorted; a filter's number tells its code too."""
    found = [code.decode(unit) for code in codes]
    row = np.concatenate([r for r, _ in found])
    name = np.concatenate([n + k * code.span for k, (code, (_, n)) in enumerate(zip(codes, found))])
    order = np.lexsort((name, row))
    return row[order], name[order]


def _cap(dim: int, alpha: float) -> float:
    """Share of the unit sphere with a first coordinate of at least ``alpha``."""
    if dim == 1:
        return 0.5
    angle = np.linspace(0, np.pi, 20_001)
    density = np.sin(angle) ** (dim - 2)
    return float(density[angle <= np.arccos(alpha)].sum() / density.sum())


def _pairs(dim: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors and, for each, another one at exactly this cosine."""
    rng = np.random.default_rng([_SEED, dim, 1 << 20])
    a = rng.standard_normal((PAIRS, dim))
    a /= np.sqrt((a ** 2).sum(axis=1, keepdims=True))
    if dim == 1:
        return a, a.copy()
    b = rng.standard_normal((PAIRS, dim))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.sqrt((b ** 2).sum(axis=1, keepdims=True))
    return a, cosine * a + np.sqrt(1 - cosine ** 2) * b


def _meet(code: Code, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs pass a common filter of the code."""
    met = np.zeros(len(a), bool)
    sides = [set(zip(*(x.tolist() for x in code.decode(v)))) for v in (a, b)]
    for row, _ in sides[0] & sides[1]:
        met[row] = True
    return met


def plan(n: int, dim: int, cosine: float = COSINE, recall: float = RECALL) -> list[Code]:
    """The codes for ``n`` vectors of ``dim`` components."""
    steps = np.arange(0.95, 0.0, -0.01)
    alpha = float(next((s for s in steps if n * _cap(dim, s) >= COMPANIONS), steps[-1]))
    wanted = PER_CODE / _cap(dim, alpha)
    blocks = min(dim, 2)
    while blocks < dim and wanted ** (1 / blocks) > MOST_WORDS:
        blocks += 1
    words = max(2, int(np.ceil(wanted ** (1 / blocks))))
    a, b = _pairs(dim, cosine)
    codes, met = [], np.zeros(len(a), bool)
    while met.mean() < recall and len(codes) < MOST_CODES:
        codes.append(Code.make(dim, blocks, words, alpha, len(codes)))
        met |= _meet(codes[-1], a, b)
    if met.mean() < recall:
        raise ValueError(f"{MOST_CODES} codes do not reach the recall")
    return codes


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v ** 2).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _decoder(shared):
    """One row per vector and filter: the filter, the tile's salt, the vector, and the filters before this one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                for at in range(0, len(rows), TOGETHER):
                    part = batch.take(pa.array(rows[at: at + TOGETHER]))
                    row, name = decode(codes[int(dim)], _unit(_matrix(part.column(2), int(dim))))
                    first = np.searchsorted(row, np.arange(part.num_rows + 1))
                    size = np.arange(len(row)) - first[row]  # filters of the same vector before this one
                    ends = np.concatenate(([0], np.cumsum(size)))
                    taken = np.repeat(first[row] - ends[:-1], size) + np.arange(ends[-1])
                    yield pa.record_batch(
                        [part.column(1).take(pa.array(row)), pa.array(np.full(len(row), dim, np.int32)), pa.array(name),
                         part.column(0).take(pa.array(row)),
                         pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(name[taken]))],
                        names=["label", "dim", "filter", "point", "before"])
    return run


def _roots(n: int, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The least value of ``least`` in the component of each of n vectors under the links (i, j)."""
    root = least.copy()
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        if (new == root).all():
            return root
        root = new


def _links(v: np.ndarray, weight: np.ndarray, before: np.ndarray, sizes: np.ndarray, first: np.ndarray,
           second: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of rows of ``first`` and of ``second``) with the cosine that pass no common earlier filter; ``before``:
    the earlier filters of all rows, ``sizes`` of them per row."""
    linked = v[first] @ v[second].T >= cosine
    if second is first:
        linked &= ~np.tri(len(first), dtype=bool)  # each pair once
    a, b = np.nonzero(linked)
    if len(a):
        # pairs that meet in an earlier filter are counted there
        earlier, which, often = np.unique(before, return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(v)), sizes)
        done = np.zeros(len(a), bool)
        usable = np.flatnonzero(often > 1)
        for at in range(0, len(usable), 512):
            place = np.full(len(earlier), -1)
            place[usable[at: at + 512]] = np.arange(len(usable[at: at + 512]))
            passes = np.zeros((len(v), min(512, len(usable) - at)), np.float32)
            mine = place[which] >= 0
            passes[row[mine], place[which[mine]]] = 1
            together = passes[first] @ passes[second].T > 0
            done |= together[a, b]
        a, b = a[~done], b[~done]
    return first[a], second[b]


def _compare(cosine: float):
    """Links inside the filters of a pack, or between two tiles of one filter, each counted at the smallest filter that
    both vectors pass: per vector and filter with links, their weight and the smallest point met."""
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["label", "filter"], kind="stable")
        v = _unit(np.stack(pdf["v"].to_numpy()).astype(np.float64))
        point, weight, name = (pdf[c].to_numpy(np.int64) for c in ("point", "weight", "filter"))
        tile, i, j = (pdf[c].to_numpy() for c in ("tile", "i", "j"))
        sizes = pdf["before"].map(len).to_numpy()
        before = np.concatenate(pdf["before"].to_numpy()).astype(np.int64)
        upto = np.concatenate(([0], np.cumsum(sizes)))
        label = pd.factorize(pdf["label"])[0]
        starts = np.concatenate(([0], np.flatnonzero((np.diff(name) != 0) | (np.diff(label) != 0)) + 1, [len(pdf)]))
        out = []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            first = np.flatnonzero(tile[s:e] == i[s])
            second = first if i[s] == j[s] else np.flatnonzero(tile[s:e] == j[s])
            a, b = _links(v[s:e], weight[s:e], before[upto[s]: upto[e]], sizes[s:e], first, second, cosine)
            if len(a):
                n = np.bincount(a, weight[s:e][b], e - s) + np.bincount(b, weight[s:e][a], e - s)
                met = np.flatnonzero(n > 0)
                root = _roots(e - s, a, b, point[s:e])
                out.append(pd.DataFrame({"point": point[s:e][met], "n": n[met].astype(np.int64), "root": root[met]}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("point", "n", "root")})
    return compare


def near_copies(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
                label_col: str = "label", tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "caps")
    x = F.col(vector_col)
    sound = (F.col(label_col).isNotNull() & x.isNotNull() & F.exists(x, lambda e: e != 0)
             & ~F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf"))))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).alias("label"), x.alias("v"), F.coalesce(sound, F.lit(False)).alias("sound"),
        F.xxhash64(F.lit(1), x).alias("h"), F.xxhash64(F.lit(2), x).alias("g"))
    rows = scratch.keep(rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")), "rows")
    # equal vectors: first per salt, so that the copies of one vector are spread, then over the salts
    key = ["label", "h", "g"]
    salted = (rows.where("sound").groupBy(*key, "salt")
              .agg(F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("least"), F.min("row").alias("row")))
    salted = scratch.keep(salted, "salted")
    point = salted.groupBy(*key).agg(F.sum("w").alias("weight"), F.min("least").alias("least"), F.min("row").alias("point"))
    points = scratch.keep(rows.join(point.drop(*key), F.col("row") == F.col("point")).select(
        "point", "label", "v", "weight", "least"), "points")
    sizes = points.groupBy("label", F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).groupBy("dim").agg(
        F.max("n")).collect()
    codes = {int(dim): plan(int(n), int(dim), cosine) for dim, n in sizes}
    shared = spark.sparkContext.broadcast(codes)
    label = next(f.dataType.simpleString() for f in points.schema.fields if f.name == "label")
    passed = scratch.keep(points.select("point", "label", "v").mapInArrow(
        _decoder(shared), f"label {label}, dim int, filter bigint, point bigint, before array<bigint>"), "passed")
    # the join on filters: filters with one vector have no pair, large ones are cut into tiles
    filters = ["label", "dim", "filter"]
    count = passed.groupBy(*filters).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    spread = passed.join(count, filters).withColumn("tiles", F.ceil(F.col("members") / tile).cast("int"))
    spread = spread.withColumn("tile", F.pmod(F.xxhash64("point"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    # filters of one tile share a task's call, about a tile's rows together; a pair of tiles has a call of its own
    packs = max(1, passed.count() // tile)
    pack = F.when(F.col("tiles") > 1, F.lit(-1) - F.col("filter")).otherwise(F.pmod(F.xxhash64(*filters), F.lit(packs)))
    spread = spread.withColumn("other", other).select(
        *filters, "point", "before", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
        pack.alias("pack"), F.when(F.col("tiles") > 1, F.col("label")).alias("own"))
    with_vectors = spread.join(points.select("point", "v", "weight"), "point")
    met = scratch.keep(with_vectors.groupBy("dim", "pack", "own", "i", "j").applyInPandas(
        _compare(cosine), "point bigint, n bigint, root bigint"), "met")
    edges = met.where("point <> root").select(F.col("point").alias("a"), F.col("root").alias("b")).distinct()
    grouped = scratch.keep(components(edges, scratch), "grouped")
    links = met.groupBy("point").agg(F.sum("n").alias("n"))
    found = points.select("point", "weight", "least").join(links, "point", "left").join(
        grouped.withColumnRenamed("id", "point"), "point", "left")
    found = found.withColumn("component", F.coalesce("component", "point")).withColumn(
        "n_links", F.coalesce("n", F.lit(0)) + F.col("weight") - 1)
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    found = found.join(least, "component").select("point", "n_links", "component_id")
    # back to the rows by vector and salt: at most SALTS rows of one vector on this side, and no hot key on the other
    by_salt = (salted.drop("row", "least", "w").join(point.select(*key, "point"), key).join(found, "point")
               .select(*[F.col(c).alias(f"s_{c}") for c in (*key, "salt")], "n_links", "component_id"))
    same = F.col("sound")
    for c in (*key, "salt"):
        same = same & (F.col(c) == F.col(f"s_{c}"))
    out = rows.drop("v").join(by_salt, same, "left")
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
