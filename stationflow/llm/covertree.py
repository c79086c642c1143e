"""Exact top-k inner products by dual-tree cover-tree search.

Components become the integers floor(scale * x), so scores are exact: sums go through doubles where they cannot pass
2**53, through whole numbers of any size elsewhere. Equal vectors are one point with the ids that can be needed: the
k + 1 smallest distinct ones, each as often as it occurs, k times at most. Points and queries are indexed together: the
same pivots, a bounded hash sample of the points, cut both into blocks of bounded size, and every block gets a tree.
A node's children are a net of its points: the farthest point so far joins until all lie within half the node's radius
or the net has 64 points. The bounds need each node's own covering radius only; where the net is full, children may be
wider than half of it.

A pair of nodes with centres c and d and covering radii r and s holds no score above
``c.d + r |d| + s |c| + r s``. The search goes down both trees at once and drops a pair whose bound is below the worst
kth score of the query node's queries. Between blocks the same bound prunes first: each query block is searched
against its most promising point block, and only then against the other blocks whose bound reaches its worst kth score.
The query blocks meet the point blocks' summaries under a salt; pairs that the bound drops are never written.

The queries are a stated set; they are met with the points in blocks. Defined results: null ids and vectors that are
null, empty or hold a null or non-finite component take no part; vectors are compared with vectors of their own length
only; ties go to the smaller id; a query is a distinct (id, vector): equal rows of it are one query, and it meets no row
of its own id; another id that occurs twice counts as two candidates; fewer than k candidates give them all; components
and scores beyond the range of a long are its ends; empty tables give an empty result; only the named columns are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.tables import Scratch

SCALE = 256
K = 5
#: Points and queries per block, leaf size, and the most pivots that are sampled.
BLOCK = 8192
QUERY_BLOCK = 512
LEAF = 96
PIVOTS = 256
#: Query blocks that one task meets with one point block.
TOGETHER = 32

_SLACK = 1e-9
_LONG = (1 << 63) - 1
_EXACT = float(1 << 53)


class Tree:
    """A cover tree over the rows of ``points``; children follow their parent, leaves hold a run of ``order``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points.astype(np.float64)
        self.order = np.arange(len(points))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        distance = np.sqrt(((self.points - self.points[0]) ** 2).sum(axis=1)) if len(points) else np.zeros(0)
        if len(points):
            self._build(0, 0, len(points), distance, leaf)
        self.points = self.points[self.order]
        place = np.empty(len(points), np.int64)
        place[self.order] = np.arange(len(points))
        self.centres = self.points[place[np.array(self.centre, np.int64)]] if self.centre else self.points
        self.norms = np.sqrt((self.centres ** 2).sum(axis=1))
        self.whole = points[self.order]
        self.reach = float(np.sqrt((self.points ** 2).sum(axis=1)).max()) if len(points) else 0.0

    def _build(self, centre: int, start: int, end: int, distance: np.ndarray, leaf: int) -> int:
        """Node over order[start:end]; ``distance``: of those points from the centre."""
        node, far = len(self.centre), float(distance.max())
        self.centre.append(centre)
        self.radius.append(far)
        self.span.append((start, end))
        self.children.append([])
        if end - start <= leaf or far == 0:
            return node
        members = self.order[start:end]
        nets, closest, nearest = [], np.full(end - start, np.inf), np.zeros(end - start, np.int64)
        # a net with gaps of half the radius: the centre first, then the point farthest from the net so far
        new, gap = centre, far / 2
        while True:
            d = np.sqrt(((self.points[members] - self.points[new]) ** 2).sum(axis=1))
            closer = d < closest
            closest[closer], nearest[closer] = d[closer], len(nets)
            nets.append(new)
            worst = int(closest.argmax())
            if closest[worst] <= gap or len(nets) >= 64:
                break
            new = int(members[worst])
        by_net = np.argsort(nearest, kind="stable")
        self.order[start:end] = members[by_net]
        counts = np.bincount(nearest, minlength=len(nets))
        at = start
        for k, count in enumerate(counts.tolist()):
            if count:
                mine = by_net[at - start: at - start + count]
                self.children[node].append(self._build(nets[k], at, at + count, closest[mine], leaf))
                at += count
        return node


def bound(c: np.ndarray, r: float, d: np.ndarray, s: float, cn: float, dn: float) -> float:
    far = r * dn + s * cn + r * s
    return float(c @ d) + far + _SLACK * (cn * dn + far + 1)


def scores_of(a: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """Inner products of whole-numbered rows, exact, cut off at the ends of a long; ``longest``: bound of |a| |b|."""
    if longest < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.array([[min(max(x, -_LONG), _LONG) for x in row] for row in exact], np.int64).reshape(len(a), len(b))


class Best:
    """The best (score, id) per query of one tree's queries, in the tree's order."""

    def __init__(self, n: int, keep: int, floor: np.ndarray | None = None):
        self.score = np.full((n, keep), -_LONG)
        self.id = np.full((n, keep), _LONG)
        self.floor = np.full(n, -_LONG) if floor is None else floor

    def worst(self, a: int, b: int) -> int:
        """The least kth score of queries a..b-1 (or what is known of it from elsewhere)."""
        return int(np.maximum(self.score[a:b, -1], self.floor[a:b]).min())

    def merge(self, a: int, b: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = self.score.shape[1]
        s = np.concatenate([self.score[a:b], scores], axis=1)
        i = np.concatenate([self.id[a:b], ids], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :keep]
        self.score[a:b] = np.take_along_axis(s, order, axis=1)
        self.id[a:b] = np.take_along_axis(i, order, axis=1)


def search(queries: Tree, own: np.ndarray, points: Tree, ids: np.ndarray, best: Best) -> None:
    """Dual-tree search; ``own``: every query's id, which it does not meet; ``ids`` (points, m): ids of every point in
    the tree's order, padded with the largest long."""
    if not queries.centre or not points.centre:
        return
    longest = queries.reach * points.reach

    def reach(q: int, p: int) -> float:
        return bound(queries.centres[q], queries.radius[q], points.centres[p], points.radius[p],
                     queries.norms[q], points.norms[p])

    stack = [(reach(0, 0), 0, 0)]
    while stack:
        top, q, p = stack.pop()
        a, b = queries.span[q]
        if top < best.worst(a, b):
            continue
        qs, ps = queries.children[q], points.children[p]
        if not qs and not ps:
            c, d = points.span[p]
            scores = scores_of(queries.whole[a:b], points.whole[c:d], longest)
            wanted = np.flatnonzero((scores >= np.maximum(best.score[a:b, -1], best.floor[a:b])[:, None]).any(axis=0))
            if len(wanted):
                mine = np.broadcast_to(ids[c + wanted].reshape(1, -1), (b - a, len(wanted) * ids.shape[1])).copy()
                flat = np.repeat(scores[:, wanted], ids.shape[1], axis=1)
                nobody = (mine == _LONG) | (mine == own[a:b, None])
                mine[nobody], flat[nobody] = _LONG, -_LONG
                best.merge(a, b, flat, mine)
            continue
        if qs and (not ps or queries.radius[q] >= points.radius[p]):
            pairs = [(reach(k, p), k, p) for k in qs]
        else:
            pairs = [(reach(q, k), q, k) for k in ps]
        stack += sorted(pairs)  # the most promising pair is taken next


def _pivot_of(pivots: dict[int, np.ndarray]):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.zeros(len(pdf), np.int32)
            lengths = pdf["v"].map(len).to_numpy()
            for n in np.unique(lengths):
                rows = np.flatnonzero(lengths == n)
                v = np.stack(pdf["v"].to_numpy()[rows]).astype(np.float64)
                c = pivots[int(n)]
                out[rows] = ((c * c).sum(axis=1)[None, :] - 2 * v @ c.T).argmin(axis=1)
            yield pdf.assign(pivot=out)
    return assign


def _blocks(distinct: DataFrame, pivots: dict[int, np.ndarray], size: int, scratch: Scratch, label: str) -> DataFrame:
    """(block, n, tree: pickled) of every block; a block has about ``size`` points at most."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema.fields)
    placed = scratch.keep(distinct.mapInPandas(_pivot_of(pivots), f"{fields}, pivot int"), f"{label}-placed")
    counts = {(r[0], r[1]): r[2] for r in placed.groupBy(F.size("v").alias("n"), "pivot").count().collect()}
    parts = F.expr("map(" + ", ".join(f"'{n}:{p}', {-(-c // size)}" for (n, p), c in counts.items()) + ")")
    name = F.concat_ws(":", F.size("v").cast("string"), F.col("pivot").cast("string"))
    part = F.pmod(F.xxhash64(*distinct.columns), F.element_at(parts, name))
    keyed = placed.withColumn("block", F.concat_ws(":", name, part.cast("string"))).drop("pivot")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(np.stack(pdf["v"].to_numpy()).astype(np.int64))
        if "ids" in pdf:
            width = max(len(i) for i in pdf["ids"])
            extra = np.full((len(pdf), width), _LONG)
            for k, row in enumerate(tree.order):
                ids = pdf["ids"].iloc[row]
                extra[k, : len(ids)] = ids
        else:
            extra = pdf["query_id"].to_numpy(np.int64)[tree.order]
        vector = pdf["v"].iloc[int(tree.centre[0])]
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "dim": [tree.points.shape[1]],
                             "c": [np.asarray(vector, np.int64)], "r": [tree.radius[0]],
                             "tree": [pickle.dumps((tree, extra), protocol=5)]})

    return scratch.keep(keyed.groupBy("block").applyInPandas(
        build, "block string, dim int, c array<bigint>, r double, tree binary"), label)


_FOUND = "query_id bigint, v array<bigint>, vec_id bigint, score bigint"


def _meet(k: int):
    none = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "v": pd.Series(dtype=object),
                         "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})

    def meet(key, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if points.empty or queries.empty:
            return none
        tree, ids = pickle.loads(points["tree"].iloc[0])
        out = []
        for raw, floor in zip(queries["tree"], queries["floor"]):
            mine, own = pickle.loads(raw)
            best = Best(len(own), k, None if floor is None else np.asarray(floor, np.int64))
            search(mine, own, tree, ids, best)
            rows, places = np.nonzero(best.id != _LONG)
            out.append(pd.DataFrame({"query_id": own[rows], "v": list(mine.whole[rows]), "vec_id": best.id[rows, places],
                                     "score": best.score[rows, places]}))
        return pd.concat(out) if out else none
    return meet


def _points(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids) per distinct vector: its k + 1 smallest distinct ids, each as often as it occurs, at most k times."""
    once = rows.groupBy("v", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("times"))
    order = Window.partitionBy("v").orderBy("vec_id")  # planned with a limit per map task
    least = once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    ids = F.flatten(F.collect_list(F.expr("array_repeat(vec_id, times)")))
    return least.groupBy("v").agg(F.sort_array(ids).alias("ids"))


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for every row for which ``is_query(id)`` holds."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    x = F.col(vector_col)
    sound = ~F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    rows = scratch.keep(vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & sound).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("bigint")).alias("v")), "rows")
    points = scratch.keep(_points(rows, k), "points")
    wanted = rows.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "v").distinct()
    # a bounded sample of the points, per vector length
    size = points.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1))).collect()
    if not size:
        return spark.sql("select cast(null as bigint) query_id, cast(null as int) rank, cast(null as bigint) vec_id, "
                         "cast(null as bigint) score where false")
    pivots = {}
    for d, n in size:
        count = int(min(PIVOTS, max(1, n // (BLOCK // 4))))
        sample = points.where(F.size("v") == d).orderBy(F.xxhash64("v"), "v").limit(count).select("v").collect()
        pivots[int(d)] = np.array([r[0] for r in sample], np.float64)
    index = _blocks(points, pivots, BLOCK, scratch, "index")
    asked = _blocks(wanted, pivots, QUERY_BLOCK, scratch, "asked")

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, e: s + e)

    # block summaries only: the stated queries' blocks against the point blocks, spread over salts
    salts = max(1, asked.count() // 16)
    left = asked.select(F.col("block").alias("q"), "dim", F.col("c").alias("qc"), F.col("r").alias("qr"),
                        F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"))
    right = index.select(F.col("block").alias("p"), "dim", F.col("c").alias("pc"), F.col("r").alias("pr"),
                         F.explode(F.expr(f"sequence(0L, {salts - 1}L)")).alias("salt"))
    cn, dn, middle = F.sqrt(dot(F.col("qc"), F.col("qc"))), F.sqrt(dot(F.col("pc"), F.col("pc"))), dot(F.col("qc"), F.col("pc"))
    far = F.col("qr") * dn + F.col("pr") * cn + F.col("qr") * F.col("pr")
    pairs = left.join(right, ["dim", "salt"]).select(
        "q", "p", (middle + far + _SLACK * (cn * dn + far + 1)).alias("top"), middle.alias("middle"))
    best_block = scratch.keep(pairs.groupBy("q").agg(F.max(F.struct("middle", "p")).alias("b")).select("q", F.col("b.p").alias("p")), "best")

    def meet(chosen: DataFrame, queries: DataFrame) -> DataFrame:
        group = F.pmod(F.xxhash64("q"), F.lit(1 << 30)) % F.greatest(F.lit(1), F.ceil(F.col("queries") / TOGETHER))
        many = chosen.groupBy("p").agg(F.count(F.lit(1)).alias("queries"))
        tasks = scratch.keep(chosen.join(many, "p").select("q", "p", group.alias("g")), "tasks")
        a = (tasks.select(F.col("p").alias("block"), F.col("g").alias("part")).distinct()
             .join(index.select("block", "tree"), "block"))
        b = tasks.join(queries, "q").select("p", "g", "tree", "floor")
        return (a.groupBy("block", "part").cogroup(b.groupBy("p", "g"))
                .applyInPandas(_meet(k), _FOUND))

    none = asked.select(F.col("block").alias("q"), "tree", F.lit(None).cast("array<bigint>").alias("floor"))
    first = scratch.keep(meet(best_block, none), "first")
    ranked = Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id")
    kth = (first.withColumn("n", F.row_number().over(ranked)).where(F.col("n") == k)
           .select("query_id", "v", F.col("score").alias("kth")))
    floors = scratch.keep(_with_floors(asked, kth), "floors")
    # each query block's floor goes to the summaries first, so only pairs that reach it leave the join
    rest = (pairs.join(floors.select("q", "least"), "q").where(F.col("top") >= F.col("least")).select("q", "p")
            .join(best_block, ["q", "p"], "left_anti"))
    second = meet(rest, floors.select("q", "tree", "floor"))
    best = first.unionByName(second).withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k)
    return best.select("query_id", F.col("n").cast("int").alias("rank"), "vec_id", "score")


def _with_floors(asked: DataFrame, kth: DataFrame) -> DataFrame:
    """Query blocks with the kth score known so far per query (in the tree's order) and the least of them."""
    def queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, raw in zip(pdf["block"], pdf["tree"]):
                tree, own = pickle.loads(raw)
                yield pd.DataFrame({"q": block, "at": np.arange(len(own)), "query_id": own, "v": list(tree.whole)})

    each = asked.select("block", "tree").mapInPandas(queries, "q string, at int, query_id bigint, v array<bigint>")
    low = F.coalesce("kth", F.lit(-_LONG))
    known = (each.join(kth, ["query_id", "v"], "left").groupBy("q")
             .agg(F.array_sort(F.collect_list(F.struct("at", low.alias("s")))).alias("f"),
                  F.min(low.cast("double")).alias("least")))
    return asked.select(F.col("block").alias("q"), "tree").join(known, "q").select(
        "q", "tree", F.col("f.s").alias("floor"), "least")


def oracle(k: int, every: int, scale: int) -> str:
    """The same lists as DuckDB SQL over ``embeddings``: every ``every``-th id against all rows."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.v, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % {every} = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {k}
"""
