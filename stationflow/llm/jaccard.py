"""N-gram Jaccard join: a size-aware heavy-light join over distinct word shingles.

Two texts link when their shingle sets have a Jaccard similarity of at least ``share`` percent. Two sets of sizes a
and b then overlap in at least need(a, b) = ceil(share * (a + b) / (100 + share)) shingles, which drives both parts:

* Light: a set of at most ``boundary`` shingles enumerates its subsets of every size that a light partner can require.
  Two light sets that link share such a subset, and a subset is a far rarer key than a shingle.
* Heavy: a larger set goes into inverted lists. Shingles are ordered by document frequency, rarest first; a set is
  listed under its first n - ceil(share * n) + 1 shingles only, and a pair counts at a list only where both places
  leave room for the overlap. Light sets close enough to the boundary to link with a heavy one are listed too.
* The boundary is the size that costs least: subsets enumerated below it against list entries and expected list
  lengths above it.

Frequencies come from a count sketch over all texts: a fixed number of counters, so what is broadcast never grows with
the data. It is only an order, so a shared counter costs time, never a link.

Links are needed to build components, not to be listed. So each list first checks its members against one centre, the
member with the fewest rarer shingles of its own, which links a group of near copies in one linear step. What is left
are pairs of members in different components; all of them that pass the filters are checked. Every text pair that
links is thus either checked or already connected. Copies (equal sets) are represented by their smallest id from the
start. Every candidate is verified by exact intersection.

Defined results: a text without words is an empty set, links with nothing and is its own component; fewer than five
words are one shingle; rows that share an id are one node; a null id gets a null component and links with nothing;
empty tables give an empty result; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.tables import IdFilter, Scratch, components, empty, tidy
from stationflow.llm.words import blocks, mix, runs

WORDS = 5
SHARE = 80

#: Counters of the frequency sketch, and how many go into one row.
SLOTS = 1 << 20
PART = 1 << 14
#: A set with more subsets than this is never light.
MOST_SUBSETS = 256

_SCANNED = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, part int, counts binary"
_KEYED = "id bigint, n int, tokens array<bigint>, subsets array<struct<token:bigint,c:int>>"


def need(a: int, b: int, share: int = SHARE) -> int:
    """Smallest overlap of linked sets of sizes a and b."""
    return -(-share * (a + b) // (100 + share))


def need_column(a: Column, b: Column, share: int) -> Column:
    return F.ceil(F.lit(share) * (a + b) / F.lit(float(100 + share)) - F.lit(1e-9)).cast("int")


def prefix_length(n: int, share: int = SHARE) -> int:
    return n - -(-share * n // 100) + 1


def subset_sizes(n: int, boundary: int, share: int = SHARE) -> list[int]:
    """Overlaps that a light set of size n can be required to have with a light partner."""
    partners = range(-(-share * n // 100), min(boundary, 100 * n // share) + 1)
    return sorted({need(n, m, share) for m in partners if m > 0})


def subset_count(n: int, share: int = SHARE) -> int:
    total = 0
    for c in subset_sizes(n, 100 * n // share, share):
        ways = 1
        for i in range(n - c):
            ways = ways * (n - i) // (i + 1)
        total += ways
    return total


def boundary_by_cost(sizes: dict[int, int], list_length: float, share: int = SHARE) -> int:
    """The boundary with the least cost; ``sizes``: number of sets per size, ``list_length``: expected list length."""
    best, best_cost, light = 0, 0.0, 0.0
    for n in range(1, max(sizes, default=0) + 1):
        if subset_count(n, share) > MOST_SUBSETS:
            break
        light += sizes.get(n, 0) * (subset_count(n, share) - prefix_length(n, share) * (1 + list_length))
        if light < best_cost:
            best, best_cost = n, light
    return best


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    for b in blocks(texts, lower=True):
        r = runs(b.words, words)
        for row, i, j in b.rows():
            if j - i >= words:
                yield row, np.unique(r[i: j - words + 1])
            elif j > i:
                yield row, runs(b.words[i:j], j - i)
            else:
                yield row, r[:0]


def _scan(words: int):
    @tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SLOTS, np.int64)
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                            ("part", pa.int32()), ("counts", pa.binary())])
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            keys = np.zeros((batch.num_rows, 2), np.uint64)
            pending, held = [], 0
            for row, s in shingle_sets(batch.column(1), words):
                n[row] = len(s)
                keys[row] = s.sum(), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum()
                pending.append(s)
                held += len(s)
                if held > SLOTS:
                    sketch += _counts(pending)
                    pending, held = [], 0
            sketch += _counts(pending)
            nothing = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
            yield pa.record_batch([batch.column(0), pa.array(n), pa.array(keys[:, 0].view(np.int64)),
                                   pa.array(keys[:, 1].view(np.int64)), *nothing], schema=schema)
        used = [p for p in range(SLOTS // PART) if sketch[p * PART: (p + 1) * PART].any()]
        if used:
            none = pa.nulls(len(used), pa.int64())
            yield pa.record_batch([none, none, none, none, pa.array(used, pa.int32()),
                                   pa.array([sketch[p * PART: (p + 1) * PART].astype(np.int32).tobytes() for p in used])],
                                  schema=schema)
    return scan


def _counts(sets: list[np.ndarray]) -> np.ndarray | int:
    if not sets:
        return 0
    slots = (np.concatenate(sets) & np.uint64(SLOTS - 1)).astype(np.int64)
    return np.bincount(slots, minlength=SLOTS)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the sketch rows of one task, at most one row per part of the sketch."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = counts.as_buffer()
            value = np.frombuffer(raw, np.int32 if raw.size == 4 * PART else np.int64).astype(np.int64)
            sums[part] = sums[part] + value if part in sums else value
    if sums:
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()])],
                              names=["part", "counts"])


def _sketch(scanned: DataFrame) -> np.ndarray:
    """The whole sketch: SLOTS counters, whatever the input's size."""
    rows = scanned.where("part is not null").select("part", "counts")
    sums = rows.mapInArrow(_add, "part int, counts binary").repartition(16, "part").mapInArrow(
        _add, "part int, counts binary")
    out = np.zeros(SLOTS, np.int64)
    for part, counts in sums.collect():
        out[part * PART: (part + 1) * PART] += np.frombuffer(counts, np.int64)
    return out


def _keys(shared, boundary: int, share: int, words: int):
    """Per text: list shingles in the global order, and subset keys of a light set."""
    @tidy
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        slot = np.uint64(SLOTS - 1)
        chosen = {n: [(c, np.array(list(combinations(range(n), c)))) for c in subset_sizes(n, boundary, share)]
                  for n in range(1, boundary + 1)}
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int32)
            tokens = [np.zeros(0, np.uint64)] * batch.num_rows
            subsets: list[list] = [[]] * batch.num_rows
            for row, s in shingle_sets(batch.column(1), words):
                n = sizes[row] = len(s)
                if n and 100 * n // share > boundary:
                    rank = np.lexsort((s, sketch[(s & slot).astype(np.int64)]))
                    tokens[row] = s[rank[: prefix_length(n, share)]]
                if n and n <= boundary:
                    subsets[row] = [{"token": int(t), "c": c} for c, at in chosen[n]
                                    for t in mix(s[at].sum(axis=1) + np.uint64(c)).view(np.int64)]
            ptr = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
            flat = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ptr), pa.array(flat)),
                 pa.array(subsets, pa.list_(pa.struct([("token", pa.int64()), ("c", pa.int32())])))],
                names=["id", "n", "tokens", "subsets"])
    return keys


def _sets(wanted, words: int):
    @tidy
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(wanted.value.passes(ids)))
            out = [s for _, s in shingle_sets(batch.column(1), words)]
            ptr = np.concatenate(([0], np.cumsum([len(s) for s in out]))).astype(np.int32)
            flat = np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(ptr), pa.array(flat))],
                                  names=["id", "s"])
    return sets


def verify(pairs: DataFrame, texts: DataFrame, share: int, words: int) -> DataFrame:
    """The pairs (a, b) whose sets link, by exact intersection; only texts that occur in a pair are hashed again.

    A fixed-size filter keeps the other texts out of the shuffle; the joins that follow are exact.
    """
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = texts.sparkSession.sparkContext.broadcast(IdFilter(ids))
    sets = texts.mapInArrow(_sets(wanted, words), "id bigint, s array<bigint>").join(ids, "id", "left_semi")
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= need_column(F.size("sa"), F.size("sb"), share)).select("a", "b").distinct()


def _fits(a: str, b: str, boundary: int, share: int) -> Column:
    """May the list entries a and b (columns pos, n) belong to a linked pair, and is this list the one to find it?"""
    an, bn = F.col(f"{a}n"), F.col(f"{b}n")
    least = need_column(an, bn, share)
    sized = (100 * F.least(an, bn) >= share * F.greatest(an, bn))
    listed = (F.col(f"{a}pos") <= an - least) & (F.col(f"{b}pos") <= bn - least) & (F.greatest(an, bn) > boundary)
    return sized & F.when(F.col("c") == 0, listed).otherwise(least <= F.col("c"))


def join(docs: DataFrame, share: int = SHARE, words: int = WORDS, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links, itself included) of every row."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"))
    scanned = scratch.keep(texts.mapInArrow(_scan(words), _SCANNED), "scan")
    sketch = _sketch(scanned)
    rows = scanned.where("part is null").select("doc_id", "n_shingles", "k1", "k2")
    real = rows.where("n_shingles > 0 and doc_id is not null")
    copies = scratch.keep(real.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep")), "copies")
    sizes = {int(r[0]): int(r[1]) for r in copies.where("n_shingles <= 64").groupBy("n_shingles").count().collect()}
    total = float(sketch.sum())
    expected = max(0.0, float((sketch.astype(float) ** 2).sum()) / total - total / SLOTS) if total else 0.0
    boundary = boundary_by_cost(sizes, expected, share)

    # an id with several different sets is one node: tie its sets together
    several = (real.select("doc_id", "k1", "k2").distinct().groupBy("doc_id").count().where("count > 1")
               .select("doc_id"))
    tied = scratch.keep(real.join(several, "doc_id", "left_semi").join(copies, ["k1", "k2", "n_shingles"])
                        .where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")), "tied")

    shared = spark.sparkContext.broadcast(sketch)
    reps = copies.select(F.col("rep").alias("id")).distinct()
    keyed = scratch.keep(texts.where("id is not null").mapInArrow(_keys(shared, boundary, share, words), _KEYED)
                         .join(reps, "id", "left_semi"), "keys")
    entries = keyed.select("id", "n", F.posexplode("tokens").alias("pos", "token")) \
        .select("token", F.lit(0).alias("c"), "id", "n", "pos").unionByName(
            keyed.select("id", "n", F.inline("subsets")).select("token", "c", "id", "n", F.lit(0).alias("pos")))
    centres = (entries.groupBy("token", "c").agg(F.count(F.lit(1)).alias("members"),
                                                 F.min(F.struct("pos", "n", "id")).alias("centre"))
               .where("members > 1")
               .select("token", "c", F.col("centre.pos").alias("z_pos"), F.col("centre.n").alias("z_n"),
                       F.col("centre.id").alias("z_id")))
    lists = scratch.keep(entries.join(centres, ["token", "c"]), "lists")
    scratch.drop(keyed)

    def ordered(a: str, b: str) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    star = scratch.keep(
        lists.select("*", F.col("n").alias("m_n"), F.col("pos").alias("m_pos")).where(F.col("id") != F.col("z_id"))
        .where(_fits("m_", "z_", boundary, share)).select(*ordered("id", "z_id")).distinct(), "star")
    links = scratch.keep(verify(star, texts, share, words).unionByName(tied), "links")
    labels = scratch.keep(components(links, scratch), "labels")

    # members of one list that are still apart
    named = lists.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    apart = (named.groupBy("token", "c").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("token", "c"))
    open_ = scratch.keep(named.join(apart, ["token", "c"], "left_semi")
                         .where(F.col("id") != F.col("z_id")).drop("z_pos", "z_n", "z_id"), "apart")
    scratch.drop(lists)
    left = open_.select("token", "c", *[F.col(x).alias(f"l_{x}") for x in ("id", "n", "pos", "component")])
    right = open_.select("token", "c", *[F.col(x).alias(f"r_{x}") for x in ("id", "n", "pos", "component")])
    rest = (left.join(right, ["token", "c"]).where("l_component < r_component")
            .where(_fits("l_", "r_", boundary, share)).select(*ordered("l_id", "r_id")).distinct()
            .join(star, ["a", "b"], "left_anti"))
    rest = scratch.keep(rest, "rest")
    if not empty(rest):
        more = scratch.keep(verify(rest, texts, share, words), "more-links")
        if not empty(more):
            labels = scratch.keep(components(links.unionByName(more), scratch), "labels")
    reached = copies.join(labels.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    found = real.join(reached, ["k1", "k2", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)


def distinct_documents(docs: DataFrame, share: int = SHARE, words: int = WORDS, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """The input rows of which one document per component stays: the one that gives the component its id.

    Rows with a null id are kept, as they link with nothing.
    """
    found = join(docs, share, words, id_col, text_col)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")


#: The same result as DuckDB SQL over ``documents``: all pairs that share a shingle, then reachable ids.
ORACLE = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
           WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - {WORDS - 2}), lambda p: array_to_string(w[p:p + {WORDS - 1}], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
u AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= {SHARE} * (x.n + y.n - i)),
r AS (SELECT doc_id AS id, doc_id AS m FROM n UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.id)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.m) AS component_id
FROM n JOIN r ON r.id = n.doc_id GROUP BY ALL
"""
