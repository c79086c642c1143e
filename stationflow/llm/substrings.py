"""Substring dedup by relative Lempel-Ziv parsing against everything that comes before.

The documents' own texts are the reference. It is indexed by windows of ``WINDOW`` words: the index maps a window to the
smallest document that holds it and its first place there. A document is parsed from left to right: the first window
with an entry opens a factor, which goes on as long as the following windows continue at the next place of the same
reference; the next factor starts at its end. So factors do not overlap, are at least ``WINDOW`` words long, and each
equals the words at its place (reference, position). Where a reference repeats itself, a factor follows its first place
only and may be cut shorter than the longest match. Factors are duplicate spans. At a factor's boundaries, windows that
reach across it are checked too: words of those that the index holds are duplicates as well. Removed are, in all, the
words of every window that also starts in a document with a smaller id.

Only windows that can match are indexed. The smallest hash of the 20-word runs in a window is the window's anchor;
equal windows have equal anchors, so a window whose anchor occurs in one document only has no match anywhere. Anchors
are about one word in sixteen. They are counted first, with partial minimum and maximum per task, so a passage that
sits in a third of all documents costs one row per task. A document asks for each of its distinct windows once, however
often it repeats it. Documents with equal words are represented by the smallest id: the others are one factor, the
whole text.

Words are compared by 64-bit hashes of the whole window. Defined results: a null or blank text has no words; fewer
than ``WINDOW`` words are all kept; a row with a null id is kept whole and is no reference; rows that share an id are
parsed one by one and are no references of each other (a factor's place is in one of the rows of its reference's id);
empty tables give an empty result; only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.tables import Scratch, tidy
from stationflow.llm.words import Block, blocks, runs

WINDOW = 50
ANCHOR = 20
NOTHING = hashlib.sha256(b"").hexdigest()

_FACTORS = "array<struct<start:bigint,n:bigint,ref:bigint,pos:bigint>>"


def _anchors(words: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """The least hash of the anchor runs in each window."""
    low = runs(words, anchor)
    span, size = window - anchor + 1, 1
    n = len(low) - span + 1
    if n <= 0:
        return low[:0]
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[:n], low[span - size: span - size + n])


def _words_of(b: Block, row: int) -> list[bytes]:
    """The words of a text; bytes.split cuts at the same six white-space bytes."""
    i = row - b.first
    return b.raw[b.offs[i]: b.offs[i + 1]].tobytes().split()


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _scan(window: int, anchor: int):
    @tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, shas, found = [], [], []
            for b in blocks(batch.column(1)):
                low = _anchors(b.words, window, anchor)
                for row, i, j in b.rows():
                    n.append(j - i)
                    shas.append(_digest(_words_of(b, row)))
                    found.append(np.unique(low[i: j - window + 1]).view(np.int64) if j - i >= window else np.zeros(0, np.int64))
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(shas, pa.string()),
                                   _lists(found, pa.int64())], names=["doc_id", "n_words", "sha", "anchors"])
    return scan


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ptr = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ptr), pa.array(flat, kind))


def _windows(window: int, anchor: int):
    """The distinct windows with a shared anchor and their places, of the rows (doc_id, t, sha, shared)."""
    @tidy
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, rows, at, sizes, hashes = batch.column(2).to_pylist(), [], [], [], []
            shared = batch.column(3)
            for b in blocks(batch.column(1)):
                low, whole = _anchors(b.words, window, anchor), runs(b.words, window)
                for row, i, j in b.rows():
                    if j - i < window or _digest(_words_of(b, row)) != shas[row]:
                        continue
                    mine = shared[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    hit = np.flatnonzero(np.isin(low[i: j - window + 1], mine))
                    h, which, count = np.unique(whole[i: j - window + 1][hit].view(np.int64), return_inverse=True,
                                                return_counts=True)
                    rows.append(row)
                    at.append(hit[np.argsort(which, kind="stable")].astype(np.int32))
                    sizes.append(count)
                    hashes.append(h)
            take = pa.array(rows, pa.int64())
            ends = np.concatenate(([0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes])))).astype(np.int32)
            flat = pa.array(np.concatenate([np.zeros(0, np.int32), *at]), pa.int32())
            per_row = np.concatenate(([0], np.cumsum([len(h) for h in hashes]))).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(per_row), pa.ListArray.from_arrays(pa.array(ends), flat))
            yield pa.record_batch([batch.column(0).take(take), batch.column(2).take(take), places,
                                   _lists(hashes, pa.int64())], names=["doc_id", "sha", "at", "h"])
    return windows


def factors(starts: np.ndarray, refs: np.ndarray, places: np.ndarray, window: int = WINDOW) -> list[dict]:
    """The parse of one document from its matching windows, sorted by start: their references and places there."""
    breaks = (np.diff(starts) != 1) | (np.diff(refs) != 0) | (np.diff(places) != 1)
    run_end = np.append(np.flatnonzero(breaks), len(starts) - 1)  # last window of each unbroken run
    out, k = [], 0
    while k < len(starts):
        last = int(run_end[np.searchsorted(run_end, k)])
        n = int(starts[last] - starts[k]) + window
        out.append({"start": int(starts[k]), "n": n, "ref": int(refs[k]), "pos": int(places[k])})
        k = int(np.searchsorted(starts, starts[k] + n))
    return out


def boundary_words(starts: np.ndarray, parts: list[dict], window: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of the matching windows that reach across the end or the start of a factor."""
    edges = np.array([e for f in parts for e in (f["start"], f["start"] + f["n"])], np.int64)
    after = np.searchsorted(edges, starts, side="right")
    across = (after < len(edges)) & (edges[np.minimum(after, len(edges) - 1)] < starts + window)
    return [(int(p), int(p) + window) for p in starts[across]]


def _cut(window: int):
    """Parses the rows (doc_id, t, sha, at, ref, pos) and removes their duplicate spans."""
    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, out = batch.column(2).to_pylist(), []
            for b in blocks(batch.column(1)):
                for row, i, j in b.rows():
                    words = _words_of(b, row)
                    if _digest(words) != shas[row]:
                        continue
                    lists = batch.column(3)[row].values
                    times = lists.value_lengths().to_numpy(zero_copy_only=False)
                    at = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    refs, places = (np.repeat(batch.column(c)[row].values.to_numpy(zero_copy_only=False), times) for c in (4, 5))
                    order = np.argsort(at)
                    at = at[order]
                    parts = factors(at, refs[order], places[order], window)
                    keep = np.ones(len(words), bool)
                    for a, e in [(f["start"], f["start"] + f["n"]) for f in parts] + boundary_words(at, parts, window):
                        keep[a:e] = False
                    kept = [words[k] for k in np.flatnonzero(keep)]
                    out.append((row, len(words) - len(kept), _digest(kept), parts))
            rows, removed, kept_sha, parts = zip(*out) if out else ((), (), (), ())
            take = pa.array(rows, pa.int64())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64()), ("ref", pa.int64()), ("pos", pa.int64())]))
            yield pa.record_batch([batch.column(0).take(take), batch.column(2).take(take), pa.array(removed, pa.int64()),
                                   pa.array(kept_sha, pa.string()), pa.array(parts, kind)],
                                  names=["doc_id", "sha", "n_removed", "kept_sha256", "factors"])
    return cut


def parse(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, factors (start word, words, reference and place there) of every row."""
    scratch = Scratch(docs.sparkSession, "substrings")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("t"))
    scanned = scratch.keep(texts.mapInArrow(
        _scan(window, anchor), "doc_id bigint, n_words bigint, sha string, anchors array<bigint>"), "scan")
    long = scanned.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    first = long.groupBy("sha").agg(F.min("doc_id").alias("rep"))
    marked = scratch.keep(long.join(first, "sha").select("doc_id", "sha", "rep", "anchors"), "copies")
    places = (marked.where("doc_id = rep").select("doc_id", "sha", F.explode("anchors").alias("anchor")))
    common = (places.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
              .where("low < high").select("anchor"))
    shared = scratch.keep(places.join(common, "anchor").groupBy("doc_id", "sha")
                          .agg(F.collect_set("anchor").alias("shared")), "shared")
    found = scratch.keep(
        texts.join(shared, "doc_id").select("doc_id", "t", "sha", "shared")
        .mapInArrow(_windows(window, anchor), "doc_id bigint, sha string, at array<array<int>>, h array<bigint>"), "windows")
    scratch.drop(shared)
    each = found.select("doc_id", "sha", F.inline(F.arrays_zip("at", "h")))
    # one row per window and document that holds it, so a window that fills a document is still one row of it
    least = F.min(F.struct("doc_id", F.element_at("at", 1).cast("bigint").alias("pos")))
    index = (each.groupBy("h").agg(least.alias("first"), F.max("doc_id").alias("high"))
             .where("first.doc_id < high").select("h", F.col("first.doc_id").alias("ref"), "first.pos"))
    matches = (each.join(index, "h").where("doc_id > ref").groupBy("doc_id", "sha")
               .agg(F.collect_set(F.struct("at", "ref", "pos")).alias("m")))
    matches = scratch.keep(matches.select("doc_id", "sha", F.col("m.at").alias("at"), F.col("m.ref").alias("ref"),
                                          F.col("m.pos").alias("pos")), "matches")
    scratch.drop(found)
    done = scratch.keep(
        texts.join(matches, "doc_id").select("doc_id", "t", "sha", "at", "ref", "pos")
        .mapInArrow(_cut(window), f"doc_id bigint, sha string, n_removed bigint, kept_sha256 string, factors {_FACTORS}")
        .dropDuplicates(["doc_id", "sha"]), "cut")
    whole = marked.where("doc_id > rep").select("doc_id", "sha", "rep").distinct()
    rows = (scanned.select("doc_id", "n_words", "sha").join(done, ["doc_id", "sha"], "left")
            .join(whole, ["doc_id", "sha"], "left"))
    copy = F.col("rep").isNotNull()
    return rows.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("n"),
                                      F.col("rep").alias("ref"), F.lit(0).cast("bigint").alias("pos"))))
        .otherwise(F.coalesce("factors", F.expr(f"cast(array() as {_FACTORS})"))).alias("factors"))


#: The digest columns of ``parse`` as DuckDB SQL over ``documents``.
ORACLE = f"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - {WINDOW - 2})) AS p,
             unnest(list_transform(range(1, len(w) - {WINDOW - 2}), lambda p: md5(array_to_string(w[p:p + {WINDOW - 1}], ' ')))) AS h
      FROM w WHERE len(w) >= {WINDOW}),
f AS (SELECT h, min(doc_id) AS ref FROM s GROUP BY h),
m AS (SELECT doc_id, p FROM s JOIN f USING (h) WHERE ref < doc_id),
g AS (SELECT doc_id, list_distinct(flatten(list(range(p, p + {WINDOW})))) AS gone FROM m GROUP BY doc_id),
k AS (SELECT w.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
             CASE WHEN gone IS NULL THEN w
                  ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END AS kept
      FROM w LEFT JOIN g ON g.doc_id = w.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""
