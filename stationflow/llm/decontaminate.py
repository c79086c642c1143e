"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A document is contaminated by a test item if it holds at least ``CONTAINMENT`` percent of the item's word shingles.
Items are partitioned by size (powers of two of their shingle count). An item's signature is its bottom-k MinHash: its
k smallest shingle hashes, with k = u - ceil(share * u) + 1 for the partition's largest size u. A document that holds
the share of the item misses at most n - ceil(share * n) of its n shingles, which is less than k, so it holds at least
one value of the signature: the search has no false negatives, however long the document is. Documents are compared
only with partitions whose smallest item fits into them. Every candidate is then counted exactly.

The items are a stated query set. They are taken in chunks of at most ``CHUNK_BYTES`` of text, so what is broadcast is
bounded; the documents are scanned once per chunk, without a shuffle.

Words are white-space separated, A-Z in lower case. Items with fewer than five words count as one shingle of all their
words. Defined results: null and blank items or texts match nothing; each copy of an item, and each repeated document
row, gets its own rows; a null id stays null; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.tables import bounded_batches, tidy
from stationflow.llm.words import blocks, runs

WORDS = 5
CONTAINMENT = 80
CHUNK_BYTES = 16_000_000
SCHEMA = "doc_id bigint, item_id bigint, n_hit int, n_item int"

_FILTER = 1 << 16


class Signatures:
    """One chunk of items: their shingle sets, and the signature values with the items that own them."""

    def __init__(self, ids: list, texts: list, share: int = CONTAINMENT, words: int = WORDS):
        self.ids, self.sets, self.spans, self.need = [], [], [], []
        owners: list[tuple[int, int]] = []
        by_size: dict[int, list[int]] = {}
        for b in blocks(pa.array(texts, pa.string()), lower=True):
            for row, i, j in b.rows():
                if j > i:
                    k = min(words, j - i)
                    shingles = np.unique(runs(b.words[i:j], k))
                    by_size.setdefault(len(shingles).bit_length(), []).append(len(self.ids))
                    self.ids.append(ids[row])
                    self.sets.append(shingles)
                    self.spans.append(k)
                    self.need.append(-(-share * len(shingles) // 100))
        for size, items in by_size.items():
            largest = (1 << size) - 1
            k = largest - -(-share * largest // 100) + 1
            for item in items:
                owners += [(int(h), item) for h in self.sets[item][:k]]  # sorted: the k smallest hashes
        owners.sort()
        self.values = {}
        for span in sorted(set(self.spans)):
            mine = [(h, i) for h, i in owners if self.spans[i] == span]
            hashes = np.array([h for h, _ in mine], np.uint64)
            maybe = np.zeros(_FILTER, bool)
            maybe[(hashes % np.uint64(_FILTER)).astype(np.int64)] = True
            self.values[span] = (hashes, np.array([i for _, i in mine], np.int64), maybe)

    def search(self, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(row, item, shingles held) of every pair at or above the share."""
        for b in blocks(texts, lower=True):
            n_words = np.diff(b.ptr)
            for span, (hashes, owner, maybe) in self.values.items():
                r = runs(b.words, span)
                at = np.flatnonzero(maybe[(r & np.uint64(_FILTER - 1)).astype(np.int64)])
                left = np.searchsorted(hashes, r[at], "left")
                count = np.searchsorted(hashes, r[at], "right") - left
                at, left, count = at[count > 0], left[count > 0], count[count > 0]
                if not len(at):
                    continue
                text = np.searchsorted(b.ptr, at, "right") - 1
                whole = at + span <= b.ptr[text + 1]
                at, left, count, text = at[whole], left[whole], count[whole], text[whole]
                rows = np.repeat(text, count)
                flat = np.repeat(left - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                for row, item in np.unique(np.stack([rows, owner[flat]], 1), axis=0).tolist() if len(flat) else []:
                    if n_words[row] - span + 1 >= self.need[item]:  # else the item does not fit
                        own = r[b.ptr[row]: b.ptr[row + 1] - span + 1]
                        held = int(np.isin(self.sets[item], own).sum())
                        if held >= self.need[item]:
                            yield b.first + row, item, held


def contaminated(docs: DataFrame, items: DataFrame, share: int = CONTAINMENT, words: int = WORDS,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_hit, n_item) for every document that holds at least ``share`` percent of an item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    wanted = items.select(F.col(item_col).cast("bigint").alias("i"), F.col(item_text_col).alias("t")).where("t is not null")
    size = wanted.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    chunks = max(1, -(-int(size) // chunk_bytes))
    texts = docs.select(F.col(id_col).cast("bigint").alias("d"), F.col(text_col).alias("t"))
    out = None
    for chunk in range(chunks):
        mine = wanted.where(F.pmod(F.xxhash64("t"), F.lit(chunks)) == chunk).collect() if chunks > 1 else wanted.collect()
        shared = spark.sparkContext.broadcast(Signatures([r[0] for r in mine], [r[1] for r in mine], share, words))
        found = texts.mapInArrow(_searcher(shared), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def _searcher(shared):
    @tidy
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            ids = batch.column(0)
            hits = list(items.search(batch.column(1)))
            if hits:
                rows, owners, held = zip(*hits)
                yield pa.record_batch([ids.take(pa.array(rows, pa.int64())),
                                       pa.array([items.ids[o] for o in owners], pa.int64()),
                                       pa.array(held, pa.int32()),
                                       pa.array([len(items.sets[o]) for o in owners], pa.int32())],
                                      names=["doc_id", "item_id", "n_hit", "n_item"])
    return search


#: The same pairs as DuckDB SQL over ``documents`` and ``benchmark``.
ORACLE = f"""
WITH low AS (
  SELECT 'i' AS kind, item_id AS id, text FROM benchmark UNION ALL SELECT 'd', doc_id, text FROM documents),
w AS (
  SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM low),
k AS (SELECT DISTINCT least({WORDS}, len(w)) AS k FROM w WHERE kind = 'i' AND len(w) > 0),
i AS (
  SELECT DISTINCT id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS s
  FROM w JOIN k ON k = least({WORDS}, len(w)) WHERE kind = 'i' AND len(w) > 0),
d AS (
  SELECT DISTINCT id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS s
  FROM w CROSS JOIN k WHERE kind = 'd' AND len(w) >= k),
n AS (SELECT id, count(*) AS n FROM i GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, CAST(count(*) AS INTEGER) AS n_hit, CAST(any_value(n.n) AS INTEGER) AS n_item
FROM d JOIN i ON d.k = i.k AND d.s = i.s JOIN n ON n.id = i.id
GROUP BY d.id, i.id HAVING 100 * count(*) >= {CONTAINMENT} * any_value(n.n)
"""
