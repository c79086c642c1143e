"""Alignment of two tokenizers over the same bytes: overlaps by ``pandas.merge_asof``, groups by equal ends.

Side A is a byte-level BPE (tokenizers library), side B a SentencePiece BPE with byte fallback; both are read from
files whose paths are parameters. Side A encodes a blank and the text, side B the text, to which it adds that blank
itself, so both cover the same bytes. Strings of special tokens inside a text are plain text.

Per batch, with the document as key, every token start of one side finds the token of the other side that covers it
(the last one that starts no later); the union of both directions is every overlapping pair of tokens. Places where a
token of either side ends cut the document into groups; a link is a pair of tokens that end together.

Texts are cut before a blank that follows another printable ASCII character: neither tokenizer has a token across such
a place (checked for side B's vocabulary when it is loaded), so both end there. Long texts go through in such parts and
memory is bounded by the batch, or by the longest stretch without such a place. Each distinct piece is encoded once per
worker (``tokenstore.Encoder``).

Corpus-wide counts of linked id pairs are added up per document first. Looking them up again is heavy-light: the most
frequent pairs, ``LOOKUP`` of them at most, are broadcast; every other pair is rare and joined by a shuffle.

Defined results: a text that is null or empty, or whose tokens of a side do not give back the blank and the text (side B
reads U+2581 as a blank), has no tokens: zeros and an empty digest; rows that share an id or have none are documents of
their own and keep their id; an empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.tables import Scratch, tidy
from stationflow.llm.tokenstore import Encoder
from stationflow.llm.words import text_buffers

#: Bytes of text that are aligned together, pieces that a worker remembers of each side, pairs that are broadcast.
UNIT_BYTES = 1_000_000
MEMORY = 400_000
LOOKUP = 1 << 20

#: U+2581, which the SentencePiece model writes for a blank.
_BLANK = "▁"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is printable Latin-1, else
    the next free one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class SideA(Encoder):
    """The byte-level tokenizer; ``tokens`` holds the bytes of every id."""

    memory = MEMORY

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.literals = []
        alphabet = byte_alphabet()
        added = self.tokenizer.get_added_tokens_decoder()
        self.tokens = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.tokens[i] = token.encode() if i in added else bytes(alphabet[c] for c in token)


class SideB(Encoder):
    """The SentencePiece model behind the same memory of pieces; every piece starts with the blank that it adds."""

    memory = MEMORY

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.literals = []
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [bytes([int(name[1:-1], 16)]) if self.model.is_byte(i) else name.replace(_BLANK, " ").encode()
                       for i, name in enumerate(names)]
        #: no token holds a blank after another character, so a blank after one starts a token
        self.cuts_at_blanks = not any(_BLANK in name.lstrip(_BLANK) for name in names)
        self.forget()

    def borders(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(raw), bool)
        if self.cuts_at_blanks:
            cut[1:] = (raw[1:] == 0x20) & (raw[:-1] != 0x20)
        cut[offs[:-1][offs[:-1] < len(raw)]] = True
        return np.flatnonzero(cut)

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        found = [np.array(ids, np.uint32) for ids in self.model.encode([t[1:] for t in texts], num_threads=1)]
        alone = np.array([self.model.piece_to_id(_BLANK)], np.uint32)  # the model adds no blank to an empty text
        return [alone if text == " " else ids for text, ids in zip(texts, found)]


_SIDES: dict[tuple[str, str], tuple[SideA, SideB]] = {}


def sides(path_a: str, path_b: str) -> tuple[SideA, SideB]:
    """This Python worker's two tokenizers, whose memory later tasks of the worker use again."""
    if (path_a, path_b) not in _SIDES:
        _SIDES[path_a, path_b] = SideA(path_a), SideB(path_b)
    return _SIDES[path_a, path_b]


def parts(column: pa.Array, unit: int, cut: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, offsets, bytes) of about ``unit`` bytes: whole texts or, of longer ones, parts between safe places; each
    part starts with a blank of its own. Null and empty texts have no part."""
    offs, raw = text_buffers(column)
    rows: list[int] = []
    held: list[np.ndarray] = []
    size = 0

    def flush():
        bounds = np.concatenate(([0], np.cumsum([len(h) for h in held])))
        return np.array(rows, np.int64), bounds, np.concatenate(held)

    blank = np.array([0x20], np.uint8)
    for row in range(len(offs) - 1):
        text = raw[offs[row]: offs[row + 1]]
        if not len(text):
            continue
        rest = np.concatenate([blank, text])
        if cut and len(rest) > unit:
            before = rest[:-1]
            safe = np.flatnonzero((rest[1:] == 0x20) & (before > 0x20) & (before < 0x7F)) + 1
        else:
            safe = np.zeros(0, np.int64)
        at = 0
        while at < len(rest):
            to = len(rest)
            if to - at > unit and len(safe):
                k = int(np.searchsorted(safe, at + unit, side="right")) - 1
                if k < 0 or safe[k] <= at:
                    k += 1
                if k < len(safe) and safe[k] > at:
                    to = int(safe[k])
            if held and size + to - at > unit:
                yield flush()
                rows, held, size = [], [], 0
            rows.append(row)
            held.append(rest[at:to])
            size += to - at
            at = to
    if held:
        yield flush()


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Pairs of token numbers (i, j) that share a byte; both frames hold doc, start and i or j in the order of start."""
    covered_a = pd.merge_asof(a, b.rename(columns={"start": "other"}).assign(start=b["start"]), on="start", by="doc")
    covered_b = pd.merge_asof(b, a.rename(columns={"start": "other"}).assign(start=a["start"]), on="start", by="doc")
    covered_b = covered_b[covered_b["other"] < covered_b["start"]]  # equal starts are in the first direction
    return pd.concat([covered_a[["doc", "i", "j"]], covered_b[["doc", "i", "j"]]])


class _Side:
    """Tokens of one side over a unit: ids, starts, ends, the part each lies in, and the parts given back whole."""

    def __init__(self, encoder: Encoder, offs: np.ndarray, raw: np.ndarray, lengths: np.ndarray):
        ids = encoder.encode(offs, raw)
        count = np.array([len(i) for i in ids], np.int64)
        self.ids = np.concatenate(ids).astype(np.int64)
        self.part = np.repeat(np.arange(len(ids)), count)
        size = lengths[self.ids]
        upto = np.concatenate(([0], np.cumsum(size)))
        first = np.concatenate(([0], np.cumsum(count)))
        self.same = upto[first[1:]] - upto[first[:-1]] == offs[1:] - offs[:-1]
        self.start = upto[:-1] - upto[first[:-1]][self.part] + offs[:-1][self.part]
        self.end = self.start + size
        whole = raw.tobytes()
        for k in np.flatnonzero(self.same):
            said = b"".join([encoder.tokens[i] for i in ids[k].tolist()])
            self.same[k] = said == whole[offs[k]: offs[k + 1]]

    def keep(self, good: np.ndarray) -> None:
        mine = good[self.part]
        self.ids, self.part, self.start, self.end = self.ids[mine], self.part[mine], self.start[mine], self.end[mine]


class Aligner:
    """Aligns batches of texts; one result per text, see ``column``."""

    def __init__(self, path_a: str, path_b: str, unit: int = UNIT_BYTES):
        self.a, self.b = sides(path_a, path_b)
        self.unit = unit
        self.width = len(self.b.tokens)
        self.length_a = np.array([len(t) for t in self.a.tokens], np.int64)
        self.length_b = np.array([len(t) for t in self.b.tokens], np.int64)
        # texts of the canonical form: an A id before another or the bar, a B id before another or the semicolon
        n_a = len(self.a.tokens)
        self.said = np.array([f"{i}," for i in range(n_a)] + [f"{i}|" for i in range(n_a)]
                             + [f"{i}," for i in range(self.width)] + [f"{i};" for i in range(self.width)], object)

    def unit_of(self, rows: np.ndarray, offs: np.ndarray, raw: np.ndarray):
        """(row, sides agree, n_a, n_b, n_groups, n_overlaps, canonical text, pairs, their links) of every part."""
        a, b = _Side(self.a, offs, raw, self.length_a), _Side(self.b, offs, raw, self.length_b)
        good = a.same & b.same
        a.keep(good)
        b.keep(good)
        n = len(rows)
        pairs = overlaps(pd.DataFrame({"doc": a.part, "start": a.start, "i": np.arange(len(a.ids))}),
                         pd.DataFrame({"doc": b.part, "start": b.start, "j": np.arange(len(b.ids))}))
        doc, i, j = (pairs[c].to_numpy(np.int64) for c in ("doc", "i", "j"))
        n_overlaps = np.bincount(doc, minlength=n)
        linked = a.end[i] == b.end[j]
        doc, i, j = doc[linked], i[linked], j[linked]
        last_a, last_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
        last_a[i], last_b[j] = True, True
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        groups = int(last_a.sum())
        b_before = np.concatenate(([0], np.cumsum(np.bincount(group_b, minlength=groups))))
        a_before = np.concatenate(([0], np.cumsum(np.bincount(group_a, minlength=groups))))
        text = np.empty(len(a.ids) + len(b.ids), np.int64)
        text[np.arange(len(a.ids)) + b_before[group_a]] = a.ids + np.where(last_a, len(self.a.tokens), 0)
        text[np.arange(len(b.ids)) + a_before[group_b + 1]] = b.ids + 2 * len(self.a.tokens) + np.where(last_b, self.width, 0)
        words = self.said[text]
        n_a, n_b = np.bincount(a.part, minlength=n), np.bincount(b.part, minlength=n)
        n_groups = np.bincount(a.part[last_a], minlength=n)
        at = np.concatenate(([0], np.cumsum(n_a + n_b)))
        span = self.width * len(self.a.tokens)
        keys, links = np.unique(doc * span + a.ids[i] * self.width + b.ids[j], return_counts=True)
        ptr = np.searchsorted(keys, np.arange(n + 1) * span)
        for k in range(n):
            mine = slice(ptr[k], ptr[k + 1])
            yield (int(rows[k]), bool(good[k]), int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_overlaps[k]),
                   "".join(words[at[k]: at[k + 1]].tolist()), keys[mine] - k * span, links[mine])

    def column(self, texts: pa.Array) -> list[tuple]:
        """(n_a, n_b, n_groups, n_overlaps, digest, pairs, links) of every text of a column, in order."""
        out: list[tuple] = [(0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
        open_row, held, failed = -1, [], False

        def close():
            if open_row < 0 or failed:
                return
            digest = hashlib.sha256()
            for k, h in enumerate(held):
                digest.update((h[4] if k < len(held) - 1 else h[4][:-1]).encode())
            if len(held) == 1:
                pairs, links = held[0][5:]
            else:
                pairs, where = np.unique(np.concatenate([h[5] for h in held]), return_inverse=True)
                links = np.bincount(where, np.concatenate([h[6] for h in held]), len(pairs)).astype(np.int64)
            out[open_row] = (*(sum(h[c] for h in held) for c in range(4)), digest.hexdigest(), pairs, links)

        for rows, offs, raw in parts(texts, self.unit, self.b.cuts_at_blanks):
            for row, good, *found in self.unit_of(rows, offs, raw):
                if row != open_row:
                    close()
                    open_row, held, failed = row, [], False
                failed |= not good
                held.append(found)
        close()
        return out


_ALIGNED = ("id bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_overlaps bigint, groups_sha256 string, "
            "pairs array<bigint>, links array<bigint>")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _align(path_a: str, path_b: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = aligner.column(part.column(2))
                yield pa.record_batch(
                    [part.column(0), part.column(1),
                     *[pa.array([f[c] for f in found], pa.int64()) for c in range(4)],
                     pa.array([f[4] for f in found], pa.string()), _lists([f[5] for f in found]), _lists([f[6] for f in found])],
                    names=["id", "doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "groups_sha256", "pairs", "links"])
    return run


def _vocabulary(path_a: str, path_b: str) -> int:
    """Number of side B's ids, by which a pair is packed into one number."""
    return len(sides(path_a, path_b)[1].tokens)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): links of every id pair over all documents, and whether no pair of its B id has more."""
    each = aligned.select(F.inline(F.arrays_zip("pairs", "links"))).groupBy("pairs").agg(F.sum("links").alias("n"))
    # one group per B id, at most one row per A id in it
    same_b = Window.partitionBy(F.col("pairs") % width)
    return each.withColumn("best", F.col("n") == F.max("n").over(same_b)).withColumnRenamed("pairs", "pair")


def _heavy(counts: DataFrame, lookup: int) -> tuple[int, int]:
    """(least count of the pairs to broadcast, number of pairs below it): a power of two, ``lookup`` pairs at most."""
    bits = F.floor(F.log2("n")).cast("int")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(bits).agg(F.count(F.lit(1))).collect()), reverse=True)
    taken, least, light = 0, 1 << 62, 0
    for power, n in sizes:
        if light or taken + n > lookup:
            light += n
        else:
            taken, least = taken + n, 1 << power
    return least, light


_LOOKED_UP = ("id bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
              "count_sum bigint, groups_sha256 string, n_overlaps bigint, pairs array<bigint>, links array<bigint>")


def _look_up(shared):
    """Sums over the broadcast pairs of every document; the pairs not among them stay in the two lists."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            one = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            size = pc.list_value_length(one["pairs"]).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), size)
            key, links = one["pairs"].flatten().to_numpy(), one["links"].flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            hit = known[at] == key if len(known) else np.zeros(len(key), bool)
            sums = []
            for value in (links, np.where(hit, links * best[at], 0) if len(known) else links * 0,
                          np.where(hit, links * n[at], 0) if len(known) else links * 0):
                total = np.zeros(batch.num_rows, np.int64)  # whole numbers: a sum of counts may pass 2**53
                np.add.at(total, row, value)
                sums.append(pa.array(total))
            ends = np.concatenate(([0], np.cumsum(~hit)))[np.concatenate(([0], np.cumsum(size)))].astype(np.int32)
            left = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[~hit])) for x in (key, links)]
            yield pa.record_batch([one["id"], one["doc_id"], one["n_a"], one["n_b"], one["n_groups"], *sums,
                                   one["groups_sha256"], one["n_overlaps"], *left],
                                  names=[f.split()[0] for f in _LOOKED_UP.split(", ")])
    return run


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, lookup: int = LOOKUP, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps of every row.

    The paths must be the same on every machine; by default they are the files of the installed ``public_tokenizers``.
    """
    spark = docs.sparkSession
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    scratch = Scratch(spark, "alignment")
    rows = docs.select(F.monotonically_increasing_id().alias("id"), F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("t"))
    aligned = scratch.keep(rows.mapInArrow(_align(path_a, path_b), _ALIGNED), "aligned")
    counts = scratch.keep(pair_counts(aligned, _vocabulary(path_a, path_b)), "counts")
    least, light = _heavy(counts, lookup)
    top = counts.where(F.col("n") >= least).toArrow()  # at most ``lookup`` rows
    key = top.column("pair").to_numpy()
    order = np.argsort(key)
    shared = spark.sparkContext.broadcast((key[order], top.column("n").to_numpy()[order],
                                           top.column("best").to_numpy()[order].astype(np.int64)))
    found = aligned.mapInArrow(_look_up(shared), _LOOKED_UP)
    if light:
        found = scratch.keep(found, "found")
        # every pair here has fewer than ``least`` links, so no key is hot
        rare = (found.select("id", F.inline(F.arrays_zip("pairs", "links"))).join(
            counts.where(F.col("n") < least), F.col("pairs") == F.col("pair"))
            .groupBy("id").agg(F.sum(F.col("links") * F.col("best").cast("bigint")).alias("b"),
                               F.sum(F.col("links") * F.col("n")).alias("s")))
        found = (found.join(rare, "id", "left")
                 .withColumn("n_best", F.col("n_best") + F.coalesce("b", F.lit(0)))
                 .withColumn("count_sum", F.col("count_sum") + F.coalesce("s", F.lit(0))))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
