"""Token ids on disk: independent zstandard frames, a trailing seek table, per-frame checksums.

File layout (the public seekable-zstd layout): data frames, each with zstandard's own content checksum, a skippable
frame with the first and last document id of every data frame, then the skippable frame of the seek table with an entry
per data frame (compressed size, decompressed size, low 32 bits of the content's XXH64) and a footer (number of frames,
descriptor, magic). A data frame holds whole documents: their number n, n document ids (signed 64-bit), n token counts
(32-bit), then all ids (32-bit), little-endian. A reader takes both tables from the file's end and decompresses only the
frames that hold the requested documents: one, unless an id that occurs several times spans more.

Documents are range-partitioned by id, so file k holds smaller ids than file k + 1 and files are sorted inside.

Encoding: a byte-level BPE with the usual word pattern treats each pre-token on its own. Texts are cut at places that
are certain to be pre-token borders (``cuts``), each distinct piece is encoded once per worker by the tokenizers library,
and the ids are put back in order; texts that hold an added token's literal string are encoded whole.

Defined results: a null text is empty and holds the end id only; rows that share an id are stored one after the other
(shorter text first); a null id is stored as the least 64-bit number and sorts first; an empty table has no files;
only the two named columns are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow.llm.tables import Scratch
from stationflow.llm.words import pieces, text_buffers

END = 2
FRAME_IDS = 1 << 16
#: Bytes of text per file.
FILE_BYTES = 24_000_000
#: Bytes of text that are encoded together, and distinct pieces that a worker remembers.
UNIT_BYTES = 2_000_000
MEMORY = 1_500_000

# fixed values of the public format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

_NULL_ID = -(1 << 63)
_MANIFEST = "file string, n_frames int, n_docs bigint, n_ids bigint, first_id bigint, last_id bigint"

_SPACE, _OTHER_SPACE, _LETTER_DIGIT, _PUNCT, _SAFE, _LEAD = 1, 2, 4, 8, 16, 32


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[0x20] |= _SPACE
    kind[9:14] |= _OTHER_SPACE
    for lo, hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
        kind[lo: hi + 1] |= _LETTER_DIGIT
    kind[0x21:0x7F] |= _SAFE
    kind[0x21:0x7F] |= np.where(kind[0x21:0x7F] & _LETTER_DIGIT, 0, _PUNCT).astype(np.uint8)
    kind[ord("'")] &= np.uint8(255 - _PUNCT)
    kind[0xC3:0xF5] |= _LEAD  # lead bytes of characters that are no white space
    kind[[0xE1, 0xE2, 0xE3]] = 0
    return kind


_KIND = _classes()


def cuts(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of pieces that the word pattern is certain to treat apart, every text's start among them.

    Certain borders: before white space that follows a printable ASCII character; before the last
    white space of a run; after white space other than a blank that is followed by such a character;
    between an ASCII letter or digit and ASCII punctuation other than an apostrophe.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    k = _KIND[raw]
    before = np.zeros(n, np.uint8)
    before[1:] = k[:-1]
    after = np.zeros(n, np.uint8)
    after[:-1] = k[1:]
    space = (k & (_SPACE | _OTHER_SPACE)) > 0
    solid = (k & (_SAFE | _LEAD)) > 0
    next_solid = (after & (_SAFE | _LEAD)) > 0
    last = offs[1:][(offs[1:] > 0)] - 1
    next_solid[last] = False
    cut = space & (((before & _SAFE) > 0) | next_solid)
    cut |= ((before & _OTHER_SPACE) > 0) & solid
    cut |= ((before & _LETTER_DIGIT) > 0) & ((k & _PUNCT) > 0)
    cut[offs[:-1][offs[:-1] < n]] = True
    return np.flatnonzero(cut)


class Encoder:
    """The tokenizers library behind a memory of pieces it has already encoded."""

    memory = MEMORY

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.literals = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)   # sorted piece hashes
        self.slot = np.zeros(0, np.int64)    # their numbers in order of arrival
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def borders(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Starts of the pieces that are encoded on their own."""
        return cuts(raw, offs)

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        ids: list[np.ndarray] = []
        for a in range(0, len(texts), 5_000):
            ids += self.ids_of(texts[a: a + 5_000])
        size = np.array([len(i) for i in ids], np.int64)
        start = len(self.flat) + np.concatenate(([0], np.cumsum(size)[:-1]))
        slot = len(self.size) + np.arange(len(keys))
        self.flat = np.concatenate([self.flat, *ids])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slot = np.insert(self.keys, at, keys), np.insert(self.slot, at, slot)

    def encode(self, offs: np.ndarray, raw: np.ndarray) -> list[np.ndarray]:
        """Ids of every text of a unit, without the end id."""
        starts = self.borders(raw, offs)
        ends = np.append(starts[1:], len(raw)).astype(np.int64) if len(starts) else starts
        hashes = pieces(raw, starts, ends)
        unique, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > self.memory:
            self.forget()
        at = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[at] != unique) if len(self.keys) else np.arange(len(unique))
        if len(new):
            whole = raw.tobytes()
            self._learn(unique[new], [whole[starts[i]: ends[i]].decode() for i in first[new]])
        number = self.slot[np.searchsorted(self.keys, unique)][which]
        size = self.size[number]
        upto = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.repeat(self.start[number] - upto[:-1], size) + np.arange(upto[-1])]
        bounds = upto[np.searchsorted(starts, offs)]
        out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        if any(literal in raw.tobytes() for literal in self.literals):
            for i in range(len(out)):
                text = raw[offs[i]: offs[i + 1]].tobytes()
                if any(literal in text for literal in self.literals):
                    out[i] = np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
        return out

    def column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every text of a column, in order."""
        offs, raw = text_buffers(texts)
        at, n = 0, len(offs) - 1
        while at < n:
            to = min(n, max(at + 1, int(np.searchsorted(offs, offs[at] + UNIT_BYTES, "right")) - 1))
            yield from self.encode(offs[at: to + 1] - offs[at], raw[offs[at]: offs[to]])
            at = to


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This Python worker's encoder, whose memory later tasks of the worker use again."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class FileWriter:
    """Writes one file frame by frame; only the open frame is in memory."""

    def __init__(self, sink):
        self.sink, self.entries, self.spans = sink, [], []
        self.ids: list[int] = []
        self.tokens: list[np.ndarray] = []
        self.held = self.n_docs = self.n_ids = 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.tokens.append(ids)
        self.held += len(ids)
        if self.held >= FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.ids:
            return
        body = b"".join([struct.pack("<I", len(self.ids)), np.array(self.ids, "<i8").tobytes(),
                         np.array([len(t) for t in self.tokens], "<u4").tobytes(),
                         np.concatenate(self.tokens).astype("<u4").tobytes()])
        packed = self.compressor.compress(body)
        self.sink.write(packed)
        self.entries.append(struct.pack("<III", len(packed), len(body), xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
        self.spans.append(struct.pack("<qq", self.ids[0], self.ids[-1]))
        self.n_docs += len(self.ids)
        self.n_ids += self.held
        self.ids, self.tokens, self.held = [], [], 0

    def finish(self) -> None:
        self.flush()
        index = b"".join(self.spans)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(index)) + index)
        table = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class FileReader:
    """Random access to a file's frames."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 9)
        count, flag, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a token file")
        source.seek(size - 9 - 12 * count)
        table = np.frombuffer(source.read(12 * count), "<u4").reshape(count, 3)
        self.sizes, self.contents, self.checks = table.T
        self.starts = np.concatenate(([0], np.cumsum(self.sizes.astype(np.int64))))
        self.frames = count
        source.seek(size - 9 - 12 * count - 8 - 16 * count)
        self.first, self.last = np.frombuffer(source.read(16 * count), "<i8").reshape(count, 2).T

    def frame(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document ids, token counts, token ids) of frame k, checked."""
        self.source.seek(int(self.starts[k]))
        body = zstandard.ZstdDecompressor().decompress(self.source.read(int(self.sizes[k])))
        if len(body) != self.contents[k] or xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"frame {k} is damaged")
        n = struct.unpack_from("<I", body)[0]
        ids = np.frombuffer(body, "<i8", n, 4)
        counts = np.frombuffer(body, "<u4", n, 4 + 8 * n)
        return ids, counts, np.frombuffer(body, "<u4", -1, 4 + 12 * n)


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _writer(folder: str, tokenizer_path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"ids-{context.partitionId():06d}.zst"
        fs, root = _filesystem(folder)
        # written under this attempt's own name, then moved: a second attempt puts equal bytes in the same place
        draft = f"{root}/.{name}.{context.taskAttemptId()}"
        sink = writer = first = last = None
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, tokens in zip(ids, encoder(tokenizer_path).column(batch.column(1))):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(draft)
                    writer, first = FileWriter(sink), doc_id
                writer.add(doc_id, np.append(tokens, np.uint32(END)))
                last = doc_id
        if writer is not None:
            writer.finish()
            sink.close()
            fs.move(draft, f"{root}/{name}")
            yield pa.RecordBatch.from_pylist([{
                "file": name, "n_frames": len(writer.entries), "n_docs": writer.n_docs, "n_ids": writer.n_ids,
                "first_id": first, "last_id": last}], pa.schema([
                    ("file", pa.string()), ("n_frames", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                    ("first_id", pa.int64()), ("last_id", pa.int64())]))
    return write


def write(docs: DataFrame, folder: str, scratch: Scratch, tokenizer_path: str, id_col: str = "doc_id",
          text_col: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encodes and writes ``docs``; returns the manifest, one row per file."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL_ID)).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    size = int(rows.agg(F.sum(F.octet_length("t") + 1)).first()[0] or 0)
    files = max(1, -(-size // file_bytes))
    ordered = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", F.octet_length("t"), "t")
    return scratch.keep(ordered.mapInArrow(_writer(folder, tokenizer_path), _MANIFEST), "manifest")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        for batch in batches:
            for name, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = f"{root}/{name}"
                with fs.open_input_file(path) as source:
                    reader = FileReader(source, source.size())
                    for k in range(reader.frames):
                        ids, counts, tokens = reader.frame(k)
                        ends = np.cumsum(counts.astype(np.int64))
                        starts = ends - counts
                        crc = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                        yield pa.record_batch([pa.array(ids), pa.array(begin + starts), pa.array(counts.astype(np.int64)),
                                               pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        begin += int(ends[-1]) if len(ends) else 0
    return read


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, from the files."""
    before = F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    files = manifest.select("file", F.coalesce(before, F.lit(0)).cast("bigint").alias("begin"))
    spread = files.repartition(max(1, manifest.count()), "file")
    out = spread.mapInArrow(_reader(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(_NULL_ID), F.col("doc_id")))


def lookup(spark: SparkSession, manifest: DataFrame, folder: str, wanted: list[int]) -> dict[int, list[np.ndarray]]:
    """Ids of some documents, one array per stored row; decompresses only the frames whose ids span one of them."""
    found: dict[int, list[np.ndarray]] = {}
    fs, root = _filesystem(folder)
    near = manifest.where(F.exists(F.array(*[F.lit(int(w)) for w in wanted]),
                                   lambda w: (w >= F.col("first_id")) & (w <= F.col("last_id"))))
    for row in near.orderBy("file").collect():
        with fs.open_input_file(f"{root}/{row['file']}") as source:
            reader = FileReader(source, source.size())
            asked = np.array(sorted(set(wanted)), np.int64)
            for k in range(reader.frames):
                mine = asked[(asked >= reader.first[k]) & (asked <= reader.last[k])]
                if not len(mine):
                    continue
                ids, counts, tokens = reader.frame(k)
                ends = np.cumsum(counts.astype(np.int64))
                for i in np.flatnonzero(np.isin(ids, mine)):
                    found.setdefault(int(ids[i]), []).append(tokens[ends[i] - counts[i]: ends[i]])
    return found


def store(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes all documents (to a fresh shared folder if none is named) and reads the digest back from the files."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    scratch = Scratch(docs.sparkSession, "tokens")
    folder = folder or scratch.path("files")
    return read(write(docs, folder, scratch, tokenizer_path, id_col, text_col, file_bytes), folder)
