"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into segments of ``SEGMENT`` bytes. Two GRUs, one from each end, read every segment; at
every byte the two states give the probabilities of the languages, and a document's probabilities are the mean over
all its bytes, however long it is. The network is written and trained here in numpy, by backpropagation through time
with Adam, on a bounded sample: at most ``DOCS_PER_LANG`` labelled documents per language, chosen by a hash of the id,
and ``STEPS`` batches of segments from them. The fitted weights (about 50 kB) are broadcast, and prediction is one pass
over the documents without a shuffle.

The labels come from documents whose crc32(id as text) modulo 4 is not 2; a prediction reads the text alone.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text if there is nothing
to learn from; a null id is never held out and never learned from; repeated rows get equal results; empty tables give
an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.tables import bounded_batches, give_back, tidy
from stationflow.llm.words import text_buffers

SEGMENT = 64
HIDDEN = 8
DOCS_PER_LANG = 250
#: Parts of a language that are ranked on their own first.
SALTS = 64
STEPS = 260
BATCH = 192
RATE = 0.02
SEED = 11
UNKNOWN = "und"
#: A language counts as known from this part of the way from an even guess to certainty on (0.344 of four languages), and
#: for any shorter text with a letter, whose mean is over too few bytes to say.
LEAST_LEAD = 1 / 8
LEAST_BYTES = 256

#: Segments that are read side by side.
WIDTH = 2048


class Network:
    """Weights: input table x (2, 256, 3H), recurrent u (2, H, 3H), output o (2H, C) and bias b (C).

    Gates are laid out as update, reset, candidate; direction 0 reads forwards, 1 backwards.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.x = (rng.normal(size=(2, 256, 3 * hidden)) * 0.3).astype(np.float32)
        self.u = (rng.normal(size=(2, hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.o = (rng.normal(size=(2 * hidden, len(languages))) / np.sqrt(2 * hidden)).astype(np.float32)
        self.b = np.zeros(len(languages), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.x, self.u, self.o, self.b]

    def states(self, segments: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (T, 2, N, H) at every byte of segments (N, T); ``trace`` gets each step's gates."""
        n, length = segments.shape
        hid = self.hidden
        columns = np.ascontiguousarray(segments.T).astype(np.int64)
        h = np.zeros((2, n, hid), np.float32)
        x = np.empty((2, n, 3 * hid), np.float32)
        out = np.empty((length, 2, n, hid), np.float32)
        for t in range(length):
            np.take(self.x[0], columns[t], axis=0, out=x[0])
            np.take(self.x[1], columns[length - 1 - t], axis=0, out=x[1])
            g = np.matmul(h, self.u)
            gates = x[:, :, :2 * hid] + g[:, :, :2 * hid]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :, :hid], gates[:, :, hid:]
            c = r * g[:, :, 2 * hid:]
            c += x[:, :, 2 * hid:]
            np.tanh(c, out=c)
            before = h
            h = (before - c) * z + c
            if trace is not None:
                trace.append((before, z, r, c, g[:, :, 2 * hid:]))
            out[t, 0] = h[0]
            out[length - 1 - t, 1] = h[1]
        return out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """(T, N, C) from the states at each byte."""
        hid = self.hidden
        e = states[:, 0] @ self.o[:hid]
        e += states[:, 1] @ self.o[hid:]
        e += self.b
        np.exp(e - e.max(axis=2, keepdims=True), out=e)
        e /= e.sum(axis=2, keepdims=True)
        return e

    def gradients(self, segments: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
        n, length = segments.shape
        hid = self.hidden
        trace: list = []
        states = self.states(segments, trace)
        p = self.probabilities(states)
        pick = p[:, np.arange(n), labels]
        loss = float(-np.log(np.maximum(pick, 1e-12)).mean())
        d = p
        d[:, np.arange(n), labels] -= 1
        d /= n * length
        flat = d.reshape(-1, d.shape[2])
        do = np.concatenate([states[:, k].reshape(-1, hid).T @ flat for k in (0, 1)])
        db = flat.sum(axis=0)
        from_out = np.stack([d @ self.o[:hid].T, d @ self.o[hid:].T], axis=1)  # (T, 2, N, H)
        du = np.zeros_like(self.u)
        into_x = np.empty((2, length, n, 3 * hid), np.float32)
        back = np.zeros((2, n, hid), np.float32)
        for t in reversed(range(length)):
            before, z, r, c, gc = trace[t]
            dh = back + np.stack([from_out[t, 0], from_out[length - 1 - t, 1]])
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (before - c) * z * (1 - z)
            dr = dc * gc * r * (1 - r)
            dg = np.concatenate([dz, dr, dc * r], axis=2)
            du += np.matmul(before.transpose(0, 2, 1), dg)
            back = dh * z + np.matmul(dg, self.u.transpose(0, 2, 1))
            into_x[0, t] = np.concatenate([dz[0], dr[0], dc[0]], axis=1)
            into_x[1, length - 1 - t] = np.concatenate([dz[1], dr[1], dc[1]], axis=1)
        codes = segments.T.reshape(-1)
        dx = np.stack([np.stack([np.bincount(codes, into_x[k].reshape(-1, 3 * hid)[:, j], 256)
                                 for j in range(3 * hid)], axis=1) for k in (0, 1)]).astype(np.float32)
        return loss, [dx, du, do, db]


def segments_of(raw: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """A text's bytes as rows of one segment each; the last row is padded with zero bytes."""
    rows = -(-len(raw) // segment)
    out = np.zeros(rows * segment, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(rows, segment)


def train(texts: list[tuple[str, str]], steps: int = STEPS, batch: int = BATCH, rate: float = RATE,
          seed: int = SEED) -> Network | None:
    """Fits a network to (language, text) pairs; None if there is nothing to fit."""
    by_lang: dict[str, list[np.ndarray]] = {}
    for lang, text in texts:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if len(raw):
            by_lang.setdefault(lang, []).append(segments_of(raw))
    languages = sorted(by_lang)
    if not languages:
        return None
    pools = [np.concatenate(by_lang[lang]) for lang in languages]
    net = Network(languages, seed=seed)
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    for step in range(1, steps + 1):
        labels = rng.integers(0, len(languages), batch)
        chosen = np.stack([pools[k][rng.integers(0, len(pools[k]))] for k in labels])
        _, grads = net.gradients(chosen, labels)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = rate * (1 - step / (steps + 1))
        for w, g, (m, v) in zip(net.weights(), grads, moments):
            g = g * min(1.0, 1.0 / max(norm, 1e-12))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def predict(net: Network, column: pa.Array, width: int = WIDTH) -> np.ndarray:
    """Mean probabilities (rows, C) over all bytes of every text; rows without bytes are zero."""
    offs, raw = text_buffers(column)
    sizes = np.diff(offs)
    total = np.zeros((len(sizes), len(net.languages)))
    pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> None:
        segments = np.concatenate([p[0] for p in pending])
        owner = np.concatenate([p[1] for p in pending])
        filled = np.concatenate([p[2] for p in pending])
        for a in range(0, len(segments), width):
            probs = net.probabilities(net.states(segments[a: a + width]))
            probs *= (np.arange(SEGMENT)[:, None] < filled[None, a: a + width])[:, :, None]
            summed = probs.sum(axis=0, dtype=np.float64)
            for k in range(summed.shape[1]):
                total[:, k] += np.bincount(owner[a: a + width], summed[:, k], len(sizes))

    for row in np.flatnonzero(sizes):
        at, end = int(offs[row]), int(offs[row + 1])
        while at < end:  # a long text goes through in parts of whole segments
            to = min(end, at + SEGMENT * width)
            part = segments_of(raw[at:to])
            filled = np.full(len(part), SEGMENT)
            filled[-1] = (to - at) - SEGMENT * (len(part) - 1)
            pending.append((part, np.full(len(part), row), filled))
            held += len(part)
            at = to
            if held >= width:
                flush()
                pending, held = [], 0
    if pending:
        flush()
    return total / np.maximum(sizes, 1)[:, None]


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        docs_per_lang: int = DOCS_PER_LANG) -> Network | None:
    """Fits on at most ``docs_per_lang`` documents per language outside the held-out quarter."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    known = rows.where("i is not null and l is not null and t is not null").where(~_held_out(F.col("i")))
    # the first by hash of each salt, then of the language: the last step sees at most SALTS * docs_per_lang rows
    chosen = known.select("i", "l").distinct().withColumn("h", F.xxhash64(F.lit(SEED), "i"))
    chosen = chosen.withColumn("s", F.pmod("h", F.lit(SALTS)))
    for group in (["l", "s"], ["l"]):
        order = Window.partitionBy(*group).orderBy("h", "i")
        chosen = chosen.withColumn("k", F.row_number().over(order)).where(F.col("k") <= docs_per_lang).drop("k")
    chosen = chosen.select("i", "l")
    # at most docs_per_lang rows per language on either side of the join and on the driver
    found = (known.join(F.broadcast(chosen), ["i", "l"]).groupBy("i", "l").agg(F.min("t").alias("t")).collect())
    return train([(r["l"], r["t"]) for r in sorted(found, key=lambda r: (r["l"], r["i"]))])


def identify(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; fits a network on ``docs`` if none is given."""
    bounded_batches(docs.sparkSession)
    net = net or fit(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), _held_out(F.col(id_col).cast("bigint")).alias("held_out"),
                       F.col(text_col).alias("t"))
    return rows.mapInArrow(_predictor(shared), "doc_id bigint, held_out boolean, lang_pred string, score double")


def _predict(net: Network | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The best language and its mean probability per text; ``und`` and 0 without a letter."""
    lettered = pc.fill_null(pc.match_substring_regex(texts.cast(pa.large_string()), r"\p{L}"), False)
    lettered = lettered.to_numpy(zero_copy_only=False)
    if net is None or not len(texts):
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    probs = predict(net, texts)
    names = [net.languages[k] if ok else UNKNOWN for k, ok in zip(probs.argmax(axis=1), lettered)]
    return names, np.where(lettered, np.clip(probs.max(axis=1), 0, 1), 0.0).round(6)


def _predictor(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = _predict(shared.value, batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)],
                                  names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def accepted(docs: DataFrame, least_lead: float = LEAST_LEAD, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """The rows whose language is known: a letter, and a best mean probability ``least_lead`` of the way from an even
    guess to certainty, or fewer than ``LEAST_BYTES`` bytes.

    Only the text goes to Python; the rows stay where they are. Rows without a text or a letter go, and all rows if
    there is no language to learn; rows with a repeated or no id are judged on their own; an empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    net = fit(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    even = 1 / len(net.languages) if net else 1.0
    least = even + least_lead * (1 - even) - 1e-6  # scores are rounded

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        names, scores = _predict(shared.value, texts)
        short = (pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) < LEAST_BYTES).tolist()
        out = pa.array([name != UNKNOWN and (few or score >= least) for name, few, score in zip(names, short, scores)], pa.bool_())
        give_back()
        return out

    return docs.where(known(F.col(text_col)))
