"""Conversation structure repair by the auction shortest-path algorithm.

A conversation should read as an optional system turn and then pairs of a user and an assistant turn, or be empty. The
rows seen and the last role written are the nodes of a lattice whose arcs are edits with whole costs: keep a row (0),
write it under the role that fits (2), delete it (3), insert an empty turn (2); blank and duplicate rows must go, and a
truncated row that stays costs 1 more.

The auction keeps a price per node and one path. At the path's last node it takes the least arc cost plus price behind:
above the node's own price, that price rises to it and the path contracts by the node; otherwise the path extends along
the arc. When it reaches the end, the origin's price is the least cost. Prices never pass ``cost + price behind`` on any
arc, so the arcs of all cheapest paths are exactly the tight ones that lead to the end, and the audit is read off them,
the ASCII-least letter first (D < I < K < R; no letter stands for two arcs of a node).

Long conversations go through the auction in blocks of ``BLOCK`` rows, last block first: the four prices at a block's
start are the costs of leaving the block before it. Work is then in proportion to the rows.

On Spark, rows are dealt by conversation and sorted in two streams. The first hands on a row's role initial, fault flags
and text hash only and holds some twenty bytes per row of the open conversation; the second carries the texts, row by row.
One conversation is one stream, however long: its digest is a hash of its rows in order.

Defined results: a row's null role, text, turn or conversation stands for one space where a text is wanted; rows without
a conversation form one; rows go by turn (nulls first), then role, then text; a role counts by its first character; two
rows are duplicates by a 64-bit hash of role and text; a conversation of which nothing is left, or an empty table, gives
empty audits or no row; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.tables import Scratch

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLOCK = 64

#: States of the lattice: nothing written yet, or the last role written.
START, SYSTEM, USER, ASSISTANT = range(4)
_ENDS = (START, ASSISTANT)
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Symbols of rows: x must go; s u a o by role initial, capital letters where the text is truncated.
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_SPACES = " \t\n\x0b\x0c\r"


def arcs(symbol: str, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, rows consumed, next state) of every edit before or at a row; '' after the last row."""
    out = []
    fits = _NEXT[state]
    if symbol:
        out.append(("D", DELETE, 1, state))
    out.append(("I", INSERT, 0, fits))
    if symbol and symbol != "x":
        more = TRUNCATED if symbol.isupper() else 0
        role = _INITIAL.get(symbol.lower())
        if role == fits or (role == SYSTEM and state == START):
            out.append(("K", KEEP + more, 1, role))
        out.append(("R", REROLE + more, 1, fits))
    return out


_ARCS = {(symbol, state): arcs(symbol, state) for symbol in ["", *"xsuaoSUAO"] for state in range(4)}


def auction(symbols: str, leave: dict[int, int], origins: tuple[int, ...]) -> list[int]:
    """Prices of the nodes 4 * row + state of one block after an auction from each origin state at its start.

    ``leave``: cost of going on from each state after the last row, where that is possible. Inserting past the last row
    belongs to the next block, or to this one if the end itself is meant (``leave`` lacks some state then).
    """
    n = len(symbols)
    price = [0] * (4 * n + 4)
    whole = len(leave) == 4
    behind = []
    for i, symbol in enumerate(symbols):
        for state in range(4):
            behind.append([(cost, 4 * (i + rows) + to) for _, cost, rows, to in _ARCS[symbol, state]])
    end = 4 * n + 4
    for state in range(4):
        last = [] if whole else [(cost, 4 * n + to) for _, cost, _, to in _ARCS["", state]]
        if state in leave:
            last.append((leave[state], end))
        behind.append(last)
    price.append(0)
    for origin in origins:
        path = [origin]
        while path[-1] != end:
            node = path[-1]
            least, after = min([(cost + price[to], to) for cost, to in behind[node]])
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(after)
    return price


def trace(symbols: str, leave: dict[int, int], price: list[int], state: int) -> tuple[str, int]:
    """The ASCII-least letters over tight arcs from a state to the end of a block, and the state there."""
    n = len(symbols)
    whole = len(leave) == 4
    tight: list[list[tuple[str, int]]] = [[] for _ in range(4 * n + 4)]
    leads = [False] * (4 * n + 4)
    for i in range(n, -1, -1):
        # an insertion leads to a state of the same row: user before start, system and assistant, and round again
        for again in range(2):
            for q in range(4):
                node = 4 * i + q
                if i == n:
                    leads[node] |= q in leave and price[node] == leave[q]
                tight[node] = [(letter, 4 * (i + rows) + to)
                               for letter, cost, rows, to in (_ARCS[symbols[i], q] if i < n else [] if whole else _ARCS["", q])
                               if price[node] == cost + price[4 * (i + rows) + to] and leads[4 * (i + rows) + to]]
                leads[node] |= bool(tight[node])
    node, out = state, []
    while not (node >= 4 * n and node - 4 * n in leave and price[node] == leave[node - 4 * n]):
        letter, node = min(tight[node])
        out.append(letter)
    return "".join(out), node - 4 * n


def _solve(symbols: str, block: int = BLOCK) -> tuple[int, str]:
    """(least cost, audit) of a conversation's symbols."""
    starts = list(range(0, len(symbols), block)) or [0]
    leaves: list[dict[int, int]] = [dict.fromkeys(_ENDS, 0)]
    cost = 0
    for at in reversed(starts[1:]):
        price = auction(symbols[at: at + block], leaves[-1], (0, 1, 2, 3))
        # what all four have in common is set aside, or every later block would raise its prices to it again
        least = min(price[:4])
        cost += least
        leaves.append({q: price[q] - least for q in range(4)})
    leaves.reverse()
    state, out = START, []
    for k, at in enumerate(starts):
        part = symbols[at: at + block]
        price = auction(part, leaves[k], (state,))
        cost += price[START] if k == 0 else 0
        letters, state = trace(part, leaves[k], price, state)
        out.append(letters)
    return cost, "".join(out)


_solve_short = lru_cache(maxsize=100_000)(_solve)


def solve(symbols: str) -> tuple[int, str]:
    """(least cost, audit); short conversations that look alike are solved once per worker."""
    return _solve_short(symbols) if len(symbols) <= BLOCK else _solve(symbols)


class Seen:
    """64-bit hashes met so far; beyond ``small`` of them, in sorted arrays of doubling size."""

    def __init__(self, small: int = 1 << 16):
        self.small, self.recent, self.sorted = small, set(), []

    def add(self, h: int) -> bool:
        """Whether ``h`` is new."""
        if h in self.recent:
            return False
        for held in self.sorted:
            at = int(np.searchsorted(held, h))
            if at < len(held) and held[at] == h:
                return False
        self.recent.add(h)
        if len(self.recent) >= self.small:
            new = np.sort(np.fromiter(self.recent, np.int64, len(self.recent)))
            while self.sorted and len(self.sorted[-1]) <= len(new):
                new = np.sort(np.concatenate([self.sorted.pop(), new]))
            self.sorted.append(new)
            self.recent = set()
        return True


def _same(a: int | None, b: int | None) -> bool:
    return a == b and (a is None) == (b is None)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """(first of its conversation, row) of sorted batches whose first column is the conversation."""
    open_id, some = None, False
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            first = not some or not _same(row[0], open_id)
            open_id, some = row[0], True
            yield first, row


_AUDIT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string")
_LONG = (1 << 63) - 1


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its sorted rows (conv_id, turn, initial, hash, blank, truncated)."""
    done: list[tuple] = []
    names = [f.split()[0] for f in _AUDIT.split(", ")]
    types = [pa.string() if name == "audit" else pa.int64() for name in names]

    def batch():
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    state: dict = {}

    def close():
        if state:
            cost, audit = solve("".join(state["symbols"]))
            gaps = state["last"] - state["least"] + 1 - state["turns"] if state["turns"] else 0
            done.append((state["id"], min(gaps, _LONG), state["blank"], state["duplicate"], state["truncated"],
                         state["illegal"], cost, audit))

    for first, (conv_id, turn, initial, h, blank, truncated) in _conversations(batches):
        if first:
            close()
            if len(done) >= 2000:
                yield batch()
                done = []
            state = {"id": conv_id, "symbols": [], "seen": Seen(), "turns": 0, "least": turn, "last": None,
                     "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "before": None}
        if turn is not None and (not state["turns"] or turn != state["last"]):
            state["least"] = turn if not state["turns"] else state["least"]
            state["turns"] += 1
            state["last"] = turn
        if state["before"] is not None and state["before"] + initial not in ("su", "ua", "au"):
            state["illegal"] += 1
        state["before"] = initial
        new = state["seen"].add(h)
        if blank or not new:
            state["blank" if blank else "duplicate"] += 1
            state["symbols"].append("x")
            continue
        symbol = initial if initial in _INITIAL else "o"
        state["truncated"] += truncated
        state["symbols"].append(symbol.upper() if truncated else symbol)
    close()
    if done:
        yield batch()


_REPAIRED = "conv_id bigint, place bigint, role string, text string, edit string"


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows of every conversation: its audit comes first (as text), then its rows."""
    out: list[tuple] = []
    size = 0
    letters, at, state, place, conv_id = "", 0, START, 0, None

    def batch():
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64()] + [pa.string()] * 3)],
                               names=[f.split()[0] for f in _REPAIRED.split(", ")])

    def write(role: str, text: str, edit: str):
        nonlocal place, size, state
        out.append((conv_id, place, role, text, edit))
        place += 1
        size += len(text)

    def insertions():
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            state = _NEXT[state]
            write(_ROLE[state], "", "I")
            at += 1

    for first, (row_conv, kind, role, text) in _conversations(batches):
        if first:
            insertions()
            letters, at, state, place, conv_id = text, 0, START, 0, row_conv
            continue
        insertions()
        letter, at = letters[at], at + 1
        if letter == "R":
            state = _NEXT[state]
            write(_ROLE[state], text, letter)
        elif letter == "K":
            state = SYSTEM if state == START and role[:1] == "s" else _NEXT[state]
            write(role, text, letter)
        if len(out) >= 5000 or size > 1 << 22:
            yield batch()
            out, size = [], 0
    insertions()
    if out:
        yield batch()


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text of the rows after the stated damage; nulls of role and text become one space."""
    blank = F.lit(" ")
    conv, turn = F.col(conv_col).cast("bigint"), F.col(turn_col).cast("bigint")
    key = F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    rows = turns.select(conv.alias("conv_id"), turn.alias("turn"), F.coalesce(F.col(role_col), blank).alias("role"),
                        F.coalesce(F.col(text_col), blank).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("d") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("d") == 3, 2).otherwise(1)))
    return rows.where("d <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("c")).drop("c")


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    order: list[Column] = [F.col(c) for c in ("conv_id", *first)] + [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation that has rows."""
    spaces = F.lit(_SPACES)
    last = F.right(F.rtrim("text", spaces), F.lit(1))
    return _ordered(rows).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), F.xxhash64("role", "text").alias("h"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated")).mapInArrow(_audits, _AUDIT)


def repaired(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """conv_id, place, role, text, edit (K, R or I) of every row of the repaired conversations, in order."""
    head = audit.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
                        F.col("audit").alias("text"))
    both = head.unionByName(rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text"))
    return _ordered(both, "kind").select("conv_id", "kind", "role", "text").mapInArrow(_repairs, _REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of every conversation's repaired rows, which come in order."""
    out: list[tuple] = []
    digest, conv_id = None, None

    def batch():
        return pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())],
                               names=["conv_id", "repaired_sha256"])

    for first, (row_conv, role, text) in _conversations(batches):
        if first:
            if digest is not None:
                out.append((conv_id, digest.hexdigest()))
            if len(out) >= 5000:
                yield batch()
                out = []
            digest, conv_id = hashlib.sha256(), row_conv
        digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
    if digest is not None:
        out.append((conv_id, digest.hexdigest()))
        yield batch()


def report(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The faults, the audit and the digest of the repaired rows of every conversation after the stated damage."""
    scratch = Scratch(turns.sparkSession, "repair")
    rows = damage(turns, conv_col, turn_col, role_col, text_col)
    audit = scratch.keep(audits(rows), "audits")
    # the repaired rows stay in the order in which they were written: no exchange lies between the two
    digest = repaired(rows, audit).select("conv_id", "role", "text").mapInArrow(_digests, "conv_id bigint, repaired_sha256 string")
    known = turns.select(F.col(conv_col).cast("bigint").alias("conv_id")).distinct()
    out = known.join(audit.withColumnRenamed("conv_id", "a"), F.col("conv_id").eqNullSafe(F.col("a")), "left").join(
        digest.withColumnRenamed("conv_id", "b"), F.col("conv_id").eqNullSafe(F.col("b")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
