"""Cap filters, conversation repair and tokenizer alignment against brute force."""

import hashlib
import heapq
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stationflow.llm import alignment, capfilters, repair

VECTORS = "vec_id bigint, embedding array<float>, label int, point bigint, row bigint, n bigint"


def with_clashes(rows):
    return [(*r, -1, -1, -1) for r in rows]


# --- op11 ---------------------------------------------------------------------------------------------------------------

def near_by_force(rows, cosine):
    """(links, component, kept) per row, all pairs compared."""
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        x = np.array(v, np.float32).astype(np.float64) if ok else None
        unit.append(x / np.abs(x).max() / np.sqrt(((x / np.abs(x).max()) ** 2).sum()) if ok else None)
    n = len(rows)
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
              and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = []

    def add(v, label, vec_id=-1):
        rows.append((len(rows) if vec_id == -1 else vec_id, v if v is None else [float(x) for x in v], label))

    for label in (1, 2):
        for _ in range(60):
            add(rng.standard_normal(32), label)
        for spread in (0.05, 0.05, 0.2):  # groups of near copies, one of them a chain
            centre = rng.standard_normal(32)
            for _ in range(14):
                centre = centre + spread * rng.standard_normal(32)
                add(centre, label)
    same = rng.standard_normal(32)
    for k in range(9):
        add(same, 1, None if k == 3 else 5 if k < 2 else -1)
    add(same, 2)
    add(same, None)
    add(3 * same, 1)
    add(-same, 1)
    add(None, 1)
    add([], 1)
    add(np.zeros(32), 1)
    add(np.zeros(32), 1)
    add([float("nan")] + [1.0] * 31, 1)
    add([float("inf")] + [1.0] * 31, 1)
    add(same[:8], 1)
    add(same[:8] * 2, 1)
    add([3e38] * 32, 1)
    add([2e38] * 32, 1)
    add([1e-30], 1, None)
    add([5.0], 1, None)
    add([-5.0], 1)
    return rows


@pytest.mark.parametrize("tile", [capfilters.TILE, 5])
def test_near_copies_find_the_links_of_all_pairs(spark, vectors, tile):
    df = spark.createDataFrame(with_clashes(vectors), VECTORS)
    got = sorted((tuple(r) for r in capfilters.near_copies(df, tile=tile).collect()), key=str)
    want = sorted(near_by_force(vectors, capfilters.COSINE), key=str)
    assert len(got) == len(want) == len(vectors)
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want)
    counts = Counter()
    for vec_id, links, *_ in want:
        counts[vec_id] = max(counts[vec_id], links)
    assert all(links <= counts[vec_id] for vec_id, links, *_ in got)  # none below the threshold
    assert sum(g == w for g, w in zip(got, want)) >= 0.95 * len(want)


def test_near_copies_null_component_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, None], 1), (2, [1.0, 2.0], 1), (3, [1.0, 2.0], 1)],
                               "vec_id bigint, embedding array<double>, label int")
    got = sorted(tuple(r) for r in capfilters.near_copies(df).collect())
    assert got == [(1, 0, 1, True), (2, 1, 2, True), (3, 1, 2, False)]
    none = capfilters.near_copies(df.limit(0))
    assert none.columns == ["vec_id", "n_links", "component_id", "kept"] and none.count() == 0


@pytest.mark.parametrize("n, dim", [(40, 1), (300, 2), (5000, 16), (5000, 64), (10**7, 64)])
def test_codes_reach_the_recall(n, dim):
    codes = capfilters.plan(n, dim)
    rng = np.random.default_rng(99)
    a = rng.standard_normal((500, dim))
    a /= np.sqrt((a ** 2).sum(axis=1, keepdims=True))
    b = rng.standard_normal((500, dim))
    if dim > 1:
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b /= np.sqrt((b ** 2).sum(axis=1, keepdims=True))
        b = capfilters.COSINE * a + np.sqrt(1 - capfilters.COSINE ** 2) * b
    else:
        b = a
    met = {r for r, _ in set(zip(*(x.tolist() for x in capfilters.decode(codes, a))))
           & set(zip(*(x.tolist() for x in capfilters.decode(codes, b))))}
    assert len(met) >= 0.95 * 500


def test_list_decoding_finds_every_direction_of_the_product_code():
    code = capfilters.Code.make(12, 3, 6, 0.3)
    v = capfilters._unit(np.random.default_rng(1).standard_normal((40, 12)))
    words = [(a, b, c) for a in range(6) for b in range(6) for c in range(6)]
    directions = np.array([np.concatenate([code.blocks[k][w] for k, w in enumerate(word)]) for word in words])
    assert np.allclose((directions ** 2).sum(axis=1), 1)
    want = {(i, k) for i, k in zip(*np.nonzero((v @ code.rotation) @ directions.T >= 0.3))}
    row, name = code.decode(v)
    assert set(zip(row.tolist(), name.tolist())) == {(int(i), int(k)) for i, k in want}


def test_a_large_group_of_near_copies_is_counted_in_tiles(spark):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(64)
    rows = [(i, [float(x) for x in centre + 0.1 * rng.standard_normal(64)], 3) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = capfilters.near_copies(df, tile=64).collect()
    assert [(r.n_links, r.component_id) for r in got] == [(399, 0)] * 400


# --- op12 ---------------------------------------------------------------------------------------------------------------

SPACES = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired rows) by a best-first search over whole edit strings."""
    best, heap = {}, [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, list(out)
        if (i, last) in best and best[i, last] <= (cost, audit):
            continue
        best[i, last] = (cost, audit)
        fits = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[fits]
        heapq.heappush(heap, (cost + 2, audit + "I", i, fits, (*out, (name, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, fits, (*out, (name, text))))
                if role[:1] == fits or (role[:1] == "s" and last == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, (role, text))))
    raise AssertionError


def repair_by_force(rows):
    out = []
    for conv in {r[0] for r in rows}:
        kept = []
        for conv_id, turn, role, text in rows:
            if conv_id != conv:
                continue
            said = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
            role, text, d = " " if role is None else role, " " if text is None else text, zlib.crc32(said.encode()) % 20
            if d == 0:
                continue
            text = "" if d == 1 else "".join(c for c in text if c not in ".!?") if d == 2 else text
            kept += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, counts = set(), [], Counter()
        for turn, role, text in kept:
            bare = text.rstrip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append((role, text, fault))
            counts[fault] += 1
        turns = {r[0] for r in kept if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, repaired = cheapest(faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(12)
    rows = []
    for conv in [None, *range(70)]:
        at = rng.choice([0, 1, 5])
        for k in range(rng.randint(1, 12)):
            role = "system" if k == 0 and rng.random() < 0.5 else ("user", "assistant")[k % 2]
            if rng.random() < 0.15:
                role = rng.choice(["user", "assistant", "tool", "", None, "system", "ümlaut", "u"])
            text = rng.choice(["Yes.", "Why?", "no end", "Stop!\n", "", " \t", None, "a\nb.", f"text {conv} {k}.", f"open {k}"])
            rows.append((conv, None if rng.random() < 0.04 else at, role, text))
            at += rng.choice([1, 1, 1, 0, 3])
    rows += rows[:25]  # repeated rows
    rows.append((900, None, None, None))
    return rows


TURNS = "conv_id bigint, turn bigint, role string, text string, kind int, place bigint, audit string"


def test_repair_matches_an_exhaustive_search(spark, turns):
    df = spark.createDataFrame([(*r, 0, 0, "x") for r in turns], TURNS)
    got = sorted((tuple(r) for r in repair.report(df).collect()), key=str)
    assert got == repair_by_force(turns)
    assert repair.report(df.limit(0)).count() == 0


def test_repaired_rows_follow_the_grammar(spark, turns):
    df = repair.damage(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    rows = {}
    for r in repair.repaired(df, repair.audits(df)).collect():
        rows.setdefault(r.conv_id, []).append((r.place, r.role[:1], r.edit))
    for found in rows.values():
        found.sort()
        initials = "".join(i for _, i, _ in found).removeprefix("s")
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert initials and initials == "ua" * (len(initials) // 2)


def test_auction_is_the_same_in_blocks_of_any_size():
    rng = random.Random(3)
    for _ in range(300):
        symbols = "".join(rng.choice("xsuaoSUAO") for _ in range(rng.randrange(0, 14)))
        rows = [(c.lower(), "", "blank" if c == "x" else "truncated" if c.isupper() else "") for c in symbols]
        want = cheapest(rows)[:2]
        assert {repair._solve(symbols, block) for block in (1, 2, 5, 64)} == {want}


def test_auction_prices_stay_below_cost_and_price_behind():
    leave = {repair.START: 0, repair.ASSISTANT: 0}
    symbols = "suxaUAoua"
    price = repair.auction(symbols, leave, (repair.START,))
    for i, symbol in enumerate(symbols):
        for state in range(4):
            for _, cost, rows, to in repair.arcs(symbol, state):
                assert price[4 * i + state] <= cost + price[4 * (i + rows) + to]


def test_repair_of_a_long_conversation_and_long_texts(spark):
    rng = random.Random(9)
    rows = [(1, k, rng.choice(["user", "assistant"]), f"turn {k}" + rng.choice([".", ""])) for k in range(3000)]
    rows += [(2, 0, "user", "x" * 2_000_000 + "?"), (2, 1, "assistant", " " * 2_000_000), (2, 2, "assistant", "y. " * 700_000)]
    got = {r.conv_id: r for r in repair.report(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    want = {r[0]: r for r in repair_by_force(rows)}
    assert {k: tuple(v) for k, v in got.items()} == want


def test_seen_hashes_beyond_the_small_set():
    seen = repair.Seen(small=4)
    rng = random.Random(1)
    known = set()
    for _ in range(500):
        h = rng.randrange(-60, 60)
        assert seen.add(h) == (h not in known)
        known.add(h)


# --- op13 ---------------------------------------------------------------------------------------------------------------

def paths():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned_by_force(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = paths()
    a_side = Tokenizer.from_file(path_a)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=path_b)
    alphabet = alignment.byte_alphabet()
    docs = []
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        names = [b_side.id_to_piece(i) for i in b]
        said = [[bytes(alphabet[c] for c in a_side.id_to_token(i)) for i in a],
                [bytes([int(n[1:-1], 16)]) if b_side.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names)]]
        if any(b"".join(s) != whole for s in said):
            docs.append((doc_id, [], [], [], 0, ""))
            continue
        ends = [np.cumsum([len(t) for t in s]).tolist() for s in said]
        starts = [[0] + e[:-1] for e in ends]
        links = [(x, y) for x, p in zip(a, ends[0]) for y, q in zip(b, ends[1]) if p == q]
        overlap = sum(starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i] for i in range(len(a)) for j in range(len(b)))
        groups, low = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, end) if low < e <= cut)
                                   for ids, end in zip((a, b), ends)))
            low = cut
        docs.append((doc_id, a, b, links, overlap, ";".join(groups)))
    counts = Counter(link for d in docs for link in d[3])
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for doc_id, a, b, links, overlap, groups in docs:
        out.append((doc_id, len(a), len(b), len(groups.split(";")) if groups else 0, len(links),
                    sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "", overlap))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    rows = [(1, "Hello world, it's  a test\n\nof tokens."), (2, None), (3, ""), (4, " "), (5, "a▁b"),
            (5, "x <|endoftext|> y <s> </s> <unk> <0x41>"), (None, "ünïcödé 漢字かな 🙂\t\x00 end "), (None, None),
            (6, "Hello world, it's  a test\n\nof tokens."), (7, "\n"), (8, "aaaa" * 50), (9, " lead  two   three    four ")]
    return rows + [(100 + i, "".join(rng.choice("ab cé\n .漢'▁"[: 10 + (i % 5 == 0)]) for _ in range(rng.randrange(1, 120))))
                   for i in range(50)]


@pytest.mark.parametrize("lookup", [alignment.LOOKUP, 7, 0])
def test_alignment_matches_brute_force(spark, texts, lookup):
    path_a, path_b = paths()
    df = spark.createDataFrame([(i, t, "x", [1], 5) for i, t in texts],
                               "doc_id bigint, text string, pair string, pairs array<int>, id bigint")
    got = sorted((tuple(r) for r in alignment.align(df, path_a, path_b, lookup=lookup).collect()), key=str)
    assert got == aligned_by_force(texts)
    assert alignment.align(df.limit(0), path_a, path_b).count() == 0


def test_long_texts_are_aligned_in_parts(texts):
    path_a, path_b = paths()
    column = pa.array([t for _, t in texts])
    small, whole = (alignment.Aligner(path_a, path_b, unit).column(column) for unit in (30, alignment.UNIT_BYTES))
    for a, b in zip(small, whole):
        assert a[:5] == b[:5] and a[5].tolist() == b[5].tolist() and a[6].tolist() == b[6].tolist()
    rng = random.Random(2)
    words = ["alpha", "bêta", "gamma.", "(delta)", "漢字", "it's"]
    long = " ".join(rng.choice(words) for _ in range(400_000))
    n_a, n_b, n_groups, *_ = alignment.Aligner(path_a, path_b).column(pa.array([long]))[0]
    assert n_a > 400_000 and n_b > 400_000 and 400_000 <= n_groups <= min(n_a, n_b)
