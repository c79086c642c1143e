"""The training-data operators against brute force on small tables with nulls, blanks, ties, copies and clashes."""

import hashlib
import json
import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.llm import (covertree, decontaminate, jaccard, langid, licenses, mixing, sharding, substrings,
                             tokenstore, toolcalls)
from stationflow.llm.tables import IdFilter, Scratch, components

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, k string, token string, shard int"


def words_of(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Émile", "ÀB", "x.", "The"]
    out = []

    def add(text, lang="en", source="src0"):
        out.append((len(out), text, lang, source, "clash", "clash", -1))

    base = [rng.choice(vocabulary) for _ in range(130)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for i in range(40):
        add(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 160))), rng.choice(["en", "de"]), f"src{i % 3}")
    for edits in (0, 0, 1, 2, 3, 6, 9):
        near = list(base)
        for _ in range(edits):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        add("\t".join(near).upper() if edits == 2 else "\n ".join(near), source="src1")
    for _ in range(6):
        add(" ".join([rng.choice(vocabulary) for _ in range(30)] + passage + [rng.choice(vocabulary) for _ in range(20)]))
    for text in (None, "", "   \n\t", "one", "one", "ONE", "one two three", "one  two three", "a b c d e", "a b c d e f",
                 "12 34 56", "loop " * 300, "loop " * 260, "x" * 5000):
        add(text, None if text == "one" else "en", None if text == "" else "src2")
    for n in range(5, 14):
        add(" ".join(f"s{i}" for i in range(n)))
        add(" ".join(f"s{i}" for i in range(n - 1)) + " other")
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="module")
def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def shingles(text):
    w = [x.lower() for x in words_of(text)]
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def reachable(links, ids):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("boundary", [None, 0, 9])
def test_jaccard_join_matches_brute_force(docs, rows, boundary, monkeypatch):
    if boundary is not None:
        monkeypatch.setattr(jaccard, "boundary_by_cost", lambda *a: boundary)
    sets = {r[0]: shingles(r[1]) for r in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    label = reachable(links, ids)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs).collect()}
    assert found == {i: (len(sets[i]), label[i]) for i in ids}


def test_jaccard_null_ids_and_rows_that_share_an_id(spark, empty_docs):
    text = " ".join(f"q{i}" for i in range(30))
    other = " ".join(f"p{i}" for i in range(30))
    data = [(None, text), (3, text), (3, other), (7, other), (9, text), (None, None)]
    got = sorted((r[0] if r[0] is not None else -1, r[2] if r[2] is not None else -1)
                 for r in jaccard.join(spark.createDataFrame(data, "doc_id bigint, text string")).collect())
    assert got == [(-1, -1), (-1, -1), (3, 3), (3, 3), (7, 3), (9, 3)]
    assert jaccard.join(empty_docs).count() == 0


def test_boundary_follows_the_cost():
    assert jaccard.boundary_by_cost({n: 10 for n in range(1, 40)}, 0.0) == 0
    assert jaccard.boundary_by_cost({n: 10 for n in range(1, 40)}, 50.0) > 8
    for a in range(1, 60):
        for b in range(a, a * 100 // 80 + 1):
            o = jaccard.need(a, b)
            assert 100 * o >= 80 * (a + b - o) and 100 * (o - 1) < 80 * (a + b - o + 1)


def test_distinct_documents_keeps_one_of_each_group(docs, rows):
    kept = {r["doc_id"] for r in jaccard.distinct_documents(docs).collect()}
    found = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs).collect()}
    assert kept == set(found.values())


def test_components_and_id_filter(spark):
    scratch = Scratch(spark, "test")
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 60), (7, 7)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), scratch).collect()}
    assert got == {**{i: 0 for i in range(21)}, 40: 40, 50: 40, 60: 40}
    ids = [0, 1, 32767, 32768, (1 << 24) - 1, 1 << 40, -5]
    passes = IdFilter(spark.createDataFrame([(i,) for i in ids], "id bigint")).passes(np.array(ids + [2, 77], np.int64))
    assert passes.tolist() == [True] * len(ids) + [False, False]


def test_substring_dedup_matches_brute_force(docs, rows, empty_docs):
    seen, want = set(), {}
    for doc_id, text, *_ in sorted(rows):
        w = words_of(text)
        windows = [b" ".join(w[i:i + 50]) for i in range(len(w) - 49)]
        keep = [True] * len(w)
        for i, x in enumerate(windows):
            if x in seen:
                keep[i:i + 50] = [False] * 50
        seen.update(windows)
        kept = [x for x, k in zip(w, keep) if k]
        want[doc_id] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    found = substrings.parse(docs).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == want
    check_factors(found, {r[0]: words_of(r[1]) for r in rows})
    assert substrings.parse(empty_docs).count() == 0


def check_factors(found, words):
    """Factors do not overlap, are long enough, and equal the words at their place in an earlier document."""
    for r in found:
        end = 0
        for f in r["factors"]:
            assert f["start"] >= end and f["n"] >= 50 and f["ref"] < r["doc_id"]
            end = f["start"] + f["n"]
            assert words[r["doc_id"]][f["start"]: end] == words[f["ref"]][f["pos"]: f["pos"] + f["n"]]
        assert sum(f["n"] for f in r["factors"]) <= r["n_removed"] and (not r["n_removed"] or r["factors"])


def test_substring_parse_into_factors_of_several_references(spark):
    rng = random.Random(21)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    a, b, loop = new(200), new(200), ["la"] * 120
    texts = {1: a, 2: b + a[100:180], 3: new(10) + a[:150] + b[20:120] + new(5), 4: a[90:] + a[:110], 5: loop + new(3),
             6: new(2) + loop + a[:60] + loop, 7: b[:130] + a[:49] + b[130:], 8: a[:60] + a[40:100]}
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in substrings.parse(frame).collect()}
    check_factors(found.values(), {i: words_of(" ".join(w)) for i, w in texts.items()})
    parts = {i: [(f["start"], f["n"], f["ref"], f["pos"]) for f in r["factors"]] for i, r in found.items()}
    assert parts[1] == [] and parts[2] == [(200, 80, 1, 100)]
    assert parts[3] == [(10, 150, 1, 0), (160, 100, 2, 20)] and found[3]["n_removed"] == 250
    assert parts[4] == [(0, 110, 1, 90), (110, 110, 1, 0)]
    assert parts[6][0] == (2, 50, 5, 0) and found[6]["n_removed"] == 300
    assert parts[7] == [(0, 130, 2, 0), (179, 70, 2, 130)]
    assert parts[8] == [(0, 60, 1, 0), (60, 60, 1, 40)]


def test_substring_null_ids_are_kept(spark):
    text = " ".join(f"q{i}" for i in range(70))
    got = substrings.parse(spark.createDataFrame([(None, text), (None, text), (4, text), (4, text), (5, text)],
                                                 "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in got) == [(-1, 0), (-1, 0), (4, 0), (4, 0), (5, 70)]


@pytest.mark.parametrize("k", [1, 5])
def test_top_k_matches_brute_force(spark, k):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    vectors = [(int(i), (centres[i % 6] + 0.2 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(400)]
    vectors += [(400 + i, vectors[0][1]) for i in range(30)] + [(500, [1.0] * 7), (501, None), (502, [float("nan")] * 8),
                (503, [None] + [1.0] * 7), (504, []), (None, [1.0] * 8), (505, [float("inf")] * 8), (510, [0.5] * 7)]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").withColumn("v", F.lit("clash"))
    found = {}
    for r in covertree.top_k(frame, lambda i: i % 10 == 0, k).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    good = {i: np.floor(256 * np.array(v, np.float64)).astype(int) for i, v in vectors
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    for q in (i for i in good if i % 10 == 0):
        scores = sorted((-int(good[q] @ good[i]), i) for i in good if i != q and len(good[i]) == len(good[q]))
        assert found.get(q, {}) == {n + 1: (i, -s) for n, (s, i) in enumerate(scores[:k])}


def best_by_force(vectors, k):
    """(query id, vector) -> best rows of other ids; whole numbers of any size, cut off at the ends of a long."""
    ends = (1 << 63) - 1
    rows = [(i, tuple(max(-ends - 1, min(ends, math.floor(256 * x))) for x in v)) for i, v in vectors]
    return {(q, v): sorted((-max(-ends, min(ends, sum(a * b for a, b in zip(v, w)))), i) for i, w in rows
                           if i != q and len(w) == len(v))[:k] for q, v in rows if q % 50 == 0}


@pytest.mark.parametrize("copies", [1, 3, 6, 40])
def test_top_k_of_a_query_that_occurs_often(spark, copies):
    own = [1.0, 2.0, -0.5]
    vectors = [(50, own)] * copies + [(i, [float(i % 3), 1.0, i / 7]) for i in range(1, 9)]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    got = sorted((r["rank"], -r["score"], r["vec_id"]) for r in covertree.top_k(frame, lambda i: i % 50 == 0).collect())
    assert got == [(n + 1, *x) for n, x in enumerate(best_by_force(vectors, 5)[50, (256, 512, -128)])] and len(got) == 5


def test_top_k_with_repeated_ids_and_large_components(spark):
    rng = random.Random(4)
    vectors = [(rng.choice([0, 50, 100, 3, 4, 5, 6, 7, 8, 9, 10]), [float(rng.randint(-2, 2)) for _ in range(3)]) for _ in range(150)]
    vectors += [(200 + i, [float(rng.choice([1e7, -1e7, 3e10, 2.5, 1e300, -1e300])) for _ in range(4)]) for i in range(0, 300, 10)]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    got = {}
    for r in covertree.top_k(frame, lambda i: i % 50 == 0).orderBy("query_id").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    want = {}
    for (q, _), found in best_by_force(vectors, 5).items():
        want.setdefault(q, []).extend(found)
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()}


def test_top_k_of_nothing(spark):
    assert covertree.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), lambda i: i > 0).count() == 0


def test_tree_covers_its_points():
    points = np.random.default_rng(1).integers(-50, 50, (500, 4))
    tree = covertree.Tree(points, leaf=8)
    for (a, b), centre, radius in zip(tree.span, tree.centres, tree.radius):
        assert np.sqrt(((tree.points[a:b] - centre) ** 2).sum(axis=1)).max() <= radius + 1e-9


def test_sharding_is_even_gapless_and_keeps_groups(docs, rows, empty_docs):
    got = sharding.assign(docs, shards=4).toPandas()
    text = {r[0]: r[1] for r in rows}
    size = {i: len((t or "").encode()) + 1 for i, t in text.items()}
    assert dict(zip(got["doc_id"], got["size"])) == size
    assert dict(zip(got["doc_id"], got["text_crc32"])) == {i: zlib.crc32((t or "").encode()) for i, t in text.items()}
    assert set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    loads = got.groupby("shard")["size"].sum()
    assert len(loads) == 4 and loads.max() - loads.min() <= 2 * max(size.values())
    assert sharding.assign(empty_docs).count() == 0


@pytest.mark.parametrize("share, together", [(2, True), (100, False)])
def test_sharding_keeps_small_groups_together_and_cuts_large_ones(spark, share, together):
    """Groups of 10 equal texts, a twelfth of a shard: within one part in two of a shard, beyond one in a hundred."""
    data = [(10 * n + k, f"text {n:03d} " * 5) for n in range(47) for k in range(10)]
    got = sharding.assign(spark.createDataFrame(data, "doc_id bigint, text string"), shards=4, group_share=share).toPandas()
    shards_of = got.groupby(got["doc_id"] // 10)["shard"].nunique()
    assert (shards_of.max() == 1) == together
    loads = got.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() <= (2 * 10 if together else 2) * got["size"].max()


def test_sharding_cuts_a_hot_group(spark, tmp_path):
    data = [(i, "same text") for i in range(900)] + [(None, None), (2000, ""), (2000, "")]
    frame = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("size", F.lit("clash"))
    loads = sharding.assign(frame, shards=8).groupBy("shard").agg(F.sum("size").alias("b")).toPandas()["b"]
    assert len(loads) == 8 and loads.max() - loads.min() <= 20
    sharding.write_shards(frame.drop("size"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 903


def test_tool_calls(spark):
    calls = [(1, 0, "a", None, "search", '{"query":"x","limit":3}'),
             (1, 1, "b", "a", "search", '{"limit": "3", "query":"x"}'),
             (1, 2, "c", "b", "lookup", '{"strict":true,"key":"k","more":{"z":1,"a":[1, 2]}}'),
             (1, 9, "d", "e", "search", "nonsense"), (1, 3, "e", None, "search", None),
             (2, 0, "f", "g", "search", '{"query":"x","limit":3}'), (2, 1, "g", "f", "search", '{"query":"x","limit":3}'),
             (2, 2, "h", "a", "search", '{"query":"x","limit":3}'), (2, 3, "i", "missing", "other", "{}"),
             (3, 0, None, None, "search", "{}"), (3, 1, "r", None, "search", "{}"), (3, 2, "r", None, "search", "{}")]
    results = [(1, 5, "a", "late"), (1, 4, "a", "early"), (1, 6, "zz", "lost"), (1, 7, "b", None)]
    got = toolcalls.link(
        spark.createDataFrame(calls, "conv_id bigint, seq bigint, call_id string, after string, tool string, arguments string")
        .withColumn("depth", F.lit("clash")),
        spark.createDataFrame(results, "conv_id bigint, seq bigint, call_id string, text string"), toolcalls.TURN_TOOLS)
    by_id = {r["call_id"]: r for r in got.collect() if r["call_id"] not in (None, "r")}
    assert {i: by_id[i]["depth"] for i in "abcde"} == {"a": 0, "b": 1, "c": 2, "d": 1, "e": 0}
    assert [i for i in sorted("abcde", key=lambda i: by_id[i]["position"])] == ["a", "e", "b", "d", "c"]
    status = {i: r["status"] for i, r in by_id.items()}
    assert status == {"a": "ok", "b": "invalid", "c": "invalid", "d": "invalid", "e": "invalid", "f": "cycle", "g": "cycle",
                      "h": "dangling", "i": "invalid", "zz": "orphan"}
    assert by_id["a"]["n_results"] == 2 and by_id["b"]["errors"] == "type of limit" and by_id["c"]["errors"] == "extra more"
    assert by_id["d"]["errors"] == "not an object" and by_id["i"]["errors"] == "unknown tool"
    assert by_id["a"]["record"] == ('{"after":null,"arguments":{"limit":3,"query":"x"},"id":"a","name":"search","result":"early"}')
    assert '"more":{"a":[1,2],"z":1}' in by_id["c"]["record"]
    assert sorted(r["status"] for r in got.collect() if r["call_id"] in (None, "r")) == ["no_id", "repeated_id", "repeated_id"]
    nothing = toolcalls.link(spark.createDataFrame([], "conv_id bigint, seq bigint, call_id string, after string, tool string, arguments string"),
                             spark.createDataFrame([], "conv_id bigint, seq bigint, call_id string, text string"), {})
    assert nothing.count() == 0


def test_every_result_without_a_call_keeps_its_row(spark):
    calls = [(1, 0, "a", None, "search", "{}"), (3, 1, "r", None, "search", "{}"), (3, 2, "r", None, "search", "{}"),
             (None, None, "n", None, None, None)]
    lost = [(c, s, i, f"{i}{c}{s}{k}") for i in (None, "zz", "r") for c in (1, 2, None) for s in (4, 5) for k in range(20)]
    lost += [(7, 1, "once", "x"), (7, 2, None, None), (7, 2, None, None), (8, 1, "same", "s"), (8, 1, "same", "s")]
    frame = spark.createDataFrame(lost + [(1, 6, "a", "late"), (1, 5, "a", "early")], "conv_id bigint, seq bigint, call_id string, text string")
    got = toolcalls.link(spark.createDataFrame(
        calls, "conv_id bigint, seq bigint, call_id string, after string, tool string, arguments string"),
        frame, toolcalls.TURN_TOOLS).collect()
    found = [(r["conv_id"], r["call_id"], json.loads(r["record"])["result"], r["n_results"]) for r in got if r["status"] == "orphan"]
    assert sorted(found, key=str) == sorted(((c, i, t, 1) for c, _, i, t in lost), key=str)
    assert {(r["call_id"], r["status"], r["n_results"]) for r in got if r["status"] != "orphan"} == {
        ("a", "invalid", 2), ("r", "repeated_id", 0), ("n", "invalid", 0)}
    for conv in (1, 2, 3, 7, 8, None):
        places = [r["position"] for r in got if r["conv_id"] == conv]
        assert sorted(places) == list(range(len(places)))


def test_turns_without_a_number_have_no_id(spark):
    turns = spark.createDataFrame([(None, 1, "user", "a"), (None, 2, "assistant", "b"), (3, None, "user", "c"), (1, 0, "user", "d"),
                                   (4, 2, "user", "e"), (None, 2, "user", "f")], "conv_id bigint, turn bigint, role string, text string")
    calls, results = toolcalls.from_turns(turns)
    assert sorted((r["call_id"] or "", r["after"] or "") for r in calls.collect()) == [("", ""), ("", ""), ("", ""), ("call:1:0", ""),
                                                                                       ("call:4:2", "call:4:0")]
    assert [r["call_id"] for r in results.collect()] == [None]


def test_long_chains_settle(spark):
    n = 300
    nodes = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(n)], "call_id string, parent string")
    got = {r[0]: r[1] for r in toolcalls.depths(nodes, Scratch(spark, "test")).collect()}
    assert got == {str(i): i for i in range(n)}


def test_decontamination_matches_brute_force(spark, docs, rows, empty_docs):
    by_id = {r[0]: r for r in rows}
    long = [r for r in rows if len(words_of(r[1])) > 60][:6]
    items = [(i, b" ".join(words_of(r[1])[5:5 + 12 + 4 * i]).decode().title()) for i, r in enumerate(long)]
    items += [(50, None), (51, " "), (52, "one"), (53, "one two three"), (54, items[0][1])]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    want = set()
    for item_id, text in items:
        w = [x.lower() for x in words_of(text)]
        k = min(5, len(w))
        s = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
        for r in by_id.values():
            d = [x.lower() for x in words_of(r[1])]
            held = len(s & {tuple(d[i:i + k]) for i in range(len(d) - k + 1)})
            if s and 100 * held >= 80 * len(s):
                want.add((r[0], item_id, held, len(s)))
    assert {tuple(r) for r in decontaminate.contaminated(docs, frame).collect()} == want
    assert {tuple(r) for r in decontaminate.contaminated(docs, frame, chunk_bytes=200).collect()} == want
    assert want and decontaminate.contaminated(empty_docs, frame).count() == 0
    assert decontaminate.contaminated(docs, frame.limit(0)).count() == 0


def test_mixing_matches_sql(spark, docs, rows, empty_docs):
    import duckdb

    documents = pd.DataFrame([r[:4] for r in rows], columns=["doc_id", "text", "lang", "source"])  # noqa: F841
    for weights, share, epochs in (({"lang": {"de": 3}, "source": {"src1": 2, "*": 1}}, (1, 3), 2), ({}, (7, 2), 3), ({}, (0, 1), 1)):
        want = duckdb.sql(mixing.oracle(weights, share, epochs, 17)).df()
        got = mixing.mix(docs, weights, share, epochs, 17).toPandas()
        key = list(got.columns)
        assert got.sort_values(key).reset_index(drop=True).equals(want[key].sort_values(key).reset_index(drop=True))
        taken, tokens = int((got["copies"] * got["n_tokens"]).sum()), int(got["n_tokens"].sum())
        assert taken <= tokens * share[0] // share[1]
        assert got["copies"].max() <= epochs
    assert mixing.mix(empty_docs, {}).count() == 0


def test_shortages_go_to_siblings_before_ancestors(spark):
    data = [(i, " ".join(["w"] * 10), "en", "src0" if i < 10 else "src4" if i < 100 else "src1") for i in range(200)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string")
    got = mixing.mix(frame, {}, (1, 2), 1).groupBy("domain", "source").agg(F.first("leaf_budget")).collect()
    # both domains get 500; src0 holds 100 of its 250, and the other 150 stay in its domain
    assert {tuple(r) for r in got} == {("d0", "src0", 100), ("d0", "src4", 400), ("d1", "src1", 500)}


def test_language_network_gradients():
    net = langid.Network(["a", "b"], hidden=3, seed=1)
    net.x, net.u, net.o, net.b = (w.astype(np.float64) for w in net.weights())
    segments = np.random.default_rng(0).integers(0, 256, (4, 6)).astype(np.uint8)
    labels = np.array([0, 1, 1, 0])
    _, grads = net.gradients(segments, labels)
    rng = np.random.default_rng(3)
    for w, g in zip(net.weights(), grads):
        for _ in range(12):
            at = (rng.integers(0, 2), segments.reshape(-1)[rng.integers(0, 24)], rng.integers(0, 9)) if w.ndim == 3 and w.shape[1] == 256 \
                else tuple(rng.integers(0, s) for s in w.shape)
            keep, e = w[at], 1e-3
            w[at] = keep + e
            high = net.gradients(segments, labels)[0]
            w[at] = keep - e
            low = net.gradients(segments, labels)[0]
            w[at] = keep
            assert abs((high - low) / (2 * e) - g[at]) < 2e-3


def test_language_id(spark, empty_docs):
    rng = random.Random(1)
    words = {"en": "the of and that with there which".split(), "fr": "le des une été où que très".split()}
    data = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(5, 60))), lang)
            for i in range(120) for lang in [rng.choice(["en", "fr"])]]
    odd = [(None, "the and of that", "xx"), (500, None, "en"), (501, "", "en"), (502, "123 456 !", "en"), (503, "the of and", None)]
    frame = spark.createDataFrame(data + odd, "doc_id bigint, text string, lang string").withColumn("t", F.lit("clash"))
    got = {r["doc_id"]: r for r in langid.identify(frame).collect()}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in data)
    held = [(i, lang) for i, _, lang in data if got[i]["held_out"]]
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in held]) >= 0.9
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (500, 501, 502))
    assert got[503]["lang_pred"] == "en" and got[None]["held_out"] is False and 0 <= got[None]["score"] <= 1
    assert {r["doc_id"] for r in langid.accepted(frame).collect()} == {i for i, *_ in data} | {503, None}
    assert langid.accepted(frame).columns == frame.columns and langid.accepted(empty_docs).count() == 0
    assert langid.identify(empty_docs).count() == 0
    assert langid.identify(frame.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0


@pytest.fixture(scope="module")
def tokenizer_path():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_encode_like_whole_texts(tokenizer_path):
    import pyarrow as pa

    rng = random.Random(3)
    alphabet = ["a", "Z", "9", " ", "  ", "\n", "\t", "'", "'s", "'ll", "é", " ", " ", "　", "\u0085", "…", "«", ".",
                ",", "\x1c", "日", "😀", "|", "<|endoftext|>", "\r\n", "-", "​", "ñ", "\x00"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    encoder = tokenstore.Encoder(tokenizer_path)
    for text, ids in zip(texts, encoder.column(pa.array(texts))):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_token_store_round_trip(spark, docs, rows, empty_docs, tokenizer_path, monkeypatch):
    monkeypatch.setattr(tokenstore, "FRAME_IDS", 200)
    encoder = tokenstore.Encoder(tokenizer_path)
    ids = {r[0]: [*encoder.tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows}
    want, start = {}, 0
    for i in sorted(ids):
        want[i] = (start, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes()))
        start += len(ids[i])
    scratch = Scratch(spark, "test")
    folder = scratch.path("files")
    manifest = tokenstore.write(docs, folder, scratch, tokenizer_path, file_bytes=9000)
    assert {r[0]: tuple(r)[1:] for r in tokenstore.read(manifest, folder).collect()} == want
    found = tokenstore.lookup(spark, manifest, folder, [3, 17, 40, 10_000])
    assert {i: [t.tolist() for t in x] for i, x in found.items()} == {i: [ids[i]] for i in (3, 17, 40)}
    assert tokenstore.store(empty_docs, tokenizer_path).count() == 0
    twice = spark.createDataFrame([(None, "x"), (1, None), (1, "y z")], "doc_id bigint, text string")
    assert [tuple(r)[:3] for r in tokenstore.store(twice, tokenizer_path).orderBy("start").collect()] == [(None, 0, 2), (1, 2, 1), (1, 3, 3)]


def test_lookup_opens_the_frames_of_the_asked_documents_only(spark, tokenizer_path, monkeypatch):
    monkeypatch.setattr(tokenstore, "FRAME_IDS", 30)
    data = [(i, f"document number {i} " * 4) for i in range(60)] + [(25, f"again {k} " * 9) for k in range(12)] + [(None, "none")]
    scratch = Scratch(spark, "test")
    folder = scratch.path("files")
    frame = spark.createDataFrame(data, "doc_id bigint, text string").coalesce(1)
    manifest = tokenstore.write(frame, folder, scratch, tokenizer_path)
    opened = []
    whole = tokenstore.FileReader.frame
    monkeypatch.setattr(tokenstore.FileReader, "frame", lambda self, k: opened.append(k) or whole(self, k))
    assert len(tokenstore.lookup(spark, manifest, folder, [7])[7]) == 1 and len(opened) == 1
    opened.clear()
    found = tokenstore.lookup(spark, manifest, folder, [25])[25]
    encoder = tokenstore.Encoder(tokenizer_path).tokenizer
    want = sorted([*encoder.encode(t, add_special_tokens=False).ids, 2] for i, t in data if i == 25)
    assert sorted(t.tolist() for t in found) == want and len(opened) < 12


def test_very_long_texts(spark, tokenizer_path):
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(80)]
    long = [rng.choice(["alpha", "beta", "gamma", "delta", "w"]) + str(rng.randrange(900)) for _ in range(330_000)]
    texts = {1: " ".join(passage + ["tail"]), 2: " ".join(long[:200_000] + passage + long[200_000:]),
             3: " ".join([*long[:200_000], *passage, *long[200_000:], "one", "more"]), 4: "x" * 2_000_000, 5: "y " * 1_200_000}
    assert len(texts[2]) > 2_000_000
    frame = spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id bigint, text string, lang string")
    sets = {i: shingles(t) for i, t in texts.items()}
    got = {r["doc_id"]: r for r in jaccard.join(frame).collect()}
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(x) for i, x in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5}
    cut = {r["doc_id"]: r for r in substrings.parse(frame).collect()}
    assert {i: r["n_removed"] for i, r in cut.items()} == {1: 0, 2: 80, 3: 330_080, 4: 0, 5: 0}
    kept = " ".join(long)
    assert cut[2]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    items = spark.createDataFrame([(7, " ".join(passage[5:60])), (8, "not there at all, my dear friend")], "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame, items).collect()} == {(1, 7), (2, 7), (3, 7)}
    assert {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame).collect()} == {i: "en" for i in texts}
    encoder = tokenstore.Encoder(tokenizer_path).tokenizer
    short = frame.where("doc_id <> 4")
    sizes = {r["doc_id"]: r["n_tokens"] for r in tokenstore.store(short, tokenizer_path).collect()}
    assert sizes == {i: len(encoder.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items() if i != 4}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as P

    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, "some item of a benchmark")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_damaged_frames_are_found(tmp_path):
    path = tmp_path / "f"
    with open(path, "wb") as sink:
        writer = tokenstore.FileWriter(sink)
        writer.add(1, np.arange(50, dtype=np.uint32))
        writer.finish()
    raw = bytearray(path.read_bytes())
    with open(path, "rb") as source:
        assert tokenstore.FileReader(source, len(raw)).frame(0)[2].tolist() == list(range(50))
    raw[20] ^= 255
    path.write_bytes(raw)
    with open(path, "rb") as source, pytest.raises(Exception):
        tokenstore.FileReader(source, len(raw)).frame(0)


def test_license_scan(spark, empty_docs):
    mit = licenses.TEMPLATES["MIT"][2]
    data = [(1, "Intro line\nReleased under the MIT License.\nmore"), (2, "Licensed under CC BY-NC 4.0."),
            (3, "We licensed a song to a film about a river and its long and winding way."), (4, None), (5, ""), (6, "no such words"),
            (7, "Licensed under the Apache License, Version 2.0"), (7, "Licensed under the Apache License, Version 2.0"),
            (8, mit.replace("free of charge, ", "")), (9, mit.replace(" to whom", "\nto whom")), (None, "All rights reserved.")]
    frame = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("license", F.lit("clash"))
    got = sorted(((r["doc_id"] or 0), r["first_line"], r["license"], r["n_missing"], r["exact"]) for r in licenses.scan(frame).collect())
    assert got[:5] == [(0, 0, "Proprietary", 0, True), (1, 1, "MIT", 0, True), (2, 0, "CC-BY-NC-4.0", 0, True), (3, 0, None, None, False),
                       (7, 0, "Apache-2.0", 0, True)]
    assert (8, 0, "MIT", 3, False) in got
    assert licenses.scan(empty_docs).count() == 0


def licenses_in(text, templates=None):
    import re

    scanner = licenses.Scanner(templates or licenses.TEMPLATES, licenses.TOLERANCE, licenses.CONFIRMED)
    return [r[:3] + r[4:7] for r in scanner.blocks(text, re.compile(licenses.VOCABULARY, re.IGNORECASE))]


def test_licenses_reach_over_lines_and_within_them(spark):
    import textwrap

    mit, apache = licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["Apache-2.0"][1]
    wrapped, lines = textwrap.fill(mit, 60), len(textwrap.wrap(mit, 60))
    assert licenses_in(f"Some words.\n\n{wrapped}\nmore") == [(2, lines, "MIT", 0, 0, True)]
    # a blank line inside, comment marks, and a copyright line of its own before it
    header = "\n".join(f"# {x}" for x in textwrap.wrap(apache, 70)).replace("Unless", "\n#\n# Unless")
    assert licenses_in(f"# Copyright 2020 Jane Doe\n#\n{header}\nimport os") == [
        (0, 1, None, None, None, False), (2, header.count("\n") + 1, "Apache-2.0", 0, 0, True)]
    # two notices on adjacent lines, the first one after a sentence of its line
    two = "Copyright (c) 2020 Jane Doe. All rights reserved.\nReleased under the MIT License."
    assert licenses_in(two) == [(0, 1, None, None, None, False), (0, 1, "Proprietary", 0, 0, True), (1, 1, "MIT", 0, 0, True)]
    # two copies, one with a word changed in its first line and one added
    other = textwrap.fill(mit.replace("free of charge", "free of cost").replace("substantial", "substantial big"), 70)
    got = licenses_in(f"{wrapped}\n{other}")
    assert [r[2:] for r in got] == [("MIT", 0, 0, True), ("MIT", 1, 2, False)]
    docs = spark.createDataFrame([(1, two), (2, f"x\n\n{wrapped}")], "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["first_line"], r["license"] or "", r["block"]) for r in licenses.scan(docs).collect())
    assert found == [(1, 0, "", "Copyright (c) 2020 Jane Doe."), (1, 0, "Proprietary", "All rights reserved."),
                     (1, 1, "MIT", "Released under the MIT License."), (2, 2, "MIT", wrapped)]


@pytest.mark.parametrize("name,words", [("MIT", 160), ("MIT-0", 130), ("BSD-2-Clause", 180), ("BSD-3-Clause", 210), ("ISC", 105),
                                        ("0BSD", 90), ("Unlicense", 190), ("Apache-2.0", 1500), ("GPL-2.0", 2900), ("GPL-3.0", 5600)])
def test_full_license_texts(name, words):
    import textwrap

    full = max(licenses.TEMPLATES[name], key=len)
    assert len(full.split()) >= words
    text = full.replace("free software", "open software", 1)
    changed = int(text != full)
    lines = textwrap.wrap(text, 70, break_on_hyphens=False)
    for body in (text, "\n".join(lines), "\n".join(f" * {x}" for x in lines)):
        got = licenses_in(f"Copyright (c) 2020 Jane Doe\n\n{body}\n\nSome other words.")
        assert got == [(0, 1, None, None, None, False), (2, body.count("\n") + 1, name, changed, changed, not changed)]


def test_license_parts_match_brute_force():
    rng = random.Random(4)
    words = [f"v{i}" for i in range(60)]
    templates = {f"L{n}": [" ".join(rng.choice(words) for _ in range(n)) + " license"] for n in (3, 5, 9, 20, 40)}
    for trial in range(60):
        name = rng.choice(sorted(templates))
        copy = templates[name][0].split()
        for _ in range(int(rng.random() * len(copy) * 0.2)):
            at = rng.randrange(len(copy) - 1)
            copy[at: at + 1] = rng.choice([[], [copy[at], "added"]])
        differ = abs(len(copy) - len(templates[name][0].split()))
        text = " ".join(["other"] * rng.randint(0, 30) + copy + ["words"] * rng.randint(0, 30))
        got = [r for r in licenses_in(text, templates) if r[2] == name]
        assert len(got) == 1 and got[0][3] + got[0][4] >= differ, (trial, name, text)


def test_pipeline_stages(spark, rows, tmp_path):
    import corpus_pipeline as P

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    frame = spark.createDataFrame([(r[0], r[1], r[2], r[3], len(r[1] or "")) for r in rows],
                                  "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    item = next(r for r in rows if len(words_of(r[1])) > 80)
    spark.createDataFrame([(0, b" ".join(words_of(item[1])[:30]).decode())], "item_id bigint, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    now, sf_dir = frame, str(tmp_path)
    for name, stage in P.STAGES:
        before = {r["doc_id"]: r["text"] for r in now.collect()}
        after = stage(spark, now, sf_dir)
        kept = {r["doc_id"] for r in after.collect()}
        gone = set(before) - kept
        if name != "sharding":
            assert after.columns == columns
        if name == "language_id":
            scores = {r["doc_id"]: r["score"] for r in langid.identify(now).collect()}
            least = 0.5 + langid.LEAST_LEAD * 0.5  # two languages
            assert gone == {i for i, t in before.items() if scores[i] == 0 or (
                scores[i] < least - 1e-6 and len(t.encode()) >= langid.LEAST_BYTES)}
            assert gone >= {i for i, t in before.items() if not any(c.isalpha() for c in t or "")}
        elif name == "near_duplicates":
            sets = {i: shingles(t) for i, t in before.items()}
            links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
                     and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            label = reachable(links, sets)
            assert gone == {i for i in sets if label[i] != i}
        elif name == "decontamination":
            probe = shingles(" ".join(x.decode() for x in words_of(item[1])[:30]))
            assert gone == {i for i, t in before.items() if 100 * len(probe & shingles(t)) >= 80 * len(probe)}
        elif name == "mixing":
            assert kept and gone
        else:
            assert not gone and after.where("slot is null or shard is null").count() == 0
        now = after
    final = {r["doc_id"] for r in P.run(spark, sf_dir).collect()}
    assert final == kept


@pytest.mark.parametrize("languages, best, stays", [(4, 0.25, False), (4, 0.34, False), (4, 0.35, True), (2, 0.55, False),
                                                    (2, 0.6, True), (1, 1.0, True)])
def test_languages_are_accepted_by_their_lead_over_a_guess(spark, monkeypatch, languages, best, stays):
    net = langid.Network([f"l{k}" for k in range(languages)])
    net.o[:] = 0
    if languages > 1:
        net.b[:] = np.log((1 - best) / (languages - 1))
        net.b[0] = np.log(best)
    monkeypatch.setattr(langid, "fit", lambda *a: net)
    frame = spark.createDataFrame([(1, "some letters " * 40), (2, None), (3, "12 3"), (4, "short"), (None, "é" * 128),
                                   (5, "é" * 127)], "doc_id bigint, text string").withColumn("lang", F.lit("l0"))
    assert {r["doc_id"] for r in langid.accepted(frame).collect()} == ({1, 4, 5, None} if stays else {4, 5})


def test_mixture_carries_columns_of_any_name(spark):
    data = [(None if n % 3 else n // 30, "w " * (n % 5 + 1), "en", "src0", n, "c") for n in range(200)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, place bigint, g string")
    for name in ("__place", "row", "taken"):
        clashing = frame.withColumnRenamed("place", name)
        kept = mixing.chosen_rows(clashing, {}, (1, 2), 1)
        assert kept.columns == clashing.columns and 0 < kept.count() < 200
        tokens = sum(len(words_of(r["text"])) for r in kept.collect())
        assert tokens <= sum(n % 5 + 1 for n in range(200)) // 2
    assert mixing.chosen_rows(frame.limit(0), {}).count() == 0


def test_mixture_keeps_the_rows_that_were_chosen(spark):
    import corpus_pipeline as P

    rng = random.Random(8)
    data = [(rng.choice([*[None] * 40, 1, 2, 3, *range(10, 40)]), " ".join(["w"] * rng.randint(0, 6) + [f"t{n}"] * rng.randint(0, 1)) or None,
             rng.choice(["en", None]), rng.choice(["src0", "src1", None]), n) for n in range(300)]
    data += [(5, "one two three", "en", "src0", 7)] * 20
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    chosen = mixing.mix(frame, P.MIX_WEIGHTS, P.MIX_SHARE, P.MIX_EPOCHS, P.MIX_SEED).where("copies > 0").collect()
    kept = P.mixture(spark, frame, "").collect()
    assert any(r["doc_id"] is None for r in chosen) and len(chosen) < sum(1 for d in data if d[1])

    def place(doc_id, lang, source, n_tokens):
        return str((doc_id, lang or mixing.NONE, source or mixing.NONE, n_tokens))

    assert sorted(place(r["doc_id"], r["lang"], r["source"], len(words_of(r["text"]))) for r in kept) == sorted(
        place(r["doc_id"], r["lang"], r["source"], r["n_tokens"]) for r in chosen)
    rows = [tuple(r) for r in kept]
    assert all(rows.count(r) <= data.count(r) for r in set(rows))


def test_canonical_json_is_stable(spark):
    got = spark.range(1).select(toolcalls.canonical(F.lit('{"b": [1, {"z": null, "a": "é"}], "a": 1.50}'))).first()[0]
    assert got == '{"a":1.5,"b":[1,{"a":"é","z":null}]}' and json.loads(got)["a"] == 1.5
