import random

import pytest
from check import compare, connect

from resight.llm import graph, minhash, queries

FOLDER = "/root/testdata/sf0.01"


def brute(rows, size, percent=80):
    """doc_id -> (set size, component) by comparing each document with each."""
    sets = {}
    for i, t in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        grams = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets.setdefault(i, []).append(grams)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    flat = [(i, s) for i, many in sets.items() for s in many if s]
    for i, a in flat:
        for j, b in flat:
            if i < j and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def variants(seed, base_words, n, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(base_words)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_against_each_with_each(spark, size):
    texts = variants(1, 60, 60, 7) + variants(2, 40, 30, 4) + ["", None, "one", "ONE", "one", "a b", "A  b", " ", "é É"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (7, "quite another text here"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    got = minhash.near_duplicates(docs, shingle=size).collect()
    assert len(got) == len(rows)
    want = brute([r for r in rows if r[0] is not None], size)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    kept = minhash.keep_one(docs, shingle=size)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))


def test_apart_members_are_settled_exactly(spark, monkeypatch):
    monkeypatch.setattr(graph, "SMALL", 2)
    monkeypatch.setattr(graph, "ROUNDS", 1)
    monkeypatch.setattr(minhash, "_BLOCK", 16)
    texts = variants(3, 80, 90, 14)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, shingle=2).collect()}
    want = brute(list(enumerate(texts)), 2)
    assert got == want and len(set(want.values())) > 3


def test_every_text_of_an_id_links(spark):
    a, b = variants(4, 60, 1, 0)[0], variants(5, 60, 1, 0)[0]
    rows = [(1, a), (1, b), (2, f"{b} more"), (3, f"{a} more"), (4, "alone here"), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs, shingle=2).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (None, None, True)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(docs).collect() == [] and minhash.keep_one(docs).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 40), (60, 50), (7, 7), (40, 60), (50, 40)]
    rows = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {**dict.fromkeys(range(31), 0), **dict.fromkeys((40, 50, 60), 40)}
    assert len(rows) == 34


@pytest.mark.parametrize("name", ["op5_minhash", "op7_quality_rules", "op8_mixing", "op10_substring_dedup"])
def test_query_against_sql(spark, name):
    result = compare(spark, connect(FOLDER), name, queries.QUERIES[name], queries.ORACLES[name], FOLDER)
    assert result == "ok, 1000 rows"


def test_rounds_without_new_links_find_no_components_again(spark, monkeypatch):
    named, find = [], graph.components
    monkeypatch.setattr(graph, "components", lambda edges: named.append(edges.count()) or find(edges))
    members = spark.createDataFrame([(k, i) for k in (1, 2) for i in range(k, 60, k)], "bucket long, id long")
    none = graph.link_buckets(members, lambda pairs: pairs.filter("a = b"))
    assert none.collect() == [] and named == [0]
    named.clear()
    links = graph.link_buckets(members, lambda pairs: pairs.filter("a % 5 = b % 5"))
    got = {r.node: r.component for r in find(links).collect()}
    assert got == {i: i % 5 or 5 for i in range(1, 60)}
    # each later round starts with a star for each group
    assert len(named) == graph.ROUNDS and all(n <= 59 + 60 for n in named[1:])
