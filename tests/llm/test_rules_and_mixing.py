import pytest
from pyspark.sql import functions as F

from resight.llm import mixing, quality_rules


def test_ledger_edge_cases(spark):
    texts = [None, "", " \n\t", "a b", "a b c a b c d", "x\nx\n\nx y", "# <b> & it!"]
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    rows = {r.doc_id: r for r in quality_rules.ledger(docs).collect()}
    assert [(rows[i].n_words, rows[i].n_repeat_words, rows[i].n_dup_lines) for i in range(7)] == [
        (0, 0, 0), (0, 0, 0), (0, 0, 0), (2, 0, 0), (7, 6, 0), (4, 0, 1), (4, 0, 0),
    ]
    assert rows[6].n_symbols == 4 and all(r.fail_bits & 1 for r in rows.values())
    assert quality_rules.ledger(docs.limit(0)).collect() == []
    assert quality_rules.keep_passing(docs).columns == docs.columns


def test_ablations(spark):
    entries = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (256,)], "fail_bits long")
    policy = quality_rules.Policy("t", ("too_few_words", "repeated_windows"))
    rows = {r.rule: (r.n_failed, r.n_only_this) for r in quality_rules.ablations(entries, policy).collect()}
    assert rows == {"too_few_words": (3, 2), "repeated_windows": (1, 0)}
    assert entries.filter(quality_rules.passes(policy)).count() == 3


def water(sizes, weights, total):
    """Targets by giving excess back until no source is above twice its size."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while open_:
        left = total - sum(2 * sizes[s] for s in sizes if s not in open_)
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w >= 2 * sizes[s]}
        for s in open_:
            target[s] = 2 * sizes[s] if s in over else left * weights[s] / w
        if not over:
            break
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    import random

    rng = random.Random(seed)
    rows = [(i, " w" * rng.choice([0, 1, 5, 300]), rng.choice(["b", "a", "é", None, "Z", "aa"]), "x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.taken(docs).collect()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want = water(sizes, weights, 1.5 * sum(sizes.values()))
    totals = {}
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        totals[r.source] = totals.get(r.source, 0) + r.taken
    assert all(abs(totals[s] - want[s]) <= 0.05 * want[s] + 300 for s in sizes)
    assert sorted(map(str, mixing.taken(docs).collect())) == sorted(map(str, got))
    mixed = mixing.mix(docs).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert {r.doc_id: r.n for r in mixed} == {r.doc_id: r.copies for r in got if r.copies}


def test_mixing_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.taken(docs).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.taken(docs.limit(0)).collect() == [] and mixing.mix(docs.limit(0)).collect() == []
