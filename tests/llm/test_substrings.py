import random

import numpy as np
import pytest

from resight.llm import substrings
from resight.llm.fm_index import FMIndex, repeated_windows, suffix_array


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    where = {}
    for d, w in enumerate(words):
        for i in range(len(w) - window + 1):
            where.setdefault(tuple(w[i : i + window]), []).append((d, i))
    gone = {(d, i + k) for places in where.values() if len(places) > 1 for d, i in places for k in range(window)}
    return [(len(w), sum((d, i) in gone for i in range(len(w))), b" ".join(x for i, x in enumerate(w) if (d, i) not in gone).decode()) for d, w in enumerate(words)]


def corpus(seed, n, words=40):
    rng = random.Random(seed)
    passages = [" ".join(f"p{rng.randrange(words)}" for _ in range(rng.randint(5, 60))) for _ in range(6)]
    texts = [None, "", "a", "x " * 80, "b c " * 50, " a\tb c\x0bd "]
    for _ in range(n):
        parts = [" ".join(f"w{rng.randrange(words)}" for _ in range(rng.randint(0, 30))) for _ in range(3)]
        texts.append(f"{parts[0]} {rng.choice(passages)} {parts[1]}\n{rng.choice(passages)} {parts[2]}")
    return texts + texts[-3:]


@pytest.mark.parametrize("options", [{}, {"hot": 3, "shard_words": 300}])
def test_against_brute_force(spark, options):
    texts = corpus(1, 60)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(docs, window=12, gram=4, **options).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 12)


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(map(str, range(40)))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "short")], "doc_id long, text string")
    rows = substrings.remove_repeats(docs).collect()
    assert sorted((r.n_words, r.n_removed) for r in rows) == [(1, 0), (40, 40), (40, 40)]
    assert substrings.remove_repeats(docs.limit(0)).collect() == []


def test_minimisers_of_unique_text_occur_once():
    hashes = np.random.default_rng(0).integers(1, 1 << 63, 3000, dtype=np.uint64)
    start, size, key, occurs, _ = substrings.runs_of(hashes, 35, 6)
    assert size.sum() == 3000 - 34 and (np.diff(start) == size[:-1]).all()
    assert (occurs == 1).all() and len(np.unique(key)) == len(key)


def test_equal_windows_share_a_key_that_occurs_twice():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 9, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    start, size, key, occurs, _ = substrings.runs_of(a, 10, 3)
    of = np.repeat(key, size)
    total = {}
    for k, n in zip(key, occurs, strict=True):
        total[k] = total.get(k, 0) + n
    seen = {}
    for i in range(len(a) - 9):
        seen.setdefault(a[i : i + 10].tobytes(), []).append(i)
    for places in seen.values():
        assert len({of[i] for i in places}) == 1
        assert len(places) == 1 or total[of[places[0]]] >= 2


def test_index_counts_and_windows():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 5, 300)
    assert (suffix_array(np.append(text, 0)) == sorted(range(301), key=lambda i: list(np.append(text, 0)[i:]))).all()
    index = FMIndex(text)
    for _ in range(50):
        i, k = rng.integers(0, 290), rng.integers(1, 8)
        pattern = text[i : i + k]
        lo, hi = np.array([0]), np.array([index.size])
        for c in pattern[::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        assert hi[0] - lo[0] == sum((text[j : j + k] == pattern).all() for j in range(300 - k + 1))
    begin, end = np.array([0, 100, 200]), np.array([100, 200, 203])
    for size in (3, 5, 7):
        found = repeated_windows(index, text, begin, end, size)
        for b, e, ranges in zip(begin, end, found, strict=True):
            got = {i for lo, hi in ranges for i in range(lo, hi)}
            want = {i for i in range(e - b - size + 1) if sum((text[j : j + size] == text[b + i : b + i + size]).all() for j in range(301 - size)) > 1}
            assert got == want
