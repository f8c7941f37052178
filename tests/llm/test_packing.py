import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from resight.llm import packing

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("length", T.StringType())])


def tokens(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")


def check(rows, texts):
    """Every id in exactly one piece, checksums right, sequences gapless and never too long."""
    by_sequence = {}
    for doc_id, text in texts.items():
        ids, at = tokens(text), 0
        for r in sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
            by_sequence.setdefault(r.sequence_id, []).append(r)
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LENGTH
    return len(by_sequence)


def test_round_trip_of_odd_texts(spark):
    long = "Straße naïve 中文字 don't é  x <|endoftext|> " * 700
    texts = {1: None, 2: "", 3: "Hello,\tWorld\x0b!", 4: long, 5: "a " * 2047, 6: "a " * 2048, 7: " ", 8: "b " * 5000,
             9: "a\x1cb", 10: "a\x1f b \x1d\x1ec\u2028d\x85e\u180ef\u200bg"}
    docs = spark.createDataFrame([(k, v, "clash") for k, v in texts.items()], SCHEMA)
    check(packing.pack(docs).collect(), texts)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c", None)] * 3, SCHEMA)
    rows = packing.pack(docs).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_patterns_cover_the_demand_with_little_waste(seed):
    rng = np.random.default_rng(seed)
    sizes = np.unique(rng.integers(1, 512, 60 * (seed + 1)))
    demand = rng.integers(1, 400, len(sizes))
    used = packing.solve(sizes, demand, 512)
    assert (sum(p * n for p, n in used) == demand).all()
    assert all(p @ sizes <= 512 for p, _ in used)
    basis, x, prices = packing.relax(sizes, demand, 512)
    best = [0.0] * 513  # no packing needs fewer sequences than prices @ demand / worth of the best pattern
    for c in range(1, 513):
        best[c] = max([best[c - 1], *(best[c - s] + p for s, p in zip(sizes, prices, strict=True) if s <= c)])
    bound = max(sizes @ demand / 512, prices @ demand / max(1, best[512]))
    assert np.allclose(np.array(basis).T @ x, demand)
    assert bound - 1e-6 <= x.sum() <= bound + 0.5
    assert bound - 1e-6 <= sum(n for _, n in used) <= bound * 1.02 + 3


def test_table_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs).collect()
    used = check(rows, {r.doc_id: r.text for r in docs.collect()})
    assert sum(r.length for r in rows) / (used * packing.LENGTH) > 0.99


def test_stems_outlive_the_words_they_are_in(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED", 3)
    encoder, merged = packing._Encoder(packing.tokenizer_path()), []
    merge = encoder.merge
    encoder.merge = lambda run: merged.append(run) or merge(run)
    text = "Naïvecat naïvecat NAÏVECAT naïveCat don't"
    for _ in range(3):
        (ids,) = encoder.encode([text])
        assert ids.tolist() == tokens(text).tolist()
    assert len(merged) == 1


def test_words_in_use_are_not_merged_again(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED", 3)
    encoder = packing._Encoder(packing.tokenizer_path())
    merged, merge = [], encoder.merge
    encoder.merge = lambda run: merged.append(run) or merge(run)
    texts = [f"Often, often {w} 4.5 often" for w in ("one", "two", "three", "four", "five", "six", "seven", "eight")]
    got = [x.tolist() for t in texts for x in encoder.encode([t])]
    assert got == [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert merged.count("often") == 1 and merged.count(",") == 1 and "eight" in merged
    assert len(encoder.known) + len(encoder.known.before) <= 14
