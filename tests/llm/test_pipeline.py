"""The pipeline, stage by stage, against plain Python or SQL on what the stage was given."""

import re

import corpus_pipeline
import duckdb
import pytest
from test_fuzzy_lines import brute as brute_lines
from test_near_duplicates import brute as brute_near
from test_packing import check

from resight.llm import queries
from resight.session import saved

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    out = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], FOLDER)))
    return [t.toPandas() for t in out]


def test_columns_and_names(tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "packing"]
    assert all(list(t.columns) == list(corpus_pipeline.COLUMNS) for t in tables[:-1])
    assert all(len(t) for t in tables)


def passes(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    grams, again = {}, set()
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in grams.values():
        if len(places) > 1:
            again |= {i + k for i in places for k in range(3)}
    n, chars = len(words), sum(map(len, words))
    return not (
        n < 50
        or 100 * len(again) > 50 * n
        or 100 * sum(c in "#*$%&|<>" for c in text) > 10 * n
        or 100 * (len(lines) - len(set(lines))) > 50 * len(lines)
        or chars < 3 * n
        or chars > 12 * n
        or 100 * sum("A" <= c <= "Z" for c in text) > 30 * chars
        or 100 * text.count("!") > 50 * n
    )


def test_rules(tables):
    assert set(tables[1].doc_id) == {r.doc_id for r in tables[0].itertuples() if passes(r.text or "")}


def test_lines(spark, tables):
    rows = tables[1].sort_values("doc_id")
    want = brute_lines(spark, list(zip(rows.doc_id, rows.text, strict=True)))
    got = tables[2].sort_values("doc_id")
    assert list(got.doc_id) == list(rows.doc_id) and list(got.text) == want
    assert list(got.n_chars) == [len(t) for t in got.text]


def test_near(tables):
    components = brute_near(list(zip(tables[2].doc_id, tables[2].text, strict=True)), 5)
    assert sorted(tables[3].doc_id) == sorted(set(components.values()))


def test_mixing(tables):
    con = duckdb.connect()
    con.register("documents", tables[3])
    want = {d: (taken, size) for d, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({queries.OP8_SQL})").fetchall()}
    copies = tables[4].groupby("doc_id").size().to_dict()
    assert all(copies.get(d, 0) * size == taken for d, (taken, size) in want.items())
    assert set(copies) <= set(want)


def test_packing(tables):
    texts, rows = dict(zip(tables[4].doc_id, tables[4].text, strict=True)), list(tables[5].itertuples())
    seen, once = {}, []
    copies = tables[4].groupby("doc_id").size()
    for r in rows:
        seen[(r.doc_id, r.start)] = seen.get((r.doc_id, r.start), 0) + 1
    assert all(n == copies[d] for (d, _), n in seen.items())
    starts = set()
    for r in rows:
        if (r.doc_id, r.start) not in starts:
            starts.add((r.doc_id, r.start))
            once.append(r)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for some in by_sequence.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    for d, text in texts.items():
        own = [r for r in once if r.doc_id == d]
        assert sum(r.length for r in own) == own[0].doc_tokens
    assert check([r._replace(sequence_id=i, offset=0) for i, r in enumerate(once)], texts) == len(once)
