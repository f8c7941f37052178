import random
import timeit
from fractions import Fraction

import numpy as np
from check import compare, connect

from resight.llm import divergence
from resight.llm.queries import OP11_SQL, op11_source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def against_sql(spark, folder, rows):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS item", "3 AS total")
    docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return compare(spark, con, "op11", op11_source_divergence, OP11_SQL, str(folder))


def test_nulls_copies_and_groups_without_terms(spark, tmp_path):
    rng = random.Random(1)
    words = ["Straße", "été", "the", "The", "a1b", "x", "日本", "co-op", "12", "..."] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = [
        (i, " ".join(rng.choices(words, k=rng.randrange(40))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "ß", None]), 1)
        for i in range(120)
    ]
    rows += [rows[0]] * 30 + [(1, None, "en", "empty", 0), (2, "", "en", "", 0), (3, "12 -", "xx", "a", 0), (4, None, "xx", "b", 0), (5, "once", "yy", "c", 0)]
    assert against_sql(spark, tmp_path, rows).startswith("ok")


def test_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_language_in_several_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(divergence, "RANGE_ROWS", 40)
    monkeypatch.setattr(divergence, "MEMORY_TERMS", 50)
    rng = random.Random(2)
    rows = [(i, " ".join(f"q{chr(97 + int(rng.expovariate(0.1)) % 26)}{'xyz'[rng.randrange(3)]}" for _ in range(60)), "en", f"s{rng.randrange(6)}", 1) for i in range(150)]
    assert against_sql(spark, tmp_path, rows).startswith("ok")


def test_run_columns_and_pair_sums():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n_rows, n_groups = int(rng.integers(1, 40)), int(rng.integers(1, 6))
        dense = rng.integers(0, 3, (n_groups, n_rows)) * rng.integers(0, 2, (n_groups, n_rows))
        weights = rng.integers(1, 5, n_rows)
        totals, terms = (dense * weights).sum(axis=1).tolist(), int(weights.sum())
        source, rows = np.nonzero(dense)
        columns = divergence._run_columns(rows, source, dense[source, rows], totals, terms)
        p = [[1 + 10**9 * (int(c) + 1) // (t + terms) for c in line] for line, t in zip(dense, totals)]
        for i, (to, back) in enumerate(divergence.pair_sums(columns, np.cumsum(weights))):
            for j in range(i):
                f = lambda a, b: sum(int(w) * ((x - y) ** 2 // y) for x, y, w in zip(a, b, weights))
                assert (to[j], back[j]) == (f(p[i], p[j]), f(p[j], p[i]))


def test_probabilities_of_large_counts(spark):
    n, total, terms = 10**13, 3 * 10**13, 10**7
    want = 1 + int(Fraction(10**9 * (n + 1), total + terms))
    assert divergence._probabilities(np.array([n]), total, terms).tolist() == [want]
    row = spark.createDataFrame([(n, total, terms)], "n long, t long, v long")
    assert row.select(divergence.probability(row.n, row.t, row.v)).first()[0] == want


def test_terms_of_other_scripts_cost_no_more():
    text = "İSTANBUL KELVIN ÉTÉ Straße ABC-DEF"
    assert divergence.terms_of(text) == ["İstanbul", "Kelvin", "ÉtÉ", "straße", "abc", "def"]

    def seconds(text):
        return min(timeit.repeat(lambda: divergence.terms_of(text), number=1, repeat=5))

    assert seconds("Strasse und Muenchen " * 20_000 + "ß") < 2.5 * seconds("Strasse und Muenchen " * 20_000)
