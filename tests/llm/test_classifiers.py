import numpy as np
import pytest

from resight.llm import language, line_crf, queries

FOLDER = "/root/testdata/sf0.01"


def test_quality_on_held_out_documents(spark):
    rows = queries.op2_quality_crf(spark, FOLDER).toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    both = rows[rows.held_out].merge(labels, on="doc_id")
    assert len(rows) == 1000 and rows.score.between(0, 1).all()
    assert (both.predicted == both.quality).mean() > 0.97


def test_language_on_held_out_documents(spark):
    rows = queries.op4_language_id(spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas()
    both = rows[rows.held_out].merge(docs, on="doc_id")
    assert (both.lang_pred == both.lang).mean() > 0.98


@pytest.fixture(scope="module")
def small(spark):
    en, ru, zh = "the cat and the dog of this house ", "кот и собака в этом доме ", "我们的房子里有猫和狗 "
    rows = [(i, t * 5, lang) for i, (t, lang) in enumerate([(en, "en"), (ru, "ru"), (zh, "zh")] * 4)]
    return language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_language_edge_cases(spark, small):
    texts = [None, "", "123 456 !!", "the dog", "собака дом", "猫", "the cat and the dog " * 4 + "кот и собака в доме " * 9, "ααα ᚠᚢ"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    rows = {r.doc_id: r for r in language.identify(docs, small).collect()}
    assert [rows[i].lang_pred for i in range(7)] == ["und", "und", "und", "en", "ru", "zh", "ru"]
    assert rows[6].spans == "0-20:en 20-65:ru"
    assert rows[7].lang_pred in ("en", "ru", "zh")
    assert language.train(docs.limit(0).selectExpr("text", "score as lang")) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(docs.limit(0), small).collect() == []


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 3, 7, 8])
    scores = rng.normal(0, 3, (8, 3))
    got = language.viterbi(first, scores, 2.0)
    for a, b in zip(first[:-1], first[1:], strict=True):
        def worth(path):
            return sum(scores[a + i, k] for i, k in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))

        paths = np.array(np.meshgrid(*[range(3)] * (b - a))).T.reshape(-1, b - a) if b > a else []
        if len(paths):
            assert worth(got[a:b]) == pytest.approx(max(map(worth, paths)))


def test_marginals_against_enumeration():
    rng = np.random.default_rng(1)
    first, score, trans = np.array([0, 4, 4, 6]), rng.normal(0, 2, 6), rng.normal(0, 1, (2, 2))
    p, expected = line_crf.marginals(first, score, trans, pairs=True)
    want, pairs = np.zeros(6), np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:], strict=True):
        total, good, moves = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for k in range(1 << (b - a)):
            y = [(k >> i) & 1 for i in range(b - a)]
            w = np.exp(sum(score[a + i] * v for i, v in enumerate(y)) + sum(trans[u, v] for u, v in zip(y, y[1:])))
            total += w
            good += w * np.array(y)
            for u, v in zip(y, y[1:]):
                moves[u, v] += w
        if b > a:
            want[a:b] = good / total
            pairs += moves / total
    assert np.allclose(p, want) and np.allclose(expected, pairs)


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "\n \n"), (4, "A b.\nC d.")], "doc_id long, text string")
    assert {r.score for r in line_crf.score(docs, None).collect()} == {0.5}
    assert line_crf.train(docs.selectExpr("doc_id", "text", "cast(null as int) quality")) is None
    labelled = spark.createDataFrame([(f"good words here {i}.", 1) for i in range(20)] + [(f"BAD!! $$ {i}", 0) for i in range(5)], "text string, quality int")
    model = line_crf.train(labelled)
    rows = {r.doc_id: r for r in line_crf.score(docs, model).collect()}
    assert rows[1].score == rows[2].score == rows[3].score == pytest.approx(0.8)
    assert rows[4].n_lines == 2


def test_more_than_127_languages():
    scores = np.zeros((6, 200))
    scores[:, 150] = 9.0
    assert language.viterbi(np.array([0, 6]), scores, 1.0).tolist() == [150] * 6
