import numpy as np
import pytest
from pyspark.sql import functions as F

from resight.llm import html_text, learned_partitions, queries


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("<article><h1>Title</h1><p><b>One &amp; two<br>three&nbsp; four</article><footer>x</footer>", "Title One & two three four"),
        ("<nav>menu</nav><main><header>Head</header><p>The end of it.</p><div class='comments'>nice!</div></main>", "Head The end of it."),
        ("<body><div id=sidebar>links</div><p>" + "the way of the world is a long and winding road for all " * 2, ("the way of the world is a long and winding road for all " * 2).strip()),
        ("<script>var a='</p>';if(a<b){}</script><article>a &lt;b&gt; c < d</article><p cla", "a <b> c < d"),
        ("<article>open<script>never closed", "open"),
        ("<article>one<div class='ad'>buy</div>two <a href=x>link</a></article>", "one two link"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_short_blocks_follow_their_neighbours():
    long = "the story of the man and the sea is told by one who was there in the end"
    page = f"<p>{long}</p><p>So it was.</p><p>{long}</p><ul><li><a href=a>Home page link here</a></li><li>Next</li></ul>"
    assert html_text.main_text(page) == f"{long} So it was. {long}"


def test_pages_query(spark):
    rows = queries.op9_html_text(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 50 and all(r.n_chars == len(r.text) and r.n_chars for r in rows)
    assert not any("track(" in r.text or "©" in r.text for r in rows)


def brute(rows, k=10):
    rows = [(i, np.array(x, float)) for i, x in rows]
    out = {}
    for q, x in rows:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((y - x) ** 2).sum())), v) for v, y in rows if v != q)[:k]
            out[q] = near
    return out


def test_recall_and_scores(spark):
    folder = "/root/testdata/sf0.1"
    want = brute([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()])
    got = {}
    for r in queries.op3_learned_partitions(spark, folder).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        hits += len({m[2] for m in mine} & {v for _, v in near})
    assert hits / (10 * len(want)) >= 0.9


def test_search_edge_cases(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [1.0]), (6, [float("inf"), 0.0])]
    good = [(100, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [0.0, 1.0]), (200, [0.0, 2.0])]
    table = spark.createDataFrame([(i, x, "clash") for i, x in bad + good], "vec_id long, embedding array<float>, part string")
    rows = learned_partitions.search(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    want = brute(good)
    assert [(r.query_id, r.score, r.vec_id) for r in rows] == [(q, d, v) for q in (100, 200) for d, v in want[q]]
    assert learned_partitions.search(table.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_blocks_of_a_hot_part(spark, monkeypatch):
    monkeypatch.setattr(learned_partitions, "BLOCK_ROWS", 50)
    monkeypatch.setattr(learned_partitions, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 4).tolist() if i % 3 else [1.0, 1.0, 1.0, 1.0]) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = learned_partitions.search(table, F.col("vec_id") % 100 == 0, mass=1.1).orderBy("query_id", "rank").collect()
    want = brute(rows)
    assert [(r.query_id, r.vec_id) for r in got] == [(q, v) for q in sorted(want) for _, v in want[q]]


PROSE = "the story of the man and the sea is told by one who was there in the end and it is long"


def test_article_is_one_feature_of_blocks():
    body = f"<div><p>{PROSE} one</p><p>So it was.</p><p>{PROSE} two</p><p>{PROSE} three</p></div>"
    want = f"{PROSE} one So it was. {PROSE} two {PROSE} three"
    assert html_text.main_text(f"<article><h2>Short teaser</h2></article>{body}").endswith(want)
    # a part outside the article, and a list of links with its short heading at the end of the article
    tags = " ".join(f"tag{i}" for i in range(40))
    linked = f"<div>Read</div><p>now <a href=x>{tags}</a> of the day</p><div>More</div>"
    page = f"<article><p>{PROSE} one</p><p>{PROSE} two</p>{linked}</article><div>{PROSE} four</div>"
    assert html_text.main_text(page) == f"{PROSE} one {PROSE} two {PROSE} four"
    # words of a language without known stop words stay
    assert html_text.main_text(f"<article><p>{tags}</p></article>") == tags


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class='layout has-sidebar'><article><p>{PROSE}</p></article></div>", PROSE),
        (f"<div id='no-header'><p>{PROSE}</p></div>", PROSE),
        (f"<section class='side-effects'><p>{PROSE}</p></section><p>{PROSE}</p>", f"{PROSE} {PROSE}"),
        (f"<form action=x><input name=q><p>{PROSE}</p><p>{PROSE}</p><button>Send</button></form>", f"{PROSE} {PROSE}"),
        (f"<article><div class='entry-header'><h1>Title</h1></div><p>{PROSE}</p></article>", f"Title {PROSE}"),
        (f"<p>{PROSE}</p><svg width=1 /><p>{PROSE} two</p>", f"{PROSE} {PROSE} two"),
        (f"<p>{PROSE}</p><svg><text>x</text></svg><p>{PROSE} two</p>", f"{PROSE} {PROSE} two"),
        # a side element that holds the only article, or nearly all of the text, but not comments beside an article
        (f"<div class='notice'><article><p>{PROSE}</p></article></div>", PROSE),
        (f"<div class='banner'><p>{PROSE}</p><p>{PROSE}</p></div><p>So it was.</p>", f"{PROSE} {PROSE} So it was."),
        (f"<article><p>{PROSE} {PROSE}</p></article><div class='comments'><article>{PROSE * 9}</article></div>", f"{PROSE} {PROSE}"),
        (f"<p>{PROSE}</p><span class='ad'>buy</span> it", f"{PROSE} it"),
    ],
)
def test_wrappers_do_not_hide_the_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # a quote opens a value only behind "="
        (f"<p class=it's>{PROSE}</p><p>{PROSE} two</p>", f"{PROSE} {PROSE} two"),
        (f"<div title='a'\">{PROSE}</div>", PROSE),
        (f"<div title=\"a > b\" data-x = 'c > d'>{PROSE}</div>", PROSE),
        (f"<div title='class=ad id=menu'>{PROSE}</div>", PROSE),
        (f"<p>{PROSE}</p><p>Copyright 2024 Some House</p>", PROSE),
        (f"<p>{PROSE}</p><p>© Some House. All rights reserved.</p><p>So it was.</p>", f"{PROSE} So it was."),
        (f"<p>{PROSE}</p><div class='x", PROSE),
    ],
)
def test_odd_tags_and_notes(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "text",
    [
        "Старик вышел в море рано утром и долго смотрел на воду, пока солнце не поднялось над берегом и лодки не ушли далеко",
        "老人很早就出海了，他看了很久的海水，直到太阳从岸边升起，船都走远了。",
        "Stary rybak wyszedł rano na morze, długo patrzył na wodę, aż słońce wzeszło nad brzegiem, kiedy wszystkie łodzie odpłynęły bardzo daleko",
    ],
)
def test_languages_without_known_stop_words(text):
    menu = "<div><a href=a>Один</a> <a href=b>Два</a></div>"
    assert html_text.main_text(f"{menu}<div><p>{text}</p><p>{text}</p></div>{menu}") == f"{text} {text}"


def test_broken_pages_take_linear_time(spark):
    import time

    for piece in ("<a \"", "<a ='", "<a = \"", "<!--", "<p x", "<", "<a b=", "</p "):
        begun = time.perf_counter()
        html_text.main_text(piece * 250_000)
        assert time.perf_counter() - begun < 20, piece
    page = f"<p>{PROSE}</p>"
    table = spark.createDataFrame([(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "x")], "page_id long, url string, html string, text string")
    rows = sorted((r.page_id, r.url, r.text) for r in html_text.extract(table).collect())
    assert rows == [(1, "u", PROSE), (1, "u", PROSE), (2, None, "")]
    assert html_text.extract(table.limit(0)).collect() == []


def test_magnitudes(spark):
    rows = [(100, [1e200, 0.0]), (1, [1e200, 1.0]), (2, [1.0, 0.0]), (3, [1e-200, 0.0]), (200, [2e-200, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = learned_partitions.search(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    # the rest is as far from 100 in double precision, so ties go to the smaller id
    want = [(100, 1, 1.0), (100, 2, 1e200), (100, 3, 1e200), (100, 200, 1e200), (200, 3, 1e-200), (200, 2, 1.0), (200, 1, 1e200), (200, 100, 1e200)]
    assert [(r.query_id, r.vec_id, r.score) for r in got] == want
    many = [(i, [float(i), 1e300 if i == 7 else 1.0]) for i in range(1, 301)]
    found = learned_partitions.search(spark.createDataFrame(many, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0)
    assert found.count() == 30 and found.filter("vec_id = 7").count() == 0
