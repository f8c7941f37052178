import random
import re

import pytest
from check import compare, connect

from resight.llm import disclosure
from resight.llm.queries import OP13_SQL, op13_disclosure

SCHEMA = "doc_id long, text string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(m):
    d = [int(c) for c in m if c.isdigit()]
    return 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0


HOLDS = {
    "email": lambda m: True,
    "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
    "card": luhn,
    "phone": lambda m: 8 <= sum(c.isdigit() for c in m) <= 15,
}


def brute(text):
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}" for kind, p in PLAIN.items() for m in re.finditer(p, text or "", re.ASCII) if HOLDS[kind](m.group())
    )


def base(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    none = spark.createDataFrame([], "term string, action string")
    rows = disclosure.find(docs, terms=none).select("doc_id", disclosure.span_list(*disclosure.KINDS, *disclosure.ACTIONS).alias("s"))
    return [r.s for r in rows.orderBy("doc_id").collect()]


def test_base_spans_as_plain_patterns(spark):
    rng = random.Random(7)
    parts = ["a", "b.c", "@", ".", "1", "12", "255", "256", "001", "4111 1111 1111 1111", "4111111111111111", "+1 (988) 555-2485", "+", "-", " ", "é", "😀", "%", "x@y.z", "\n", "0"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(600)]
    texts += [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "000255.1.1.01", "1.2.3.1000", "0.0.0.0", "😀 a@b.cd", "+12345678@x.yz"]
    assert base(spark, texts) == [brute(t) for t in texts]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a" * 300_000, ""),
        ("a" * 100_000 + "@c" + ".b" * 100_000, "email:0:300002"),
        ("1" * 300_000, ""),
        ("1." * 40_000, ",".join(f"ip:{i}:{i + 7}" for i in range(0, 80_000, 8))),
        ("+1" + "(" * 300_000, ""),
        ("1 " * 150_000, ""),
        ("+" * 300_000, ""),
    ],
    ids=["letters", "labels", "digits", "addresses", "brackets", "spaced", "plus"],
)
def test_long_texts_of_one_kind(spark, text, want):
    """In linear time and without recursion; plain patterns would take squared time."""
    assert base(spark, [text]) == [want]


def test_many_spans_in_one_text(spark):
    text = "ü a@b.cd 10.0.0.1 " * 3_000
    assert base(spark, [text]) == [brute(text)]


def planted():
    """A name beside one address in many different sentences, in two spellings; a word shared with others; copies."""
    rng = random.Random(9)
    fill = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(10)]
    some = lambda n: " ".join(rng.choices(fill, k=n))
    texts = [some(30) for _ in range(300)]
    for k in range(6):
        texts.append(f"{some(9)} Zoltan Quibbler {some(3)} {'Z.Q@mail.example' if k % 2 else 'z.q@mail.example'} {some(9)} common {some(4)}")
    texts += [f"{some(5)} Quibbled quibbling {some(5)} common" for _ in range(9)]
    texts += [f"{some(5)} zoltan wrote {some(5)}"]
    texts += [f"only {k} here rareword +1 (988) 555-2485 end" for k in (1, 1, 1, 1)] + [None, "", "common"]
    return texts + texts[300:302] * 5


def test_disclosing_terms_against_sql(spark, tmp_path):
    rows = [(i, t, 1, "x") for i, t in enumerate(planted())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits int, gaps string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, con, "op13", op13_disclosure, OP13_SQL, str(tmp_path)) == f"ok, {len(rows)} rows"
    terms = {r.term: r.action for r in disclosure.disclosing(docs).collect()}
    assert terms == {"zoltan": "remove", "quibbler": "generalise"}


def test_sanitised_text(spark):
    docs = spark.createDataFrame([(1, "Mr Zoltan Quibbler, +1 (988) 555-2485; 12"), (2, None), (3, "4111 1111 1111 1112")], SCHEMA)
    terms = spark.createDataFrame([("zoltan", "remove"), ("quibbler", "generalise")], "term string, action string")
    out = disclosure.sanitised(disclosure.find(docs, terms=terms))
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Mr  Qui*, [phone]; 12", 2: None, 3: "4111 1111 1111 1112"}


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert disclosure.find(docs).collect() == []
