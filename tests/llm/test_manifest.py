import hashlib
import random
from collections import defaultdict

from check import compare, connect
from pyspark.sql import functions as F

from resight.llm import merkle
from resight.llm.queries import OP12_SQL, op12_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = i // 8 * 8
        out += nodes[run:i] + nodes[i + 1 : run + 8]
        i //= 8
    return "".join(out)


def brute(rows):
    """Counts of (doc_id, leaf, subroot, root, proof)."""
    groups = defaultdict(list)
    for r in rows:
        doc_id, text, lang, source, n_chars = r
        values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
        leaf = h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])
        groups[lang].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: levels([leaf for *_, leaf in sorted(groups[lang])]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    return sorted(
        (str(doc_id), leaf, trees[lang][-1][0], top[-1][0], h(siblings(trees[lang], i), siblings(top, k)))
        for k, lang in enumerate(langs)
        for i, (_, doc_id, leaf) in enumerate(sorted(groups[lang]))
    )


def manifest(docs):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaves = docs.select(merkle.group_key(F.col("lang")).alias("g"), "doc_id", merkle.leaf_hash(*fields).alias("leaf"))
    return merkle.manifest(leaves)


def check(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = manifest(docs).select("doc_id", "leaf", "subroot", "root", merkle.proof_hash().alias("p"), merkle.folded(F.col("leaf")).alias("f")).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.p) for r in got) == brute(rows)
    assert all(r.f == r.root for r in got)


def test_places_of_all_kinds_of_ids(spark):
    rng = random.Random(3)
    ids = [None, None, 0, -1, 63, 64, 4095, 4096, -4097, 2**63 - 1, -(2**63), 1 << 40, 7, 7, 7]
    ids += [rng.randrange(-(2**63), 2**63) for _ in range(40)] + rng.sample(range(3000), 900)
    rows = [(i, rng.choice([None, "", "a", "Ü b", "x" * 50]), rng.choice(["en", "de"]), "s", 3) for i in ids]
    rows += rows[-20:] + [rows[2]] * 70  # copies
    rows += [(5, "lone", None, None, None), (6, "", "", "s", 0)]
    check(spark, rows)


def test_groups_of_every_depth(spark):
    sizes = {"a": 1, "b": 2, "c": 8, "d": 9, "e": 64, "f": 65, "g": 512, "h": 513, "é": 3}
    check(spark, [(i * 3, f"t{i}", lang, "s", i) for lang, n in sizes.items() for i in range(n)])


def test_one_row_and_none(spark):
    check(spark, [(1, "x", "en", "s", 1)])
    docs = spark.createDataFrame([], SCHEMA)
    assert manifest(docs).collect() == []


def test_query_finds_what_was_changed(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice(["Abc", "abc", "", None, "ÄB c"]), rng.choice(["en", None, "fr"]), "s", i) for i in range(700)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("g", F.lit("clash")).withColumn("path", F.lit(1))
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, con, "op12", op12_merkle_manifest, OP12_SQL, str(tmp_path)) == "ok, 700 rows"
    out = op12_merkle_manifest(spark, str(tmp_path))
    assert 0 < out.filter("not verified").count() < 700 / 3
