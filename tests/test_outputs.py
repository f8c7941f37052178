"""Incremental outputs per file and ordered exports, against literal cases."""

import os
import random

from pyspark.sql import functions as F

from resight.sources import incremental, sheets, writers


def put(root, name, text, at):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (at, at))


def states(frame):
    return {r.source_file.rsplit("/", 1)[1]: r.state for r in frame.collect()}


def written(folder):
    return {(p.parent.name, p.name): p.stat().st_mtime_ns for p in folder.glob("per_file/source=*/version=*/*.parquet")}


def test_only_changed_files_are_read_and_written(spark, tmp_path):
    root, out, seen = tmp_path / "in", tmp_path / "out", []

    def read(after):
        found = sheets.read_sheets(spark, str(root), ["a"], modified_after=after)
        seen.append({r.source_file.rsplit("/", 1)[1] for r in found.headers.collect()})
        return found.rows.select("a", "source_file")

    def run():
        return states(incremental.refresh(spark, str(root), str(out), read, sheets.SHEETS))

    def rows():
        return sorted((r.source_file.rsplit("/", 1)[1], r.a) for r in incremental.current(spark, str(out)).collect())

    put(root, "x 1.csv", "a\n1\n2\n", 1_000_000)
    put(root, "deep/2019.csv", "a\n3\n", 1_000_100)
    put(root, "z.csv", "a\n4\n", 1_000_200)
    assert run() == {"x%201.csv": "new", "2019.csv": "new", "z.csv": "new"}
    assert rows() == [("2019.csv", "3"), ("x%201.csv", "1"), ("x%201.csv", "2"), ("z.csv", "4")]

    before = written(out)
    assert set(run().values()) == {"same"} and len(seen) == 1 and written(out) == before  # nothing to do

    put(root, "z.csv", "a\n5\n6\n", 1_000_300)  # changed
    put(root, "new.csv", "b,a\n,7\n", 1_000_250)
    (root / "deep/2019.csv").unlink()
    assert run() == {"x%201.csv": "same", "2019.csv": "gone", "z.csv": "changed", "new.csv": "new"}
    assert seen[-1] == {"z.csv", "new.csv"}  # older files stay out of the scan
    assert len(set(written(out)) - set(before)) == 2 and all(written(out)[p] == t for p, t in before.items())
    assert rows() == [("new.csv", "7"), ("x%201.csv", "1"), ("x%201.csv", "2"), ("z.csv", "5"), ("z.csv", "6")]

    put(root, "z.csv", "a\n", 1_000_400)  # a changed file without rows takes its old rows with it
    put(root, "new.csv", "b,a\n,8\n", 900_000)  # older than before, and yet another state
    assert run() == {"x%201.csv": "same", "z.csv": "changed", "new.csv": "changed"}
    assert rows() == [("new.csv", "8"), ("x%201.csv", "1"), ("x%201.csv", "2")]

    for name in ("x 1.csv", "z.csv", "new.csv"):
        (root / name).unlink()
    assert set(run().values()) == {"gone"} and rows() == []
    put(root, "z.csv", "a\n9\n", 1_000_500)
    assert run() == {"z.csv": "new"} and rows() == [("z.csv", "9")]


def test_a_run_that_failed_before_its_manifest_changes_nothing(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    put(root, "x.csv", "a\n1\n", 1_000_000)

    def read(after):
        return sheets.read_sheets(spark, str(root), ["a"], modified_after=after).rows.select("a", "source_file")

    incremental.refresh(spark, str(root), str(out), read, sheets.SHEETS)
    put(root, "x.csv", "a\n2\n", 1_000_100)
    incremental.refresh(spark, str(root), str(out), read, sheets.SHEETS)
    (out / "manifest/run=2").rename(tmp_path / "lost")
    assert [r.a for r in incremental.current(spark, str(out)).collect()] == ["1"]
    incremental.refresh(spark, str(root), str(out), read, sheets.SHEETS)  # writes the same folder again, once
    assert [r.a for r in incremental.current(spark, str(out)).collect()] == ["2"]


def test_order_is_kept_over_many_pieces(spark, tmp_path):
    rng = random.Random(3)
    values = [(rng.choice(["a, b", "", None, "NA", 'q"q', "z"]), rng.randrange(50), i) for i in range(5000)]
    rows = spark.createDataFrame(values, "t string, k int, i int").repartition(7)
    order = [F.col("k").desc(), F.col("i")]
    path = writers.write_ordered(rows, str(tmp_path), "export", "v1", order)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (before, "1500"):  # whole files, and files in many splits
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            back = writers.read_ordered(spark, path, "t string, k int, i int").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        want = sorted(values, key=lambda r: (-r[1], r[2]))
        assert [(r.k, r.i) for r in sorted(back, key=lambda r: r.row_no)] == [(k, i) for _, k, i in want]
        assert sorted(r.row_no for r in back) == list(range(1, 5001))
    empty = writers.write_ordered(rows.filter("false"), str(tmp_path), "empty", "v1", order)
    assert writers.read_ordered(spark, empty, "t string, k int, i int").collect() == []
