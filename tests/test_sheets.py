"""Sheets of differing headers, broken lines and files, against literal cases."""

import csv
import gzip
import io
import random

from resight.sources import readers, sheets

WANTED = ["file_name", "longitude", "note"]


def folder(tmp_path, files):
    for name, content in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(tmp_path)


def test_columns_by_name_and_lines_of_the_wrong_width(spark, tmp_path):
    root = folder(
        tmp_path,
        {
            "a.csv": "File name,Longitude\nx.JPG,1.5\n,2\nonly\ny.JPG,3,more\n\n",
            "deep/b b.csv": '﻿"Longitude","File.name","Note"\nNA,"q, ""r"".JPG",\n7,z.JPG,"say \\"hi\\""\n',
        },
    )
    got = {r.longitude or r.file_name: (r.source_file.rsplit("/", 1)[1][0], r.file_name, r.note, r.bad_record) for r in sheets.read_sheets(spark, root, WANTED).rows.collect()}
    assert got == {
        "1.5": ("a", "x.JPG", None, None),
        "2": ("a", None, None, None),
        "only": ("a", "only", None, "only"),
        "3": ("a", "y.JPG", None, "y.JPG,3,more"),
        'q, "r".JPG': ("b", 'q, "r".JPG', None, None),
        "7": ("b", "z.JPG", 'say "hi"', None),
    }


def test_every_file_has_a_state(spark, tmp_path):
    good = "File name,Longitude\nx.JPG,1\n,2\nz,3,4\n"
    root = folder(
        tmp_path,
        {"good.csv": good, "packed.csv.gz": gzip.compress(good.encode()), "broken.csv.gz": b"\x1f\x8b\x08\x00 nothing", "empty.csv": "", "header.csv": "File name\n"},
    )
    found = sheets.read_sheets(spark, root, WANTED)
    got = {r.source_file.rsplit("/", 1)[1]: tuple(r)[1:] for r in sheets.file_status(found).collect()}
    assert got == {
        "good.csv": ("read", 3, 1, 1),
        "packed.csv.gz": ("read", 3, 1, 1),
        "broken.csv.gz": ("unreadable", 0, 0, 0),
        "header.csv": ("read", 0, 0, 0),
    }
    assert [r.source_file.rsplit("/", 1)[1] for r in sheets.unreadable(found).collect()] == ["broken.csv.gz"]
    assert {r.bad_record for r in sheets.bad_records(found).collect()} == {"z,3,4"}


def test_a_file_in_many_blocks_has_one_header(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        root = folder(tmp_path, {"long.csv": "Note,File name\n" + "".join(f"n{i},f{i}\n" for i in range(3000))})
        found = sheets.read_sheets(spark, root, WANTED)
        assert found.rows.rdd.getNumPartitions() > 3
        assert {(r.file_name, r.note) for r in found.rows.collect()} == {(f"f{i}", f"n{i}") for i in range(3000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fields_as_a_csv_reader(spark):
    rng = random.Random(4)
    lines = []
    for _ in range(300):
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(["".join(rng.choices('ab ,"é', k=rng.randrange(6))) for _ in range(rng.randrange(1, 6))])
        lines.append((out.getvalue(),))
    df = spark.createDataFrame(lines, "line string")
    for r in df.select("line", sheets.fields_of(df.line).alias("f")).collect():
        want = next(csv.reader([r.line]), [""])
        assert [(x or "").strip() for x in r.f] == [x.strip() for x in want]


def test_listing_with_line_breaks_and_bad_records(spark, tmp_path):
    text = 'a,b\n1,"two\nlines, one field"\n2\n3,x,y\n4,NA\n'
    root = folder(tmp_path, {"l.csv": text})
    rows = readers.read_listing(spark, root, ["a", "b"], multi_line=True, bad_records=True).collect()
    assert sorted((r.a, r.b, r.bad_record) for r in rows) == [
        ("1", "two\nlines, one field", None), ("2", None, "2"), ("3", "x", "3,x,y"), ("4", None, None),
    ]
