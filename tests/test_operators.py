"""Grouped operators against straightforward Python on small random tables, skew paths included."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from resight.operators import gates, groups, joins, order, scans, skew

DATES = order.by_date("date", "photo_seq")
FILES = order.by_sequence("photo_seq")
SCHEMA = "photo_seq bigint, id string, date date, sex string"


@pytest.fixture(scope="module")
def rows():
    """One individual holds a third of the rows; some rows have no ID, some no date."""
    rng = random.Random(3)
    out = []
    for seq in range(600):
        who = "hot" if seq % 3 == 0 else rng.choice(["a", "b", "c", "d", None])
        day = None if rng.random() < 0.15 else dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(40))
        sex = rng.choice(["FemaleJ", "MaleM", "UNK", None, None, None, None])
        out.append((seq, who, day, None if who == "d" else sex))
    return out


@pytest.fixture(params=["one segment", "many segments"])
def blocks(request, monkeypatch, spark):
    """The same results whether a group lies in one segment or in very many."""
    n = "1"
    if request.param == "many segments":
        monkeypatch.setattr(skew, "PART_ROWS", 7)
        n = "40"
    settings = {"spark.sql.shuffle.partitions": n, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def in_order(rows, who):
    far = dt.date(9999, 1, 1)
    return sorted((r for r in rows if r[1] == who), key=lambda r: (r[2] or far, r[0]))


def fill(values, direction):
    def down(vs):
        last, out = None, []
        for v in vs:
            last = v if v is not None else last
            out.append(last)
        return out

    def up(vs):
        return down(vs[::-1])[::-1]

    steps = {"down": [down], "up": [up], "downup": [down, up], "updown": [up, down]}[direction]
    for step in steps:
        values = step(values)
    return values


@pytest.mark.parametrize("direction", ["down", "up", "downup", "updown"])
def test_fill_group(spark, rows, blocks, direction):
    got = {
        r["photo_seq"]: r["sex"]
        for r in scans.fill_group(frame(spark, rows), "id", "sex", DATES, direction).collect()
    }
    want = {r[0]: r[3] for r in rows if r[1] is None}
    for who in {r[1] for r in rows} - {None}:
        ordered = in_order(rows, who)
        want.update(zip((r[0] for r in ordered), fill([r[3] for r in ordered], direction)))
    assert got == want


def test_fill_keeps_values_and_rows(spark, rows, blocks):
    out = scans.fill_group(frame(spark, rows), "id", "sex", FILES, "downup", "filled")
    assert out.count() == len(rows)
    assert out.filter("sex is not null and (filled is null or filled != sex)").count() == 0


@pytest.mark.parametrize("direction", ["downup", "updown"])
def test_fill_several_values_in_one_pass(spark, rows, blocks, direction):
    df = frame(spark, rows).withColumn("sparse", F.when(F.col("photo_seq") % 50 == 7, F.col("photo_seq")))
    both = scans.fill_group(df, "id", ["sex", "sparse"], DATES, direction, ["s", "n"])
    got = {r["photo_seq"]: (r["s"], r["n"]) for r in both.collect()}
    for who in {r[1] for r in rows} - {None}:
        ordered = in_order(rows, who)
        want = zip(fill([r[3] for r in ordered], direction), fill([r[0] if r[0] % 50 == 7 else None for r in ordered], direction))
        assert [got[r[0]] for r in ordered] == list(want)


def test_a_hot_group_lies_in_many_segments(spark, rows, blocks, request):
    cut = scans.segmented(frame(spark, rows), "id", DATES.ascending())
    per = cut.groupBy("_segment").count().collect()
    assert sum(r["count"] for r in per) == len(rows)
    if "many" in request.node.callspec.id:
        assert max(r["count"] for r in per) < len(rows) / 8
        assert cut.filter("id = 'hot'").select("_segment").distinct().count() > 8


def test_scans_of_an_empty_table(spark):
    empty = frame(spark, [])
    assert scans.fill_group(empty, "id", "sex", DATES, "downup").collect() == []
    timed = spark.createDataFrame([], "seq bigint, id string, ts timestamp_ntz")
    assert scans.sessionize(timed, "id", "ts", "seq").collect() == []
    assert scans.gap_to_previous(timed, "id", "ts", "seq").collect() == []


def test_fill_unknown_direction(spark, rows):
    with pytest.raises(ValueError):
        scans.fill_group(frame(spark, rows), "id", "sex", DATES, "sideways")


def test_running_number(spark, rows, blocks):
    out = scans.running_number(frame(spark, rows).filter("id is not null"), "id", FILES, "n").collect()
    want = {}
    for who in {r[1] for r in rows} - {None}:
        for i, r in enumerate(sorted(x for x in rows if x[1] == who), 1):
            want[r[0]] = i
    assert {r["photo_seq"]: r["n"] for r in out} == want


@pytest.fixture(scope="module")
def sightings():
    rng = random.Random(5)
    start, out = dt.datetime(2024, 3, 1, 23, 0), []
    for seq in range(500):
        who = "hot" if seq % 3 == 0 else rng.choice(["a", "b", "c", None])
        ts = None if rng.random() < 0.1 else start + dt.timedelta(seconds=rng.choice([1, 30, 60, 1800]) * rng.randrange(60))
        out.append((seq, who, ts))
    return out


def sessions(sightings, gap=1800):
    ids, gaps = {}, {}
    for who in {s[1] for s in sightings} - {None}:
        timed = sorted((s for s in sightings if s[1] == who and s[2]), key=lambda s: (s[2], s[0]))
        n, last = 0, None
        for s in timed:
            diff = None if last is None else (s[2] - last).total_seconds()
            n += 1 if diff is None or diff > gap else 0
            ids[s[0]], gaps[s[0]], last = n, None if diff is None else diff / 60, s[2]
        for s in sorted(x for x in sightings if x[1] == who and not x[2]):
            n += 1
            ids[s[0]] = n
    return ids, gaps


def test_sessionize(spark, sightings, blocks):
    df = spark.createDataFrame(sightings, "seq bigint, id string, ts timestamp_ntz")
    got = scans.sessionize(df, "id", "ts", "seq").collect()
    keyless = {s[0]: None for s in sightings if s[1] is None}
    assert {r["seq"]: r["encounter_id"] for r in got} == sessions(sightings)[0] | keyless


def test_gap_to_previous(spark, sightings, blocks):
    df = spark.createDataFrame(sightings, "seq bigint, id string, ts timestamp_ntz")
    got = {r["seq"]: r["gap_minutes"] for r in scans.gap_to_previous(df, "id", "ts", "seq").collect()}
    assert len(got) == len(sightings)
    want = sessions(sightings)[1]
    assert {k: v and round(v, 6) for k, v in got.items() if k in want} == {k: v and round(v, 6) for k, v in want.items()}
    assert all(got[s[0]] is None for s in sightings if s[1] is None or s[2] is None)


def test_exactly_the_gap_stays_in_one_session(spark):
    t = dt.datetime(2024, 1, 1, 8)
    rows = [(0, "a", t), (1, "a", t + dt.timedelta(minutes=30)), (2, "a", t + dt.timedelta(minutes=60, seconds=1))]
    df = spark.createDataFrame(rows, "seq bigint, id string, ts timestamp_ntz")
    got = {r["seq"]: r["encounter_id"] for r in scans.sessionize(df, "id", "ts", "seq").collect()}
    assert got == {0: 1, 1: 1, 2: 2}


def test_session_buckets_as_sessions(spark, sightings, blocks):
    df = spark.createDataFrame(sightings, "seq bigint, id string, ts timestamp_ntz")
    got = {}
    for r in scans.session_buckets(df, "id", "ts").collect():
        first, last, n = got.get((r["id"], r["encounter_id"]), (r["start"], r["end"], 0))
        got[r["id"], r["encounter_id"]] = min(first, r["start"]), max(last, r["end"]), n + r["group_rows"]
    want, ids = {}, sessions(sightings)[0]
    epoch = dt.datetime(1970, 1, 1)
    for seq, who, ts in sightings:
        if who and ts:
            at = (ts - epoch) // dt.timedelta(microseconds=1)
            first, last, n = want.get((who, ids[seq]), (at, at, 0))
            want[who, ids[seq]] = min(first, at), max(last, at), n + 1
    assert got == want


def test_a_long_time_of_one_key_is_walked_in_segments(spark, blocks, request):
    """Four years of one record every 20 minutes with a break every 1000: no segment holds more than its share."""
    n = 100_000
    df = spark.range(n).selectExpr("'a' AS id", "timestamp_seconds(1200 * id + 3600 * (id div 1000)) AS ts")
    out = scans.session_buckets(df, "id", "ts")
    assert out.agg(F.max("encounter_id")).first()[0] == n // 1000
    if "many" in request.node.callspec.id:
        window = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in line and "lag" in line]
        assert window and all("_segment" in line for line in window)


def test_attach_group_splits_large_groups(spark, rows):
    df = frame(spark, rows)
    out = skew.attach_group(df, ["id"], [F.max("date").alias("last")], ["photo_seq"], part_rows=5)
    assert out.count() == len(rows) and out.columns == [*df.columns, "last"]
    for who in {r[1] for r in rows}:
        last = max((r[2] for r in rows if r[1] == who and r[2]), default=None) if who else None
        got = {r["last"] for r in out.filter(F.col("id").eqNullSafe(who)).collect()}
        assert got == {last}


def test_precedence_and_first_known(spark, rows, blocks):
    strongest = groups.precedence_label(frame(spark, rows), "id", "sex", ["photo_seq"]).collect()
    first = groups.first_known_label(frame(spark, rows), "id", "sex", FILES, ["photo_seq"]).collect()
    own = {r[0]: r[3] for r in rows}
    for who in {r[1] for r in rows}:
        labels = [r[3] for r in rows if r[1] == who]
        known = [x for x in labels if x in ("FemaleJ", "MaleM")]
        best = "MaleM" if "MaleM" in labels else "FemaleJ" if "FemaleJ" in labels else "UNK"
        for r in strongest:
            if r["id"] == who:
                assert r["sex"] == (own[r["photo_seq"]] if who is None else best)
        for r in first:
            if r["id"] == who:
                assert r["sex"] == (own[r["photo_seq"]] if who is None else (known or ["UNK"])[0])


def test_strict_min_max(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("b", 5)], "k string, v int")
    got = {r["k"]: tuple(r)[1:] for r in df.groupBy("k").agg(groups.strict_min("v"), groups.strict_max("v"), F.min("v")).collect()}
    assert got == {"a": (None, None, 1), "b": (2, 5, 2)}


def test_distinct_with_null(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), ("b", "x")], "k string, v string")
    got = {r["k"]: r["n"] for r in df.groupBy("k").agg(groups.distinct_with_null("v").alias("n")).collect()}
    assert got == {"a": 2, "b": 1}


def test_first_distinct_text(spark):
    data = [(4, "a", "z"), (1, "a", "y"), (2, "a", "z"), (3, "a", "x"), (5, "a", "w"), (6, None, "q"), (0, "b", None)]
    df = spark.createDataFrame(data, "photo_seq bigint, id string, k string")
    got = {r["id"]: r["s"] for r in groups.first_distinct_text(df, ["id"], "k", FILES, 3, "s").collect()}
    assert got == {"a": "y | z | x", None: "q", "b": "NA"}


def test_first_row_takes_nulls_last(spark, rows):
    got = {r["id"]: r["photo_seq"] for r in groups.first_row(frame(spark, rows), ["id"], DATES, ["photo_seq", "date"]).collect()}
    assert got == {who: in_order(rows, who)[0][0] for who in {r[1] for r in rows}}


def test_sample_one_is_stable(spark, rows):
    df = frame(spark, rows).filter("id is not null")

    def draw(frame, seed):
        return sorted(map(tuple, groups.sample_one(frame, ["id"], "photo_seq", ["photo_seq"], seed).collect()))

    assert draw(df, 1) == draw(df.repartition(7), 1)
    assert len(draw(df, 1)) == len({r[1] for r in rows} - {None})
    assert draw(df, 1) != draw(df, 2)


def test_null_safe_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    got = sorted(map(tuple, joins.null_safe(left, right, ["k"]).collect()), key=str)
    assert got == sorted([("a", 1, 10), (None, 2, 20), ("b", 3, None)], key=str)


def test_corrections(spark, rows):
    fixes = spark.createDataFrame([("hot", "FemaleJ", "MaleM"), ("a", "UNK", None)], "id string, sex string, new_value string")
    out = joins.apply_corrections(frame(spark, rows), fixes.union(fixes), ["id"], "sex")
    table = {("hot", "FemaleJ"): "MaleM", ("a", "UNK"): None}
    assert {r["photo_seq"]: r["sex"] for r in out.collect()} == {r[0]: table.get((r[1], r[3]), r[3]) for r in rows}


def test_conflicting_corrections(spark, rows):
    fixes = spark.createDataFrame([("a", "M"), ("a", "F")], "id string, new_value string")
    with pytest.raises(gates.GateError, match="not unique"):
        joins.apply_corrections(frame(spark, rows), fixes, ["id"], "sex")


def test_sessions_keep_rows_without_key(spark):
    rows = [(1, "a", 0), (2, "a", 10), (3, None, 5), (4, None, None), (5, "a", None)]
    df = spark.createDataFrame(rows, "seq long, id string, m int").selectExpr("seq", "id", "timestamp_seconds(60 * m) AS t")
    got = {r.seq: r.encounter_id for r in scans.sessionize(df, "id", "t", "seq").collect()}
    assert got == {1: 1, 2: 1, 3: None, 4: None, 5: 2}


@pytest.mark.parametrize("pairs", [None, 50])
def test_many_to_many_with_a_hot_key(spark, pairs):
    left = [("hot", i) for i in range(200)] + [("a", 1), ("a", 2), ("b", 3), (None, 4), ("only", 5)]
    right = [("hot", -i) for i in range(30)] + [("a", 7), ("a", 8), ("b", 9), (None, 1), ("zz", 2)]
    a, b = spark.createDataFrame(left, "key string, x int"), spark.createDataFrame(right, "key string, y int")
    out = joins.many_to_many(a, b, "key", ["x"], pairs)
    want = sorted((k, x, y) for k, x in left for j, y in right if k is not None and k == j)
    assert out.columns == ["key", "x", "y"] and sorted(map(tuple, out.collect())) == want
    counts = {r["key"]: (r["n_left"], r["n_right"]) for r in joins.key_counts(a, b, "key").collect()}
    assert counts == {"hot": (200, 30), "a": (2, 2), "b": (1, 1), None: (1, 1), "only": (1, 0), "zz": (0, 1)}


@pytest.mark.parametrize("rows", [None, 20])
def test_many_to_one_with_hot_keys(spark, rows):
    left = [("hot", "L", i) for i in range(90)] + [(None, "R", i) for i in range(50)] + [("a", None, 1), ("b", "L", 2), ("none", "L", 3)]
    right = [("hot", "L", "x"), (None, "R", "y"), ("a", None, "z"), ("b", "L", None), ("zz", "L", "w")]
    a, b = spark.createDataFrame(left, "id string, side string, n int"), spark.createDataFrame(right, "id string, side string, v string")
    facts = {(i, s): v for i, s, v in right}
    want = Counter((i, s, n, facts.get((i, s))) for i, s, n in left)
    out = joins.many_to_one(a, b, ["id", "side"], spread=["n"], part_rows=rows)
    assert out.columns == ["id", "side", "n", "v"] and Counter(map(tuple, out.collect())) == want
    # facts that come from the rows themselves
    sums = a.groupBy("id", "side").agg(F.max("n").alias("top"))
    top = {(i, s): max(m for j, t, m in left if (j, t) == (i, s)) for i, s, _ in left}
    got = joins.many_to_one(a, sums, ["id", "side"], part_rows=rows).collect()
    assert len(got) == len(left) and all(r["top"] == top[r["id"], r["side"]] for r in got)


def test_ids_present(spark, rows, blocks):
    ids = spark.createDataFrame([("hot",), ("a",), ("a",), (None,), ("zz",)], "id string")
    out = joins.ids_present(frame(spark, rows), ids, "id", ["photo_seq"])
    assert sorted(r["photo_seq"] for r in out.collect()) == [r[0] for r in rows if r[1] in ("hot", "a")]
    assert out.columns == ["photo_seq", "id", "date", "sex"]


def test_id_sets(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "id string")
    b = spark.createDataFrame([("y",), ("z",), (None,)], "id string")
    both = {r["id"] for r in joins.id_intersection(a, b, "id").collect()}
    only = {r["id"] for r in joins.id_difference(a, b, "id").collect()}
    assert both == {"y", None} and only == {"x"} and both | only == {r["id"] for r in a.collect()}


def test_first_match(spark):
    targets = spark.createDataFrame([("x",), ("y",), (None,)], "key string")
    files = spark.createDataFrame([("x", "x-2"), ("x", "x-1"), (None, "n")], "key string, name string")
    got = sorted(map(tuple, joins.first_match(targets, files, "key", "name", "name").collect()), key=str)
    assert got == sorted([("x", "x-1", True), ("y", None, False), (None, None, False)], key=str)


def test_repeated_groups(spark):
    df = spark.createDataFrame([("a", "F", 1), ("a", "M", 2), ("b", "F", 1)], "id string, sex string, n int")
    assert sorted(map(tuple, groups.repeated_groups(df, ["id"]).collect())) == [("a", "F", 1), ("a", "M", 2)]


def test_gates(spark):
    df = spark.createDataFrame([("1", "FemaleJ"), ("1", "UNK"), ("2", "MaleM"), (None, "MaleM"), (None, "UNK")], "id string, sex string")
    with pytest.raises(gates.GateError, match="1 groups, all listed in .*; first: 1$"):
        gates.halt_on_conflicts(df, "id", "sex")
    assert gates.halt_on_conflicts(df, "id", "sex", ignore_unknown=True) is df
    with pytest.raises(gates.GateError, match="not unique: 1 groups, .*first: 1$"):
        gates.require_unique(df.filter("id is not null"), ["id"])
    with pytest.raises(gates.GateError, match="missing columns in sheet: b, c"):
        gates.require_columns(df, ["id", "b", "c"], "sheet")
    with pytest.raises(gates.GateError, match="sex is not single-valued"):
        gates.require_single(df, ["id"], "sex")
    gates.require_single(df.filter("id = '2'"), ["id"], "sex")


def test_many_to_one_refuses_duplicates(spark):
    left = spark.createDataFrame([("a", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, w int")
    with pytest.raises(gates.GateError):
        joins.many_to_one(left, right, ["k"])
