"""Links from buckets of candidates, and connected components of links.

Components come from alternating large-star and small-star, as joins and grouped minima.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resight.session import discard, saved, saved_counting


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them (here: a > b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node of ``edges`` (a, b: longs).

    Loops and repeated edges are harmless. Each round is written to the scratch folder; the driver sees
    one fingerprint per round. Rounds grow with the logarithm of the longest path. No edges: no rows.
    """
    metrics = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
    undirected = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, seen = saved_counting(undirected.distinct(), *metrics)
    while seen["n"]:
        last = now
        now, new = saved_counting(_small_star(_large_star(last)), *metrics)
        discard(last)
        if new == seen:
            break
        seen = new
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


SMALL = 8  # members of a bucket that are compared each with each
ROUNDS = 3


def _members_apart(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members with their component ``c``, only of buckets that hold more than one component."""
    named = members.join(comps, members.id == comps.node, "left").select(
        *members.columns, F.coalesce("component", "id").alias("c")
    )
    mixed = named.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo != hi")
    return named.join(mixed.select("bucket"), "bucket")


def link_buckets(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    near: Callable[[str, str], Column] | None = None,
    values: tuple[str, ...] = (),
    settle: Callable[[DataFrame], DataFrame] | None = None,
    small: int | None = None,
    first: DataFrame | None = None,
) -> DataFrame:
    """Confirmed links (a, b) that connect whatever the candidates of all buckets connect; of connected groups stars may be left.

    ``members``: (bucket, id, values...), the same id at most once in a bucket, and if known ``size``, the number of its members. Buckets of up to ``small``
    members (``SMALL`` unless given) compare each with each. In a larger one, members meet one representative per round, another one
    each round, and members already connected are left out; what is still apart after ``ROUNDS`` (bucket, id, c) goes to
    ``settle``, which returns its links, or is compared each with each across components, a pair once however many buckets it shares. So a large group costs
    about one pair per member and round, and yet no candidate between different components is left out. ``near`` may
    reject pairs by the values alone. ``first``: pairs (a, b) of other buckets, known already.
    """

    def pairs(met: DataFrame) -> DataFrame:
        kept = met.filter(near(*[f for v in values for f in (v, f"{v}2")])) if near else met
        if "own" in met.columns:  # a pair counts in the first bucket that both are in
            kept = kept.filter(F.array_min(F.array_intersect("own", "own2")) == F.col("bucket"))
        return kept.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"))

    def every(rows: DataFrame) -> DataFrame:
        if "c" in rows.columns:
            rows = rows.join(rows.groupBy("id").agg(F.collect_list("bucket").alias("own")), "id")
        names = [c for c in ("id", *values, "c", "own") if c in rows.columns]
        other = rows.select("bucket", *[F.col(c).alias(f"{c}2") for c in names])
        met = rows.join(other, "bucket").filter("id < id2")
        return met.filter("c != c2") if "c" in names else met

    def star(rows: DataFrame, turn: int) -> DataFrame:
        names = [c for c in ("id", *values, "c") if c in rows.columns]
        order = F.col("id") if turn == 0 else F.xxhash64("id", F.lit(turn))
        heads = rows.groupBy("bucket").agg(F.min_by(F.struct(*names), order).alias("head"))
        met = rows.join(heads, "bucket").select(*rows.columns, *[F.col(f"head.{c}").alias(f"{c}2") for c in names])
        return met.filter("c != c2") if "c" in names else met.filter("id != id2")

    limit = SMALL if small is None else small
    if "size" in members.columns:
        small = members.filter((F.col("size") > 1) & (F.col("size") <= limit)).drop("size")
        many = members.filter(F.col("size") > limit).drop("size")
    else:
        sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        small = members.join(sizes.filter((F.col("n") > 1) & (F.col("n") <= limit)).select("bucket"), "bucket")
        many = members.join(sizes.filter(F.col("n") > limit).select("bucket"), "bucket")
    large, found = saved_counting(many, F.count(F.lit(1)).alias("n"))
    known, first = first, pairs(every(small))
    if known is not None:
        first = first.union(known)
    if not found["n"]:
        return saved(confirm(first))
    links = saved(confirm(first.union(pairs(star(large, 0)))))
    named = None
    for turn in range(1, ROUNDS + 1):
        if named is None:
            named = components(links)
            apart, found = saved_counting(_members_apart(large, named), F.count(F.lit(1)).alias("n"))
        if not found["n"]:
            break
        if turn == ROUNDS and settle:
            new = settle(apart)
        else:
            new = confirm(pairs(star(apart, turn) if turn < ROUNDS else every(apart)))
        new, more = saved_counting(new, F.count(F.lit(1)).alias("n"))
        if more["n"]:  # else all groups stay as they are
            stars = named.filter("node != component").select(F.col("component").alias("a"), F.col("node").alias("b"))
            old, links = links, saved(new.union(stars))
            discard(old, named, apart)
            named = None
        discard(new)
    if named is not None:
        discard(named, apart)
    discard(large)
    return links
