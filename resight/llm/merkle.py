"""Merkle manifest of a dataset: a root over all rows, and a proof per row (built-in functions only).

Every row is a leaf; the leaves of a group stand in order of ``doc_id``. Their places come from bitmaps, not from a
sort: per group a container for 4096 ids keeps its non-empty 64-bit words, and a directory counts the rows ahead of
every word. Containers are counted ahead in three steps of 2^17 or 2^18, so no window holds more rows than that.
A row's place is base + directory + the bits below its own. Then slot arrays of ``BLOCK`` nodes are hashed, three
levels of eight at a time, and the paths to the root are handed down block by block.

Cases: a null group is the first group, a null ``doc_id`` the first of its group. Rows of one ``doc_id`` are ordered by
leaf hash and equal leaves take adjacent places, so the result doesn't depend on the order of rows. A null value
is hashed as ``-``, an empty text as ``0:``. A lone leaf is its own subroot; an empty table has no rows.
Only the named columns are read; others, also of the names used here, don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resight.session import saved

FAN = 8
BLOCK = FAN**3
CHUNK_BITS, STEP_BITS = 12, 17
NO_ID = -(1 << 63 - CHUNK_BITS) - 1  # container of the null id: below that of any id
TIE_DIGITS = 4
STEP = "struct<left:string,right:string>"


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def group_key(group: Column) -> Column:
    """The group as text that sorts null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _below(bits: Column, place: Column) -> Column:
    """How many bits stand below a place."""
    return F.bit_count(bits.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), place)))).cast("long")


def _addressed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*",
        F.coalesce(F.shiftright("doc_id", CHUNK_BITS), F.lit(NO_ID)).alias("chunk"),
        F.coalesce(F.shiftright("doc_id", 6).bitwiseAND(F.lit(63)), F.lit(0)).cast("int").alias("word"),
        F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int").alias("bit"),
    )


def bitmaps(leaves: DataFrame) -> DataFrame:
    """Containers (g, chunk, present, n, slots): ``slots`` are the non-empty words with the rows ahead of them, and
    ``more`` counts the rows of ids that occur repeatedly."""
    ids = leaves.groupBy("g", "doc_id").agg(F.sum("copies").alias("copies"))
    repeats = F.when(F.col("copies") > 1, F.struct("bit", F.col("copies").alias("n")))
    words = (
        _addressed(ids)
        .groupBy("g", "chunk", "word")
        .agg(F.bit_or(_bit(F.col("bit"))).alias("bits"), F.sum("copies").alias("n"), F.collect_list(repeats).alias("more"))
    )
    ahead = Window.partitionBy("g", "chunk").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    return (
        words.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .groupBy("g", "chunk")
        .agg(
            F.bit_or(_bit(F.col("word"))).alias("present"),
            F.sum("n").alias("n"),
            F.sort_array(F.collect_list(F.struct("word", "bits", "ahead", "more"))).alias("slots"),
        )
    )


def with_bases(containers: DataFrame) -> DataFrame:
    """Add ``base``, the rows in earlier containers of the group, and ``size``, the rows of the group."""

    def ahead(order: str, *group: str) -> Column:
        window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    low = containers.select(
        "g", F.shiftright("chunk", 2 * STEP_BITS).alias("c2"), F.shiftright("chunk", STEP_BITS).alias("c1"), "chunk", "n"
    )
    mid = low.groupBy("g", "c2", "c1").agg(F.sum("n").alias("n"))
    high = mid.groupBy("g", "c2").agg(F.sum("n").alias("n"))
    high = high.select("g", "c2", ahead("c2", "g").alias("a2"), F.sum("n").over(Window.partitionBy("g")).alias("size"))
    mid = mid.select("g", "c2", "c1", ahead("c1", "g", "c2").alias("a1")).join(high, ["g", "c2"])
    low = low.select("g", "c2", "c1", "chunk", ahead("chunk", "g", "c2", "c1").alias("a0")).join(mid, ["g", "c2", "c1"])
    return containers.join(low.select("g", "chunk", (F.col("a0") + F.col("a1") + F.col("a2")).alias("base"), "size"), ["g", "chunk"])


def _among_equal_ids(rows: DataFrame) -> Column:
    """Rows of the same id with a smaller leaf hash: counted by the first digits of the hash, then inside."""
    key = ["g", "chunk", "word", "bit"]
    rows = rows.withColumn("digits", F.substring("leaf", 1, TIE_DIGITS))
    before = Window.partitionBy(*key).orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*key, "digits").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy(*key, "digits").agg(F.sum("copies").alias("n"))
    buckets = buckets.select(*key, "digits", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    rows = rows.withColumn("inner", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(buckets, [*key, "digits"])
    return rows.withColumn("idx", F.col("idx") + F.col("earlier") + F.col("inner")).drop("digits", "earlier", "inner")


def coordinates(leaves: DataFrame) -> DataFrame:
    """Add ``idx``, the place of each leaf in its group, and ``size``; rows with several ``copies`` are repeated.

    ``leaves`` has one row per (g, doc_id, leaf) with the number of ``copies``.
    """
    containers = saved(with_bases(saved(bitmaps(leaves))))
    slot = F.col("slots")[_below(F.col("present"), F.col("word")).cast("int")]
    more = F.col("slot.more")
    ahead = F.aggregate(
        F.filter(more, lambda m: m.bit < F.col("bit")), F.lit(0).cast("long"), lambda n, m: n + m.n - F.lit(1)
    )
    placed = (
        _addressed(leaves)
        .join(containers.drop("n"), ["g", "chunk"])
        .withColumn("slot", slot)
        .select(
            *leaves.columns,
            "chunk",
            "word",
            "bit",
            "size",
            (F.col("base") + F.col("slot.ahead") + _below(F.col("slot.bits"), F.col("bit")) + ahead).alias("idx"),
            F.exists(more, lambda m: m.bit == F.col("bit")).alias("tied"),
        )
    )
    placed = saved(placed)
    both = placed.filter(~F.col("tied")).unionByName(_among_equal_ids(placed.filter("tied")))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return (
        both.select("*", copy.alias("copy"))
        .withColumn("idx", F.col("idx") + F.col("copy"))
        .drop("copy", "copies", "chunk", "word", "bit", "tied")
    )


def _parents(nodes: Column) -> Column:
    def parent(i: Column) -> Column:
        return F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, FAN), ""), 256)

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int")), parent)


def _remaining(height: int) -> Column:
    """Nodes of the group after ``height`` blocks."""
    span = BLOCK**height
    return F.floor((F.col("size") + (span - 1)) / span).cast("long") if height else F.col("size")


def ascend(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of all heights over nodes (g, size, idx, hash, payload). A block keeps its nodes in slot order, two
    levels above them, and ``top``: the third, or the group's root if it ends earlier."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    blocks: list[DataFrame] = []
    while True:
        left = _remaining(len(blocks))
        slots = F.struct(F.pmod("idx", F.lit(BLOCK)).alias("slot"), "hash", "payload")
        rows = (
            nodes.groupBy("g", "size", F.floor(F.col("idx") / BLOCK).cast("long").alias("block"))
            .agg(F.sort_array(F.collect_list(slots)).alias("slots"))
            .select("g", "size", "block", F.col("slots.hash").alias("l0"), F.col("slots.payload").alias("payload"))
            .withColumn("l1", F.when(left > 1, _parents(F.col("l0"))))
            .withColumn("l2", F.when(left > FAN, _parents(F.col("l1"))))
        )
        top = F.when(left <= 1, F.col("l0")[0]).when(left <= FAN, F.col("l1")[0])
        top = top.when(left <= FAN * FAN, F.col("l2")[0]).otherwise(_parents(F.col("l2"))[0])
        blocks.append(saved(rows.withColumn("top", top)))
        if largest <= BLOCK ** len(blocks):
            return blocks
        nodes = (
            blocks[-1].filter(left > BLOCK).select("g", "size", F.col("block").alias("idx"), F.col("top").alias("hash"), F.lit(0).alias("payload"))
        )


def group_roots(blocks: list[DataFrame]) -> DataFrame:
    done = [b.filter(_remaining(i) <= BLOCK).select("g", "size", F.col("top").alias("subroot")) for i, b in enumerate(blocks)]
    return reduce(DataFrame.unionByName, done)


def _step(nodes: str, i: Column) -> Column:
    """What stands left and right of node ``i`` in its run of siblings."""
    at = F.pmod(i, F.lit(FAN))
    return F.struct(
        F.array_join(F.slice(F.col(nodes), i - at + 1, at), "").alias("left"),
        F.array_join(F.slice(F.col(nodes), i + 2, F.lit(FAN - 1) - at), "").alias("right"),
    )


def descend(blocks: list[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Leaves with ``path``, the siblings from the leaf to the root. ``tops`` has (g, size, path) of each group's
    root and the columns ``carried`` down to its leaves."""
    below = None
    for height in reversed(range(len(blocks))):
        left = _remaining(height)
        ends = (left <= BLOCK) & ((F.lit(height) == 0) | (_remaining(max(height - 1, 0)) > BLOCK))
        upper = tops.filter(ends).select("g", F.lit(0).cast("long").alias("block"), "path", *carried)
        if below is not None:
            upper = upper.unionByName(below.select("g", F.col("idx").alias("block"), "path", *carried))

        def entry(payload: Column, i: Column) -> Column:
            none = F.array().cast(f"array<{STEP}>")
            steps = [
                F.when(left > FAN**k, F.array(_step(f"l{k}", F.shiftright(i, 3 * k)))).otherwise(none) for k in range(3)
            ]
            return F.struct(
                i.cast("long").alias("slot"), F.get(F.col("l0"), i).alias("hash"), payload.alias("payload"),
                F.concat(*steps, F.col("path")).alias("path"),
            )

        rows = blocks[height].join(upper, ["g", "block"]).select("g", "block", *carried, F.inline(F.transform("payload", entry)))
        below = rows.withColumn("idx", F.col("block") * BLOCK + F.col("slot")).drop("block", "slot")
    return below


def numbered(groups: DataFrame) -> DataFrame:
    """Add ``idx`` by order of ``g``: ranges are counted, then numbered inside."""
    ranged = saved(groups.repartitionByRange("g").withColumn("part", F.spark_partition_id()))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"), F.sum("n").over(Window.partitionBy()).alias("of"))
    inside = Window.partitionBy("part").orderBy("g")
    return ranged.withColumn("i", F.row_number().over(inside)).join(offsets, "part").withColumn("idx", F.col("offset") + F.col("i") - 1)


def manifest(leaves: DataFrame, *payload: str) -> DataFrame:
    """Every leaf (``g``, ``doc_id``, ``leaf``, payload columns) with ``idx``, ``path``, ``subroot`` and ``root``.

    Payload columns must follow from the leaf's row content: rows of equal (g, doc_id, leaf, payload) are copies.
    """
    keys = ["g", "doc_id", "leaf", *payload]
    distinct = saved(leaves.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")))
    placed = coordinates(distinct)
    blocks = ascend(placed.select("g", "size", "idx", F.col("leaf").alias("hash"), F.struct("doc_id", *payload).alias("payload")))
    groups = saved(numbered(group_roots(blocks)))
    top = ascend(
        groups.select(F.lit("").alias("g"), F.col("of").alias("size"), "idx", F.col("subroot").alias("hash"), F.struct("g", "size").alias("payload"))
    )
    root = group_roots(top).select("g", "size", F.col("subroot").alias("root"), F.array().cast(f"array<{STEP}>").alias("path"))
    per_group = descend(top, root, ["root"]).select(
        "payload.g", "payload.size", F.col("hash").alias("subroot"), "root", "path"
    )
    out = descend(blocks, saved(per_group), ["subroot", "root"])
    return out.select("g", "payload.*", "idx", F.col("hash").alias("leaf"), "path", "subroot", "root")


def proof_hash(path: str = "path") -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s.left, s.right)), ""), 256)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s.left, node, s.right), 256))
