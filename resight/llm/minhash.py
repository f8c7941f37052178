"""Near-duplicate documents: MinHash signatures, banding, verification on full sets, components.

1. A document's set is its distinct word shingles as 64-bit hashes. Documents with equal sets form one
   class at once (128-bit set hash), so copies are carried as class membership, never as pairs.
2. ``HASHES`` universal hash minima per class are banded. A pair of Jaccard similarity 0.8 shares no band
   with a chance of (1 - 0.8^6)^40 = 5e-6.
3. Buckets give candidate pairs (``graph.link_buckets``): large ones by representatives in rounds, so that a
   group of n near copies costs about n pairs. Members that stay apart (similar, but below the limit) are compared
   on their full sets block by block, so no candidate between components is left out.
4. A candidate must pass the signature estimate and then the exact test on the full sets.

Cases: null or empty text has an empty set, class and component of its own; texts shorter than a shingle
are one shingle; rows with equal ``doc_id`` are one node, linked by each of their texts; rows without an id are
linked with nothing; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resight.llm.graph import components, link_buckets
from resight.llm.word_arrays import Words, mix, pieces, utf8
from resight.session import saved

SHINGLE = 5
SIMILARITY = 80  # percent
BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
_FLOOR = 0.8 - 6 * (0.8 * 0.2 / HASHES) ** 0.5  # six standard deviations below the limit
_RNG = np.random.default_rng(7)
_A = _RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_WEIGHTS = _RNG.integers(1, 1 << 63, (64,), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    w = Words(data, at, fold=True)
    n = len(w.hash)
    whole = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size):
        whole += w.hash[k : k + len(whole)] * _WEIGHTS[k]
    whole = mix(whole)
    for i in range(len(at) - 1):
        s, e = w.first[i], w.first[i + 1]
        if e - s >= size:
            yield np.unique(whole[s : e - size + 1])
        elif e > s:
            one = np.full(1, e - s, np.uint64)  # the whole sequence, kept apart from full shingles by its length
            for k in range(s, e):
                one = mix(one * _WEIGHTS[63] + w.hash[k])
            yield one
        else:
            yield np.zeros(0, np.uint64)


def signature(x: np.ndarray) -> np.ndarray:
    low = (x >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for s in range(0, len(low), 512):
        np.minimum(best, (low[s : s + 512, None] * _A + _B).min(axis=0), out=best)
    return best


def _set_hash(x: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


_SIGNED = "doc_id long, n_shingles long, set_hash binary, signature binary, bands array<long>"


def signed(docs: DataFrame, shingle: int) -> DataFrame:
    """Per row: set size, set hash, signature and band keys (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                sizes, hashes, signs, bands = [], [], [], []
                for x in shingle_sets(*utf8(part.column("text")), shingle):
                    sizes.append(len(x))
                    hashes.append(_set_hash(x) if len(x) else None)
                    if not len(x):
                        signs.append(None)
                        bands.append(None)
                        continue
                    s = signature(x)
                    key = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    for k in range(ROWS):
                        key = mix(key + s[k::ROWS].astype(np.uint64) * _WEIGHTS[k])
                    signs.append(s.tobytes())
                    bands.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(hashes, pa.binary()),
                        pa.array(signs, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_hash", "signature", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, _SIGNED)


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``set_hash`` and the whole set of every document; asked for those that take part in a candidate pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                sets = list(shingle_sets(*utf8(part.column("text")), shingle))
                hashes = [_set_hash(x) if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes, pa.binary()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))],
                    ["set_hash", "items"],
                )

    return docs.select("text").mapInArrow(run, "set_hash binary, items array<long>")


def _estimate(pairs: DataFrame) -> DataFrame:
    """Keep the pairs whose signatures agree in enough places (columns sa, sb are dropped)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                sa, sb = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(n, HASHES) for c in ("sa", "sb")
                )
                kept = (sa == sb).mean(axis=1) >= _FLOOR
                yield batch.select(["a", "b"]).filter(pa.array(kept))

    return pairs.mapInArrow(run, "a long, b long")


class _Linker:
    """Candidate pairs in, confirmed links out; sets are only built for documents of candidate pairs."""

    def __init__(self, docs: DataFrame, classes: DataFrame, members: DataFrame, shingle: int, percent: int) -> None:
        self.classes, self.percent = classes, percent
        wanted = saved(members.select("id").distinct().join(classes, "id").select("id", "set_hash", "doc"))
        rows = docs.join(wanted, docs.doc_id == wanted.doc, "left_semi")
        # rows of one id may hold several texts: the set hash tells which of them a class stands for
        found = full_sets(rows, shingle).join(wanted.select("id", "set_hash"), "set_hash")
        self.sets = saved(found.dropDuplicates(["set_hash"]).select("id", "items"))

    def confirm(self, pairs: DataFrame) -> DataFrame:
        signs = self.classes.select("id", "signature")
        pairs = (
            pairs.distinct()
            .join(signs.select(F.col("id").alias("a"), F.col("signature").alias("sa")), "a")
            .join(signs.select(F.col("id").alias("b"), F.col("signature").alias("sb")), "b")
        )
        likely = _estimate(pairs.select("a", "b", "sa", "sb"))
        left = self.sets.select(F.col("id").alias("a"), F.col("items").alias("xa"))
        right = self.sets.select(F.col("id").alias("b"), F.col("items").alias("xb"))
        both = F.size(F.array_intersect("xa", "xb"))
        union = F.size("xa") + F.size("xb") - both
        return likely.join(left, "a").join(right, "b").filter(both * 100 >= union * self.percent).select("a", "b")


    def settle(self, apart: DataFrame) -> DataFrame:
        """Links among members that share buckets but were not connected through representatives.

        Members that hang together through buckets form a cluster, cut into blocks; each pair of blocks is one group
        in which full sets are compared directly, so only links leave the task, never candidate pairs.
        """
        heads = apart.groupBy("bucket").agg(F.min("id").alias("b"))
        clusters = components(apart.join(heads, "bucket").select(F.col("id").alias("a"), "b"))
        members = apart.select("id", "c").distinct().join(clusters, F.col("id") == F.col("node")).select("id", "c", F.col("component").alias("cluster"))
        sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / F.lit(_BLOCK)).cast("int").alias("blocks"))
        placed = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        rows = placed.join(self.sets, "id").select("cluster", "id", "c", "items", "block", other.alias("other"))
        return rows.groupBy("cluster", F.least("block", "other"), F.greatest("block", "other")).applyInArrow(
            _compare(self.percent), "a long, b long"
        )


_BLOCK = 500  # members of a cluster per block


def _compare(percent: int):
    def links(table: pa.Table) -> pa.Table:
        ids, c = table.column("id").to_numpy(), table.column("c").to_numpy()
        items = table.column("items").combine_chunks()
        first = items.offsets.to_numpy() - items.offsets[0].as_py()
        values = np.unique(items.flatten().to_numpy(), return_inverse=True)[1]
        size = np.diff(first)
        names, counts = np.unique(c, return_counts=True)
        found: list[tuple[int, int]] = []
        here = np.zeros(int(values.max()) + 1, np.int64)
        for r in np.flatnonzero(c != names[counts.argmax()]):  # members of the largest component are connected
            own = values[first[r] : first[r + 1]]
            here[own] = 1
            both = np.add.reduceat(here[values], first[:-1])
            here[own] = 0
            good = (both * 100 >= (size + size[r] - both) * percent) & (c != c[r])
            found += [(min(ids[r], x), max(ids[r], x)) for x in ids[good]]
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return links


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = saved(signed(docs, shingle))
    filled = rows.filter("set_hash is not null and doc_id is not null")
    # a class has a number of its own, fixed by writing, as documents of one id may have several sets; its bands and
    # signature are equal in all members
    classes = saved(
        filled.groupBy("set_hash")
        .agg(F.min("doc_id").alias("doc"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    banded = classes.select("id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    members = saved(banded.join(shared, "bucket").select("bucket", "id"))
    linker = _Linker(docs, classes, members, shingle, percent)
    links = link_buckets(members, linker.confirm, settle=linker.settle)
    # from classes to documents: each class by its smallest one; equal ids and equal sets also connect
    names = classes.select("id", "doc")
    linked = (
        links.join(names.select(F.col("id").alias("a"), F.col("doc").alias("da")), "a")
        .join(names.select(F.col("id").alias("b"), F.col("doc").alias("db")), "b")
        .filter("da != db")
        .select(F.col("da").alias("a"), F.col("db").alias("b"))
    )
    same = filled.select("doc_id", "set_hash").distinct().join(classes.select("set_hash", "doc"), "set_hash")
    edges = linked.union(same.filter("doc_id != doc").select(F.col("doc_id").alias("a"), F.col("doc").alias("b")))
    final = components(edges)
    return rows.join(final, rows.doc_id == final.node, "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """The documents with the smallest id of each component, all columns kept.

    Rows that repeat an id are one document, of which one row stays; rows without an id all stay.
    """
    decided = near_duplicates(docs, shingle, percent).filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    kept = docs.join(decided, docs.doc_id.eqNullSafe(decided._id), "left_semi")
    first = Window.partitionBy("doc_id").orderBy("_h")
    kept = kept.withColumn("_h", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    return kept.withColumn("_i", F.row_number().over(first)).filter("_i = 1 or doc_id is null").drop("_h", "_i")
