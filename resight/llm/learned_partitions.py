"""Approximate nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is built and cut into balanced parts of few crossing edges; a small network
learns which parts hold a vector's neighbours. It puts every row into its most probable part (the index) and sends
a query to its most probable parts, as many as reach the probability ``MASS``, where distances are exact. Well
separated data needs few of them; vectors spread evenly over a sphere need most. Parts are cut into blocks of bounded rows
and queries, so a part that holds a third of all rows is no single task; queries that find too few rows there are
searched in all parts.

Cases: vectors that are null, zero, of another than the prevailing length, or that hold null or non-finite
components take no part; components of any finite size do; ties go to the smaller id; rows with equal ids are never each other's neighbours; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resight.session import saved

SAMPLE = 6000  # rows the index is fitted on
PARTS = 16
MASS = 0.98  # a query visits its most probable parts until their probabilities reach this sum
NEIGHBOURS = 16
HIDDEN = 96
BLOCK_ROWS = 20_000
BLOCK_QUERIES = 4_000
K = 10
_LARGE, _SMALL = 1e150, 1e-290  # a component whose square may overflow, a square that lost digits
_CLIP = 1e100  # the network sees no larger components


def usable(vectors: DataFrame, id_: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id``, ``x`` (doubles) of the rows that take part."""
    x = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(id_).cast("long").alias("vec_id"), x.alias("x")).filter("vec_id is not null and size(x) > 0")
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.filter(~bad).filter(F.exists("x", lambda v: v != 0))
    lengths = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    return rows.join(F.broadcast(lengths.select("n")), F.size("x") == F.col("n"), "left_semi")  # one row


def _graph(x: np.ndarray, k: int) -> np.ndarray:
    """Ids of the k nearest of every row, in blocks."""
    square = (x * x).sum(axis=1)
    out = np.empty((len(x), k), np.int64)
    for s in range(0, len(x), 512):
        d = square[None] - 2 * x[s : s + 512] @ x.T
        d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
        out[s : s + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Part of every node: halves along the widest direction, then moves that cut fewer edges within capacity."""
    part = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        largest = max(range(len(groups)), key=lambda g: len(groups[g]))
        at = groups.pop(largest)
        centred = x[at] - x[at].mean(axis=0)
        axis = np.ones(x.shape[1])
        for _ in range(8):  # power iteration
            axis = centred.T @ (centred @ axis)
            axis /= np.linalg.norm(axis) or 1
        order = at[np.argsort(centred @ axis, kind="stable")]
        groups += [order[: len(order) // 2], order[len(order) // 2 :]]
    for g, at in enumerate(groups):
        part[at] = g
    capacity = int(np.ceil(len(x) / parts * slack))
    source = np.repeat(np.arange(len(x)), near.shape[1])
    both = np.concatenate([source, near.ravel()]), np.concatenate([near.ravel(), source])
    for _ in range(rounds):
        votes = np.bincount(both[0] * parts + part[both[1]], minlength=len(x) * parts).reshape(-1, parts)
        wish = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), wish] - votes[np.arange(len(x)), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[wish[i]] < capacity:
                size[part[i]] -= 1
                size[wish[i]] += 1
                part[i] = wish[i]
                moved += 1
        if not moved:
            break
    return part


def _probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    h = np.maximum(np.clip(x, -_CLIP, _CLIP) @ model["w1"] + model["b1"], 0) @ model["w2"] + model["b2"]
    h = np.exp(h - h.max(axis=1, keepdims=True))
    return h / h.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, parts: int, epochs: int = 30, batch: int = 256) -> dict:
    """A network of one hidden layer; its targets are the parts of a vector and its neighbours."""
    rng = np.random.default_rng(3)
    x = np.clip(x, -_CLIP, _CLIP)
    scale = float(np.sqrt((x * x).sum(axis=1).mean())) or 1.0
    x = x / scale
    near = _graph(x, min(NEIGHBOURS, len(x) - 1))
    part = balanced_parts(x, near, parts)
    target = np.zeros((len(x), parts))
    for k in range(near.shape[1]):
        target[np.arange(len(x)), part[near[:, k]]] += 1
    target[np.arange(len(x)), part] += near.shape[1] / 2
    target /= target.sum(axis=1, keepdims=True)
    d = x.shape[1]
    p = {
        "w1": rng.normal(0, (2 / d) ** 0.5 * d**0.5, (d, HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)),
        "b2": np.zeros(parts),
    }
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for s in range(0, len(x), batch):
            at = order[s : s + batch]
            h = np.maximum(x[at] @ p["w1"] + p["b1"], 0)
            out = h @ p["w2"] + p["b2"]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            e = (out / out.sum(axis=1, keepdims=True) - target[at]) / len(at)
            back = (e @ p["w2"].T) * (h > 0)
            grads = {"w2": h.T @ e, "b2": e.sum(axis=0), "w1": x[at].T @ back, "b1": back.sum(axis=0)}
            step += 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= 3e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    p["w1"] = p["w1"] / scale
    return p


def train(rows: DataFrame, n: int, parts: int = PARTS, sample: int = SAMPLE) -> dict | None:
    """Fit in one task on at most ``sample`` rows, those of smallest hash."""
    parts = max(1, min(parts, n // 64))

    def fitted(table: pa.Table) -> pa.Table:
        x = np.array(table.column("x").to_pylist())
        p = fit(x, parts)
        return pa.table({k: [a.ravel().tolist()] for k, a in p.items()})

    if parts == 1:
        return None
    chosen = rows.orderBy(F.xxhash64("vec_id", "x")).limit(sample)
    row = chosen.groupBy(F.lit(1).alias("g")).applyInArrow(fitted, "w1 array<double>, b1 array<double>, w2 array<double>, b2 array<double>").first()
    return {"w1": np.array(row.w1).reshape(-1, HIDDEN), "b1": np.array(row.b1), "w2": np.array(row.w2).reshape(HIDDEN, parts), "b2": np.array(row.b2)}


def _route(rows: DataFrame, model: dict | None, parts: int, mass: float) -> DataFrame:
    """Every row with its most probable parts, one row each: at least one, as many as reach ``mass``."""
    if model is None:
        return rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            p = _probabilities(model, flat)
            order = np.argsort(-p, axis=1, kind="stable")
            sums = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
            visits = np.minimum((sums < mass).sum(axis=1) + 1, parts)
            at = np.repeat(np.arange(batch.num_rows), visits)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(visits) - visits, visits)
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(order[at, nth].astype(np.int32))], ["vec_id", "x", "part"])

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, x array<double>, part int")


_FOUND = "query_id long, vec_id long, score double"


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances; differences whose squares overflow or vanish are scaled first."""
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        apart = np.abs(x - q)
        squares = (apart**2).sum(axis=1)
        out = np.sqrt(squares)
        most = apart.max(axis=1)
        odd = ((squares == np.inf) | (squares < _SMALL)) & (most > 0) & (most < np.inf)
        if odd.any():
            out[odd] = most[odd] * np.sqrt(((apart[odd] / most[odd, None]) ** 2).sum(axis=1))
    return out


def _nearest(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of every query within one block, exact and with ties to the smaller id."""
    out_q, out_v, out_d = [], [], []
    if len(queries) and len(rows):
        q, x = np.stack(queries["x"].to_numpy()), np.stack(rows["x"].to_numpy())
        qid, vid = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
        scale = max(np.abs(q).max(), np.abs(x).max())
        scale = scale if scale > _LARGE else 1.0  # squares of larger components could overflow
        near = x / scale
        square, most = (near * near).sum(axis=1), min(k + 1, len(x))
        for s in range(0, len(q), 256):
            part = q[s : s + 256] / scale
            d = (part * part).sum(axis=1)[:, None] + square[None] - 2 * part @ near.T
            own = qid[s : s + 256, None] == vid[None]
            d[own] = np.inf
            limit = np.partition(d, most - 1, axis=1)[:, most - 1]
            # all rows that rounding could put among the k nearest, then the exact measure
            margin = 1e-9 * (1 + square.max() + (part * part).sum(axis=1))
            for i in range(len(part)):
                at = np.flatnonzero((d[i] <= limit[i] + margin[i]) & ~own[i])
                exact = _distances(x[at], q[s + i])
                best = np.lexsort((vid[at], exact))[:k]
                out_q.append(np.full(len(best), qid[s + i]))
                out_v.append(vid[at[best]])
                out_d.append(exact[best])
    if not out_q:
        return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_d)})


def _search(index: DataFrame, routed: DataFrame, row_blocks: int, query_blocks: int, k: int) -> DataFrame:
    """Both sides are dealt over (row block x query block) of their part."""
    rb = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(row_blocks)).cast("int")
    qb = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(query_blocks)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = index.withColumn("rb", rb).withColumn("qb", every(query_blocks))
    queries = routed.withColumn("qb", qb).withColumn("rb", every(row_blocks))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _nearest(left, right, k)

    keys = ["part", "rb", "qb"]
    found = queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(run, _FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = K, parts: int = PARTS, mass: float = MASS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score for every row that satisfies ``is_query`` (a condition on vec_id)."""
    rows = saved(usable(vectors))
    n = rows.count()
    model = train(rows, n, parts, sample)
    parts = len(model["b2"]) if model else 1
    index = saved(_route(rows, model, parts, 0.0))
    queries = saved(rows.filter(is_query))
    n_queries = queries.count()
    largest = index.groupBy("part").count().agg(F.max("count")).first()[0] or 1
    row_blocks = -(-largest // BLOCK_ROWS)
    query_blocks = max(1, -(-n_queries // BLOCK_QUERIES))
    found = saved(_search(index, _route(queries, model, parts, mass), row_blocks, query_blocks, k))
    # an exact way for queries whose parts hold fewer than k rows
    enough = found.groupBy("query_id").count().filter(F.col("count") >= k)
    short = saved(queries.join(enough, queries.vec_id == enough.query_id, "left_anti"))
    if not short.isEmpty():
        again = _search(index, _route(short, None, parts, 1.0), row_blocks, query_blocks, k)
        found = found.join(enough, "query_id", "left_semi").unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
