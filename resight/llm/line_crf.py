"""Document quality from a linear-chain conditional random field over lines.

Every line with a word has shape measurements (capitals, digits, symbols, word lengths, repetition ...), its own
and its neighbours'. The field labels lines good or bad; training lines take the label of their document.
A document's quality is the mean of its lines' forward-backward marginals, weighted by length.

Training uses at most ``LABELLED`` labelled rows and of them ``CHAINS`` stretches of at most ``STRETCH`` lines (those of
smallest hash), bounds that do not grow with the corpus; it runs in one task on that sample. The labels go to the
texts, so no text is shuffled. Scoring reads every whole text.

Cases: null text and text without a word get the share of good training stretches; without training rows
every score is 0.5; repeated rows score alike; other columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.llm.chains import Chains
from resight.llm.word_arrays import Words, pieces, utf8

LABELLED = 10_000
CHAINS = 3000
STRETCH = 128
_STEPS = 150
_KINDS = np.zeros(256, np.int64)  # byte kinds: other, capital, small, digit, space, symbol, exclamation, punctuation
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b"#*$%&|<>=~^_{}[]@\\", b"!", b".,;:?'\"()-"), 1):
    _KINDS[list(_chars)] = _k
_KINDS[0x80:] = 2
FEATURES = 17


class Lines:
    """Lines with a word: ``row``, ``bytes``, the features ``x`` and the n + 1 offsets ``first`` of the rows."""

    def __init__(self, column: pa.Array) -> None:
        data, at = utf8(column)
        breaks = np.flatnonzero(data == 0x0A)
        edges = np.unique(np.concatenate([at, breaks, breaks + 1]))
        begin, end = edges[:-1], edges[1:]
        real = data[begin] != 0x0A if len(begin) else np.zeros(0, bool)
        begin, end = begin[real], end[real]
        words = Words(data, at, fold=True)
        lo, hi = np.searchsorted(words.start, begin), np.searchsorted(words.start, end)
        some = hi > lo
        begin, end, lo, hi = begin[some], end[some], lo[some], hi[some]
        self.row = np.searchsorted(at, begin, "right") - 1
        self.first = np.searchsorted(self.row, np.arange(len(at)))
        self.bytes = (end - begin).astype(float)
        n = np.maximum(hi - lo, 1).astype(float)
        kinds = np.stack([self._between(_KINDS[data] == k, begin, end) for k in range(8)], axis=1)
        size = (words.end - words.start).astype(float)
        sums = np.concatenate([[0], np.cumsum(size)])
        letters = (sums[hi] - sums[lo]).astype(float)
        line = np.repeat(np.arange(len(begin)), hi - lo)
        order = np.lexsort((words.hash[: hi[-1]] if len(hi) else words.hash, line)) if len(line) == len(words.hash) else None
        distinct, most = self._variety(line, words.hash, lo, hi, order)
        same = np.zeros(len(words.hash) + 1)
        same[1:-1] = np.cumsum(words.hash[1:] == words.hash[:-1]) if len(words.hash) > 1 else same[1:-1]
        again = np.maximum(same[np.maximum(hi - 1, lo)] - same[lo], 0) if len(lo) else np.zeros(0)
        share = kinds / np.maximum(self.bytes, 1)[:, None]
        self.x = np.column_stack(
            [
                share[:, [1, 3, 5, 6, 7]] * 4,
                kinds[:, 5] / n,
                kinds[:, 6] / n,
                np.minimum(letters / n / 8, 4),
                distinct / n,
                most / n,
                again / n,
                np.minimum(np.log1p(n) / 4, 3),
                n < 4,
                n > 60,
                kinds[:, 1] > kinds[:, 2],
                kinds[:, 5] > n,
                np.ones(len(n)),
            ]
        ).astype(float)

    @staticmethod
    def _between(flags: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return (sums[end] - sums[begin]).astype(float)

    @staticmethod
    def _variety(line, hashes, lo, hi, order) -> tuple[np.ndarray, np.ndarray]:
        """Different words per line, and how often the most frequent one occurs."""
        n = len(lo)
        if order is None or not len(order):
            return np.ones(n), np.ones(n)
        l, h = line[order], hashes[order]
        new = np.ones(len(l), bool)
        new[1:] = (l[1:] != l[:-1]) | (h[1:] != h[:-1])
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(l)))
        most = np.zeros(n)
        np.maximum.at(most, l[at], counts)
        return np.bincount(l[at], minlength=n).astype(float), most

    def with_neighbours(self) -> np.ndarray:
        n, k = self.x.shape
        out = np.zeros((n, 3 * k))
        out[:, :k] = self.x
        if n > 1:
            same = (self.row[1:] == self.row[:-1])[:, None]
            out[1:, k : 2 * k] = self.x[:-1] * same
            out[:-1, 2 * k :] = self.x[1:] * same
        return out


def marginals(first: np.ndarray, score: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """P(good) per line by forward-backward; with ``pairs`` also the expected transition counts.

    ``score``: log-odds of good per line; ``trans``: 2 x 2 log-weights of (label, next label).
    """
    chains = Chains(first)
    alpha, beta = np.zeros((len(score), 2)), np.zeros((len(score), 2))
    state = np.zeros((len(chains.starts), 2))
    for t, at in enumerate(chains.forward()):
        now = state[: len(at)]
        if t:
            now = np.logaddexp(now[:, :1] + trans[0], now[:, 1:] + trans[1])
        now = now + np.stack([np.zeros(len(at)), score[at]], axis=1)
        state[: len(at)] = now
        alpha[at] = now
    state[:] = 0
    done = 0
    expected = np.zeros((2, 2))
    for at in chains.backward():
        k = len(at)
        beta[at[:done]] = state[:done]
        beta[at[done:k]] = 0
        if pairs and done:
            nxt = at[:done] + 1
            out = beta[nxt] + np.stack([np.zeros(done), score[nxt]], axis=1)
            joint = alpha[at[:done], :, None] + trans + out[:, None, :]
            joint -= np.logaddexp(*(alpha[at[:done]] + beta[at[:done]]).T)[:, None, None]
            expected += np.exp(joint).sum(axis=0)
        here = beta[at] + np.stack([np.zeros(k), score[at]], axis=1)
        state[:k] = np.logaddexp(here[:, None, 0] + trans[:, 0], here[:, None, 1] + trans[:, 1])
        done = k
    both = alpha + beta
    p = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    return (p, expected) if pairs else p


def fit(first: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions of largest penalised likelihood, by Adam on the whole sample."""
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.ones(len(y), bool)
    inner[first[1:][np.diff(first) > 0] - 1] = False  # lines with a next line in the chain
    at = np.flatnonzero(inner)
    seen = np.bincount(y[at] * 2 + y[at + 1], minlength=4).astype(float)
    chains = max(len(first) - 1, 1)
    for step in range(1, _STEPS + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        p, expected = marginals(first, np.einsum("ij,j->i", x, w), trans, pairs=True)
        grad = np.concatenate([np.einsum("ij,i->j", x, y - p), seen - expected.ravel()]) / chains - 1e-3 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def sample_labels(labels: DataFrame, label: str = "quality", n: int = LABELLED) -> DataFrame:
    """(doc_id, label) of at most ``n`` labelled rows: those of smallest hash."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", label)
    return known.orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(n)


def train(docs: DataFrame, label: str = "quality", chains: int = CHAINS) -> dict | None:
    """Fit on a bounded sample of the labelled rows: ``weights``, ``trans`` and the share of good stretches."""

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                lines = Lines(part.column("text"))
                x = lines.with_neighbours()
                out = [
                    (int(y), x[s : min(s + STRETCH, b)].astype(np.float32).tobytes())
                    for y, a, b in zip(part.column("label").to_pylist(), lines.first[:-1], lines.first[1:], strict=True)
                    for s in range(a, b, STRETCH)
                ]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], ["label", "x"])

    def fitted(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, np.float32).reshape(-1, 3 * FEATURES) for b in table.column("x").to_pylist()]
        first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        y = np.repeat(table.column("label").to_numpy(), np.diff(first)).astype(np.int64)
        w, trans = fit(first, np.concatenate(parts).astype(float), y)
        good = float(table.column("label").to_numpy().mean())
        return pa.table({"weights": [w.tolist()], "trans": [trans.ravel().tolist()], "good": [good]})

    rows = docs.filter(F.col(label).isNotNull() & F.col("text").isNotNull()).select("text", F.col(label).cast("int").alias("label"))
    cut = rows.mapInArrow(stretches, "label int, x binary")
    sample = cut.orderBy(F.xxhash64("label", "x")).limit(chains)
    model = sample.groupBy(F.lit(1).alias("g")).applyInArrow(fitted, "weights array<double>, trans array<double>, good double").first()
    return model.asDict() if model else None


def score(docs: DataFrame, model: dict | None, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per row: keys, ``score`` and ``n_lines`` (lines with a word)."""
    schema = docs.select(*keys).schema.add("score", "double").add("n_lines", "long")
    w = np.array(model["weights"]) if model else None
    trans = np.array(model["trans"]).reshape(2, 2) if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("_text")):
                part = batch.slice(lo, hi - lo)
                lines = Lines(part.column("_text"))
                n = part.num_rows
                total = np.bincount(lines.row, lines.bytes, n)
                if model:
                    p = marginals(lines.first, np.einsum("ij,j->i", lines.with_neighbours(), w), trans)
                    mean = np.bincount(lines.row, lines.bytes * p, n) / np.maximum(total, 1)
                    value = np.where(total > 0, mean, model["good"])
                else:
                    value = np.full(n, 0.5)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keys], pa.array(np.clip(value, 0, 1)), pa.array(np.diff(lines.first).astype(np.int64))],
                    [*keys, "score", "n_lines"],
                )

    return docs.select(*keys, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)
