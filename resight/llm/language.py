"""Language identification of whole texts, with spans for mixed ones.

Learning counts, per language, the hashed words and letter trigrams of all training texts and the scripts
they are written in. A text is labelled word by word: script ranges narrow the candidates, each word has a
score per candidate (naive Bayes over its trigrams and the word itself), and Viterbi with a switching
penalty joins words to spans of one language. The text's language is the one that holds most letters.

Cases: null text, and text without a letter, is ``und`` with score 1; words in a script no language was seen
in favour none; without any training text everything is ``und``; repeated rows get equal answers; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.llm.chains import Chains
from resight.llm.word_arrays import Words, mix, pieces, utf8

UNKNOWN = "und"
BUCKETS = 1 << 15  # per language; bounds the model whatever the corpus
SWITCH = 12.0  # log-likelihood a change of language costs
_TEMPER = 0.5  # trigrams overlap: their log-likelihoods count in part
_PIECE = 1 << 23

# First code point of each range and the script of its letters (0: no letters of a listed script).
SCRIPT_RANGES = (
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0), (0x00BA, 1), (0x00BB, 0),
    (0x00C0, 1), (0x00D7, 0), (0x00D8, 1), (0x00F7, 0), (0x00F8, 1), (0x02B0, 0), (0x0370, 2), (0x0400, 3),
    (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0A80, 10),
    (0x0B00, 11), (0x0B80, 12), (0x0C00, 13), (0x0C80, 14), (0x0D00, 15), (0x0D80, 16), (0x0E00, 17), (0x0E80, 18),
    (0x0F00, 19), (0x1000, 20), (0x10A0, 21), (0x1100, 22), (0x1200, 23), (0x1380, 0), (0x1780, 24), (0x1800, 0),
    (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 25), (0x3100, 0), (0x3400, 26), (0x4DC0, 0), (0x4E00, 26),
    (0xA000, 0), (0xAC00, 22), (0xD7B0, 0), (0xF900, 26), (0xFB00, 0), (0x20000, 26), (0x32000, 0),
)
_FROM = np.array([a for a, _ in SCRIPT_RANGES])
_SCRIPT = np.array([b for _, b in SCRIPT_RANGES])
SCRIPTS = 27


class _Distinct:
    """The different words of some texts with their hashed features."""

    def __init__(self, words: Words) -> None:
        _, at, self.word = np.unique(words.hash, return_index=True, return_inverse=True)
        self.n = len(at)
        raw = b" ".join(bytes(words.data[words.start[i] : words.end[i]]) for i in at)
        text = " " + raw.decode("utf-8", "replace").lower() + " "
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        gap = code == 0x20
        owner = np.cumsum(gap) - 1
        script = _SCRIPT[np.searchsorted(_FROM, code, "right") - 1]
        counts = np.bincount(owner[~gap] * SCRIPTS + script[~gap], minlength=self.n * SCRIPTS).reshape(self.n, SCRIPTS)
        self.letters = counts[:, 1:].sum(axis=1)
        self.script = np.where(self.letters > 0, counts[:, 1:].argmax(axis=1) + 1, 0)
        use = ~gap[1:-1] & (self.letters[owner[1:-1]] > 0)
        tri = (code[:-2] * 0x110000 + code[1:-1]) * 0x110000 + code[2:]
        self.gram = (mix(tri[use].astype(np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        self.owner = owner[1:-1][use]
        self.whole = (words.hash[at] >> np.uint64(20) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    gram: np.ndarray  # buckets x langs, log-probabilities
    whole: np.ndarray
    script: np.ndarray  # scripts x langs, bool
    common: int  # the language of most training letters

    def word_scores(self, d: _Distinct) -> np.ndarray:
        scores = np.stack(
            [np.bincount(d.owner, self.gram[d.gram, k], d.n) for k in range(len(self.langs))], axis=1
        )
        scores = _TEMPER * (scores + self.whole[d.whole])
        allowed = self.script[d.script]
        some = allowed.any(axis=1) & (d.letters > 0)
        scores -= scores.max(axis=1, keepdims=True)
        scores = np.maximum(scores, -30.0)
        return np.where(some[:, None], np.where(allowed, scores, -60.0), 0.0)


def train(docs: DataFrame, lang: str = "lang") -> Model | None:
    """Count over all given rows with a language; only the per-language tables reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("text"), _PIECE):
                part = batch.slice(lo, hi - lo)
                words = Words(*utf8(part.column("text")), fold=True)
                if not len(words.start):
                    continue
                names = part.column("lang").dictionary_encode()
                of_row = names.indices.to_numpy()
                d = _Distinct(words)
                for k, name in enumerate(names.dictionary.to_pylist()):
                    n = np.bincount(d.word[of_row[words.row] == k], minlength=d.n)
                    n[d.letters == 0] = 0
                    kinds = (
                        np.bincount(d.gram, n[d.owner], BUCKETS),
                        np.bincount(d.whole, n, BUCKETS),
                        np.bincount(d.script, n * d.letters, BUCKETS),
                    )
                    for kind, counts in enumerate(kinds):
                        at = np.flatnonzero(counts)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([name] * len(at), pa.string()),
                                pa.array(np.full(len(at), kind), pa.int32()),
                                pa.array(at, pa.int32()),
                                pa.array(counts[at].astype(np.int64)),
                            ],
                            ["lang", "kind", "bucket", "n"],
                        )

    rows = docs.filter(F.col(lang).isNotNull() & F.col("text").isNotNull()).select("text", F.col(lang).alias("lang"))
    counted = rows.mapInArrow(run, "lang string, kind int, bucket int, n long")
    # at most (2 x BUCKETS + scripts) rows per language
    table = counted.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(table):
        return None
    langs = sorted(table["lang"].unique())
    column = {name: k for k, name in enumerate(langs)}
    counts = np.zeros((3, BUCKETS, len(langs)))
    counts[table["kind"], table["bucket"], table["lang"].map(column)] = table["n"]

    def logs(x: np.ndarray) -> np.ndarray:
        return np.log((x + 0.5) / (x.sum(axis=0) + 0.5 * BUCKETS))

    letters = counts[2, :SCRIPTS]
    return Model(langs, logs(counts[0]), logs(counts[1]), letters > 0.005 * letters.sum(axis=0), int(letters.sum(axis=0).argmax()))


def viterbi(first: np.ndarray, scores: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word: label scores per word, ``switch`` off for every change of label."""
    chains = Chains(first)
    back = np.zeros(scores.shape, np.int32)
    label = np.zeros(len(scores), np.int32)
    state = np.zeros((len(chains.starts), scores.shape[1]))
    for t, at in enumerate(chains.forward()):
        now = state[: len(at)]
        if t:
            best = now.argmax(axis=1)
            moved = now[np.arange(len(at)), best] - switch
            change = moved[:, None] > now
            back[at] = np.where(change, best[:, None], np.arange(scores.shape[1]))
            np.maximum(now, moved[:, None], out=now)
        now += scores[at]
    last = state.argmax(axis=1)
    for at in chains.backward():
        k = len(at)
        label[at] = last[:k]
        last[:k] = back[at, last[:k]]
    return label


def identify(docs: DataFrame, model: Model | None, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per row: keys, lang_pred, score (its share of the letters) and spans (word ranges of one language)."""
    schema = docs.select(*keys).schema.add("lang_pred", "string").add("score", "double").add("spans", "string")
    names = [*keys, "lang_pred", "score", "spans"]

    def answers(part: pa.RecordBatch) -> list[tuple[str, float, str]]:
        words = Words(*utf8(part.column("text")), fold=True)
        out = []
        if model and len(words.start):
            d = _Distinct(words)
            label = viterbi(words.first, model.word_scores(d)[d.word], SWITCH)
            letters = d.letters[d.word]
            n, k = part.num_rows, len(model.langs)
            held = np.bincount(words.row * k + label, letters, n * k).reshape(n, k)
        texts = None
        for i in range(part.num_rows):
            if not model or not len(words.start) or held[i].sum() == 0:
                texts = texts or part.column("text").to_pylist()
                other = any(c.isalpha() for c in texts[i] or "")  # letters outside the listed ranges
                out.append((model.langs[model.common], 0.0, "") if model and other else (UNKNOWN, 1.0, ""))
                continue
            best = int(held[i].argmax())
            own = label[words.first[i] : words.first[i + 1]]
            cut = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]])
            spans = " ".join(f"{a}-{b}:{model.langs[own[a]]}" for a, b in zip(cut[:-1], cut[1:], strict=True))
            out.append((model.langs[best], float(held[i, best] / held[i].sum()), spans))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("_text"), _PIECE):
                part = batch.slice(lo, hi - lo)
                found = answers(part.rename_columns([*keys, "text"]))
                columns = [part.column(c) for c in keys]
                columns += [pa.array([a[k] for a in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*keys, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)
