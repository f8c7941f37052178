"""Quality rules as a bitmask ledger (built-in functions only).

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed
rule. A policy is a version name and a mask over those bits, so accepting a document under any policy,
old or new, is one bitwise test, and an ablation (what would each rule's removal give back?) is an
aggregation over the few distinct masks instead of a new pass over the texts.

Cases: null text measures as empty. Texts below three words have no window. Rows are judged one by one,
so repeated rows get equal verdicts; other columns are ignored by the rules and never clash, because the
ledger carries only the key columns asked for. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resight.llm.tables import NOT_SPACE, SPACES, let, text_of, words_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition over the measurement columns; ``bit`` never changes its meaning."""

    bit: int
    name: str
    fails: Callable[[], Column]


def _share(part: str, whole: str, percent: int) -> Column:
    return F.col(part) * 100 > F.col(whole) * percent


RULES = (
    Rule(0, "too_few_words", lambda: F.col("n_words") < 50),
    Rule(1, "repeated_windows", lambda: _share("n_repeat_words", "n_words", 50)),
    Rule(2, "symbols", lambda: _share("n_symbols", "n_words", 10)),
    Rule(3, "repeated_lines", lambda: _share("n_dup_lines", "n_lines", 50)),
    Rule(4, "short_words", lambda: F.col("word_chars") < F.col("n_words") * 3),
    Rule(5, "long_words", lambda: F.col("word_chars") > F.col("n_words") * 12),
    Rule(6, "capitals", lambda: _share("n_capitals", "word_chars", 30)),
    Rule(7, "exclamations", lambda: _share("n_exclaim", "n_words", 50)),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        known = {r.name: r.bit for r in RULES}
        return sum(1 << known[n] for n in set(self.rules))


BASE = Policy("base", ("too_few_words", "repeated_windows"))
STANDARD = Policy("standard-1", tuple(r.name for r in RULES))


def _count(text: Column, unwanted: str) -> Column:
    """Characters left when everything that matches ``unwanted`` is removed."""
    return F.length(F.regexp_replace(text, unwanted, "")).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the document.

    Windows become 64-bit hashes. Only where some hash occurs twice are they sorted with their
    positions; equal neighbours give the repeated windows, and their positions in order the words.
    """

    def sorted_pairs(hashes: Column) -> Column:
        return F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def repeated_positions(pairs: Column) -> Column:
        def kept(x: Column, i: Column) -> Column:
            before = F.get(pairs, i - F.lit(1))["h"] == x["h"]
            after = F.get(pairs, i + F.lit(1))["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.array_sort(F.transform(F.filter(pairs, kept), lambda x: x["p"]))

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(
            positions,
            start,
            lambda acc, p: F.struct(
                p.alias("last"), (acc["total"] + F.least(F.lit(3), p - acc["last"])).alias("total")
            ),
            lambda acc: acc["total"],
        )

    def of(hashes: Column) -> Column:
        all_differ = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(all_differ, F.lit(0).cast("long")).otherwise(
            covered(let(sorted_pairs(hashes), repeated_positions))
        )

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - F.lit(3)),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + F.lit(1)), F.get(w, i + F.lit(2))),
        )

    some = let(words, lambda w: let(windows(w), of))
    return F.when(F.size(words) >= 3, some).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """``keys`` and the measurements of the whole text."""
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda line: line.rlike(NOT_SPACE))
    return (
        docs.select(*keys, text_of(text).alias("_text"))
        .select("*", words_of(F.col("_text")).alias("_words"), lines.alias("_lines"))
        .select(
            *keys,
            F.size("_words").cast("long").alias("n_words"),
            _count(F.col("_text"), SPACES).alias("word_chars"),
            _count(F.col("_text"), f"[^{SYMBOLS}]+").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            _repeat_words(F.col("_words")).alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("n_lines"),
            _count(F.col("_text"), "[^A-Z]+").alias("n_capitals"),
            _count(F.col("_text"), "[^!]+").alias("n_exclaim"),
        )
    )


def ledger(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document: keys, measurements and ``fail_bits``."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, keys, text).withColumn("fail_bits", bits)


def passes(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, and documents that only it rejects.

    Documents are first counted per distinct mask (at most 2^rules of them), then masks per rule.
    """
    masks = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("m")).agg(
        F.count(F.lit(1)).alias("n")
    )
    named = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("b")) for r in RULES if r.name in policy.rules]
    )
    hit = F.col("m").bitwiseAND(F.col("x.b")) != 0
    return (
        masks.select("m", "n", F.explode(named).alias("x"))
        .groupBy(F.col("x.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("m") == F.col("x.b"), F.col("n")).otherwise(0)).alias("n_only_this"),
        )
        .withColumn("version", F.lit(policy.version))
    )


def keep_passing(docs: DataFrame, policy: Policy = STANDARD, text: str = "text") -> DataFrame:
    """The documents that pass the policy, with all their columns and no other.

    Measurements are computed in the same scan and dropped again; no join back.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`"))
    kept = ledger(whole, keys=("_row",), text=text).filter(passes(policy))
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
