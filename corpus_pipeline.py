"""A cleaned, deduplicated, mixed and packed corpus from the ``documents`` table.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the docs of
the next one. All stages but the last return the columns of ``documents``. No SQL expresses the packing, so
the pipeline is tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resight.llm import fuzzy_lines, minhash, mixing, packing, quality_rules
from resight.session import saved

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the standard rule policy."""
    return _documents(quality_rules.keep_passing(docs, quality_rules.STANDARD))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each fuzzy line once in the corpus; ``n_chars`` counts the new text."""
    return _documents(fuzzy_lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return _documents(minhash.keep_one(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the source weights ask for."""
    return _documents(mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces placed in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs)
    return docs
