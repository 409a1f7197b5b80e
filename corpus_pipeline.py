"""The corpus pipeline: documents in, a training mix out.

Every stage works on all rows that the one before it kept, and is written as Parquet
before the next one reads it. Stages before the last give the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm import digest_index, fm_index, mixing, simhash, toxicity
from penprint.llm.common import table
from penprint.session import new_path


def _new_column(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = "_" + name
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; the rest go."""
    score = _new_column(docs, "toxicity_score")
    scored = toxicity.scored(docs, table(spark, sf_dir, "labels"), score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return digest_index.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages."""
    hits = _new_column(docs, "benchmark_hits")
    found = fm_index.with_hits(docs, table(spark, sf_dir, "benchmark"), hits)
    return found.where(~fm_index.contaminated(F.col(hits))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All copies of documents in the mix, with their places in it."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]

# Trained scores and XXH64 fingerprints are beyond SQL; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
