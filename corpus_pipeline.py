"""The corpus pipeline: five stages, each one operator of ``lakewash.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes it as Parquet under the shared checkpoint folder and reads it back as
the next stage's documents. All but the last return the columns of
``documents``; the last adds the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.llm import decontamination, mixing, quality_rules, secret_scan, simhash
from lakewash.llm.common import staged, table


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    return secret_scan.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and
    taken (words, repeats counted)."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("SimHash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("mixing sources to target weights", mixing_stage),
]

# SQL cannot express the fingerprints (XXH64 of shingles) or the seeded picks;
# tests/llm holds every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
