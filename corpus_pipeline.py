"""Documents to training mixture: quality, near-duplicates, benchmark leaks, secrets, mixture.

Every stage reads the table that the one before wrote.  All but the last return
the columns of `documents`.  Rows without text, doc_id, lang or source, repeated rows and empty
tables are handled as the stages' functions in `lexmill.llm.stages` say; further columns go.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import stages
from lexmill.llm.common import delete, read_table, shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents beyond a fence of their language and source go.  Odd rows: see the function it calls."""
    return stages.without_low_quality(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.  Odd rows: see the function it calls."""
    return stages.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.  Odd rows: see the function it calls."""
    return stages.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays.  Odd rows: see the function it calls."""
    return stages.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its place in the mixture.  Odd rows: see the function it calls."""
    return stages.in_target_mixture(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_dedup", minhash_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
]

#: Sketched thresholds, similarity search and the slot schedule have no SQL form;
#: tests/llm/test_pipeline.py holds the rows against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again; only the last one's table stays."""
    where = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{where}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            delete(spark, before)
        before = path
    return docs
