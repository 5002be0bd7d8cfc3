"""The corpus pipeline: documents through five operators, one stage after the other.

Each stage reads all rows its predecessor kept and returns the columns of ``documents``; the
last one returns token ids. Every stage is written as Parquet and read again, so that a lost
executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusprep.llm import stages
from corpusprep.llm.common import scratch

STAGES = [
    ("language_id", stages.language_id),
    ("simhash_dedup", stages.drop_near_copies),
    ("secret_scan", stages.redact_secrets),
    ("mixing", stages.mix_sources),
    ("bpe", stages.encode_bpe),
]

#: No SQL: the stages fit models and merge tokens. tests/llm/test_pipeline.py compares the
#: stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; a table without rows passes through all of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
