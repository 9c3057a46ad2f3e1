"""A corpus pipeline over ``documents``: each stage applies one corpus operator.

Stages are ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pktsieve.llm import stages
from pktsieve.session import scratch_path

STAGES = [
    ("language_id", stages.language_id),
    ("ngram_jaccard_join", stages.ngram_jaccard_join),
    ("suffix_array_dedup", stages.suffix_array_dedup),
    ("mix_sources", stages.mix_sources),
    ("packing", stages.packing),
]

# Tokenisation, language identification and suffix grouping have no SQL form:
# the tests hold the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, writing each stage's rows to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline/{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
