"""From raw documents to a training mix: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from episodica.llm import stages
from episodica.sources.shared import store

STAGES = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("secrets", stages.secrets),
    ("mixture", stages.mixture),
]

# The language model of the first stage and the candidate strings of the fourth are fitted; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
