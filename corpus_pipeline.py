"""A corpus clean-up in five stages over the table of documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tastegrid.llm import stages
from tastegrid.session import stored

STAGES = [
    ("language_id", stages.language_id),
    ("ngram_join", stages.ngram_join),
    ("substring_dedup", stages.substring_dedup),
    ("decontamination", stages.decontamination),
    ("byte_bpe", stages.byte_bpe),
]

#: A trained classifier and the tokenizer have no SQL; run() is tested on planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return reduce(
        lambda kept, stage: stored(stage[1](spark, kept, sf_dir), stage[0]), STAGES, docs
    )
