"""The corpus pipeline: quality rules, near duplicates, repeated passages, mixing, packing.

Every stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again as the next
one's ``docs``; all but the last return the columns of ``documents``. Stages hold no state of their own: a lost
run starts again at the last stage that was written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import mixing, near_dedup, packing, quality, substring
from skyloom.llm.queries import table, tokenizer_path
from skyloom.session import scratch_root, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    ship_package(spark)
    return near_dedup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has too are cut out of the texts."""
    ship_package(spark)
    return substring.cut_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's rate says."""
    return mixing.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, placed in a training sequence."""
    ship_package(spark)
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
    ("source_mix", source_mix), ("packed_sequences", packed_sequences),
]

#: the last stage needs a tokenizer and the thresholds exact binomial tests, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    folder = f"{scratch_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
