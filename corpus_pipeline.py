"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadloom.llm import stages
from leadloom.sources.scratch import new_folder

STAGES = [
    ("toxicity", stages.without_toxic),
    ("exact_dedup", stages.without_copies),
    ("near_duplicates", stages.without_near_copies),
    ("decontamination", stages.without_benchmark),
    ("packing", stages.packed),
]

# a trained machine and connected components have no SQL form; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: pieces of the documents that stay, each with its place in a sequence."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
