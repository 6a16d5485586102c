"""The operators as stages over whole documents: each keeps, drops or packs rows.

Stages take ``doc_id`` and ``text`` and pass on all columns as they are, whatever
their names. Null texts count as empty, rows that repeat an id or a whole row are
rows of their own, texts of any length are read whole, and no rows give no rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import decontamination, exact_dedup, jaccard_join, packing, toxicity
from leadloom.llm.common import read
from leadloom.sources.scratch import written

# rows of one file at most
_FILE_ROWS = 1 << 40


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number that no other row has, and the name of its column, which ``docs`` does not use.

    The number is the row's place in its Parquet file, so a task that runs again
    finds the same one; what is not read from such files is written first.
    """
    name = "row_key"
    while name in docs.columns:
        name += "_"
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(f"{name}file"), F.col("_metadata.row_index").alias(name))
    except AnalysisException:
        return _numbered(written(docs, "numbered"))
    # one row for each file
    files = sorted(r[0] for r in placed.select(f"{name}file").distinct().collect())
    order = docs.sparkSession.createDataFrame([(f, i * _FILE_ROWS) for i, f in enumerate(files)], f"`{name}file` string, `{name}from` long")
    joined = placed.join(F.broadcast(order), f"{name}file")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col(f"{name}from") + F.col(name)).alias(name)), name


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without those that the toxicity machine rejects (a score of 0.5 or more).

    The machine is trained on the labelled ones among all documents, so that it
    does not depend on what this stage is given.
    """
    every = read(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(every, read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, machine)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal contents: the longest original, then the smallest id."""
    return exact_dedup.exact_survivors(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the one with the smallest id, null ids last.

    Of rows of a group that share that id the first in its file stays. Documents
    without words are in no group and all stay.
    """
    keyed, key = _numbered(docs)
    found = jaccard_join.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), jaccard_join.Similarity(words=5, percent=80))
    ids = keyed.select(F.col(key).alias("row"), F.col("doc_id").alias("id")).join(
        found.select(F.col("doc_id").alias("row"), "component_id"), "row"
    )
    first = F.min_by("row", F.struct(F.col("id").isNull(), F.col("id"), F.col("row")))
    keep = ids.groupBy("component_id").agg(first.alias(key)).select(key)
    return keyed.join(keep, key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without those that contain any window of ten consecutive words of a benchmark item.

    Documents without words stay.
    """
    keyed, key = _numbered(docs)
    found = decontamination.decontaminate(keyed.select(F.col(key).alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    bad = found.where("size(hits) > 0").select(F.col("doc_id").alias(key))
    return keyed.join(bad, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of ``docs`` with their places in sequences of permitted lengths; an empty text is a piece of one token."""
    return packing.pack(docs)
