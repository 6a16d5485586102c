"""Exact duplicates by a content sort.

Rows are range-partitioned by their normalised bytes with splitters that Spark
samples, each partition is sorted (externally, if it has to spill), and equal
contents, now adjacent, are compared in full with their neighbours.

The sort key begins with a short prefix and a hash of the normalised text, so
that splitters stay small however long the texts are; the whole text decides.

Contents that more than one row in ``HOT_PARTS`` has get consecutive salts in
the key, so that splitters can fall inside them; each piece then names one
survivor, and the few pieces of a content are put together by full comparison.
How often a content occurs changes the route only, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.llm.common import shuffle_partitions
from leadloom.sources.scratch import written

# a content with a larger share than one in so many rows is cut into pieces of about that share;
# so there are fewer hot contents than this, whatever the table's size
HOT_PARTS = 4096
_PREFIX = 16


def normalised(text: Column) -> Column:
    """``text`` without white space (0x20, 0x09 to 0x0D); null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    for code in (0x20, 0x0A, 0x09, 0x0D, 0x0B, 0x0C):
        text = F.replace(text, F.lit(chr(code)))
    return text


def _hot_contents(rows: DataFrame) -> DataFrame:
    """``(h, pieces)`` of contents with many rows, at most ``HOT_PARTS`` by their definition."""
    counts = written(rows.groupBy("h").agg(F.count("*").alias("n")), "contents")
    total = max(counts.agg(F.sum("n")).first()[0] or 0, 1)
    hot = counts.where((F.col("n") * HOT_PARTS > total) & (F.col("n") > 1))
    return hot.select("h", F.ceil(F.col("n") * HOT_PARTS / total).cast("int").alias("pieces"))


_KEY = ["prefix", "h", "salt"]


def _placed(rows: DataFrame) -> DataFrame:
    """Rows in range partitions of their content, hot contents in several."""
    salted = rows.join(F.broadcast(_hot_contents(rows)), "h", "left")
    spread = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.col("pieces"))
    salted = salted.withColumn("salt", F.coalesce(spread.cast("int"), F.lit(0)))
    return salted.repartitionByRange(shuffle_partitions(rows.sparkSession), *_KEY)


def _order() -> list[Column]:
    return [F.desc("n_points"), F.asc_nulls_last("doc_id")]


def _rank() -> Column:
    return F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("salt"))


def exact_survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    The rows themselves are sorted, so nothing has to be joined to them afterwards.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("doc_id"),
        F.xxhash64(normalised(text)).alias("h"),
        F.left(normalised(text), F.lit(_PREFIX)).alias("prefix"),
        F.char_length(text).cast("long").alias("n_points"),
    )
    placed = _placed(rows).withColumn("norm", normalised(F.col(f"row.{text_col}")))
    place = F.row_number().over(Window.partitionBy(*_KEY, "norm").orderBy(*_order()))
    best = placed.withColumn("place", place).where("place = 1")
    best = best.select("row", "h", "doc_id", "n_points", "salt", F.col("pieces").isNotNull().alias("hot"))
    best = written(best, "runs")
    # the pieces of hot contents: at most two times HOT_PARTS rows
    pieces = best.where("hot").withColumn("norm", normalised(F.col(f"row.{text_col}")))
    winners = pieces.groupBy("h", "norm").agg(F.min(_rank()).alias("best"), F.min_by("row", _rank()).alias("row"))
    return best.where("NOT hot").select("row.*").unionByName(winners.select("row.*"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256, n_points)``, one row for each row of ``docs``.

    Equal are texts with the same bytes after white space is taken out; null and
    empty texts are equal. Of equal rows the one with the most code points in its
    original text stays, of those the smallest id (null ids last). Rows that
    repeat the id and the length of the survivor cannot be told from it by id;
    exactly one of them is kept. Other columns of ``docs`` play no part.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        normalised(F.col(text_col)).alias("norm"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_points"),
    ).withColumns({"h": F.xxhash64("norm"), "prefix": F.left("norm", F.lit(_PREFIX))})
    placed = _placed(rows)
    run = Window.partitionBy(*_KEY, "norm").orderBy(*_order())
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.row_number().over(run) == 1
    marked = placed.select(
        "doc_id",
        "n_points",
        "h",
        "salt",
        F.sha2("norm", 256).alias("text_sha256"),
        F.col("pieces").isNotNull().alias("hot"),
        first.alias("first"),
        F.first("doc_id").over(whole).alias("keep_id"),
        F.count("*").over(whole).alias("group_size"),
        # one text for each piece, to put the pieces of a content together
        F.when(first & F.col("pieces").isNotNull(), F.col("norm")).alias("norm"),
    )
    marked = written(marked, "runs")
    whole_groups = (
        marked.where("hot AND first")
        .groupBy("h", "norm")
        .agg(F.min(_rank()).alias("best"), F.sum("group_size").alias("size"), F.min("text_sha256").alias("text_sha256"))
    )
    # at most HOT_PARTS rows, one for each hot content
    whole_groups = whole_groups.select(
        "h", "text_sha256", F.col("best.doc_id").alias("best_id"), F.col("best.salt").alias("best_salt"), "size"
    )
    plain = marked.where("NOT hot").select(
        "doc_id", "keep_id", "group_size", F.col("first").alias("kept"), "text_sha256", "n_points"
    )
    pieces = marked.where("hot").drop("norm").join(F.broadcast(whole_groups), ["h", "text_sha256"])
    pieces = pieces.select(
        "doc_id",
        F.col("best_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("first") & (F.col("salt") == F.col("best_salt"))).alias("kept"),
        "text_sha256",
        "n_points",
    )
    return plain.unionByName(pieces)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_points,
  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS place,
  first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r"""
