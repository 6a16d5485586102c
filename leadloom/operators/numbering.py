"""Consecutive numbers over a distributed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# rows of one stretch of the order are numbered together in one task
STRETCH = 1 << 17


# stretches, and groups of such, whose counts one task puts in order
_FAN = 1 << 15


def stretch_offsets(rows: DataFrame, order: str) -> DataFrame:
    """``(stretch, before, n)``: how many rows precede each stretch of ``order``, and how many it has.

    Stretches are fixed ranges of the order column, so a rerun after a lost
    executor finds the same ones. Counts are added up in groups of ``_FAN``
    stretches, and groups of ``_FAN`` groups, so however far apart the values of a
    64-bit number lie, no task puts more than some ``_FAN`` counts in order.
    """
    counts = rows.groupBy(F.floor(F.col(order) / STRETCH).alias("stretch")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("group", F.floor(F.col("stretch") / _FAN)).withColumn("top", F.floor(F.col("group") / _FAN))
    groups = counts.groupBy("top", "group").agg(F.sum("n").alias("n"))
    tops = groups.groupBy("top").agg(F.sum("n").alias("n"))
    # a 64-bit number has at most _FAN tops
    offsets = tops.select("top", _before(Window.orderBy("top")).alias("above"))
    groups = groups.withColumn("within", _before(Window.partitionBy("top").orderBy("group")))
    groups = groups.join(F.broadcast(offsets), "top").select("group", (F.col("above") + F.col("within")).alias("above"))
    counts = counts.withColumn("within", _before(Window.partitionBy("group").orderBy("stretch"))).drop("top")
    return counts.join(groups, "group").select("stretch", (F.col("above") + F.col("within")).alias("before"), "n")


def _before(order: Window) -> Column:
    """The sum of ``n`` over the rows before."""
    return F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def number_rows(rows: DataFrame, order: str, name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in ascending ``order`` (a unique whole number).

    No global sort and no single-task window over the rows themselves.
    """
    offsets = stretch_offsets(rows, order).drop("n")
    staged = rows.withColumn("stretch", F.floor(F.col(order) / STRETCH))
    place = F.row_number().over(Window.partitionBy("stretch").orderBy(order))
    return (
        staged.withColumn("_place", place)
        .join(offsets, "stretch")
        .withColumn(name, F.col("before") + F.col("_place") - 1)
        .drop("stretch", "before", "_place")
    )
