"""Candidate pairs by shared block keys."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.identity import block_keys, lead_name, phone_tail
from leadloom.functions.text import present
from leadloom.schema import MAX_BLOCK_SIZE
from leadloom.sources.scratch import written

# A key that more than one in this many leads has is hot. A lead has at most six
# keys, so there are fewer than six times as many hot keys.
HOT_SHARE = 2000


def block_sizes(leads: DataFrame) -> DataFrame:
    """``(kind, value, n)``, counted with partial sums in each task."""
    return block_keys(leads).groupBy("kind", "value").agg(F.count("*").alias("n"))


def blocks(leads: DataFrame, max_block_size: int = MAX_BLOCK_SIZE) -> DataFrame:
    """``(kind, value, ids)`` of blocks that propose pairs, with sorted ids.

    A block proposes pairs if it has two to ``max_block_size`` leads. Larger ones
    propose none by definition: a shared value that common says little. Their
    rows are taken out in two steps. Keys that more than one in 2000 leads has
    are dropped on the map side by a broadcast anti join; fewer than 12000 such
    keys can exist, however large the table. The rest are dropped after the
    shuffle, by a semi join with the counts, which are partitioned alike
    already. No list of ids is built for a block that has too many.
    """
    keys = block_keys(leads)
    sizes = block_sizes(leads)
    total = leads.agg(F.count("*")).scalar()
    hot = sizes.where((F.col("n") > max_block_size) & (F.col("n") * HOT_SHARE > total))
    paired = sizes.where(F.col("n").between(2, max_block_size))
    members = keys.join(F.broadcast(hot), ["kind", "value"], "left_anti").join(
        paired, ["kind", "value"], "left_semi"
    )
    return members.groupBy("kind", "value").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def partners(leads: DataFrame, max_block_size: int = MAX_BLOCK_SIZE) -> DataFrame:
    """``(id_a, ids_b)``: for each lead its distinct partners with a larger id.

    A lead sits in at most six blocks, so a row holds at most
    ``6 * (max_block_size - 1)`` partners. Pairs that share several blocks come
    out once, and one shuffle on ``id_a`` serves both this and the join with
    the lead that follows.
    """
    placed = blocks(leads, max_block_size).select("ids", F.posexplode("ids").alias("pos", "id_a"))
    later = placed.where(F.col("pos") + 1 < F.size("ids")).select(
        "id_a", F.slice("ids", F.col("pos") + 2, F.size("ids")).alias("later")
    )
    return later.groupBy("id_a").agg(F.array_distinct(F.flatten(F.collect_list("later"))).alias("ids_b"))


def candidate_pairs(leads: DataFrame, max_block_size: int = MAX_BLOCK_SIZE) -> DataFrame:
    """Distinct ``(id_a, id_b)`` with ``id_a < id_b`` that share a block."""
    return partners(leads, max_block_size).select("id_a", F.explode("ids_b").alias("id_b"))


def candidate_pair_count(leads: DataFrame, max_block_size: int = MAX_BLOCK_SIZE) -> DataFrame:
    """One row: number of pairs considered, before any confidence cut."""
    sizes = partners(leads, max_block_size).select(F.size("ids_b").alias("n"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("candidate_pairs_considered"))


def oversized_blocks(leads: DataFrame, max_block_size: int = MAX_BLOCK_SIZE) -> DataFrame:
    """``(kind, value, n, pairs_not_compared)`` of the blocks that propose no pairs for being too large.

    The bound is a rule of the blocking, not of this engine; this says what it leaves out.
    """
    n = F.col("n")
    return block_sizes(leads).where(n > max_block_size).select(
        "kind", "value", "n", (n * (n - 1) / 2).cast("bigint").alias("pairs_not_compared")
    )


# what leads are compared by; those alike in all of it are alike to every rule
_COMPARED = ["phone_normalized", "email_normalized", "company_normalized", "country"]
# values by which a part is split at most; what is still too large then is listed
MAX_SPLITS = 8


def representatives(leads: DataFrame) -> DataFrame:
    """``(id, representative, members)``: for each lead the smallest id of those alike in all that is compared.

    Empty and missing values are the same. A value that many leads share is
    reduced by partial minima; the join back is one that Spark splits if skewed.
    """
    alike = [F.coalesce(F.col(c), F.lit("")).alias(f"_{c}") for c in _COMPARED]
    rows = leads.select("id", F.coalesce(lead_name(), F.lit("")).alias("_name"), *alike)
    same = [c for c in rows.columns if c != "id"]
    first = rows.groupBy(*same).agg(F.min("id").alias("representative"), F.count("*").alias("members"))
    return rows.join(first, same).select("id", "representative", "members")


def _marks() -> Column:
    """Second values of a lead: the end of its phone, its mailbox, the words of its name and company."""
    local = F.substring_index(present(F.col("email_normalized")), "@", 1)
    marks = F.concat(
        F.array(F.concat(F.lit("p "), phone_tail(present(F.col("phone_normalized"))))),
        F.array(F.concat(F.lit("e "), local)),
        F.transform(F.split(F.coalesce(lead_name(), F.lit("")), " "), lambda w: F.concat(F.lit("n "), w)),
        F.transform(F.split(F.coalesce("company_normalized", F.lit("")), " "), lambda w: F.concat(F.lit("c "), w)),
    )
    return F.array_distinct(F.filter(marks, lambda m: F.char_length(m) > 2))


_PART = ["kind", "value", "marks"]


@dataclass
class Refined:
    """Outcome of splitting oversized blocks: pairs to compare, copies, and what stays uncompared."""

    pairs: DataFrame
    copies: DataFrame
    uncompared: DataFrame


def refine_blocks(leads: DataFrame, max_block_size: int = MAX_BLOCK_SIZE) -> Refined:
    """Splits blocks with more than ``max_block_size`` leads until their parts fit.

    Leads alike in all that is compared are one: ``copies (id, representative)``
    names the smallest id for each other one, and only representatives are split.
    A block with few enough of them is one part. A larger one has a part for every
    mark (see ``_marks``) that some but not all of its leads have, a part that is
    still too large one for every further mark, and so on. ``pairs (id_a, id_b)``
    are those of all parts that fit: of two leads of a block whenever at most
    ``max_block_size`` of it have all the marks that the two share, and they share
    one. ``uncompared (kind, value, marks, n)`` lists what cannot be split: more leads
    of a block than that with just the same marks, and parts that ``MAX_SPLITS`` marks
    have not brought down. Two leads that share nothing but marks of more leads than
    that are not compared, as two that share only a large block are not.

    Parts are counted before ids are collected, at most ``max_block_size`` each.
    """
    known = representatives(leads)
    copies = known.where("id <> representative").select("id", "representative")
    alone = written(leads.join(known.where("id = representative").select("id"), "id", "left_semi"), "alone")
    marks = written(alone.select("id", _marks().alias("own")), "marks")
    large = oversized_blocks(leads, max_block_size).select("kind", "value")
    start = block_keys(alone).join(large, ["kind", "value"], "left_semi")
    none = F.array().cast("array<string>").alias("marks")
    members = written(start.select("kind", "value", none, "id"), "parts")
    same = start.join(marks, "id").groupBy("kind", "value", F.array_sort("own").alias("marks")).agg(F.count("*").alias("n"))
    pairs, stuck = [], [same.where(F.col("n") > max_block_size)]
    for depth in range(MAX_SPLITS + 1):
        sizes = members.groupBy(*_PART).agg(F.count("*").alias("n"))
        fits = members.join(sizes.where(F.col("n").between(2, max_block_size)).select(*_PART), _PART, "left_semi")
        inside = fits.groupBy(*_PART).agg(F.array_sort(F.collect_list("id")).alias("ids"))
        placed = inside.select("ids", F.posexplode("ids").alias("pos", "id_a"))
        later = F.slice("ids", F.col("pos") + 2, F.size("ids"))
        pairs.append(written(placed.select("id_a", F.explode(later).alias("id_b")).distinct(), "pairs"))
        over = written(sizes.where(F.col("n") > max_block_size), "over")
        if over.isEmpty():
            break
        if depth == MAX_SPLITS:
            stuck.append(over)
            break
        held = members.join(over.withColumnRenamed("n", "above"), _PART).join(marks, "id")
        longer = held.select("kind", "value", "marks", "above", "id", F.explode(F.array_except("own", "marks")).alias("mark"))
        longer = longer.withColumnRenamed("marks", "parent")
        grown = longer.withColumn("marks", F.array_sort(F.array_append("parent", F.col("mark"))))
        # a mark that all of a part have splits nothing
        count = grown.groupBy("kind", "value", "parent", "marks").agg(F.count("*").alias("n"), F.first("above").alias("above"))
        # the same part may be reached by its marks in another order
        children = count.where("n < above").select(*_PART).distinct()
        members = written(grown.select(*_PART, "id").distinct().join(children, _PART, "left_semi"), "parts")
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return Refined(union(pairs).distinct(), copies, union(stuck))


def refined_pairs(leads: DataFrame, max_block_size: int = MAX_BLOCK_SIZE) -> DataFrame:
    """Distinct ``(id_a, id_b)``: the candidate pairs, those of the parts of oversized blocks, and copies.

    A lead that is a copy is linked with its representative, not with every other
    copy. See ``refine_blocks``.
    """
    refined = refine_blocks(leads, max_block_size)
    linked = refined.copies.select(F.col("representative").alias("id_a"), F.col("id").alias("id_b"))
    return candidate_pairs(leads, max_block_size).unionByName(refined.pairs).unionByName(linked).distinct()


def uncompared_parts(leads: DataFrame, max_block_size: int = MAX_BLOCK_SIZE) -> DataFrame:
    """``(kind, value, marks, n)`` of the parts of oversized blocks that could not be split until they fit."""
    return refine_blocks(leads, max_block_size).uncompared
