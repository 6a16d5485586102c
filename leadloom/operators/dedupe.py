"""Likely duplicates among leads, with a confidence and the reasons for it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.functions.identity import lead_summary, scoring_fields
from leadloom.functions.similarity import prefixed, rounded, score_pairs, signals
from leadloom.operators.blocking import partners
from leadloom.schema import LIST_CONFIDENCE, MAX_BLOCK_SIZE
from leadloom.sources.scratch import written

_SCORES = ["name_score", "company_score", "email_score", "phone_score", "country_score"]


def hydrated_pairs(leads: DataFrame, max_block_size: int = MAX_BLOCK_SIZE) -> DataFrame:
    """Candidate pairs with the scoring fields of both leads."""
    fields = scoring_fields(leads)
    left = partners(leads, max_block_size).join(prefixed(fields, "a"), F.col("id_a") == F.col("a_id"))
    pairs = left.select("*", F.explode("ids_b").alias("_b")).drop("ids_b", "id_a")
    return pairs.join(prefixed(fields, "b"), F.col("_b") == F.col("b_id")).drop("_b")


def pair_scores(
    leads: DataFrame, min_confidence: float | None = None, max_block_size: int = MAX_BLOCK_SIZE
) -> DataFrame:
    """``(id_a, id_b, score)`` and the five signal scores of every candidate pair."""
    scored = score_pairs(hydrated_pairs(leads, max_block_size), min_confidence)
    return scored.select(
        F.col("a_id").alias("id_a"), F.col("b_id").alias("id_b"), "score", *_SCORES, "same_email", "same_phone"
    )


def scored_candidates(
    leads: DataFrame, min_confidence: float = LIST_CONFIDENCE, max_block_size: int = MAX_BLOCK_SIZE
) -> DataFrame:
    """``(id_a, id_b, score, confidence, reason, signals)`` at or above the cut.

    The cut is on the unrounded score.
    """
    if not 0.0 <= min_confidence <= 1.0:
        raise ValueError("min_confidence must be between 0 and 1")
    scored = pair_scores(leads, min_confidence, max_block_size).withColumn("signals", signals())
    return scored.select(
        "id_a",
        "id_b",
        "score",
        rounded(F.col("score")).alias("confidence"),
        F.array_join("signals", "; ").alias("reason"),
        "signals",
    )


def dedupe_candidates(
    leads: DataFrame, min_confidence: float = LIST_CONFIDENCE, max_block_size: int = MAX_BLOCK_SIZE
) -> DataFrame:
    """Likely duplicates, most confident first, with a summary of both leads.

    Leads are not merged. Summaries are joined to the surviving pairs only, which
    are written first: sorting takes a sample before it runs, and would score
    every pair twice. Equal confidences are in order of the two ids.
    """
    found = written(scored_candidates(leads, min_confidence, max_block_size), "survivors")
    summary = lead_summary(leads)
    nested = summary.select(F.col("id"), F.struct(*summary.columns).alias("lead"))
    a = nested.select(F.col("id").alias("id_a"), F.col("lead").alias("lead_a"))
    b = nested.select(F.col("id").alias("id_b"), F.col("lead").alias("lead_b"))
    return (
        found.join(a, "id_a")
        .join(b, "id_b")
        .orderBy(F.desc("confidence"), "id_a", "id_b")
        .select("lead_a", "lead_b", "confidence", "reason", "signals")
    )
