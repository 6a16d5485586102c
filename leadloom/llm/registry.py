"""Queries of the subpackage, and the SQL they are checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadloom.llm import (
    bpe_tree,
    decontamination,
    exact_dedup,
    fill_middle,
    html_extraction,
    jaccard_join,
    language_model,
    license_scan,
    packing,
    sharding,
    toxicity,
    vector_codes,
    warc,
)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_histogram_shards": sharding.query,
    "op2_jaccard_join": jaccard_join.query,
    "op3_crf_main_text": html_extraction.query,
    "op4_patience_licenses": license_scan.query,
    "op5_best_fit_packing": packing.query,
    "op6_maxent_scores": language_model.query,
    "op7_benchmark_index": decontamination.query,
    "op8_exact_dedup": exact_dedup.query,
    "op9_string_kernel_toxicity": toxicity.query,
    "op10_warc_segments": warc.query,
    "op11_fill_in_middle": fill_middle.query,
    "op12_bpe_tree": bpe_tree.query,
    "op13_vector_codes": vector_codes.query,
}
_ORACLES = {
    "op7_benchmark_index": decontamination.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op11_fill_in_middle": fill_middle.SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
