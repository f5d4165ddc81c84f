"""The queries and SQL that this subpackage registers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, jaccard, lines, neighbours, packing, quality, sites, suffix, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": chat.query,
        "op2_quality_classifier": sites.query,
        "op3_best_fit_packing": packing.query,
        "op4_ngram_jaccard": jaccard.query,
        "op5_line_dedup": lines.query,
        "op6_suffix_dedup": suffix.query,
        "op7_embedding_near_dup": neighbours.query,
        "op8_toxicity": toxicity.query,
        "op9_byte_bpe": bpe.query,
        "op10_quality_rules": quality.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": chat.SQL, "op10_quality_rules": quality.SQL}
