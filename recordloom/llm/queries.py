"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, filter_audit, flac, html_extract, lm_score, near_dup, packing, personal, quality, secret_scan, sharding, token_align


def _over(query: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": _over(secret_scan.query, "documents"),
        "op2_quality_mil": _over(quality.query, "documents", "labels"),
        "op3_benchmark_decontamination": _over(decontaminate.query, "documents", "benchmark"),
        "op4_minhash_near_dup": _over(near_dup.query, "documents"),
        "op5_lm_score": _over(lm_score.query, "documents"),
        "op6_chat_perspectives": _over(chat.query, "conversations"),
        "op7_html_template": _over(html_extract.query, "pages"),
        "op8_flac_media": _over(flac.query, "documents"),
        "op9_extendible_sharding": _over(sharding.query, "documents"),
        "op10_harmonic_packing": _over(packing.query, "documents"),
        "op11_filter_audit": _over(filter_audit.query, "documents", "labels"),
        "op12_token_align": _over(token_align.query, "documents"),
        "op13_personal_data": _over(personal.query, "documents"),
    }


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express; the others are tested by brute force or round trip."""
    return {"op6_chat_perspectives": chat.SQL, "op9_extendible_sharding": sharding.SQL, "op11_filter_audit": filter_audit.SQL}
