"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import (
    backoff,
    byte_bpe,
    centroids,
    decontamination,
    iblt,
    language_id,
    licenses,
    line_dedup,
    pieces,
    simhash,
    spellings,
    token_files,
    toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": decontamination.op1_decontamination,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_backoff": backoff.op3_backoff,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_sentencepiece": pieces.op5_sentencepiece,
        "op6_fingerprints": iblt.op6_fingerprints,
        "op7_simhash": simhash.op7_simhash,
        "op8_licenses": licenses.op8_licenses,
        "op9_token_files": token_files.op9_token_files,
        "op10_language_id": language_id.op10_language_id,
        "op11_byte_bpe": byte_bpe.op11_byte_bpe,
        "op12_spellings": spellings.op12_spellings,
        "op13_centroids": centroids.op13_centroids,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontamination.ORACLE_SQL,
        "op3_backoff": backoff.ORACLE_SQL,
        "op4_line_dedup": line_dedup.ORACLE_SQL,
        "op8_licenses": licenses.ORACLE_SQL,
        "op12_spellings": spellings.ORACLE_SQL,
        "op13_centroids": centroids.ORACLE_SQL,
    }
