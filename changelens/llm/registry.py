"""Queries of this package, each over its whole table, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from changelens.llm import (
    alignment, bpe, chat, collocations, exact_dedup, hilbert, html_content, langid, mixing, quality, simhash, token_counts, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": simhash.query,
    "op2_exact_dedup": exact_dedup.query,
    "op3_hilbert_sharding": hilbert.query,
    "op4_html_content": html_content.query,
    "op5_quality_rules": quality.query,
    "op6_bpe_round_trip": bpe.query,
    "op7_language_id": langid.query,
    "op8_source_mixing": mixing.query,
    "op9_chat_format": chat.query,
    "op10_token_counts": token_counts.query,
    "op11_warc_segments": warc.query,
    "op12_token_alignment": alignment.query,
    "op13_collocations": collocations.query,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op5_quality_rules": quality.SQL,
    "op9_chat_format": chat.SQL,
    "op11_warc_segments": warc.SQL,
    "op13_collocations": collocations.SQL,
}
