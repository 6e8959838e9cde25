"""Documents to training tokens: quality rules, exact dedup, near dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns
is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changelens.llm import bpe, exact_dedup, mixing, quality, simhash
from changelens.llm.common import table
from changelens.session import delete_paths, stage_path, stage_scope

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, of the largest doc_id."""
    return exact_dedup.one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, of the smallest doc_id."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the documents that are left.  A stage's own folders go when its
    result is written, and that goes when the next stage's is."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = stage_path(spark, name.replace(" ", "-"))
        with stage_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        delete_paths(spark, before)
        docs, before = spark.read.parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fingerprints, pivotal rounding and BPE can't be said in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None
