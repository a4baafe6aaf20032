"""Cleaning a corpus for training: quality, near copies, repeated passages, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and the documents its predecessor kept; `run` writes each
stage's rows as Parquet to the shared folder and reads them back. Nulls, repeated rows, ties and extra
columns are treated as each operator's module says; an empty table runs through to an empty result.
SQL cannot express the trained stage, so tests hold the stages against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import bpe, mixture, quality, simhash, substrings
from marketlens.llm.store import reach_workers, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the trained model go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id.

    The shingle length and the bit distance are those of `op8_simhash`.
    """
    return simhash.deduplicate(docs, radius=2, size=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand in a document with a smaller doc_id are cut out."""
    return substrings.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, parts of them or repeats, so that sources meet their target weights."""
    return mixture.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, the byte each starts at, and the digest of the decoded bytes."""
    coded = bpe.decode(bpe.encode(docs, keep=["doc_id", "lang", "source"]))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"),
                        "ids", "offsets",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix_sources),
    ("byte-level bpe", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet before the next reads it."""
    reach_workers(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
