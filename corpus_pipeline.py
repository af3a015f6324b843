"""From raw documents to packed training sequences, in stages over whole tables.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor
kept, and its result is written before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import mixing, near_copies, packing, quality_rules, simhash, suffix_dedup
from textloom.llm.common import table
from textloom.llm.queries import vocabulary_path
from textloom.plans.storage import materialise


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return quality_rules.select_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of five-word shingle sets at least 0.8 alike, found by SimHash and, beyond its reach, MinHash."""
    return simhash.keep_first(docs, find=near_copies.near_copies)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur elsewhere too; every document stays."""
    return suffix_dedup.strip_repeats(docs, length_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources again as far as their weight reaches."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(docs.select("doc_id", "source", "text"), vocabulary_path(), ["doc_id"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", drop_low_quality),
    ("near duplicates", drop_near_copies),
    ("repeated passages", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The tokenizer cannot be expressed in SQL; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
