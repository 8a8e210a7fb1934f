"""From raw documents to encoded training text: each stage is one operator over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from zoneflow.llm.bpe import encode_documents, read_ranks
from zoneflow.llm.common import ship_package, table
from zoneflow.llm.line_templates import drop_recurring_lines
from zoneflow.llm.mixing import order_documents, place_documents
from zoneflow.llm.quality import clean_documents
from zoneflow.llm.simhash import drop_near_duplicates
from zoneflow.session import materialize

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, failing lines removed."""
    return clean_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs and stands in an earlier document already."""
    ship_package(spark)
    return drop_recurring_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class."""
    ship_package(spark)
    return drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in mixed order: part files follow the schedule, and so do the rows inside each."""
    return order_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their ids and what these decode to in place of their text, and ``mix_position``, from 0 without gaps.

    Files are read again in any order, so the place in the mixed order is worked out anew, by the same operator."""
    ship_package(spark)
    placed = place_documents(docs, "mix_position")
    return encode_documents(placed, read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN, decoded=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a table in the shared folder before the next one starts."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Near-duplicate classes are reachability over bit distances of XXH64 fingerprints, which DuckDB's SQL has no function for.
ORACLE_SQL = None
